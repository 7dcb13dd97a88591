"""Token ids in files of independent blocks, coded by a static range asymmetric
numeral system.

``write_ids`` puts the documents in ascending order of their key, turns them into
ids, counts every id of the corpus (the shared frequency table) and codes blocks
of consecutive documents. The format is a folder:

* ``table``  (Parquet) ``id, freq``: frequencies that add up to 2**20, each at
  least 1; one row per id that occurs.
* ``blocks/part=P`` (Parquet), one row per block: ``first`` (number of its first
  document in the part), ``keys`` (or null), ``lengths`` (ids of each document),
  ``lanes``, ``payload`` (32-bit words), ``states`` (64-bit, of each lane) and
  ``marks`` (word positions), one set for each checkpoint, ``payload_crc``,
  ``ids_crc``. Parts, ``first`` and the documents of a block ascend by key.

A block's ids are dealt to ``lanes`` coders in turn, whose words share one
payload. A checkpoint every ``EVERY`` steps holds all lanes' states, so that a
block can be decoded from any of them. ``read_ids`` decodes blocks in parallel,
checks both checksums and returns the documents.

Defined results: a null text is the empty text (the end id alone); a null key
comes first; rows that repeat are documents of their own; a very long document
is one block; an empty table gives empty files and an empty result. Of the input
only the key and the text are written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ._common import bounded_batches, slices
from ._tokens import SLICE, encoder
from ._tokens import tokenizer as vocabulary

BITS = 20
LOW = 31                 # states are 2**31 or more between steps
LANES = 1024
EVERY = 128              # steps between checkpoints
BLOCK = 1 << 18          # ids of a block, but for its last document
END = 0
U = np.uint64


def table(counts: dict[int, int], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and frequencies that add up to 2**bits, each 1 or more."""
    ids = np.array(sorted(counts), np.int64)
    n = np.array([counts[i] for i in ids], np.float64)
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    if len(ids) > 1 << bits:
        raise ValueError("more ids than the table has room for")
    freq = 1 + np.floor(n / n.sum() * ((1 << bits) - len(ids))).astype(np.int64)
    freq[np.argmax(n)] += (1 << bits) - freq.sum()
    return ids, freq


class Coder:
    """Codes arrays of ids with one frequency table."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids = ids.astype(np.uint32)
        self.freq = freq.astype(np.uint64)
        self.low = (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(ids), dtype=np.uint32), freq)
        # Where an id is in the table; past its end for one that is not there, which fails.
        self.place = np.full(int(ids[-1]) + 1 if len(ids) else 0, len(ids), np.uint32)
        self.place[ids] = np.arange(len(ids), dtype=np.uint32)

    def encode(self, ids: np.ndarray) -> dict:
        n = len(ids)
        lanes = int(min(LANES, max(1, n // 64)))
        steps = -(-n // lanes)
        sym = self.place[ids]
        f, c = self.freq[sym], self.low[sym]
        x = np.full(lanes, 1 << LOW, U)
        words, states = [], []
        for t in range(steps - 1, -1, -1):
            at = slice(t * lanes, min(n, (t + 1) * lanes))
            k = at.stop - at.start
            own, ft = x[:k], f[at]
            full = (own >> U(LOW + 32 - BITS)) >= ft
            words.append((own[full] & U(0xFFFFFFFF)).astype("<u4"))
            own = np.where(full, own >> U(32), own)
            q = own // ft
            x[:k] = (q << U(BITS)) + (own - q * ft) + c[at]
            if t % EVERY == 0:
                states.append(x.copy())
        words.reverse()
        sizes = np.cumsum([0] + [len(w) for w in words])
        payload = np.concatenate(words) if words else np.zeros(0, "<u4")
        return {"lanes": lanes, "payload": payload.tobytes(), "states": np.concatenate(states[::-1]).astype("<u8").tobytes() if states else b"",
                "marks": [int(sizes[t]) for t in range(0, steps, EVERY)], "payload_crc": zlib.crc32(payload), "ids_crc": zlib.crc32(ids.astype("<u4"))}

    def decode(self, block: dict, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids from checkpoint ``first`` up to checkpoint ``last`` (the end)."""
        lanes, words = block["lanes"], np.frombuffer(block["payload"], "<u4").astype(U)
        steps = -(-n // lanes)
        t0, t1 = first * EVERY, steps if last is None else min(steps, last * EVERY)
        x = np.frombuffer(block["states"], "<u8")[first * lanes:(first + 1) * lanes].astype(U)
        at, got = block["marks"][first] if steps else 0, np.empty(max(0, min(n, t1 * lanes) - t0 * lanes), np.uint32)
        for t in range(t0, t1):
            k = min(n, (t + 1) * lanes) - t * lanes
            own = x[:k]
            low = own & U((1 << BITS) - 1)
            s = self.slot[low]
            got[(t - t0) * lanes:(t - t0) * lanes + k] = s
            own = self.freq[s] * (own >> U(BITS)) + low - self.low[s]
            need = np.flatnonzero(own < U(1 << LOW))
            if len(need):
                own[need] = (own[need] << U(32)) | words[at:at + len(need)]
                at += len(need)
            x[:k] = own
        return self.ids[got]


def planes(ids: np.ndarray, width: int = 4) -> bytes:
    """Ids of ``width`` bytes (2 or 4) byte plane by byte plane (compresses better than id by id)."""
    return np.ascontiguousarray(ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(raw: bytes, width: int = 4) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").reshape(-1)


def write_ids(df: DataFrame, tokenizer: str, path: str, end: int = END, block: int = BLOCK) -> None:
    """Writes the ids of every ``text`` of ``df(key, text)``, each with ``end``
    after it, in ascending order of ``key`` (a long) to the folder ``path``."""
    spark = df.sparkSession
    width = 2 if max(end, *vocabulary(tokenizer).get_vocab().values()) < 1 << 16 else 4  # bytes of an id between the passes
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ranged = df.select("key", "text").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def coded(batches):
        enc, nth = encoder(tokenizer), {}
        for b in slices(batches, "text", SLICE):
            ids, off = enc.encode(b.column("text"))
            part = b.column("part").to_numpy()
            raw, number = [], []
            for i in range(b.num_rows):
                raw.append(planes(np.append(ids[off[i]:off[i + 1]], np.uint32(end)), width))
                number.append(nth.get(part[i], 0))
                nth[part[i]] = number[-1] + 1
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(number, pa.int64()), b.column("key"), pa.array(raw, pa.binary())],
                                             names=["part", "nth", "key", "ids"])

    rows = scratch_path(spark, "rans-ids")
    bounded_batches(ranged).mapInArrow(coded, "part int, nth long, key long, ids binary").write.option("compression", "zstd").parquet(rows)
    rows = spark.read.parquet(rows)

    def counted(batches):
        n = np.zeros(0, np.int64)
        for b in batches:
            if b.num_rows:
                c = np.bincount(np.concatenate([from_planes(raw, width) for raw in b.column("ids").to_pylist()]), minlength=len(n))
                c[:len(n)] += n
                n = c
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["id", "n"])

    # one row per id of the vocabulary, whatever the corpus
    counts = rows.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ids, freq = table({r.id: r.n for r in counts})
    spark.createDataFrame(list(zip(ids.tolist(), freq.tolist())), "id long, freq long").coalesce(1).write.parquet(f"{path}/table")

    def blocks(batches):
        coder = Coder(ids, freq)
        held, size, names = [], 0, ["part", "first", "keys", "lengths", "lanes", "payload", "states", "marks", "payload_crc", "ids_crc"]

        def flush():
            own = [x[3] for x in held]
            c = coder.encode(np.concatenate(own))
            cols = [[held[0][0]], [held[0][1]], [[x[2] for x in held]], [[len(x) for x in own]], *[[c[n]] for n in names[4:]]]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=names)

        for b in batches:
            for part, nth, key, raw in zip(*[b.column(c).to_pylist() for c in ("part", "nth", "key")], b.column("ids")):
                if held and (size >= block or held[-1][0] != part or held[-1][1] + 1 != nth):
                    yield flush()
                    held, size = [], 0
                held.append((part, nth, key, from_planes(raw.as_py(), width)))
                size += len(held[-1][3])
        if held:
            yield flush()

    rows.mapInArrow(blocks, "part int, first long, keys array<long>, lengths array<long>, lanes int, payload binary, states binary, "
                            "marks array<long>, payload_crc long, ids_crc long").write.partitionBy("part").option("compression", "none").parquet(f"{path}/blocks")


FORMAT = ("first long, keys array<long>, lengths array<long>, lanes int, payload binary, states binary, marks array<long>, "
          "payload_crc long, ids_crc long, part int")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a folder: ``part``, ``first`` (of the block), ``nth`` (in the
    part), ``in_block`` (ids before it in its block), ``key``, ``n``, ``ids_crc32`` and, if wanted, ``ids`` (little-endian 32-bit)."""
    rows = spark.read.schema("id long, freq long").parquet(f"{path}/table").orderBy("id").collect()  # one row per id of the vocabulary
    ids, freq = np.array([r.id for r in rows], np.int64), np.array([r.freq for r in rows], np.int64)
    stored = spark.read.schema(FORMAT).parquet(f"{path}/blocks")

    def decoded(batches):
        coder = Coder(ids, freq)
        for b in batches:
            for r in b.to_pylist():
                got = coder.decode(r, sum(r["lengths"]))
                if zlib.crc32(r["payload"]) != r["payload_crc"] or zlib.crc32(got) != r["ids_crc"]:
                    raise ValueError(f"block {r['part']}:{r['first']} is damaged")
                stop = np.cumsum(r["lengths"])
                own = [got[e - n:e] for e, n in zip(stop, r["lengths"])]
                k = len(own)
                cols = [pa.array([r["part"]] * k, pa.int32()), pa.array([r["first"]] * k, pa.int64()), pa.array(np.arange(k) + r["first"]),
                        pa.array(stop - r["lengths"], pa.int64()), pa.array(r["keys"], pa.int64()), pa.array(r["lengths"], pa.int64()),
                        pa.array([zlib.crc32(x) for x in own], pa.int64())]
                if with_ids:
                    cols.append(pa.array([x.astype("<u4").tobytes() for x in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["part", "first", "nth", "in_block", "key", "n", "ids_crc32", "ids"][:len(cols)])

    # a batch of one block: its payload and its ids are all that a task holds
    return stored.mapInArrow(decoded, "part int, first long, nth long, in_block long, key long, n long, ids_crc32 long" + ", ids binary" * with_ids)


def starts(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``start``: the ids of all documents before each. The running
    sum goes within parts; one row per part carries the parts' totals."""
    spark = docs.sparkSession
    lens = spark.read.schema(FORMAT).parquet(f"{path}/blocks").select("part", "first", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
    before = Window.partitionBy("part").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    lens = lens.withColumn("within", F.coalesce(F.sum("total").over(before), F.lit(0)))
    parts = lens.groupBy("part").agg(F.sum("total").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = parts.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    lens = lens.join(parts, "part").select("part", "first", (F.col("ahead") + F.col("within")).alias("block_start"))
    return docs.join(lens, ["part", "first"]).withColumn("start", F.col("block_start") + F.col("in_block"))


def op9_rans(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "rans-files")
    write_ids(docs.select(F.col("doc_id").alias("key"), "text"), public_tokenizers.path("byte_bpe_50k.json"), path)
    got = starts(read_ids(spark, path, with_ids=False), path)
    return got.select(F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), "ids_crc32")
