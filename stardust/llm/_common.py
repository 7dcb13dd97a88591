"""Small helpers shared by the training-data operators: row identity, prefix
sums in a total order, connected components, and vectorised word hashing."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def word_count(text: Column) -> Column:
    """Number of words of a text; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, str], label: str) -> DataFrame:
    """``df`` written once in the total order ``order`` with, for each
    ``new: column`` of ``sums``, the sum of ``column`` (long or double) over all
    rows before the row.

    The rows are range-partitioned; each task adds up its own rows as they
    stream by, and one row per partition carries its total into the offsets of
    the later ones. No task sees more than its range.
    """
    spark = df.sparkSession
    news = list(sums)
    pid, schema = "_range", df.schema
    out = T.StructType(schema.fields + [T.StructField(pid, T.IntegerType())]
                       + [T.StructField(n, schema[sums[n]].dataType) for n in news])
    names = [f.name for f in out.fields]

    def run(batches):
        at = dict.fromkeys(news, 0)
        for b in batches:
            if not b.num_rows:
                continue
            cols = b.columns
            for n in news:
                v = b.column(sums[n]).to_numpy(zero_copy_only=False)
                before = np.cumsum(v) - v + at[n]
                at[n] = before[-1] + v[-1]
                cols.append(pa.array(before))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(pid, F.spark_partition_id())
    done = materialize(ranged.mapInArrow(run, out), label)
    offs = done.groupBy(pid).agg(*[F.max(F.col(n) + F.col(sums[n])).alias(f"_t_{n}") for n in news])
    w = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offs = offs.select(F.col(pid).alias("_at"), *[F.coalesce(F.sum(f"_t_{n}").over(w), F.lit(0)).alias(f"_o_{n}") for n in news])
    j = done.join(offs, done[pid] == offs["_at"])
    return j.select(*[done[c] for c in df.columns], *[(done[n] + offs[f"_o_{n}"]).alias(n) for n in news])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, component)`` for every id of the links ``edges(a, b)`` (longs):
    the smallest id that the links reach.

    Alternating large-star and small-star steps: every round is two
    aggregations over the edges, a hub is spread by its neighbours' labels, and
    the number of rounds grows with the logarithm of the longest chain. Each
    round is written to the shared folder.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    last = None
    while True:
        # large star: every larger neighbour of u is linked to the smallest label around u
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the smaller neighbours of u, and u, are linked to the smallest of them
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low2, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = materialize(small, label)
        state = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == last:
            return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        last = state


# --- vectorised words ---------------------------------------------------------------------

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array end to end, and where each text begins."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on a batch that goes to Python holds about 4 MB, not 10,000 rows
    of any length (unless the session names another bound)."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, str(4 << 20))
    return df


def slices(batches, column: str, most_bytes: int = 1 << 20, inside: str | None = None, most_rows: int = 1 << 30):
    """Arrow batches cut so that ``column`` (or the field of that name of the struct
    ``inside``) holds about ``most_bytes`` of text in each (a single longer text
    stays whole), and ``most_rows`` rows."""
    try:
        for b in batches:
            if not b.num_rows:
                continue
            off = text_bytes(b.column(column) if inside is None else b.column(inside).field(column))[1]
            at = 0
            while at < b.num_rows:
                to = min(at + most_rows, max(at + 1, int(np.searchsorted(off, off[at] + most_bytes, "right")) - 1))
                yield b.slice(at, to - at)
                at = to
    finally:
        give_back()


def give_back() -> None:
    """Returns the memory that a task's arrays had to the system: a worker serves many
    tasks, of other stages too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
    if trim:
        trim(0)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every text of an Arrow string array:
    ``start`` and ``end`` (byte positions in ``data``), ``first`` (index of each
    text's first word, one longer than the array) and ``hash`` (64 bits)."""

    def __init__(self, arr: pa.Array, fold_ascii: bool = False):
        data, off = text_bytes(arr)
        if fold_ascii:
            lut = np.arange(256, dtype=np.uint8)
            lut[65:91] += 32
            data = lut[data]
        self.data, self.off = data, off
        inside = ~_BLANK[data]
        begin = inside.copy()
        edge = off[(off > 0) & (off < len(data))]
        if len(data) > 1:
            apart = ~inside[:-1]
            apart[edge - 1] = True
            begin[1:] &= apart
        self.start = np.flatnonzero(begin)
        stop = inside
        if len(data) > 1:
            apart = ~inside[1:]
            apart[edge - 1] = True
            stop = inside.copy()
            stop[:-1] &= apart
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, off)
        self.hash = self._hash(inside, begin)

    def _hash(self, inside, begin):
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lens = self.end - self.start
        power = np.cumprod(np.full(int(lens.max()), _BASE, np.uint64), dtype=np.uint64)
        at = np.flatnonzero(inside)
        firsts = np.cumsum(lens) - lens
        place = np.arange(len(at)) - np.repeat(firsts, lens)
        sums = np.add.reduceat(_BYTE[self.data[at]] * power[place], firsts)
        return mix(sums + lens.astype(np.uint64))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``k``-word windows of every text, in order, and each
        text's first index; a text of fewer words (but some) has one, its whole
        sequence."""
        h, first = self.hash, self.first
        n = np.diff(first)
        count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
        begin = np.concatenate([[0], np.cumsum(count)])
        total = int(begin[-1])
        if not total:
            return np.zeros(0, np.uint64), begin
        src = np.arange(total) - np.repeat(begin[:-1] - first[:-1], count)
        acc = np.zeros(total, np.uint64)
        left = np.repeat(first[1:], count)
        for j in range(k):
            at = src + j
            ok = at < left
            nxt = mix(acc * _BASE + h[np.minimum(at, len(h) - 1)] + np.uint64(j + 1))
            acc = np.where(ok, nxt, acc)
        return acc, begin
