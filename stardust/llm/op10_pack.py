"""Best-fit packing of pieces into sequences under several capacities at once.

Every item has a vector of sizes (tokens, documents, attention cost) and every
sequence a residual of each capacity. Items are dealt by a hash of their row
number into groups of about ``GROUP`` rows; each group packs its items, largest
first, into the sequence that can take the item in every dimension and leaves
the smallest weighted residual norm (``rule="norm"``) or has the largest
weighted dot product of item and residual (``rule="dot"``). The few sequences
that a group leaves half empty are packed again, as items, across groups.

Defined results: a null text is the empty text, one piece with the end id alone;
a text is never shortened, one of more tokens than a sequence is cut into full
pieces and a last one; an item larger than a capacity has a sequence of its own;
rows that repeat are items of their own; an empty table gives an empty result;
columns of the input but the text are passed on unless they have the name of a
result column.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ._common import bounded_batches, slices
from ._tokens import SLICE, encoder

TOKENS = 2048                # of a sequence
DOCUMENTS = 2048             # pieces of a sequence
ATTENTION = TOKENS * TOKENS  # sum of squared lengths of a sequence
CAPACITY = (TOKENS, DOCUMENTS, ATTENTION)
WEIGHTS = (1.0, 0.05, 0.1)
GROUP = 20_000
END = 0
OUT = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pieces(df: DataFrame, tokenizer: str, most: int = TOKENS, end: int = END, text: str = "text") -> DataFrame:
    """Every row of ``df``, without its text, once per piece of at most ``most``
    ids of its text (ids of the ``tokenizer`` file, then ``end``): ``piece``,
    ``start`` (ids before it), ``length``, ``ids_crc32`` and ``ids`` (bytes)."""
    kept = [c for c in df.columns if c.lower() not in (*OUT, "ids") and c != text]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    out = T.StructType([src.schema["row"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        enc = encoder(tokenizer)
        for b in slices(batches, "text", SLICE):
            ids, off = enc.encode(b.column("text"))
            rows, piece, start, length, crc = [], [], [], [], []
            for i in range(b.num_rows):
                own = np.append(ids[off[i]:off[i + 1]], np.uint32(end)).astype("<u4")
                for k in range(0, len(own), most):
                    part = own[k:k + most]
                    rows.append(i)
                    piece.append(k // most)
                    start.append(k)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                              pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=out.names)

    got = bounded_batches(src).mapInArrow(run, out)
    return got.select(*[F.col("row")[c].alias(c) for c in kept], *out.names[1:])


def best_fit(sizes: np.ndarray, capacity=CAPACITY, weights=WEIGHTS, rule: str = "norm") -> np.ndarray:
    """The bin of every item (rows of ``sizes``), largest item first."""
    cap, w = np.asarray(capacity, np.float64), np.asarray(weights, np.float64) / np.asarray(capacity, np.float64)
    n = len(sizes)
    weighed = sizes * w
    order = np.lexsort((-sizes[:, 0], -np.sqrt((weighed * weighed).sum(1))))
    least = np.minimum.accumulate(sizes[order, 0][::-1])[::-1]  # the smallest item still to come
    dims = range(sizes.shape[1])
    rest = [np.empty(1024) for _ in dims]
    ids = np.empty(1024, np.int64)
    m = made = 0
    where = np.empty(n, np.int64)
    for step, i in enumerate(order):
        s = sizes[i]
        fits = rest[0][:m] >= s[0]
        for d in dims[1:]:
            fits &= rest[d][:m] >= s[d]
        at = np.flatnonzero(fits)
        if len(at):
            if rule == "dot":
                best = at[np.argmax(sum((rest[d][at] * w[d]) * (s[d] * w[d]) for d in dims))]
            else:
                best = at[np.argmin(sum(((rest[d][at] - s[d]) * w[d]) ** 2 for d in dims))]
        else:
            if m == len(ids):
                rest = [np.concatenate([r, np.empty(m)]) for r in rest]
                ids = np.concatenate([ids, np.empty(m, np.int64)])
            best, ids[m] = m, made
            for d in dims:
                rest[d][m] = cap[d]
            m, made = m + 1, made + 1
        for d in dims:
            rest[d][best] -= s[d]
        where[i] = ids[best]
        if step + 1 < n and rest[0][best] < least[step + 1]:  # closed: no item to come can go there
            m -= 1
            ids[best] = ids[m]
            for d in dims:
                rest[d][best] = rest[d][m]
    return where


def _round(items: DataFrame, level: int, rule: str, capacity, weights) -> DataFrame:
    """Packs ``items(item, tokens, documents, cost)``: ``item, bin, place``."""
    groups = max(1, -(-items.count() // GROUP))

    def run(pdf):
        pdf = pdf.sort_values("item")
        sizes = pdf[["tokens", "documents", "cost"]].to_numpy(np.float64)
        where = best_fit(sizes, capacity, weights, rule)
        order = np.argsort(where, kind="stable")
        tokens = pdf["tokens"].to_numpy()[order]
        first = np.flatnonzero(np.diff(where[order], prepend=-1))
        before = np.cumsum(tokens) - tokens
        place = before - np.repeat(before[first], np.diff(np.append(first, len(order))))
        named = (np.int64(level) << 60) + (pdf["g"].to_numpy(np.int64)[order] << 32) + where[order]
        return pd.DataFrame({"item": pdf["item"].to_numpy()[order], "bin": named, "place": place})

    dealt = items.withColumn("g", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("long"))
    return dealt.groupBy("g").applyInPandas(run, "item long, bin long, place long")


def pack(df: DataFrame, capacity=CAPACITY, weights=WEIGHTS, rule: str = "norm") -> DataFrame:
    """Every row of ``df`` (with ``length``) with ``sequence_id`` and ``offset``."""
    kept = [c for c in df.columns if c.lower() not in ("sequence_id", "offset")]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("length").cast("long").alias("tokens"))
    src = materialize(src.withColumn("item", F.monotonically_increasing_id()), "pack-items")  # the numbers are fixed by writing them
    items = src.select("item", "tokens", F.lit(1).cast("long").alias("documents"), (F.col("tokens") * F.col("tokens")).alias("cost"))
    done = materialize(_round(items, 0, rule, capacity, weights), "pack-round0")
    sums = materialize(done.join(items, "item").groupBy("bin").agg(F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"), F.sum("cost").alias("cost")), "pack-bins")
    level, half = 1, sums.where(F.col("tokens") <= capacity[0] // 2).withColumnRenamed("bin", "item")
    n = half.count()
    while n > 1:
        moved = materialize(_round(half, level, rule, capacity, weights), f"pack-round{level}").select(F.col("item").alias("was"), F.col("bin").alias("to"), F.col("place").alias("shift"))
        done = done.join(moved, F.col("bin") == F.col("was"), "left").select(
            "item", F.coalesce("to", "bin").alias("bin"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"))
        half = half.join(moved, F.col("item") == F.col("was")).groupBy(F.col("to").alias("item")).agg(
            F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"), F.sum("cost").alias("cost")).where(F.col("tokens") <= capacity[0] // 2)
        half = materialize(half, "pack-half")
        before, n, level = n, half.count(), level + 1
        if n >= before:
            break
    got = src.join(done, "item")
    return got.select(*[F.col("row")[c].alias(c) for c in kept], F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))


def op10_pack(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).select("doc_id", *OUT)
