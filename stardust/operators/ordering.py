"""Sort, top-k, preview, seeded sample, union (O1-O4, U1), fixed-size batches.

Top-k and previews are ``orderBy(...).limit(n)``, planned as
``TakeOrderedAndProject``: each task keeps its own n best rows and only those
reach the final merge, so the cost does not grow with a global sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _at_least_one(what: str, n: int) -> int:
    if n < 1:
        raise ValueError(f"{what}: {n} is not a positive count")
    return n


def top_k(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """O2 / O3: first ``n`` rows by an explicit, total order."""
    return df.orderBy(*order).limit(_at_least_one("rows to keep", n))


def sample_key(key: str | Column, seed: int) -> Column:
    """Portable pseudo-random rank: SHA-256 of 'key:seed' (same in any engine)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.sha2(F.concat(k.cast("string"), F.lit(f":{seed}")), 256)


SORTED_AT_ONCE = 100_000


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by a seeded hash of ``key``
    (stable across partitionings and re-runs); n <= 0 is an error.

    For large ``n`` the cut is found first: rows are counted by the first digits of
    their hash (at most 65,536 counts), all cells before the one that holds the n-th row
    are kept by a filter, and only rows of that cell are sorted. A cell of over
    ``SORTED_AT_ONCE`` rows is counted again by its next digits."""
    _at_least_one("rows to sample", n)
    h = sample_key(key, seed)
    prefix, left, kept = "", n, F.lit(False)
    while left > SORTED_AT_ONCE and len(prefix) < 64:
        own = df.where(h.startswith(prefix)) if prefix else df
        cells = own.groupBy(F.substring(h, 1, len(prefix) + 4).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        upto = cells.withColumn("upto", F.sum("n").over(Window.orderBy("cell")))  # 65,536 rows at most
        cut = upto.where(F.col("upto") >= left).orderBy("cell").limit(1).first()
        if cut is None:  # fewer rows than asked for: all of them
            return df if not prefix else df.where(kept | h.startswith(prefix))
        kept = kept | (h.startswith(prefix) & (F.substring(h, 1, len(cut.cell)) < cut.cell))
        left -= cut.upto - cut.n
        prefix = cut.cell
        if cut.n <= SORTED_AT_ONCE:
            break
    if not prefix:
        return df.orderBy(h, F.col(key)).limit(n)
    return df.where(kept).unionByName(df.where(h.startswith(prefix)).orderBy(h, F.col(key)).limit(left))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def batch_ids(df: DataFrame, seq: str, size: int, out: str = "batch_id") -> DataFrame:
    """``floor(seq / size)`` as a batch id; size <= 0 is an error. ``seq``
    is a dense 0-based position (see ``keys.dense_index``)."""
    return df.withColumn(out, F.floor(F.col(seq) / F.lit(_at_least_one("rows of a batch", size))).cast("bigint"))
