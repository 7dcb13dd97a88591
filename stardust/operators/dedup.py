"""Deduplication (D1-D7) and latest-row-per-key.

"First" and "last" need an explicit arrival order (lists have one, tables do
not). ``keep_one`` filters ``row_number() = 1``: Spark plans it with a partial
``WindowGroupLimit`` before the shuffle, so each task sends at most one row per
key and a hot key cannot pile its rows into one task. Duplicate finding counts
keys with a partial aggregate and joins the (small) duplicate-key set back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def _key(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def keep_one(df: DataFrame, key: str | Column, order: list[Column], keep: str = "first",
             drop_empty: bool = True) -> DataFrame:
    """One row per key, the first (or last) by ``order``.

    Empty keys (null or '') are dropped, as the reference skips falsy keys."""
    flip = {"first": lambda c: c, "last": lambda c: c.desc()}  # orders come in ascending form
    if keep not in flip:
        raise ValueError(f"unknown side to keep: {keep!r}")
    ordering = [flip[keep](c) for c in order]
    # A key that is a column is not copied: the copy would be sorted and shuffled too.
    k, tmp = (key, df) if isinstance(key, str) else ("__k", df.withColumn("__k", key))
    if drop_empty:
        tmp = tmp.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    w = Window.partitionBy(k).orderBy(*ordering)
    return tmp.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn", "__k")


def latest(df: DataFrame, key: str | Column, ts_order: list[Column]) -> DataFrame:
    """``QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC) = 1``
    (``ts_order`` given ascending; the newest row wins)."""
    return keep_one(df, key, ts_order, keep="last", drop_empty=False)


def content_key(df: DataFrame, cols: list[str] | None = None) -> Column:
    """D4 key: SHA-256 of the record's key-sorted JSON."""
    return X.content_hash(cols or df.columns)


def dedup_content(df: DataFrame, order: list[Column], cols: list[str] | None = None) -> DataFrame:
    """Drop records whose whole content repeats (first kept)."""
    return keep_one(df, content_key(df, cols), order, "first")


def duplicate_key_counts(df: DataFrame, key: str | Column) -> DataFrame:
    """Keys seen more than once (empty key counts as a key) with their counts."""
    return (df.groupBy(F.coalesce(_key(key).cast("string"), F.lit("")).alias("dup_key"))
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def find_duplicates(df: DataFrame, key: str | Column) -> DataFrame:
    """All rows whose key repeats, tagged with the key and its count."""
    dups = duplicate_key_counts(df, key)
    tagged = df.withColumn("dup_key", F.coalesce(_key(key).cast("string"), F.lit("")))
    return tagged.join(dups, "dup_key", "inner")


def delete_repeated(df: DataFrame, key: str | Column) -> DataFrame:
    """Remove every row whose key repeats (the good copy goes too; use
    ``keep_one`` to repair instead)."""
    dups = duplicate_key_counts(df, key)
    tagged = df.withColumn("dup_key", F.coalesce(_key(key).cast("string"), F.lit("")))
    return tagged.join(dups, "dup_key", "left_anti").drop("dup_key")
