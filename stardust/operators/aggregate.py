"""Aggregations (A1-A13). All are hash aggregates with a partial (map-side)
step before the shuffle, so a hot key costs one partial row per task, never a
whole group in one place. Maps are only built over bounded key sets (ratings,
rule keys); open key sets (categories, products) stay long-form rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def summary(df: DataFrame, rating: str = "star_rating", flag: str = "verified_purchase", digits: int | None = None) -> DataFrame:
    """A1 + A2 scalars in one pass: total, mean rating (0.0 if none), verified /
    unverified counts, verified rate (0.0 when no flags)."""
    out = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.avg(rating), F.lit(0.0)).alias("avg_star_rating"),
        F.count_if(F.col(flag) == "Y").alias("verified_count"),
        F.count_if(F.col(flag) == "N").alias("unverified_count"),
    ).withColumn("verified_rate", F.coalesce(
        F.try_divide(F.col("verified_count").cast("double"), F.col("verified_count") + F.col("unverified_count")), F.lit(0.0)))
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("avg_star_rating", "verified_rate")})
    return out


def star_distribution(df: DataFrame, rating: str = "star_rating") -> DataFrame:
    """A1 ``star_distribution`` (long form): count per integer rating seen."""
    return df.where(F.col(rating).isNotNull()).groupBy(rating).agg(F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, col: str = "product_category") -> DataFrame:
    """A1 ``category_counts``: blank / missing categories are skipped."""
    return (df.where(F.coalesce(F.col(col), F.lit("")) != "")
              .groupBy(col).agg(F.count(F.lit(1)).alias("n")))


def summary_maps(df: DataFrame, rating: str = "star_rating", flag: str = "verified_purchase") -> DataFrame:
    """A1 as one row with the rating map, in two aggregation steps and no join:
    per rating (partial + final), then over those few rows (one per distinct
    rating, so the map is bounded by the rating domain)."""
    per = df.groupBy(rating).agg(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col(flag) == "Y").alias("y"),
                                 F.count_if(F.col(flag) == "N").alias("no"))
    rated = F.col(rating).isNotNull()
    out = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.try_divide(F.sum(F.when(rated, F.col(rating) * F.col("n"))).cast("double"),
                                F.sum(F.when(rated, F.col("n")))), F.lit(0.0)).alias("avg_star_rating"),
        F.coalesce(F.sum("y"), F.lit(0)).alias("verified_count"),
        F.coalesce(F.sum("no"), F.lit(0)).alias("unverified_count"),
        F.map_from_entries(F.filter(F.collect_list(F.struct(F.col(rating), F.col("n"))),
                                    lambda e: e[rating].isNotNull())).alias("star_distribution"))
    return out.withColumn("verified_rate", F.coalesce(
        F.try_divide(F.col("verified_count").cast("double"), F.col("verified_count") + F.col("unverified_count")),
        F.lit(0.0)))


def top_counts(df: DataFrame, col: str, n: int, order_tie: list[Column] | None = None) -> DataFrame:
    """A3: top ``n`` values by count, ties broken by first arrival (``order_tie``
    gives the arrival order columns; their minimum per group ranks ties)."""
    cnt = df.where(F.coalesce(F.col(col), F.lit("")) != "")
    if order_tie:
        cnt = cnt.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order_tie)).alias("__first"))
        return cnt.orderBy(F.col("n").desc(), F.col("__first").asc()).limit(n).drop("__first")
    cnt = cnt.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return cnt.orderBy(F.col("n").desc(), F.col(col).asc()).limit(n)


def text_key(col: str) -> Column:
    """Grouping key as text; null and missing both become '' (documented deviation)."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def group_rows(df: DataFrame, key: str) -> DataFrame:
    """A4: rows tagged with their text group key (``group_key``). The groups are
    left as rows: collecting a group into one value would put an unbounded
    group into one task. ``group_sizes`` gives the per-group counts."""
    return df.withColumn("group_key", text_key(key))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    return group_rows(df, key).groupBy("group_key").agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, key: str) -> DataFrame:
    """A5: count per text key (order by ``n`` descending when presenting)."""
    return df.groupBy(text_key(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def rating_histogram(df: DataFrame, rating: str = "star_rating", lo: int = S.STAR_MIN, hi: int = S.STAR_MAX) -> DataFrame:
    """Counts for every rating lo..hi, zeros included. The rating domain
    is a fixed 5-row frame; the counts come from a partial+final aggregate."""
    spark = df.sparkSession
    stars = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias(rating))
    counts = df.where(F.col(rating).between(lo, hi)).groupBy(rating).agg(F.count(F.lit(1)).alias("n"))
    return stars.join(counts, rating, "left").select(rating, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def field_stats(df: DataFrame, field: str, digits: int = 6) -> DataFrame:
    """Count (all rows), non_null, min, max, mean; count is 0 when no value
    is numeric (the reference's rule), even if rows exist."""
    c = F.col(field)
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.count(c).alias("non_null"),
                 F.min(c).alias("min"), F.max(c).alias("max"), F.round(F.avg(c), digits).alias("mean"))
    return agg.select(F.when(F.col("non_null") > 0, F.col("rows")).otherwise(F.lit(0)).alias("count"),
                      "non_null", "min", "max", "mean")


def count_avg_by(df: DataFrame, keys: list[str], count_col: str, avg_col: str,
                 count_name: str = "n", avg_name: str = "avg", digits: int = 6) -> DataFrame:
    """Count + average per group."""
    return df.groupBy(*keys).agg(F.count(count_col).alias(count_name),
                                 F.round(F.avg(avg_col), digits).alias(avg_name))


def count_if_above(col: str, threshold, name: str) -> Column:
    """Conditional count (``SUM(CASE WHEN x > t THEN 1 ELSE 0 END)``)."""
    return F.count_if(F.col(col) > threshold).alias(name)


def next_id(df: DataFrame, col: str) -> DataFrame:
    """``COALESCE(MAX(id), 0) + 1``."""
    return df.agg((F.coalesce(F.max(col), F.lit(0)) + 1).alias("next_id"))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A13."""
    return df.agg(F.count(F.lit(1)).alias(name))
