"""Readers for the driver's parquet tables and the review-shaped view over them.

The driver's tables hold no reviews, so the review record is derived from
lineitem x orders x part x customer (same text as the oracle's view). All reads
are plain parquet scans, so Catalyst prunes columns and pushes filters into them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Off unless ``spark.stardust.minScanPartitions`` is set (local tests and the
    bench set it): deals the rows of a scan round-robin over that many tasks, for
    test files of one row group, which no smaller splits can divide."""
    n = int(df.sparkSession.conf.get("spark.stardust.minScanPartitions", "0"))
    return df.repartition(n) if n > 1 else df


# Review view: one review per lineitem row. Text runs unchanged on Spark SQL and
# DuckDB; the oracle SQL of every query starts from it.
REVIEW_VIEW_SQL = """
SELECT
  'R' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS review_id,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING)                                   AS review_date,
  'C' || CAST(o.o_custkey AS STRING)                                           AS customer_id,
  'P' || CAST(l.l_partkey AS STRING)                                           AS product_id,
  p.p_name                                                                     AS product_title,
  p.p_type                                                                     AS product_category,
  CAST(l.l_quantity AS INT) % 7                                                AS star_rating,
  CASE WHEN l.l_linenumber = 7 THEN ' ' ELSE p.p_brand || '  ' || p.p_name END AS review_body,
  CAST(l.l_quantity AS INT)                                                    AS helpful_votes,
  CASE l.l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE 'R' END         AS verified_purchase,
  l.l_orderkey                                                                 AS order_id,
  CAST(l.l_quantity AS INT)                                                    AS quantity,
  lower(c.c_name) || '@example.com'                                            AS email,
  c.c_name                                                                     AS name,
  c.c_mktsegment                                                               AS address,
  CAST(p.p_retailprice AS DECIMAL(38,2))                                       AS price,
  l.l_shipdate                                                                 AS loaded_timestamp,
  l.l_extendedprice AS tie1, l.l_suppkey AS tie2, l.l_partkey AS tie3, l.l_discount AS tie4
FROM lineitem l
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN part p     ON l.l_partkey  = p.p_partkey
JOIN customer c ON o.o_custkey  = c.c_custkey
"""

# Columns that make "latest" and "first" deterministic (arrival order).
ARRIVAL_ORDER = ("loaded_timestamp", "tie1", "tie2", "tie3", "tie4")


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed review rows (same columns and values as ``REVIEW_VIEW_SQL``).

    Plan shape: customer joins orders (a quarter of the rows of lineitem), the
    result joins lineitem on the order key, then part: lineitem's rows are shuffled
    twice, however large the dimensions are, and once less where Spark's runtime
    size check (``autoBroadcastJoinThreshold``) broadcasts one.
    """
    l = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = l.join(oc, l.l_orderkey == o.o_orderkey).join(p, l.l_partkey == p.p_partkey)
    qty = F.col("l_quantity").cast("int")
    return j.select(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("review_date"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_type").alias("product_category"),
        (qty % 7).alias("star_rating"),
        F.when(F.col("l_linenumber") == 7, F.lit(" "))
         .otherwise(F.concat(F.col("p_brand"), F.lit("  "), F.col("p_name"))).alias("review_body"),
        qty.alias("helpful_votes"),
        F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N").otherwise("R").alias("verified_purchase"),
        F.col("l_orderkey").alias("order_id"),
        qty.alias("quantity"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("address"),
        F.col("p_retailprice").cast("decimal(38,2)").alias("price"),
        F.col("l_shipdate").alias("loaded_timestamp"),
        F.col("l_extendedprice").alias("tie1"), F.col("l_suppkey").alias("tie2"),
        F.col("l_partkey").alias("tie3"), F.col("l_discount").alias("tie4"),
    )


def arrival_order() -> list[Column]:
    """Arrival order as plain (ascending) columns; operators flip them for "last"."""
    return [F.col(c) for c in ARRIVAL_ORDER]
