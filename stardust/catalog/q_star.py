"""Star-schema loads (K1, M1-M9, J1-J4, Q3-Q5, Q9/V12) over two staged batches.

The feed is split by arrival into two batches (before / from 1998-07-01), each
loaded with a pinned clock, so the final tables are deterministic. The oracle
rebuilds the same tables in SQL (first batch a key appears in decides inserts
and surrogate keys; the last decides updates).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import aggregate as A
from ..operators import upsert as U
from ..plans import star_load as SL
from ..session import for_lookup, materialize
from ..sources.tables import ARRIVAL_ORDER, review_records
from ._register_helpers import nested_orders, order_documents
from ._registry import register
from ._sql import R, with_

CUTOFF = "1998-07-01"
NOW1, NOW2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


def staging(spark, sf_dir, batch: int | None = None):
    """Raw staging rows: one JSON record per row (VARIANT), arrival columns."""
    r = review_records(spark, sf_dir)
    rec = F.to_json(F.struct(*S.REVIEW_TYPES, *S.STAR_TYPES))
    stg = r.select(F.parse_json(rec).alias("mydata"), *ARRIVAL_ORDER)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    if batch == 1:
        stg = stg.where(F.col("loaded_timestamp") < cut)
    elif batch == 2:
        stg = stg.where(F.col("loaded_timestamp") >= cut)
    return stg


def _now(t):
    return F.lit(t).cast("timestamp_ntz")


def star_after_two_batches(spark, sf_dir) -> SL.Star:
    star = SL.empty_star(spark)
    order = list(ARRIVAL_ORDER)
    star = SL.load_batch(star, staging(spark, sf_dir, 1), _now(NOW1), order)
    star = _materialise(star)
    star = SL.load_batch(star, staging(spark, sf_dir, 2), _now(NOW2), order)
    return _materialise(star)


def _materialise(star: SL.Star) -> SL.Star:
    """Cut lineage between batches (tables written to the shared folder), as
    a real run does by writing each table version."""
    facts = {n: materialize(df, f"star-{n}") for n, df in star.tables().items() if n in ("orders", "reviews")}
    return replace(star, **facts)  # the load wrote the dimensions


# ---------------------------------------------------------------- oracle SQL
B = ("b AS (SELECT *, CASE WHEN loaded_timestamp < TIMESTAMP '1998-07-01 00:00:00' THEN 1 ELSE 2 END AS batch "
     "FROM r)")


def _ts(b: str) -> str:
    return f"CASE {b} WHEN 1 THEN TIMESTAMP '2026-01-01 00:00:00' ELSE TIMESTAMP '2026-01-02 00:00:00' END"


def _dim_sql(key: str, cols: str, latest_cols: str) -> str:
    """Dimension after two batches: first/last batch per key, keys by (first batch, id)."""
    return f"""
{key}_fl AS (SELECT {key}, min(batch) AS fb, max(batch) AS lb FROM b WHERE {key} IS NOT NULL GROUP BY {key}),
{key}_latest AS (SELECT {key}, {latest_cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key}
     ORDER BY loaded_timestamp DESC, tie1 DESC, tie2 DESC, tie3 DESC, tie4 DESC) AS rn FROM b WHERE {key} IS NOT NULL) WHERE rn = 1),
{key}_dim AS (SELECT row_number() OVER (ORDER BY f.fb, f.{key}) AS {cols}, {_ts('f.fb')} AS created_at,
     {_ts('f.lb')} AS updated_at, true AS is_active
     FROM {key}_fl f JOIN {key}_latest l USING ({key}))"""


CUST = _dim_sql("customer_id", "customer_key, f.customer_id, l.email, l.name, l.address",
                "email, name, address")
PROD = _dim_sql("product_id", "product_key, f.product_id, l.name, l.category, l.price",
                "product_title AS name, product_category AS category, price")


def _fact_sql(key: str, ins_cols: str, upd_cols: str) -> str:
    """Fact after two batches: row inserted from the latest row of the first batch
    the key is seen in; update columns from the latest row of the last batch."""
    return f"""
{key}_pb AS (SELECT *, row_number() OVER (PARTITION BY {key}, batch ORDER BY loaded_timestamp DESC, tie1 DESC,
     tie2 DESC, tie3 DESC, tie4 DESC) AS rn_k FROM b WHERE {key} IS NOT NULL),
{key}_fl AS (SELECT {key}, min(batch) AS fb, max(batch) AS lb FROM b WHERE {key} IS NOT NULL GROUP BY {key}),
{key}_fact AS (SELECT {ins_cols}, {upd_cols}, {_ts('f.fb')} AS created_at
     FROM {key}_fl f JOIN {key}_pb i ON i.{key} = f.{key} AND i.batch = f.fb AND i.rn_k = 1
     JOIN {key}_pb u ON u.{key} = f.{key} AND u.batch = f.lb AND u.rn_k = 1
     LEFT JOIN customer_id_dim c ON c.customer_id = i.customer_id
     LEFT JOIN product_id_dim p ON p.product_id = i.product_id)"""


REV = _fact_sql("review_id",
                "f.review_id, i.order_id, c.customer_key, p.product_key, CAST(i.review_date AS DATE) AS review_date, "
                "i.review_body, i.verified_purchase",
                "u.star_rating, u.helpful_votes")
ORD = _fact_sql("order_id",
                "f.order_id, CAST(i.review_date AS DATE) AS order_date, c.customer_key, p.product_key",
                "COALESCE(u.quantity, 1) AS quantity")
STAR_CTES = with_(R, B) [:-1] + "," + CUST + "," + PROD + "," + REV + "," + ORD + " "

CUST_COLS = "customer_key, customer_id, email, name, address, created_at, updated_at, is_active"
PROD_COLS = "product_key, product_id, name, category, price, created_at, updated_at, is_active"


_STAR_CACHE: dict = {}


def star(spark, sf_dir) -> SL.Star:
    """The two-batch star for this session and input (built once, checkpointed)."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _STAR_CACHE:
        _STAR_CACHE[k] = star_after_two_batches(spark, sf_dir)
    return _STAR_CACHE[k]


@register("m2_customers_load", STAR_CTES + f"SELECT {CUST_COLS} FROM customer_id_dim")
def m2_customers(spark, sf_dir):
    """M2 + K1 + M7: customer dimension after two merged batches."""
    return star(spark, sf_dir).customers


@register("m3_products_load", STAR_CTES + f"SELECT {PROD_COLS} FROM product_id_dim")
def m3_products(spark, sf_dir):
    return star(spark, sf_dir).products


@register("m4_reviews_load", STAR_CTES + """
SELECT review_id, order_id, customer_key, product_key, review_date, star_rating, review_body, helpful_votes,
       verified_purchase, created_at FROM review_id_fact
""")
def m4_reviews(spark, sf_dir):
    """M4 (left key lookups, update only rating and votes)."""
    return star(spark, sf_dir).reviews


@register("m5_orders_load", STAR_CTES + """
SELECT order_id, order_date, customer_key, product_key, quantity, created_at FROM order_id_fact
""")
def m5_orders(spark, sf_dir):
    """M5 (inner key lookups, quantity default 1, update only quantity)."""
    return star(spark, sf_dir).orders


@register("k1_surrogate_keys_unique", STAR_CTES + """
SELECT 'customers' AS table_name, count(*) AS n, count(DISTINCT customer_key) AS n_keys, max(customer_key) AS max_key
FROM customer_id_dim
UNION ALL SELECT 'products', count(*), count(DISTINCT product_key), max(product_key) FROM product_id_dim
""")
def k1_keys(spark, sf_dir):
    """K1 invariant: keys are unique, dense 1..n, never reused."""
    s = star(spark, sf_dir)
    def one(df, name, key):
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"),
                      F.count_distinct(key).alias("n_keys"), F.max(key).alias("max_key"))
    return one(s.customers, "customers", "customer_key").unionByName(one(s.products, "products", "product_key"))


@register("m6_nested_orders_insert", with_(R) + """
SELECT DISTINCT order_id, CAST(min(review_date) OVER (PARTITION BY order_id) AS DATE) AS order_date,
       customer_id, product_id, quantity, TIMESTAMP '2026-01-01 00:00:00' AS created_at FROM r
""")
def m6_nested(spark, sf_dir):
    """M6: insert-only orders from the nested draft shape, one row per order
    and product; natural keys shown (surrogates come from the dimensions)."""
    r = review_records(spark, sf_dir)
    chunks = nested_orders(r)
    docs = materialize(order_documents(chunks), "nested-docs")  # both inserts read it
    spark_ = r.sparkSession
    # The ids that the documents name: no second and third reading of the feed's tables.
    named = lambda of, id_: chunks.select(F.explode(of).alias(id_)).distinct()
    cust = materialize(named("orders.customer.customer_id", "customer_id"), "nested-customers").withColumn("customer_key", F.xxhash64("customer_id"))
    prods = materialize(named(F.flatten("orders.products")["product_id"], "product_id"), "nested-products").withColumn("product_key", F.xxhash64("product_id"))
    cust, prods = for_lookup(cust), for_lookup(prods)
    empty = spark_.createDataFrame([], SL.ORDERS)
    ins = materialize(SL.nested_orders_insert(empty, docs, cust, prods, _now(NOW1)), "nested-orders")
    ins = SL.nested_orders_insert(ins, docs, cust, prods, _now(NOW2))  # re-run inserts nothing
    return (ins.join(cust, "customer_key").join(prods, "product_key")
               .select("order_id", "order_date", "customer_id", "product_id", "quantity", "created_at"))


@register("m8_m9_update_delete", STAR_CTES + f"""
SELECT customer_key, customer_id, email, name, address, created_at,
       CASE WHEN address = 'AUTOMOBILE' THEN TIMESTAMP '2026-01-03 00:00:00' ELSE updated_at END AS updated_at,
       CASE WHEN address = 'AUTOMOBILE' THEN false ELSE is_active END AS is_active
FROM customer_id_dim WHERE NOT (address = 'FURNITURE')
""")
def m8_m9(spark, sf_dir):
    """M8 (deactivate by predicate) then M9 (delete by predicate) on a snapshot."""
    c = star(spark, sf_dir).customers
    c = U.update_where(c, F.col("address") == "AUTOMOBILE",
                       {"is_active": F.lit(False), "updated_at": _now(dt.datetime(2026, 1, 3))})
    return U.delete_where(c, F.col("address") == "FURNITURE")


@register("j2_unmatched_reviews", with_(R) + """
SELECT DISTINCT review_id, customer_id FROM r
WHERE customer_id NOT IN (SELECT customer_id FROM r WHERE loaded_timestamp < TIMESTAMP '1998-07-01 00:00:00')
  AND loaded_timestamp >= TIMESTAMP '1998-07-01 00:00:00'
""")
def j2_unmatched(spark, sf_dir):
    """Second-batch reviews whose customer is not in a dimension loaded
    from the first batch only (the quarantine side of the left lookups)."""
    st1, st2 = (SL.typed_staging(staging(spark, sf_dir, b), list(ARRIVAL_ORDER)) for b in (1, 2))
    customers, products = SL.customers_source(st1, list(ARRIVAL_ORDER)), SL.products_source(st2, list(ARRIVAL_ORDER))
    bad = SL.unmatched_reviews(st2, customers, products)
    return bad.where("missing = 'customer'").select("review_id", "customer_id").distinct()


@register("q3_top_products", STAR_CTES + """
SELECT p.name, p.category, count(r.review_id) AS review_count, round(avg(r.star_rating), 6) AS avg_rating
FROM review_id_fact r JOIN product_id_dim p ON r.product_key = p.product_key
GROUP BY p.product_key, p.name, p.category
ORDER BY review_count DESC, p.product_key LIMIT 10
""")
def q3_top(spark, sf_dir):
    """Q3: top 10 products by review count with mean rating (J3 + A8 + O2)."""
    s = star(spark, sf_dir)
    agg = (s.reviews.join(for_lookup(s.products), "product_key")
           .groupBy("product_key", "name", "category")
           .agg(F.count("review_id").alias("review_count"), F.round(F.avg("star_rating"), 6).alias("avg_rating")))
    return agg.orderBy(F.col("review_count").desc(), "product_key").limit(10).drop("product_key")


@register("q4_purchase_history", STAR_CTES + """
SELECT c.name, p.name AS product_name, o.order_date, r.star_rating, r.review_body
FROM order_id_fact o JOIN customer_id_dim c ON o.customer_key = c.customer_key
JOIN product_id_dim p ON o.product_key = p.product_key
LEFT JOIN review_id_fact r ON o.order_id = r.order_id
""")
def q4_history(spark, sf_dir):
    """Q4: orders x customers x products, left join reviews (J4), by name, newest first."""
    s = star(spark, sf_dir)
    o, c, p, r = s.orders, for_lookup(s.customers), for_lookup(s.products), for_lookup(s.reviews)
    j = (o.join(c.select("customer_key", "name"), "customer_key")
          .join(p.select("product_key", F.col("name").alias("product_name")), "product_key")
          .join(r.select("order_id", "star_rating", "review_body"), "order_id", "left"))
    return j.select("name", "product_name", "order_date", "star_rating", "review_body").orderBy("name", F.desc("order_date"))


@register("q5_recent_review_stats", STAR_CTES + """
SELECT p.name, p.category, count(r.review_id) AS review_count, round(avg(r.star_rating), 6) AS avg_rating,
       count(*) FILTER (WHERE r.helpful_votes > 10) AS helpful_reviews
FROM review_id_fact r JOIN product_id_dim p ON r.product_key = p.product_key
WHERE r.review_date >= DATE '2001-06-30' - INTERVAL 30 DAY
GROUP BY p.product_key, p.name, p.category
""")
def q5_recent(spark, sf_dir):
    """Q5: last-30-day stats per product with helpful count (P10 + A9), today pinned."""
    s = star(spark, sf_dir)
    today = F.lit(dt.date(2001, 6, 30))
    rv = s.reviews.where(F.col("review_date") >= F.date_sub(today, 30))
    return (rv.join(for_lookup(s.products), "product_key").groupBy("product_key", "name", "category")
              .agg(F.count("review_id").alias("review_count"), F.round(F.avg("star_rating"), 6).alias("avg_rating"),
                   A.count_if_above("helpful_votes", 10, "helpful_reviews"))
              .orderBy(F.desc("review_count"), "product_key").drop("product_key"))


@register("q9_table_counts", STAR_CTES + """
SELECT 'CUSTOMERS' AS table_name, count(*) AS record_count FROM customer_id_dim
UNION ALL SELECT 'PRODUCTS', count(*) FROM product_id_dim
UNION ALL SELECT 'ORDERS', count(*) FROM order_id_fact
UNION ALL SELECT 'REVIEWS', count(*) FROM review_id_fact
""")
def q9_counts(spark, sf_dir):
    """Row count per star table (UNION ALL of counts)."""
    s = star(spark, sf_dir)
    from ..operators import validate as V
    t = V.table_counts({"CUSTOMERS": s.customers, "PRODUCTS": s.products, "ORDERS": s.orders, "REVIEWS": s.reviews})
    return t.withColumnRenamed("row_count", "record_count")


# ------------------------------------------------------ streaming twin (Q2)
_STREAM_CACHE: dict = {}

RETAINED = dt.datetime(2026, 1, 8, 12)
ORDER_FIELDS = {"loaded_timestamp": "timestamp_ntz", "tie1": "double", "tie2": "bigint", "tie3": "bigint",
                "tie4": "double"}


def streamed_star(spark, sf_dir):
    """The feed lands as two NDJSON drops; each drop is
    consumed by one availableNow run of the file stream (restart from the
    checkpoint in between); foreachBatch loads the star's
    changed rows. The result must equal the batch load."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k in _STREAM_CACHE:
        return _STREAM_CACHE[k]
    from ..session import scratch_path
    from ..sources import files as FS
    from ..streaming.loader import StarStreamLoader
    base = scratch_path(spark, "q2-stream")
    r = review_records(spark, sf_dir)
    recs = r.select(*S.REVIEW_TYPES, *S.STAR_TYPES, *ARRIVAL_ORDER)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    clock = {0: NOW1, 1: NOW2}
    loader = StarStreamLoader(spark, f"{base}/in/*/*.json.gz", root=f"{base}/star",
                              clock=lambda b: clock[b], order_fields=ORDER_FIELDS)
    FS.write_ndjson(recs.where(F.col("loaded_timestamp") < cut), f"{base}/in/drop1", compression="gzip")
    loader.run_available()
    FS.write_ndjson(recs.where(F.col("loaded_timestamp") >= cut), f"{base}/in/drop2", compression="gzip")
    loader.run_available()
    loader.run_available()  # no new files: no batch runs (C7)
    loader.retain(RETAINED)  # R1 / R5: the first drop's landing rows are past the seven days
    _STREAM_CACHE[k] = loader
    return loader


@register("q2_stream_customers", STAR_CTES + f"SELECT {CUST_COLS} FROM customer_id_dim")
def q2_customers(spark, sf_dir):
    return streamed_star(spark, sf_dir).table("customers")


@register("q2_stream_reviews", STAR_CTES + """
SELECT review_id, order_id, customer_key, product_key, review_date, star_rating, review_body, helpful_votes,
       verified_purchase, created_at FROM review_id_fact
""")
def q2_reviews(spark, sf_dir):
    return streamed_star(spark, sf_dir).table("reviews")


@register("q2_stream_orders", STAR_CTES + """
SELECT order_id, order_date, customer_key, product_key, quantity, created_at FROM order_id_fact
""")
def q2_orders(spark, sf_dir):
    return streamed_star(spark, sf_dir).table("orders")


@register("c7_c9_stream_batches", """
SELECT CAST(count(DISTINCT l_shipdate >= TIMESTAMP '1998-07-01 00:00:00') AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS records_consumed FROM lineitem
""")
def c9_stream_log(spark, sf_dir):
    """C7 + C9 + R3: two micro-batches ran (the third, empty trigger ran none),
    all records consumed once."""
    loader = streamed_star(spark, sf_dir)
    log = AU_current(loader)
    return log.agg(F.count(F.lit(1)).alias("batches"), F.sum("record_count").cast("bigint").alias("records_consumed"))


def AU_current(loader):
    from ..plans import audit as AU
    return AU.current_batches(loader.table("batch_log")).where((F.col("status") == AU.SUCCESS) & (F.col("data_source") == AU.LOAD))
