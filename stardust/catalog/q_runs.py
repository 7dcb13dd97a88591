"""Runs, handlers, run log and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import batches as B
from ..operators import keys as K
from ..operators import validate as V
from ..plans import audit as AU
from ..plans import reviews as RV
from ..plans.review_job import run_reviews
from ..session import scratch_path
from ..sources.tables import review_records
from ._registry import register
from ._sql import C, R, VALID, with_


@register("q1_review_run", with_(R, C) + f"""
SELECT count(*) AS total_records, count(*) FILTER (WHERE {VALID}) AS valid_records,
       count(*) FILTER (WHERE NOT ({VALID})) AS invalid_records,
       count(*) FILTER (WHERE {VALID} AND star_rating BETWEEN 4 AND 5 AND verified_purchase = 'Y') AS processed_records,
       CAST(0 AS BIGINT) AS failed_records,
       greatest(1, count(*) FILTER (WHERE {VALID} AND star_rating BETWEEN 4 AND 5 AND verified_purchase = 'Y') // 100)
         AS batches_processed
FROM c
""")
def q1_run(spark, sf_dir):
    """Q1: read -> clean -> validate -> filter (4-5 stars, verified) -> process
    -> write NDJSON; returns the run's metrics row (R8 / R9 / S21)."""
    m = run_reviews(spark, "", scratch_path(spark, "q1-out"),
                    filters=[P.star_between(4, 5), P.verified(True)], lines=RV.review_lines(spark, sf_dir))
    cols = ("total_records", "valid_records", "invalid_records", "processed_records", "failed_records",
            "batches_processed")
    return m.select(*cols)


@register("r6_r7_sql_handler", with_(R) + """
SELECT count(*) AS total, count(*) FILTER (WHERE helpful_votes <= 45) AS processed,
       count(*) FILTER (WHERE helpful_votes > 45) AS failed,
       round(COALESCE(count(*) FILTER (WHERE helpful_votes <= 45) / NULLIF(count(*), 0), 0.0), 6) AS success_rate
FROM r
""")
def r6_sql(spark, sf_dir):
    """R6 with a column handler (fails records with more than 45 votes) + R7."""
    r = review_records(spark, sf_dir)
    ann = B.with_column_handler(r, lambda: F.when(F.col("helpful_votes") > 45, F.concat(
        F.lit("helpful_votes "), F.col("helpful_votes").cast("string"), F.lit(" over limit"))))
    return B.result(ann)


def _quantity_handler(rec: dict) -> None:
    # A user's per-record handler (Python): rejects large quantities.
    if rec["quantity"] > 45:
        raise ValueError(f"quantity {rec['quantity']} over limit")


@register("r6_python_handler", with_(R) + """
SELECT review_id, quantity <= 45 AS ok,
       CASE WHEN quantity > 45 THEN 'Record processing error: quantity ' || CAST(quantity AS VARCHAR) || ' over limit'
       END AS error
FROM r
""")
def r6_python(spark, sf_dir):
    """A Python handler per record inside mapInPandas (Arrow batches)."""
    r = review_records(spark, sf_dir).select("review_id", "quantity")
    return B.with_python_handler(r, _quantity_handler).select("review_id", "ok", "error")


def batch_outcomes(spark, sf_dir):
    """One load batch per arrival day, derived from the feed: rows seen, rows
    valid; a day without any valid row is a FAILED batch."""
    ann = V.annotate(review_records(spark, sf_dir), v=None)
    days = ann.groupBy(F.to_date("loaded_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if(F.size("errors") == 0).alias("rows_processed"))
    days = K.dense_index(days, [F.col("day")], "batch_id", start=1)
    start = F.col("day").cast("timestamp_ntz")
    return days.select(
        "batch_id", F.lit("S3_LOAD").alias("data_source"), start.alias("start"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("end"),
        F.when(F.col("rows_processed") > 0, F.lit(AU.SUCCESS)).otherwise(F.lit(AU.FAILED)).alias("status"),
        "record_count", "rows_processed",
        F.when(F.col("rows_processed") == 0, F.lit("no valid records")).alias("error_message"))


BATCHES_SQL = with_(R, C) + f"""
, d AS (SELECT CAST(loaded_timestamp AS DATE) AS day, count(*) AS record_count,
               count(*) FILTER (WHERE {VALID}) AS rows_processed FROM c GROUP BY 1)
, cur AS (SELECT row_number() OVER (ORDER BY day) AS batch_id,
                 CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR AS batch_timestamp, 'S3_LOAD' AS data_source,
                 record_count, CAST(day AS TIMESTAMP) AS processing_start,
                 CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR AS processing_end,
                 CASE WHEN rows_processed > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
                 CASE WHEN rows_processed = 0 THEN 'no valid records' END AS error_message, rows_processed
          FROM d)
"""


@register("r2_r3_batch_state", BATCHES_SQL + "SELECT * FROM cur")
def r3_state(spark, sf_dir):
    """R2 + R3: start and end events appended per batch; the current state of
    each batch is its latest event."""
    return AU.current_batches(AU.batch_events(batch_outcomes(spark, sf_dir)))


@register("q6_latest_batches", BATCHES_SQL + "SELECT * FROM cur ORDER BY batch_timestamp DESC LIMIT 20")
def q6_latest(spark, sf_dir):
    """Q6: the 20 most recent batch log rows."""
    cur = AU.current_batches(AU.batch_events(batch_outcomes(spark, sf_dir)))
    return cur.orderBy(F.col("batch_timestamp").desc()).limit(20)


@register("q7_consumption_totals", BATCHES_SQL + """
SELECT 'stream_json_data' AS stream_name, sum(record_count) AS total_consumed, count(*) AS consumption_events,
       max(batch_timestamp) AS last_run FROM cur
""")
def q7_consumption(spark, sf_dir):
    """C9 + Q7: one consumption event per batch, totals per stream."""
    b = batch_outcomes(spark, sf_dir)
    log = b.select(F.lit("stream_json_data").alias("stream_name"), F.col("end").alias("last_consumed_timestamp"),
                   F.col("record_count").cast("bigint").alias("records_consumed"), F.col("end").alias("created_at"))
    return AU.consumption_totals(log).withColumn("total_consumed", F.col("total_consumed").cast("bigint"))


@register("q8_failures_per_day", BATCHES_SQL + """
SELECT CAST(batch_timestamp AS DATE) AS date, data_source, status, count(*) AS run_count,
       count(*) FILTER (WHERE status = 'FAILED') AS failures
FROM cur GROUP BY 1, 2, 3
""")
def q8_failures(spark, sf_dir):
    """Runs and failures per day, source and state."""
    return AU.failures_per_day(AU.batch_events(batch_outcomes(spark, sf_dir)), F.current_timestamp())


@register("c8_stream_review_run", with_(R, C) + f"""
SELECT review_id, review_date, star_rating, verified_purchase FROM c
WHERE {VALID} AND star_rating BETWEEN 4 AND 5 AND verified_purchase = 'Y'
""")
def c8_stream_run(spark, sf_dir):
    """The review run as a file stream over two NDJSON drops (split by
    arrival), one availableNow run per drop; the sink holds every valid,
    filtered record exactly once."""
    from ..sources import files as FS
    from ..sources.tables import review_records
    from ..streaming.reviews import ReviewStream
    base = scratch_path(spark, "c8-stream")
    r = review_records(spark, sf_dir)
    fields = ["review_id", "review_date", "customer_id", "product_id", "product_title", "product_category",
              "star_rating", "review_body", "helpful_votes", "verified_purchase"]
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    rs = ReviewStream(spark, f"{base}/in/*/*.json.gz", f"{base}/out", f"{base}/ckpt",
                      filters=[P.star_between(4, 5), P.verified(True)], quarantine_dir=f"{base}/bad")
    FS.write_ndjson(r.where(F.col("loaded_timestamp") < cut).select(*fields), f"{base}/in/drop1", compression="gzip")
    rs.run_available()
    FS.write_ndjson(r.where(F.col("loaded_timestamp") >= cut).select(*fields), f"{base}/in/drop2", compression="gzip")
    rs.run_available()
    out = spark.read.schema("review_id string, review_date string, star_rating int, verified_purchase string") \
        .json(f"{base}/out/*")
    return out
