"""Run log, consumption log, retention and run metrics.

Logs are append-only event tables: a batch writes an IN_PROGRESS event when it
starts and a final event when it ends; the current state of a batch is its
latest event (no UPDATE needed, so the log is safe to append from any
attempt). Retention pins one cutoff per run, writes the archive first and the
kept rows second, then logs the count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedup as D

TS = T.TimestampNTZType()
BATCH_LOG = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("batch_timestamp", TS),
    T.StructField("data_source", T.StringType()), T.StructField("record_count", T.LongType()),
    T.StructField("processing_start", TS), T.StructField("processing_end", TS),
    T.StructField("status", T.StringType()), T.StructField("error_message", T.StringType()),
    T.StructField("rows_processed", T.LongType())])
CONSUMPTION_LOG = T.StructType([
    T.StructField("stream_name", T.StringType()), T.StructField("last_consumed_timestamp", TS),
    T.StructField("records_consumed", T.LongType()), T.StructField("created_at", TS)])

IN_PROGRESS, SUCCESS, FAILED = "IN_PROGRESS", "SUCCESS", "FAILED"
LOAD, ARCHIVAL = "S3_LOAD", "ARCHIVAL"


def batch_events(batches: DataFrame) -> DataFrame:
    """R2 + R3 as events from a frame of batch outcomes with columns
    (batch_id, data_source, start, end, status, record_count, rows_processed,
    error_message): a start event and an end event per batch."""
    start = batches.select("batch_id", F.col("start").alias("batch_timestamp"), "data_source",
                           F.lit(0).cast("bigint").alias("record_count"), F.col("start").alias("processing_start"),
                           F.lit(None).cast(TS).alias("processing_end"), F.lit(IN_PROGRESS).alias("status"),
                           F.lit(None).cast("string").alias("error_message"),
                           F.lit(None).cast("bigint").alias("rows_processed"))
    end = batches.select("batch_id", F.col("end").alias("batch_timestamp"), "data_source",
                         F.col("record_count").cast("bigint"), F.col("start").alias("processing_start"),
                         F.col("end").alias("processing_end"), "status", "error_message",
                         F.col("rows_processed").cast("bigint"))
    return start.unionByName(end)


def current_batches(events: DataFrame) -> DataFrame:
    """The state of each batch = its latest event (W1 on the event log);
    a batch is identified by (batch_id, data_source)."""
    key = F.concat_ws("|", F.col("batch_id").cast("string"), F.col("data_source"))
    return D.latest(events, key, [F.col("batch_timestamp"), F.col("status") != IN_PROGRESS])


def archive_split(landing: DataFrame, now: Column, days: int = 7, ts: str = "loaded_timestamp"):
    """R1 halves with one pinned cutoff: (archive, kept). A null timestamp is
    kept (``<`` is not true for it)."""
    cutoff = now - F.expr(f"INTERVAL {days} DAYS")
    old = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return landing.where(old), landing.where(~old)


def archive_and_purge(landing: DataFrame, archive_path: str, kept_path: str, now: dt.datetime,
                      days: int = 7, ts: str = "loaded_timestamp") -> dict:
    """R1 as a job: archive written first, kept snapshot second (a crash in
    between leaves both copies, never a loss); returns the log row."""
    now_c = F.lit(now).cast(TS)
    archive, kept = archive_split(landing, now_c, days, ts)
    # Both folders are named by the cutoff and overwritten: a retry writes them again.
    cutoff = (now - dt.timedelta(days=days)).strftime("%Y%m%dT%H%M%S%f")
    seen = Observation()
    archive.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{archive_path}/cutoff={cutoff}")
    kept.write.mode("overwrite").parquet(f"{kept_path}/cutoff={cutoff}")
    n = seen.get["rows"]
    return {"batch_timestamp": now, "data_source": ARCHIVAL, "record_count": n, "status": SUCCESS,
            "message": f"Archived {n} records successfully"}


def consumption_totals(log: DataFrame) -> DataFrame:
    """Q7 / A10: per stream total consumed, events, last run (sorted by last run)."""
    return log.groupBy("stream_name").agg(
        F.sum("records_consumed").alias("total_consumed"), F.count(F.lit(1)).alias("consumption_events"),
        F.max("last_consumed_timestamp").alias("last_run")).orderBy(F.desc("last_run"))


def failures_per_day(events: DataFrame, now: Column, hours: int | None = None) -> DataFrame:
    """Runs and failures per day, source and final state."""
    cur = current_batches(events)
    if hours is not None:
        cur = cur.where(F.col("batch_timestamp") >= now - F.expr(f"INTERVAL {hours} HOURS"))
    return cur.groupBy(F.to_date("batch_timestamp").alias("date"), "data_source", "status").agg(
        F.count(F.lit(1)).alias("run_count"), F.count_if(F.col("status") == FAILED).alias("failures"))


# Fixed names: the columns of a run's metrics.
RUN_ID, START, END, DURATION, RATE, ERRORS = "run_id", "start_time", "end_time", "duration_s", "throughput_rps", "validation_errors"


def run_row(spark: SparkSession, began: dt.datetime, ended: dt.datetime, counts: dict[str, int], errors: dict[str, int]) -> DataFrame:
    """A run as one row, its id, span and rate worked out in SQL from
    the two instants and the observed counts (``validation_errors``: a count by rule
    key). ``F.to_json(F.struct("*"))`` of it is the JSON report;
    ``sources.files.append`` adds it to a metrics table."""
    told = F.create_map(*[F.lit(x) for k, n in errors.items() for x in (k, n)]).cast("map<string,bigint>")
    row = spark.range(1).select(F.lit(began).alias(START), F.lit(ended).alias(END), *[F.lit(n).cast("bigint").alias(k) for k, n in counts.items()], told.alias(ERRORS))
    span = F.greatest(F.unix_micros(END) - F.unix_micros(START), F.lit(0)) / 1e6
    row = row.select(F.left(F.sha2(F.to_json(F.struct("*")), 256), F.lit(12)).alias(RUN_ID), "*", span.alias(DURATION))
    return row.withColumn(RATE, F.coalesce(F.try_divide(F.col("processed_records").cast("double"), F.col(DURATION)), F.lit(0.0)))


def archival_history(events: DataFrame) -> DataFrame:
    """Q6: every archive operation that was logged, newest first."""
    own = events.where(F.col("data_source") == ARCHIVAL).select("batch_id", "batch_timestamp", "data_source", "record_count", "status")
    return own.orderBy(F.desc("batch_timestamp"))


def batches_on(events: DataFrame, day: Column) -> DataFrame:
    """Q6: today's batches (``DATE(batch_timestamp) = day``), newest first."""
    return current_batches(events).where(F.to_date("batch_timestamp") == day).orderBy(F.col("batch_timestamp").desc())
