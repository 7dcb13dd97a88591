"""End-to-end review run (Q1, Q10): read NDJSON -> clean -> validate ->
filter -> process -> write NDJSON, with run metrics (R8, R9).

One lazy plan and one write action. Valid / invalid counts are observed right
after validation (before the filters, as the reference counts them), the
processed / failed counts after the handler; both are read once the write
has run, so the metrics cost no extra pass over the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import predicates as P
from ..operators import batches as B
from ..operators.fence import observed
from ..sources import files as FS
from ..sources import ndjson as N
from . import reviews as RV
from .audit import run_row


def _field_is(name: str):
    return lambda e: e["field"] == F.lit(name)


def run_reviews(spark: SparkSession, source: str, destination: str, filters: list[Column] | None = None,
                batch_size: int = S.DEFAULT_BATCH_SIZE, handler: Callable[[], Column] | None = None,
                quarantine: str | None = None, lines=None, metrics: str | None = None) -> DataFrame:
    """Q1. ``lines`` may replace ``source`` with a frame of text lines (a feed
    derived in Spark); ``quarantine`` also writes invalid records with errors;
    ``metrics`` names a table (a folder) that the run's row is appended to.
    Returns the run's row (``audit.run_row``)."""
    began = dt.datetime.now()
    parsed = N.parse_lines(lines) if lines is not None else N.read_ndjson(spark, source)
    ann = RV.clean_validate(parsed).drop("v", "source_file")
    # Counts per rule key ride on the same observation (the key set is bounded
    # by the rule list), so the error summary needs no extra pass.
    keys = ["*", *S.STRING_FIELDS, "review_date", "star_rating", "verified_purchase"]
    per_key = [F.count_if(F.exists("errors", _field_is(k))).alias(f"err:{k}") for k in keys]
    ann, v_obs = observed(ann, "validation", [F.count(F.lit(1)).alias("total"),
                                              F.count_if(F.size("errors") == 0).alias("valid"),
                                              F.count_if(F.size("errors") > 0).alias("invalid"), *per_key])
    if quarantine:
        ann = ann.persist()
        ann.where(F.size("errors") > 0).withColumn("errors", F.to_json("errors")).write.mode("errorifexists").json(quarantine)
    valid = ann.where(F.size("errors") == 0).drop("errors")
    kept = P.apply_filters(valid, *(filters or []))
    done = B.with_column_handler(kept, handler) if handler else kept.withColumn("ok", F.lit(True)).withColumn(
        "error", F.lit(None).cast("string"))
    done, p_obs = observed(done, "processing", [F.count_if("ok").alias("processed"),
                                                F.count_if(~F.col("ok")).alias("failed")])
    FS.write_ndjson(done.where("ok").drop("ok", "error"), destination)
    v, p = v_obs.get, p_obs.get
    counts = {"total_records": v["total"], "valid_records": v["valid"], "invalid_records": v["invalid"],
              "processed_records": p["processed"], "failed_records": p["failed"]}
    # Whole batches of what was kept, one at least.
    counts["batches_processed"] = max(1, (p["processed"] + p["failed"]) // batch_size)
    errors = {("Missing fields" if k[4:] == "*" else k[4:]): n for k, n in v.items() if k.startswith("err:") and n}
    row = run_row(spark, began, dt.datetime.now(), counts, errors)
    if quarantine:
        ann.unpersist()
    if metrics:
        FS.append(row, metrics)
    return row
