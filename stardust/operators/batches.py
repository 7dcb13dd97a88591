"""Per-record handlers in batches.

A handler either is a column expression (JVM-side: returns an error text or
null per row), or a Python function called on each record inside
``mapInArrow`` (the escape hatch for user code: Arrow batches of
``batch_size`` rows, never a driver loop). Both produce the same annotated
frame: the input columns plus ``ok`` and ``error``; totals are one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_column_handler(df: DataFrame, handler: Callable[[], Column]) -> DataFrame:
    """R6 with a SQL handler: ``error`` is the handler's text (null = success)."""
    err = handler()
    return df.withColumn("error", F.when(err.isNotNull(), F.concat(F.lit("Record processing error: "), err))) \
             .withColumn("ok", F.col("error").isNull())


def with_python_handler(df: DataFrame, handler: Callable[[dict], None], batch_size: int = 100,
                        stop_on_error: bool = False) -> DataFrame:
    """R6 with a Python handler per record (X4). An exception marks the record
    failed with ``Record processing error: <exc>``; ``stop_on_error`` lets it
    fail the task (and so the job) instead."""
    if batch_size < 1:
        raise ValueError(f"rows of a batch: {batch_size} is not a positive count")
    schema = T.StructType(df.schema.fields + [T.StructField("ok", T.BooleanType()),
                                              T.StructField("error", T.StringType())])

    names = schema.fieldNames()

    def attempt(rec: dict) -> str | None:
        try:
            handler(rec)
        except Exception as exc:  # a user's handler may raise anything; its text is the row's error
            if stop_on_error:
                raise
            return f"Record processing error: {exc}"
        return None

    def run(batches):
        # Arrow to Python values: nulls stay None and integers stay integers.
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                part = whole.slice(at, batch_size)
                errs = [attempt(rec) for rec in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([e is None for e in errs], pa.bool_()), pa.array(errs, pa.string())], names=names)

    return df.mapInArrow(run, schema)


def result(annotated: DataFrame) -> DataFrame:
    """R6 totals + R7 success rate (0.0 for an empty input)."""
    return annotated.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("processed"),
                         F.count_if(~F.col("ok")).alias("failed")).withColumn(
        "success_rate", F.round(F.coalesce(F.try_divide(F.col("processed").cast("double"), F.col("total")), F.lit(0.0)), 6))
