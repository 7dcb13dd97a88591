"""A plan fence: keep Catalyst from copying expensive expressions.

A filter above a projection is pushed below it by substituting the projected
expressions into the condition; with parse/validate expressions that means
computing them twice per row (10x slower on the validation path). A
``CollectMetrics`` node (``DataFrame.observe``) is not pushed through, so the
fence costs one counter per task and also gives the row count at that point of
the plan (what the run metrics need)."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_ids = itertools.count()


def fence(df: DataFrame, label: str = "fence", metrics: list[Column] | None = None) -> DataFrame:
    name = f"{label}_{next(_ids)}"
    return df.observe(name, *(metrics or [F.count(F.lit(1)).alias("rows")]))


def observed(df: DataFrame, label: str, metrics: list[Column]) -> tuple[DataFrame, Observation]:
    """Fence plus a handle to read the metrics after the action that runs the plan."""
    obs = Observation(f"{label}_{next(_ids)}")
    return df.observe(obs, *metrics), obs
