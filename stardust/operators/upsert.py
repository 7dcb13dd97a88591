"""Keyed upsert, update and delete on immutable snapshots (M1, M7, M8, M9).

Parquet tables refuse MERGE / UPDATE / DELETE, and files are immutable, so each
write produces a new snapshot frame. ``upsert`` is two joins with the (one row
per key) source batch: target LEFT JOIN source applies the updates, source
LEFT ANTI target finds the inserts. A batch is usually far smaller than the
table, so Spark can broadcast it (runtime size check) in both joins and stream
the table without shuffling it; a full outer join could not broadcast either
side. A source row always wins for the listed update columns, even when its
value is null (a marker column says "matched", not the value). New rows get
surrogate keys from ``keys.assign_keys`` (no global window) and the insert
defaults (M7). "Inserts" are found by the keys that both have (a semi join of the
table with the batch), then the batch without those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keys as K


def upsert(target: DataFrame, source: DataFrame, on: list[str], update: list[str],
           on_update: dict[str, Column] | None = None, on_insert: dict[str, Column] | None = None,
           surrogate: str | None = None, surrogate_order: list[str] | None = None,
           key_floor: int | None = None, part: bool = False) -> DataFrame:
    """M1: ``MERGE INTO target USING source ON keys WHEN MATCHED UPDATE SET
    update[, on_update] WHEN NOT MATCHED INSERT (source columns + on_insert)``.

    ``source`` must hold one row per key (reduce it first: ``dedup.latest``).
    The result has the target's columns; a ``surrogate`` key column is filled for
    inserted rows from ``max(existing) + 1`` in ``surrogate_order``; pass
    ``key_floor`` (the table's high-water mark) when ``target`` is only a part
    of the table. ``part``: ``target`` holds rows of the batch's keys only, one each, and
    is joined to the batch once."""
    on_update, on_insert = on_update or {}, on_insert or {}
    cols = target.columns
    src_cols = [c for c in source.columns if c not in on]
    s = source.select(*on, *[F.col(c).alias(f"__s_{c}") for c in src_cols], F.lit(True).alias("__in_s"))

    # WHEN MATCHED: every target row, updated where the batch has its key.
    j = s.join(target.withColumn("__in_t", F.lit(True)), on, "left") if part else target.join(s, on, "left")
    hit = F.coalesce(F.col("__in_t" if part else "__in_s"), F.lit(False))
    kept = []
    for c in cols:
        if c in on:
            kept.append(F.col(c))
            continue
        if c in update and c in src_cols:
            new_v = F.col(f"__s_{c}")
        elif c in on_update:
            new_v = on_update[c]
        else:
            kept.append(F.col(c))
            continue
        kept.append(F.when(hit, new_v).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))

    def insert_value(c: str) -> Column:
        if c in on_insert:
            return on_insert[c]
        if c in src_cols:
            return F.col(f"__s_{c}")
        return F.lit(None)

    if part and surrogate is None:
        of = {c: target.schema[c].dataType for c in cols}
        return j.select(*[F.col(c) if c in on else F.when(hit, k).otherwise(insert_value(c).cast(of[c])).alias(c) for c, k in zip(cols, kept)])
    existing = (j.where(hit) if part else j).select(*kept)

    # WHEN NOT MATCHED: batch rows whose key the target lacks. The target's keys are
    # cut down to the batch's first, by a semi join in which the batch is the small
    # side; what is left is no larger than the batch, and the target stays in place.
    new = j.where(~hit) if part else s.join(target.select(*on).join(s.select(*on), on, "left_semi"), on, "left_anti")

    inserts = new.select(*[F.col(c) if c in on else insert_value(c).cast(target.schema[c].dataType).alias(c)
                           for c in cols if c != surrogate])
    if surrogate is None:
        return existing.unionByName(inserts.select(*cols))
    top = key_floor if key_floor is not None else K.max_key(target, surrogate)
    keyed = K.assign_keys(inserts, [F.col(c) for c in (surrogate_order or on)], surrogate, top)
    return existing.unionByName(keyed.select(*cols))


def insert_only(target: DataFrame, source: DataFrame, on: list[str],
                on_insert: dict[str, Column] | None = None) -> DataFrame:
    """Append source rows whose key is not in the target (insert-only load)."""
    new = source.join(target.select(*on), on, "left_anti")
    add = new.select(*[(on_insert or {}).get(c, F.col(c) if c in source.columns else F.lit(None))
                       .cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return target.unionByName(add)


def update_where(df: DataFrame, pred: Column, sets: dict[str, Column]) -> DataFrame:
    """M8: ``UPDATE ... SET c = expr WHERE pred`` as a new snapshot frame."""
    hit = F.coalesce(pred, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in sets.items()})


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """M9: ``DELETE ... WHERE pred`` (a null predicate keeps the row)."""
    return df.where(~F.coalesce(pred, F.lit(False)))
