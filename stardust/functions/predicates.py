"""Row predicates (P1-P11). Each builder returns a boolean Column that is never
null (null counts as "drop"), so ``where`` and ``~`` behave like the
reference's Python predicates. Id sets that are data are joins, not literal lists."""

from __future__ import annotations

import datetime as dt
from functools import reduce

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X

def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _nn(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def star_between(min_stars: int = 1, max_stars: int = 5, col: str = "star_rating") -> Column:
    """Integer rating within [min, max], inclusive."""
    return _nn(_c(col).between(min_stars, max_stars))


def verified(flag: bool = True, col: str = "verified_purchase") -> Column:
    """Flag equals 'Y' (or 'N' when flag is False)."""
    return _nn(_c(col) == F.lit("Y" if flag else "N"))


def date_between(start: dt.date | str | None = None, end: dt.date | str | None = None,
                 col: str = "review_date") -> Column:
    """Parseable date within the inclusive range; open ends allowed;
    unparseable dates are dropped even when no bound is given."""
    d = X.parse_date(col)
    cond = d.isNotNull()
    if start is not None:
        cond = cond & (d >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (d <= F.lit(end).cast("date"))
    return _nn(cond)


def in_set(values, col: str) -> Column:
    """P4 / P6 / P7 with a literal set of any size; a missing value compares as ''.
    A set that is itself data (a frame) goes to ``keep_in`` / ``drop_in``."""
    return _nn(F.coalesce(_c(col), F.lit("")).isin(sorted(set(values))))


def category_in(categories, col: str = "product_category") -> Column:
    """P4 (case-sensitive)."""
    return in_set(categories, col)


def product_in(ids, col: str = "product_id") -> Column:
    """P6."""
    return in_set(ids, col)


def customer_in(ids, col: str = "customer_id") -> Column:
    """P7."""
    return in_set(ids, col)


def category_not_in(categories, col: str = "product_category") -> Column:
    """A missing category is kept (unless '' is listed)."""
    return ~in_set(categories, col)


def min_length(n: int = 10, col: str = "review_body") -> Column:
    """P5: at least ``n`` characters (inclusive)."""
    return _nn(F.length(_c(col)) >= n)


def recent(ts_col: str, now: Column, interval: str) -> Column:
    """P10: ``ts >= now - interval`` with ``now`` pinned by the caller."""
    return _nn(_c(ts_col) >= now - F.expr(f"INTERVAL {interval}"))


def equals(col: str, value) -> Column:
    """Equality / status predicate."""
    return _nn(_c(col) == F.lit(value))


def all_of(*preds: Column) -> Column | None:
    """AND of any number of predicates; none -> None (no filter)."""
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply_filters(df: DataFrame, *preds: Column) -> DataFrame:
    """One ``where`` for all predicates (Catalyst pushes what it can)."""
    cond = all_of(*preds)
    return df if cond is None else df.where(cond)


def keep_in(df: DataFrame, ids, col: str, id_col: str | None = None) -> DataFrame:
    """P4/P6/P7 with a set of values or a frame of them: the frame becomes a left
    semi join (J6), whose id side Spark broadcasts only when its measured size is
    under the broadcast threshold. Both give the same rows."""
    if not isinstance(ids, DataFrame):
        return df.where(in_set(ids, col))
    id_col = id_col or col
    right = ids.select(F.col(id_col).alias("__id")).distinct()
    return df.join(right, F.coalesce(df[col], F.lit("")) == right["__id"], "left_semi")


def drop_in(df: DataFrame, ids, col: str, id_col: str | None = None) -> DataFrame:
    """P8 with a set of values or a frame of them (a left anti join)."""
    if not isinstance(ids, DataFrame):
        return df.where(~in_set(ids, col))
    id_col = id_col or col
    right = ids.select(F.col(id_col).alias("__id")).distinct()
    return df.join(right, F.coalesce(df[col], F.lit("")) == right["__id"], "left_anti")


def python_filter(fn, *cols: str) -> Column:
    """X1 escape hatch: a Python predicate over whole Arrow batches
    (``fn(*pandas.Series) -> pandas.Series[bool]``); null results drop the row.
    Prefer the column predicates above: they stay in the JVM."""

    names = list(cols)

    @F.pandas_udf(T.BooleanType())
    def _pred(batch: pd.DataFrame) -> pd.Series:
        return fn(*[batch[c] for c in names]).astype("boolean")

    return _nn(_pred(F.struct(*[F.col(c) for c in names])))
