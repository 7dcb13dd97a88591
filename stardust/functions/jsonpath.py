"""JSON extraction on VARIANT columns.

Raw records stay as VARIANT until they are validated, because only the variant
keeps the three states a typed column loses: missing key, JSON null, wrong type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _path(name: str) -> str:
    # Field names with dots or brackets would need quoting; review fields do not.
    return "$." + name if not name.startswith("$") else name


def get(v: str | Column, path: str, type_: str = "string") -> Column:
    """Path access + cast; null when absent, JSON null or not castable."""
    return F.try_variant_get(_c(v), _path(path), type_)


def get_strict(v: str | Column, path: str, type_: str = "string") -> Column:
    """E3 strict form: a value that cannot be cast fails the job."""
    return F.variant_get(_c(v), _path(path), type_)


def node(v: str | Column, path: str) -> Column:
    """The sub-variant at ``path`` (SQL null when the key is missing)."""
    return F.try_variant_get(_c(v), _path(path), "variant")


def kind(v: str | Column, path: str) -> Column:
    """JSON kind of a field: NULL = missing, 'VOID' = JSON null, else
    'STRING', 'BIGINT', 'DECIMAL(p,s)', 'DOUBLE', 'BOOLEAN', 'OBJECT<...>', 'ARRAY<...>'."""
    return F.schema_of_variant(node(v, path))


def is_missing(v: str | Column, path: str) -> Column:
    return node(v, path).isNull()


def is_json_null(v: str | Column, path: str) -> Column:
    n = node(v, path)
    return n.isNotNull() & F.is_variant_null(n)


def is_string(v: str | Column, path: str) -> Column:
    return F.coalesce(kind(v, path) == F.lit("STRING"), F.lit(False))


def is_integer(v: str | Column, path: str, bool_is_int: bool = False) -> Column:
    """JSON integer (whole-number literal without fraction or exponent).

    Integer literals parse as the integer kinds; ``5.0`` parses as DECIMAL and
    fails, like the reference's ``isinstance(x, int)``. ``bool_is_int`` restores
    Python's ``isinstance(True, int)`` quirk.
    """
    k = kind(v, path)
    ok = k.isin("TINYINT", "SMALLINT", "INT", "BIGINT")
    if bool_is_int:
        ok = ok | (k == F.lit("BOOLEAN"))
    return F.coalesce(ok, F.lit(False))


def json_text(v: str | Column, path: str) -> Column:
    """Raw JSON text of a field (null when missing)."""
    return F.to_json(node(v, path))


def as_records(v: str | Column) -> Column:
    """E1 element array: an array document gives its elements, a bare object
    (or any other value) gives itself (trap: exploding an object yields keys)."""
    vv = _c(v)
    return F.coalesce(F.try_variant_get(vv, "$", "array<variant>"), F.array(vv))


def flatten(df: DataFrame, v: str = "v", out: str = "rec", keep: list[str] | None = None) -> DataFrame:
    """One row per record of a document that is an array of records or a
    record. Rows whose document is SQL null disappear (nothing to unnest)."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != out]
    return df.select(*keep, F.posexplode(as_records(v)).alias(f"{out}_pos", out))


def flatten_nested(df: DataFrame, parent: str, path: str, out: str) -> DataFrame:
    """Second lateral unnest of an array inside each record."""
    arr = F.try_variant_get(F.col(parent), _path(path), "array<variant>")
    return df.select("*", F.posexplode(arr).alias(f"{out}_pos", out))


def typed(df: DataFrame, types: dict[str, str], v: str = "v", keep: list[str] | None = None) -> DataFrame:
    """Cast the listed paths to typed columns (one projection, done once)."""
    keep = keep if keep is not None else [c for c in df.columns if c != v]
    return df.select(*keep, *[get(v, name, t).alias(name) for name, t in types.items()])
