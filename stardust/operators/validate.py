"""Validation and data quality.

Rules are data: each is (field, rule, failing-condition, message). A record's
errors are one ``array<struct<field, rule, message>>`` column built from the rule
list, so validation is a single projection inside whole-stage codegen and the
valid / invalid split is two filters over the same annotated frame.

Records can be checked in raw form (a VARIANT, where "missing", "JSON null"
and "wrong JSON type" are all visible) or in typed form (columns; a null is a
present-but-null value, a column absent from the frame is a missing field).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import jsonpath as J
from ..functions import text as X
from .fence import fence

ERROR_TYPE = "array<struct<field:string,rule:string,message:string>>"


def py_repr_text(s: Column) -> Column:
    """Python ``repr`` of a string value (quotes, backslash, \\n \\r \\t)."""
    swap = lambda t, a, b: F.replace(t, F.lit(a), F.lit(b))
    esc = swap(swap(swap(swap(s, "\\", "\\\\"), "\n", "\\n"), "\r", "\\r"), "\t", "\\t")
    dq = s.contains("'") & ~s.contains('"')
    return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), swap(esc, "'", "\\'"), F.lit("'")))


class _Access:
    """How rules see a field."""

    def present(self, f: str) -> Column: ...
    def is_string(self, f: str) -> Column: ...
    def is_int(self, f: str) -> Column: ...
    def text(self, f: str) -> Column: ...
    def int_value(self, f: str) -> Column: ...
    def repr(self, f: str) -> Column: ...

    def is_clean(self, f: str) -> bool:
        return False


class VariantAccess(_Access):
    """Kinds come from the raw VARIANT; text may come from already-cleaned
    columns (``text_cols``), since cleaning never changes a value's kind.

    ``prepare`` computes each field's kind (and raw text / integer value) once
    per row into helper columns behind a fence, so the rules read columns
    instead of re-walking the variant for every reference."""

    def __init__(self, v: str = "v", bool_is_int: bool = False, text_cols: tuple[str, ...] = ()):
        self.v, self.bool_is_int, self.text_cols = v, bool_is_int, set(text_cols)

    def is_clean(self, f):
        return f in self.text_cols

    @staticmethod
    def _k(f):
        return F.col(f"__k_{f}")

    def prepare(self, df: DataFrame) -> DataFrame:
        cols = {f"__k_{f}": J.kind(self.v, f) for f in S.REQUIRED_FIELDS}
        cols.update({f"__t_{f}": J.get(self.v, f, "string") for f in S.REQUIRED_FIELDS if f not in self.text_cols})
        cols["__i_star_rating"] = J.get(self.v, "star_rating", "bigint")
        return fence(df.withColumns(cols), "kinds")

    def cleanup(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in df.columns if c.startswith(("__k_", "__t_", "__i_"))])

    def present(self, f):
        return self._k(f).isNotNull()

    def is_string(self, f):
        return F.coalesce(self._k(f) == F.lit("STRING"), F.lit(False))

    def is_int(self, f):
        k = self._k(f)
        ok = k.isin("TINYINT", "SMALLINT", "INT", "BIGINT")
        if self.bool_is_int:
            ok = ok | (k == F.lit("BOOLEAN"))
        return F.coalesce(ok, F.lit(False))

    def text(self, f):
        src = F.col(f) if f in self.text_cols else F.col(f"__t_{f}")
        return F.when(self.is_string(f), src)

    def int_value(self, f):
        src = F.col("__i_star_rating") if f == "star_rating" else J.get(self.v, f, "bigint")
        return F.when(self.is_int(f), src)

    def repr(self, f):
        k = self._k(f)
        return (F.when(k == "VOID", F.lit("None"))
                 .when(k == "STRING", py_repr_text(self.text(f)))
                 .when(k == "BOOLEAN", F.when(J.get(self.v, f, "boolean"), "True").otherwise("False"))
                 .otherwise(J.json_text(self.v, f)))


class TypedAccess(_Access):
    def __init__(self, schema: T.StructType):
        self.types = {fld.name: fld.dataType for fld in schema.fields}

    def present(self, f):
        return F.lit(f in self.types)

    def _t(self, f):
        return self.types.get(f)

    def is_string(self, f):
        return F.lit(False) if not isinstance(self._t(f), T.StringType) else F.col(f).isNotNull()

    def is_int(self, f):
        ok = isinstance(self._t(f), (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        return F.lit(False) if not ok else F.col(f).isNotNull()

    def text(self, f):
        return F.col(f) if isinstance(self._t(f), T.StringType) else F.lit(None).cast("string")

    def int_value(self, f):
        return F.when(self.is_int(f), F.col(f).cast("bigint")) if f in self.types else F.lit(None).cast("bigint")

    def repr(self, f):
        if f not in self.types:
            return F.lit("None")
        t, c = self._t(f), F.col(f)
        if isinstance(t, T.StringType):
            r = py_repr_text(c)
        elif isinstance(t, T.BooleanType):
            r = F.when(c, "True").otherwise("False")
        else:
            r = c.cast("string")
        return F.coalesce(r, F.lit("None"))


@dataclass(frozen=True)
class Rule:
    field: str
    rule: str
    bad: Column
    message: Column


def review_rules(acc: _Access, null_is_missing: bool = False) -> list[Rule]:
    """The review rule list in the reference's order (V1-V5).

    ``null_is_missing`` gives the older twin's behaviour: a null value is not
    checked (it only counts when the key is absent)."""
    rules: list[Rule] = []
    missing = [F.when(~acc.present(f), F.lit(f)) for f in sorted(S.REQUIRED_FIELDS)]
    names = F.array_compact(F.array(*missing))
    listed = F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
    absent = reduce(lambda a, b: a | b, [~acc.present(f) for f in S.REQUIRED_FIELDS])
    rules.append(Rule("*", "missing", absent, F.concat(F.lit("Missing fields: "), listed)))

    def checked(f: str) -> Column:
        p = acc.present(f)
        if null_is_missing:
            p = p & ~(acc.repr(f) == F.lit("None"))
        return p

    for f in S.STRING_FIELDS:
        # Cleaned text is already stripped; raw text is stripped here.
        t = acc.text(f)
        stripped = t if acc.is_clean(f) else F.regexp_replace(t, "(?U)^\\s+|\\s+$", "")
        bad = ~(acc.is_string(f) & (F.length(stripped) > 0))
        rules.append(Rule(f, "non_empty_string", checked(f) & F.coalesce(bad, F.lit(True)),
                          F.concat(F.lit(f"{f} must be a non-empty string, got "), acc.repr(f))))
    f = "review_date"
    bad = ~(acc.is_string(f) & X.is_valid_date(acc.text(f)))
    rules.append(Rule(f, "date_format", checked(f) & F.coalesce(bad, F.lit(True)),
                      F.concat(F.lit(f"{f} must be YYYY-MM-DD, got "), acc.repr(f))))
    f = "star_rating"
    bad = ~(acc.is_int(f) & acc.int_value(f).between(S.STAR_MIN, S.STAR_MAX))
    rules.append(Rule(f, "star_range", checked(f) & F.coalesce(bad, F.lit(True)),
                      F.concat(F.lit(f"{f} must be int {S.STAR_MIN}-{S.STAR_MAX}, got "), acc.repr(f))))
    f = "verified_purchase"
    allowed = "[" + ", ".join(f"'{x}'" for x in S.VERIFIED_VALUES) + "]"
    bad = ~(acc.is_string(f) & acc.text(f).isin(*S.VERIFIED_VALUES))
    rules.append(Rule(f, "allowed_values", checked(f) & F.coalesce(bad, F.lit(True)),
                      F.concat(F.lit(f"{f} must be one of {allowed}, got "), acc.repr(f))))
    return rules


def errors_column(rules: list[Rule]) -> Column:
    """V6: all error structs of a record, in rule order (empty when valid).

    The generated code of a row holds the tests alone; the error texts sit in a
    lambda, outside it, and only records that fail a test reach them. In one
    expression they make a method too long for the JIT to compile."""
    items = [F.when(r.bad, F.struct(F.lit(r.field).alias("field"), F.lit(r.rule).alias("rule"),
                                    r.message.alias("message"))) for r in rules]
    told = F.transform(F.array(F.lit(0)), lambda _: F.array_compact(F.array(*items)))
    failed = reduce(lambda a, b: a | b, [F.coalesce(r.bad, F.lit(False)) for r in rules])
    return F.when(failed, told[0]).otherwise(F.array().cast(ERROR_TYPE))


def with_errors(df: DataFrame, rules: list[Rule], out: str) -> DataFrame:
    """V6: adds ``errors_column``. The tests come first, as columns behind a fence: the
    lambda of the texts, which is interpreted, reads their outcomes and runs none again."""
    flags = [f"__bad_{i}" for i in range(len(rules))]
    tested = fence(df.withColumns({n: F.coalesce(r.bad, F.lit(False)) for n, r in zip(flags, rules)}), "tests")
    return tested.withColumn(out, errors_column([replace(r, bad=F.col(n)) for n, r in zip(flags, rules)])).drop(*flags)


def annotate(df: DataFrame, v: str | None = "v", null_is_missing: bool = False,
             bool_is_int: bool = False, out: str = "errors", text_cols: tuple[str, ...] = (),
             extra_rules: list[Rule] | None = None) -> DataFrame:
    """V6: add the ``errors`` array; raw records when ``v`` is a VARIANT column
    of ``df`` (``text_cols`` name cleaned text columns to check instead of the
    raw text), typed columns otherwise. ``extra_rules`` (X2: user validators as
    column rules) are checked after the built-in ones."""
    if v is not None and v in df.columns:
        acc = VariantAccess(v, bool_is_int, text_cols)
        rules = review_rules(acc, null_is_missing) + list(extra_rules or [])
        checked = acc.cleanup(with_errors(acc.prepare(df), rules, out))
    else:
        rules = review_rules(TypedAccess(df.schema), null_is_missing) + list(extra_rules or [])
        checked = with_errors(df, rules, out)
    # Fenced: later filters on the errors must not re-evaluate the rules below.
    return fence(checked, "validation")


def with_batch_validator(annotated: DataFrame, validator: Callable[[pa.RecordBatch], pa.Array], out: str = "errors",
                         columns: list[str] | None = None, field: str = "*", rule: str = "custom") -> DataFrame:
    """A user's validator over Arrow batches. It gets a record batch of ``columns``
    (all but the errors by default) and returns a list of error texts for each row
    (``list<string>``; null or empty: none); these come after the row's errors."""
    columns = columns or [c for c in annotated.columns if c != out]
    src = annotated.select(F.struct("*").alias("row"), F.struct(*columns).alias("seen"))
    schema = T.StructType([src.schema["row"], T.StructField("told", T.ArrayType(T.StringType()))])

    def run(batches):
        for b in batches:
            seen = b.column("seen")
            told = validator(pa.RecordBatch.from_arrays([seen.field(c) for c in columns], names=columns))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(told, pa.list_(pa.string())) if not isinstance(told, pa.Array) else told.cast(pa.list_(pa.string()))],
                                             names=["row", "told"])

    got = src.mapInArrow(run, schema)
    more = F.transform(F.coalesce("told", F.array().cast("array<string>")), lambda m: F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), m.alias("message")))
    return got.select(*[F.concat(F.col(f"row.{out}"), more).alias(out) if c == out else F.col(f"row.`{c}`").alias(c) for c in annotated.columns])


def split(annotated: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """V7: (valid, invalid) over one annotated frame. Persist the annotated frame
    (or write both from one ``foreachBatch``) when both sides are consumed."""
    valid = annotated.where(F.size(errors) == 0).drop(errors)
    invalid = annotated.where(F.size(errors) > 0)
    return valid, invalid


def error_text(errors: str = "errors", sep: str = "; ") -> Column:
    return F.array_join(F.transform(F.col(errors), lambda e: e["message"]), sep)


def report_totals(annotated: DataFrame, errors: str = "errors") -> DataFrame:
    """V8 totals: total, valid, invalid, pass rate (1.0 for an empty input)."""
    return annotated.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size(errors) == 0).alias("valid_count"),
        F.count_if(F.size(errors) > 0).alias("invalid_count"),
    ).withColumn("pass_rate", F.coalesce(F.try_divide(F.col("valid_count").cast("double"), F.col("total")), F.lit(1.0)))


def summary_key(e: Column) -> Column:
    """V8 key: the field name for field rules, first 40 characters otherwise."""
    return F.when(e["rule"] == "missing", F.substring(e["message"], 1, 40)).otherwise(e["field"])


def error_summary(annotated: DataFrame, errors: str = "errors") -> DataFrame:
    """V8 errors per rule key (long form, one row per key). Only invalid rows
    are exploded; the count is a partial + final aggregate."""
    return (annotated.where(F.size(errors) > 0)
            .select(F.explode(errors).alias("e"))
            .groupBy(summary_key(F.col("e")).alias("error_key"))
            .agg(F.count(F.lit(1)).alias("n")))


def error_summary_map(annotated: DataFrame, errors: str = "errors") -> DataFrame:
    """V8 ``error_summary`` as a one-row map (number of keys is bounded by the rule list)."""
    return error_summary(annotated, errors).agg(
        F.map_from_entries(F.collect_list(F.struct("error_key", "n"))).alias("error_summary"))


def assert_valid(annotated: DataFrame, errors: str = "errors", key: str = "review_id") -> DataFrame:
    """V9: the first invalid record fails the job (raised inside the task)."""
    msg = F.concat(F.lit("Validation failed for "), F.coalesce(F.col(key).cast("string"), F.lit("?")),
                   F.lit(": "), error_text(errors))
    # A filter (not a dropped column, which the optimiser would prune) keeps the check.
    return annotated.where(F.when(F.size(errors) > 0, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))


def length_check(col: str, max_len: int) -> Rule:
    """V9 companion: VARCHAR(n) length rule for typed target columns."""
    c = F.col(col)
    return Rule(col, "max_length", F.coalesce(F.length(c) > max_len, F.lit(False)),
                F.concat(F.lit(f"{col} longer than {max_len} characters: "), F.length(c).cast("string")))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (left anti join)."""
    dim_key = dim_key or fact_key
    d = dim.select(F.col(dim_key).alias("__k")).distinct()
    return fact.join(d, fact[fact_key] == d["__k"], "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview_invalid(annotated: DataFrame, order_by: list[str], n: int = 20, errors: str = "errors") -> DataFrame:
    """The first ``n`` invalid records (by an explicit order)."""
    return annotated.where(F.size(errors) > 0).orderBy(*order_by).limit(n)
