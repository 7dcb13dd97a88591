"""Scalar column transforms (F1-F16). Every builder takes and returns a Column
and stays JVM-side, except NFC normalisation, which Spark lacks: that one is an
Arrow UDF that only receives values containing non-ASCII text (ASCII text is
already NFC); ASCII rows cross as nulls and skip the Python loop."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


@F.arrow_udf(T.StringType())
def _nfc_udf(a: pa.Array) -> pa.Array:
    # Only the non-null slots (values with non-ASCII text) reach Python's
    # normaliser; the null slots of ASCII rows are skipped without a loop.
    # (Arrow's own utf8_normalize is not used: it left "e" + U+0301 unchanged.)
    if a.null_count == len(a):
        return a
    mask = pc.is_valid(a)
    vals = pc.filter(a, mask).to_pylist()
    normed = pa.array([unicodedata.normalize("NFC", x) for x in vals], pa.string())
    return pc.replace_with_mask(a, mask, normed)


def has_non_ascii(c: Column) -> Column:
    """More UTF-8 bytes than characters: cheaper than a regex scan."""
    return F.octet_length(c) > F.length(c)


def nfc(col: str | Column) -> Column:
    """Unicode NFC form; ASCII values skip the Python round trip."""
    c = _c(col)
    non_ascii = has_non_ascii(c)
    return F.when(non_ascii, _nfc_udf(F.when(non_ascii, c))).otherwise(c)


WS = "(?U)\\s+"


def clean_text(col: str | Column, normalise: bool = True) -> Column:
    """NFC, then delete control characters, then collapse any Unicode
    whitespace run to one space, then strip. The order matters: a vertical tab
    is deleted (joining words) before whitespace is collapsed.

    ASCII text takes a cheaper, equivalent branch (no Python, no Unicode
    classes): once control characters are gone its only whitespace is tab,
    newline, carriage return and space, and after collapsing, ``trim`` is a
    full strip. Measured: running these two plain regexes on every ASCII value
    is cheaper than testing first whether a value needs them."""
    raw = _c(col)
    non_ascii = has_non_ascii(raw)
    c = nfc(raw) if normalise else raw
    c = F.regexp_replace(c, S.CONTROL_CHARS_CLASS, "")
    uni = F.regexp_replace(F.regexp_replace(c, WS, " "), "(?U)^\\s+|\\s+$", "")
    ascii_ = F.trim(F.regexp_replace(F.regexp_replace(raw, S.CONTROL_CHARS_CLASS, ""), "[\\t\\n\\r ]+", " "))
    return F.when(non_ascii, uni).otherwise(ascii_)


def _nfc_jvm(c: Column) -> Column:
    """NFC by the ICU library that Spark brings along (``compose`` without the
    compatibility forms), so that the row stays in the JVM."""
    return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))


def clean_review(df: DataFrame, fields: tuple[str, ...] = S.TEXT_FIELDS, normalise: bool = True) -> DataFrame:
    """clean the review text fields that exist in the frame; others untouched.

    One search over all fields of a record tells whether it holds anything but printable
    ASCII. If not, cleaning is no more than runs of spaces and the ends. The full
    cleaning of the others sits in a lambda, outside the generated code of the rows."""
    present = [f for f in fields if f in df.columns and isinstance(df.schema[f].dataType, T.StringType)]
    if not present:
        return df

    def full(c: Column) -> Column:
        normed = F.when(has_non_ascii(c), _nfc_jvm(c)).otherwise(c) if normalise else c
        return clean_text(normed, False)

    def spaces(c: Column) -> Column:
        return F.trim(F.when(c.contains("  "), F.regexp_replace(c, " {2,}", " ")).otherwise(c))

    odd = F.concat_ws("", *present).rlike("[^ -~]")
    told = F.transform(F.array(F.struct(*present)), lambda r: F.struct(*[full(r[f]).alias(f) for f in present]))
    done = df.withColumns({"__odd": odd, "__full": F.when(odd, told[0])})
    return done.withColumns({f: F.when(F.col("__odd"), F.col("__full")[f]).otherwise(spaces(F.col(f))) for f in present}).drop("__odd", "__full")


_NUMERIC_TEXT = "^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$"


def coerce_star_rating(col: str | Column, lo: int = S.STAR_MIN, hi: int = S.STAR_MAX) -> Column:
    """number or numeric text -> truncated integer, kept only within
    [lo, hi]; anything else null. Works on string and numeric columns (cast the
    column to string first when its type varies)."""
    c = _c(col)
    as_text = c.cast("string")
    # The regex guard keeps Spark-only number forms ('4d', 'inf') out.
    d = F.when(as_text.rlike(_NUMERIC_TEXT), as_text.try_cast("double"))
    i = F.when(F.abs(d) < F.lit(2.0 ** 31), d.cast("int"))
    return F.when(i.between(lo, hi), i)


def coerce_flag(col: str | Column) -> Column:
    """booleans and the words Y/YES/TRUE/1 or N/NO/FALSE/0 (any case,
    surrounding whitespace ignored) -> 'Y' / 'N'; anything else null, numbers
    included (1 is no flag, the text '1' is)."""
    c = _c(col)
    worded = F.typeof(c).isin("string", "boolean")
    v = F.upper(F.regexp_replace(c.cast("string"), "(?U)^\\s+|\\s+$", ""))
    return F.when(worded & v.isin(*S.FLAG_YES), F.lit("Y")).when(worded & v.isin(*S.FLAG_NO), F.lit("N"))


def coerce_flag_bool(col: str | Column) -> Column:
    """F4 for a boolean column."""
    c = _c(col)
    return F.when(c, F.lit("Y")).when(~c, F.lit("N"))


def parse_date(col: str | Column) -> Column:
    """'YYYY-M-D' text (month and day may be unpadded) -> DATE, else null;
    impossible dates such as 2024-13-45 give null."""
    c = _c(col)
    return F.when(c.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))


def is_valid_date(col: str | Column) -> Column:
    """Format check only (2024-13-45 passes, 2024-1-5 fails)."""
    return F.coalesce(_c(col).rlike("(?U)" + S.DATE_PATTERN), F.lit(False))


def stringify(col: str | Column, dtype: T.DataType | None = None) -> Column:
    """text form for CSV: null -> '', booleans as True/False, nested
    values as JSON, everything else its string cast."""
    c = _c(col)
    if isinstance(dtype, T.BooleanType):
        s = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        s = F.to_json(c)
    else:
        s = c.cast("string")
    return F.coalesce(s, F.lit(""))


def stringify_frame(df: DataFrame) -> DataFrame:
    return df.select(*[stringify(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def truncate_text(col: str | Column, max_chars: int, suffix: str = "…") -> Column:
    """keep at most ``max_chars`` characters, suffix included."""
    c = _c(col)
    room = F.greatest(F.lit(max_chars) - F.length(F.lit(suffix)), F.lit(0))
    return F.when(F.length(c) <= max_chars, c).otherwise(F.concat(F.left(c, room), F.lit(suffix)))


def mask_id(col: str | Column, visible: int = 4) -> Column:
    """F8: stars for all but the last ``visible`` characters; visible=0 masks the
    whole id."""
    c = _c(col)
    n = F.length(c)
    return F.when(n <= visible, c).otherwise(F.concat(F.repeat(F.lit("*"), n - visible), F.right(c, F.lit(visible))))


def sanitize_columns(df: DataFrame) -> DataFrame:
    """F10 on a frame: every character of a name that is no ASCII letter, digit or
    underscore becomes an underscore; two columns must not end up with one name."""
    renamed = {c: re.sub("(?a)\\W", "_", c) for c in df.columns}
    if len({n.lower() for n in renamed.values()}) < len(df.columns):
        raise ValueError(f"two columns share a name once cleaned: {renamed}")
    return df.withColumnsRenamed(renamed)


def content_hash(cols: list[str] | None = None, df: DataFrame | None = None, v: str | None = None) -> Column:
    """SHA-256 of the record content with keys in sorted order.

    For a VARIANT record (``v``) the JSON text is already key-sorted. For typed
    columns the struct is built in sorted name order."""
    if v is not None:
        return F.sha2(F.to_json(F.col(v)), 256)
    names = sorted(cols if cols is not None else df.columns)
    return F.sha2(F.to_json(F.struct(*names)), 256)


def file_digests(spark, path: str) -> DataFrame:
    """(path, length, sha256) for every file under ``path``; each file is
    hashed on an executor."""
    return (spark.read.format("binaryFile").load(path)
            .select("path", "length", F.sha2(F.col("content"), 256).alias("sha256")))


def run_message(count: Column) -> Column:
    """F16: null-safe concat message (NULL count renders as 0)."""
    return F.concat(F.lit("Archived "), F.coalesce(count, F.lit(0)).cast("string"), F.lit(" records successfully"))
