"""JSON line and document sources.

Lines are read with the text source (splittable, one task per file split),
parsed once into a VARIANT, and never go through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonpath as J
from ..operators.fence import fence

# Fixed value: what Python's str.strip() removes.
BLANKS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))

STRICT = "strict"
PERMISSIVE = "permissive"


def to_lines(df: DataFrame, cols: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Serialise rows to one JSON text per row (``value``). Null fields are
    left out, the way ``to_json`` writes them."""
    cols = cols or df.columns
    return df.select(*(keep or []), F.to_json(F.struct(*cols)).alias("value"))


def stripped(text: Column) -> Column:
    """The line without the blanks around it (any Unicode blank). One that begins and
    ends with a brace has none, and is not searched for them."""
    whole = text.startswith("{") & text.endswith("}")
    return F.when(whole, text).otherwise(F.btrim(text, F.lit(BLANKS)))


def parse_lines(lines: DataFrame, mode: str = STRICT, value: str = "value",
                source: Column | None = None) -> DataFrame:
    """Blank lines are skipped; each other line parses to ``v``.

    strict: the first unparseable line fails the job with its file and text.
    permissive: bad lines stay, flagged ``is_corrupt`` (for a quarantine sink).
    """
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"mode must be {STRICT!r} or {PERMISSIVE!r}, got {mode!r}")
    src = source if source is not None else F.lit(None).cast("string")
    text = F.col(value)
    blank = F.coalesce(F.length(stripped(text)) == 0, F.lit(True))
    parsed = F.try_parse_json(stripped(text))
    out = lines.where(~blank).withColumn("source_file", src).withColumn("v", parsed)
    if mode == STRICT:
        err = F.raise_error(F.concat(F.lit("JSON parse error at "), F.coalesce(F.col("source_file"), F.lit("<input>")),
                                     F.lit(": "), F.col(value)))
        # A filter, which no projection above (a count, say) can prune away; behind a
        # fence, or it is pushed below the parse and parses the line once more.
        out = fence(out, "parsed").where(F.when(F.col("v").isNull(), err.cast("boolean")).otherwise(F.lit(True)))
    else:
        out = out.withColumn("is_corrupt", F.col("v").isNull())
    # Fenced: every later path lookup reads the parsed value instead of
    # re-serialising and re-parsing the line once per field.
    return fence(out, "parse")


def read_ndjson(spark: SparkSession, path: str | list[str], mode: str = STRICT) -> DataFrame:
    """Read NDJSON files to (value, source_file, v[, is_corrupt])."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    return parse_lines(lines, mode, source=F.col("_file")).drop("_file")


def line_status(lines: DataFrame, value: str = "value") -> DataFrame:
    """Per-line status of a text feed: blank, corrupt or ok (for load reports)."""
    text = F.col(value)
    blank = F.coalesce(F.length(stripped(text)) == 0, F.lit(True))
    return lines.select("*", F.when(blank, "blank")
                        .when(F.try_parse_json(stripped(text)).isNull(), "corrupt")
                        .otherwise("ok").alias("status"))


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """S3: whole-file JSON (object or array); one row per file, then E1 gives
    one row per record. Use for bounded files only (a file is one task)."""
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("v"))
    bad = F.raise_error(F.concat(F.lit("Cannot read JSON from "), F.col("source_file")))
    docs = docs.withColumn("v", F.when(F.col("v").isNull(), bad.cast("variant")).otherwise(F.col("v")))
    return J.flatten(docs, "v", "rec").drop("v").withColumnRenamed("rec", "v")


def landing(parsed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Raw landing table shape: (mydata VARIANT, loaded_timestamp, source_file)."""
    ts = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return parsed.select(F.col("v").alias("mydata"), ts.alias("loaded_timestamp"), "source_file")
