"""File sinks and the CSV source.

Writers are distributed (one file per task); row counts come from an
``Observation`` on the same job, so no second pass over the data is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import text as X
from . import csv_records


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = False,
                 compression: str | None = None) -> int:
    """NDJSON, one file per task; returns the row count.

    Null fields are left out by default; ``keep_nulls`` writes them as null."""
    out, obs = _observed(df, "write_ndjson")
    w = out.write.mode(mode).option("ignoreNullFields", not keep_nulls)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return int(obs.get.get("rows", 0))


def read_csv(spark: SparkSession, path: str, encoding: str = "utf-8", multi_line: bool = True) -> DataFrame:
    """CSV with a header, every column text (no inference); empty cells read as
    ''. Quoted fields may span lines; UTF-8 files are read by many tasks each all the
    same (``csv_records``), those of another encoding by one a file. ``multi_line=False``
    is for files whose fields span no lines."""
    if multi_line and encoding.lower().replace("_", "-") in ("utf-8", "utf8", "utf-8-sig"):
        return csv_records.read(spark, path)
    df = (spark.read.option("header", True).option("encoding", encoding).option("escape", '"')
          .option("multiLine", multi_line).option("inferSchema", False)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def write_json_array(df: DataFrame, path: str, order: list[Column], mode: str = "errorifexists") -> int:
    """The rows in a total ``order`` as one JSON array over text parts: the parts' lines,
    part after part, are the array; each element has its line, ``[`` or ``,`` before it,
    and the last line is ``]``. No row holds more than one element. Returns the number
    of elements."""
    from ..operators.keys import dense_index

    rows = dense_index(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("__json"), *[c.alias(f"__o{i}") for i, c in enumerate(order)]),
                       [F.col(f"__o{i}") for i in range(len(order))], "__seq")
    n = rows.count()
    lines = rows.select("__seq", F.concat(F.when(F.col("__seq") == 0, "[").otherwise(","), F.col("__json")).alias("value"))
    end = df.sparkSession.createDataFrame([(n, "]" if n else "[]")], "__seq long, value string")
    lines.unionByName(end).orderBy("__seq").select("value").write.mode(mode).text(path)
    return n


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of ``write_json_array``'s parts, each line by itself."""
    lines = spark.read.text(path).where(~F.col("value").isin("]", "[]"))
    return lines.select(F.from_json(F.substr("value", F.lit(2)), schema).alias("r")).select("r.*")


def to_csv_frame(df: DataFrame, fieldnames: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """S7 projection: the chosen columns in order (default 9 review columns);
    extra columns are dropped, missing columns are blank, all values text."""
    cols = list(fieldnames) if fieldnames else list(S.CSV_FIELDS)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[X.stringify(c, types[c]).alias(c) if c in types else F.lit("").alias(c) for c in cols])


def write_csv(df: DataFrame, path: str, fieldnames=None, mode: str = "errorifexists") -> int:
    """Header + rows; an empty input writes nothing and returns 0."""
    out, obs = _observed(to_csv_frame(df, fieldnames), "write_csv")
    (out.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "").csv(path))
    return int(obs.get.get("rows", 0))


def conform(df: DataFrame, columns: list[str], defaults: dict[str, Column] | None = None) -> DataFrame:
    """Project onto a target column list; missing columns take their
    default (or null)."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have and c not in defaults else
                       (defaults[c] if c in defaults else F.lit(None)).alias(c) for c in columns])


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """Append rows (from a query or literal rows) to a table path."""
    out, obs = _observed(df, "append")
    w = out.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get.get("rows", 0))


def copy_table(df: DataFrame, path: str) -> int:
    """Create-as-select backup; fails if the target exists."""
    out, obs = _observed(df, "copy")
    out.write.mode("errorifexists").parquet(path)
    return int(obs.get.get("rows", 0))


def empty_like(df: DataFrame) -> DataFrame:
    """An empty frame with the same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def export_summary(df: DataFrame, path: str, rating: str = "star_rating", category: str = "product_category") -> int:
    """The review summary (averages rounded to 4) in a folder: ``totals``, one JSON
    object with total, avg_star_rating, star_distribution (the ratings of the
    domain), verified and unverified counts and verified_rate; ``categories``, a
    JSON line per category with its count, as many as there are. Returns the number
    of records summarised, observed on the first write."""
    from ..operators import aggregate as A
    summ = A.summary_maps(df, rating)
    known = F.map_filter("star_distribution", lambda k, n: k.between(S.STAR_MIN, S.STAR_MAX))
    row = summ.select("total", F.round("avg_star_rating", 4).alias("avg_star_rating"), known.alias("star_distribution"),
                      "verified_count", "unverified_count", F.round("verified_rate", 4).alias("verified_rate"))
    obs = Observation("summary")
    row.observe(obs, F.max("total").alias("total")).write.mode("errorifexists").json(f"{path}/totals")
    A.category_counts(df, category).write.mode("errorifexists").json(f"{path}/categories")
    return int(obs.get["total"])
