"""Review record plans shared by queries, jobs and streams: raw JSON lines ->
typed + cleaned + validated records (S1 -> E3 -> F2 -> V6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import jsonpath as J
from ..functions import text as X
from ..operators import validate as V
from ..operators.fence import fence
from ..sources import ndjson as N
from ..sources.tables import review_records

RAW_FIELDS = tuple(S.REVIEW_TYPES)
STAR_FIELDS = RAW_FIELDS + tuple(S.STAR_TYPES)


def review_lines(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = RAW_FIELDS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """The review feed as NDJSON text lines (``value``), one per review row,
    derived from the driver's tables (the reference's input is JSON)."""
    # Fenced: the parser's blank-line filter must read the serialised text, not
    # be pushed below it (which re-serialises each row inside the joins).
    return fence(N.to_lines(review_records(spark, sf_dir), list(fields), list(keep)), "feed")


def extract(parsed: DataFrame, types: dict[str, str] = S.REVIEW_TYPES, v: str = "v",
            keep: list[str] | None = None) -> DataFrame:
    """Typed columns from the raw record in one walk over it (a field that is absent,
    JSON null or not castable is null); ``v`` is kept for kind checks."""
    keep = keep if keep is not None else [c for c in parsed.columns if c not in types]
    record = J.get(v, "$", "struct<" + ", ".join(f"{n}: {t}" for n, t in types.items()) + ">")
    return parsed.select(*keep, record.alias("__r")).select(*keep, *[F.col("__r")[n].alias(n) for n in types])


def clean_validate(parsed: DataFrame, types: dict[str, str] = S.REVIEW_TYPES, v: str = "v",
                   normalise: bool = True, keep: list[str] | None = None) -> DataFrame:
    """typed -> F2 cleaning -> V6 errors (validated on the cleaned text, with
    kinds from the raw variant, as the reference validates cleaned records)."""
    typed = extract(parsed, types, v, keep)
    cleaned = X.clean_review(typed, normalise=normalise)
    return V.annotate(cleaned, v=v, text_cols=tuple(f for f in S.TEXT_FIELDS if f in types))


def parsed_reviews(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = RAW_FIELDS,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    return N.parse_lines(review_lines(spark, sf_dir, fields, keep))


def validated_reviews(spark: SparkSession, sf_dir: str, normalise: bool = True) -> DataFrame:
    """Annotated review records (typed, cleaned, ``errors``), ``v`` dropped."""
    return clean_validate(parsed_reviews(spark, sf_dir), normalise=normalise).drop("v", "source_file")


def valid_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated_reviews(spark, sf_dir).where(F.size("errors") == 0).drop("errors")


def validated_file(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """The annotated records of NDJSON files, a line that does not parse as an
    invalid record (``is_corrupt``). ``limit``: the first records only, by file,
    split of it and place there."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                                         F.monotonically_increasing_id().alias("_at"))
    if limit:
        blank = F.coalesce(F.length(N.stripped(F.col("value"))) == 0, F.lit(True))
        lines = lines.where(~blank).orderBy("_file", "_block", "_at").limit(limit)
    ann = clean_validate(N.parse_lines(lines.select("value", "_file"), N.PERMISSIVE, source=F.col("_file")).drop("_file"))
    of = ann.schema["errors"].dataType
    broken = F.array(F.struct(*[F.lit("JSON parse error" if f.name == "message" else "*").alias(f.name) for f in of.elementType.fields]))
    return ann.withColumn("errors", F.when(F.col("is_corrupt"), broken).otherwise(F.col("errors"))).drop("v")
