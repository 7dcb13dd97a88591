"""Mixing sources to target weights by systematic sampling.

``mix`` orders the rows by source, size and a fixed tie-break, adds up each
row's expected copies within its source, shifts the sums by one offset per
source (from a hash of its name, so reruns agree) and takes a row once for each
integer that its span of the sums crosses. Rows of like size stand next to each
other, so what a source gives differs from its target by about its largest row.

Defined results: a null size counts as 0; a null source is a source of its own,
last in order; rows that repeat are rows of their own; an empty table gives an
empty result; columns of the input are passed on unless they have the name of a
result column (then the input's are dropped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._common import prefix_sums, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
OUT = ("size", "source_size", "target", "expected", "copies", "taken")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source of ``sizes(source, size)``: ``rows``, ``source_size``,
    ``first_row`` (rows of the sources before it), ``weight`` and ``target``.

    The sources, in code point order (null last), weigh ``weights`` in turn. They
    share ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size and the rest is shared anew. With the sources in order of
    size by weight, those that stop come first: the level ``(what is left) /
    (weights left)`` is taken at the first source that it doesn't fill.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")).withColumn("_one", F.lit(1).cast("long"))
    per = prefix_sums(per, [F.asc_nulls_last("source")], {"_rank": "_one", "first_row": "rows"}, "mix-sources")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")))
    per = prefix_sums(per, [F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")],
                      {"_size": "source_size", "_weight": "weight"}, "mix-levels")
    total = per.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (share * F.lit(total[0] or 0) - most * F.col("_size")) / (F.lit(total[1] or 0) - F.col("_weight")).cast("double")
    fits = per.withColumn("_level", level).where(most * F.col("source_size") >= F.col("_level") * F.col("weight"))
    at = fits.agg(F.min_by("_level", F.struct("_weight", "_rank"))).first()[0]
    shared = F.lit(float("inf") if at is None else at) * F.col("weight")
    return per.select("source", "rows", "source_size", "first_row", "weight",
                      F.least(most * F.col("source_size"), shared).cast("double").alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's offset in [0, 1): 32 bits of a digest of its name."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("-")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mix(df: DataFrame, size: Column, key: Column | None = None, weights=WEIGHTS, share: float = SHARE,
        most: float = MOST, seed: int = 5) -> DataFrame:
    """Every row of ``df`` (which has a column ``source``) with ``size``,
    ``source_size``, ``target``, ``expected`` (copies), ``copies`` and ``taken``
    (size times copies). ``key`` breaks ties of size, for reruns to agree."""
    kept = [c for c in df.columns if c.lower() not in OUT]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("source"),
                     F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                     (F.lit(0) if key is None else key).alias("key"), F.lit(1).cast("long").alias("one"))
    rows = materialize(rows, "mix-rows")
    per = materialize(targets(rows.select("source", "size"), weights, share, most), "mix-targets")
    rows = prefix_sums(rows, [F.asc_nulls_last("source"), F.col("size"), F.col("key")], {"before": "one"}, "mix-order")
    per = per.withColumnRenamed("source", "of")
    j = rows.join(per, F.col("source").eqNullSafe(F.col("of")))
    e = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    nth = F.col("before") - F.col("first_row")
    j = j.withColumn("expected", e).withColumn("shift", offset(F.col("source"), seed))
    crossed = F.floor(F.col("shift") + F.col("expected") * (nth + 1)) - F.floor(F.col("shift") + F.col("expected") * nth)
    j = j.withColumn("copies", crossed.cast("long"))
    return j.select(*[F.col("row")[c].alias(c) for c in kept], "size", "source_size", "target", "expected", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"))


def op5_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("_words")), F.col("_words"), F.col("doc_id"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (
  SELECT *, row_number() OVER o AS k,
         coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w,
         sum(source_size) OVER () AS total
  FROM w WINDOW o AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST)),
v AS (SELECT *, (CAST(1.5 AS DOUBLE) * total - used) / CAST(left_w AS DOUBLE) AS level FROM l),
a AS (SELECT arg_min(level, k) AS lvl FROM v WHERE 2.0 * source_size >= level * weight),
t AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), lvl * weight) AS target,
         CAST(('0x' || substr(md5('5:' || coalesce('s' || source, '-')), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u
  FROM v, a),
o AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS nth FROM d),
e AS (
  SELECT doc_id, size, source_size, target, nth, u,
         CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0 END AS e
  FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CAST(floor(u + e * nth) - floor(u + e * (nth - 1)) AS BIGINT) AS copies FROM e)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""
