"""Sources, sinks and JSON extraction (S*, E*) plus the flagship recipe."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import jsonpath as J
from ..functions import predicates as P
from ..operators import aggregate as A
from ..plans import reviews as RV
from ..sources import ndjson as N
from ..sources import files as FS
from ..sources.tables import review_records
from ..session import scratch_path
from ._register_helpers import nested_order_documents
from ._registry import register
from ._sql import C, R, REVIEW_COLS, V, with_

RC = ", ".join(REVIEW_COLS)


def flagship(spark, sf_dir):
    """S1 -> F2 -> V7 -> P1(4..5) -> A8: reviews per category with mean rating."""
    valid = RV.valid_reviews(spark, sf_dir)
    kept = P.apply_filters(valid, P.star_between(4, 5))
    return A.count_avg_by(kept, ["product_category"], "review_id", "star_rating", "review_count", "avg_rating")


register("q10_category_rating_recipe", with_(R, C, V) + """
SELECT product_category, count(review_id) AS review_count, round(avg(star_rating), 6) AS avg_rating
FROM v WHERE star_rating BETWEEN 4 AND 5 GROUP BY product_category
""")(flagship)


@register("s1_read_ndjson", with_(R) + f"SELECT {RC} FROM r")
def s1_read_ndjson(spark, sf_dir):
    parsed = RV.parsed_reviews(spark, sf_dir)
    return RV.extract(parsed, keep=[]).select(*REVIEW_COLS)


def _feed_with_junk(spark, sf_dir):
    """Review lines plus a broken line after every first line of an order and a
    blank line after every second line (derived from the data)."""
    r = review_records(spark, sf_dir)
    good = N.to_lines(r, list(S.REVIEW_TYPES))
    broken = r.where(F.col("review_id").endswith("-1")).select(
        F.concat(F.lit('{"review_id": "'), F.col("review_id"), F.lit('", ')).alias("value"))
    blank = r.where(F.col("review_id").endswith("-2")).select(F.lit("   ").alias("value"))
    return good.unionByName(broken).unionByName(blank)


@register("s1b_line_status", with_(R) + """
SELECT 'ok' AS status, count(*) AS n FROM r
UNION ALL SELECT 'corrupt', count(*) FROM r WHERE review_id LIKE '%-1'
UNION ALL SELECT 'blank', count(*) FROM r WHERE review_id LIKE '%-2'
""")
def s1b_line_status(spark, sf_dir):
    return N.line_status(_feed_with_junk(spark, sf_dir)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("s1b_permissive_quarantine", with_(R) + """
SELECT review_id, false AS is_corrupt FROM r
UNION ALL SELECT NULL, true FROM r WHERE review_id LIKE '%-1'
""")
def s1b_permissive(spark, sf_dir):
    parsed = N.parse_lines(_feed_with_junk(spark, sf_dir), N.PERMISSIVE)
    return parsed.select(J.get("v", "review_id").alias("review_id"), "is_corrupt")


@register("s5_ndjson_round_trip", with_(R) + f"SELECT {RC} FROM r")
def s5_ndjson_round_trip(spark, sf_dir):
    """S5 write NDJSON (one file per task) and S1 read it back."""
    path = scratch_path(spark, "s5-ndjson")
    recs = review_records(spark, sf_dir).select(*REVIEW_COLS)
    FS.write_ndjson(recs, path)
    return RV.extract(N.read_ndjson(spark, path), keep=[]).select(*REVIEW_COLS)


@register("s7_csv_round_trip", with_(R) + """
SELECT review_id, review_date, customer_id, product_id, product_title, product_category,
       CAST(star_rating AS VARCHAR) AS star_rating, review_body, verified_purchase FROM r
""")
def s7_csv_round_trip(spark, sf_dir):
    """S7 CSV export with the default 9 columns (helpful_votes dropped), then S4
    read back: every value is text, empty cells are ''."""
    path = scratch_path(spark, "s7-csv")
    FS.write_csv(review_records(spark, sf_dir), path)
    return FS.read_csv(spark, path)


@register("s19_migrate_columns", with_(R) + """
SELECT DISTINCT customer_id, email, name, address, true AS is_active FROM r
""")
def s19_migrate_columns(spark, sf_dir):
    """Project the feed onto a target table's column list with defaults."""
    r = review_records(spark, sf_dir)
    return FS.conform(r, ["customer_id", "email", "name", "address", "is_active"],
                      defaults={"is_active": F.lit(True)}).distinct()


def _order_documents(spark, sf_dir):
    """E1 input: one raw document per order; orders with one line are a bare
    object, others an array of records (the trap: both shapes arrive)."""
    r = review_records(spark, sf_dir)
    rec = F.to_json(F.struct(*S.REVIEW_TYPES, "order_id", "loaded_timestamp"))
    # A document holds the lines of one order in chunks of 8 line numbers, so
    # its array stays bounded even for an order with very many lines.
    chunk = (F.substring_index("review_id", "-", -1).cast("int") / 8).cast("int")
    docs = r.groupBy("order_id", chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(rec).alias("recs"))
    text = F.when(F.col("n") == 1, F.element_at("recs", 1)).otherwise(
        F.concat(F.lit("["), F.array_join("recs", ","), F.lit("]")))
    return docs.select(F.parse_json(text).alias("mydata"))


@register("e1_flatten_documents", with_(R) + f"SELECT {RC}, order_id FROM r")
def e1_flatten(spark, sf_dir):
    docs = _order_documents(spark, sf_dir)
    flat = J.flatten(docs, "mydata", "f0", keep=[])
    return flat.select(*[J.get("f0", k, t).alias(k) for k, t in S.REVIEW_TYPES.items()],
                       J.get("f0", "order_id", "bigint").alias("order_id"))


@register("e2_nested_flatten", with_(R) + """
SELECT DISTINCT order_id, min(review_date) OVER (PARTITION BY order_id) AS order_date,
       customer_id, product_id, quantity FROM r
""")
def e2_nested(spark, sf_dir):
    """E2 (nested draft shape): a document is an array of orders, each with a
    customer object and a products array; unnest orders, then products."""
    docs = nested_order_documents(review_records(spark, sf_dir))
    f0 = J.flatten(docs, "mydata", "f0", keep=[])
    f1 = J.flatten_nested(f0, "f0", "products", "f1")
    return f1.select(
        J.get("f0", "order_id", "bigint").alias("order_id"),
        J.get("f0", "order_date").alias("order_date"),
        J.get("f0", "customer.customer_id").alias("customer_id"),
        J.get("f1", "product_id").alias("product_id"),
        J.get("f1", "quantity", "int").alias("quantity"),
    ).distinct()


@register("e4_required_path_default", with_(R) + """
SELECT review_id, COALESCE(CASE WHEN star_rating > 0 THEN quantity END, 1) AS quantity FROM r
WHERE review_id IS NOT NULL
""")
def e4_required_default(spark, sf_dir):
    """E4 + E5: records without the key are skipped; an absent quantity
    (here: left out when the rating is 0) defaults to 1."""
    r = review_records(spark, sf_dir)
    rec = F.to_json(F.struct("review_id", F.when(F.col("star_rating") > 0, F.col("quantity")).alias("quantity")))
    docs = r.select(F.parse_json(rec).alias("f0"))
    return docs.where(J.node("f0", "review_id").isNotNull()).select(
        J.get("f0", "review_id").alias("review_id"),
        F.coalesce(J.get("f0", "quantity", "int"), F.lit(1)).alias("quantity"))


@register("s14_s20_append_backup_restore", with_(R) + """
SELECT DISTINCT customer_id, email, name, address FROM r
""")
def s14_s20(spark, sf_dir):
    """S14 append (two slices), S16 backup copy, S17/S18 empty the table (an
    empty snapshot with the same schema), S20 restore from the backup."""
    cust = review_records(spark, sf_dir).select("customer_id", "email", "name", "address").distinct()
    table = scratch_path(spark, "s14-table")
    FS.append(cust.where(F.col("address") < "HOUSEHOLD"), table)
    FS.append(cust.where(~(F.col("address") < "HOUSEHOLD")), table)
    backup = scratch_path(spark, "s16-backup")
    FS.copy_table(spark.read.parquet(table), backup)
    emptied = scratch_path(spark, "s18-empty")
    FS.empty_like(spark.read.parquet(table)).write.parquet(emptied)
    assert spark.read.parquet(emptied).isEmpty()
    restored = scratch_path(spark, "s20-restored")
    FS.copy_table(spark.read.parquet(backup), restored)
    return spark.read.parquet(restored)


SPANNED = "CASE WHEN star_rating <= 2 THEN replace(review_body, ' ', chr(10)) || ' \"q\", ' ELSE review_body END"


@register("s4_multiline_csv", with_(R) + f"""
SELECT review_id, CAST(star_rating AS VARCHAR) AS star_rating, {SPANNED} AS review_body, product_title FROM r
""")
def s4_multiline(spark, sf_dir):
    """Fields with line ends, quotes and commas, written and read back by ranges of
    the files."""
    r = review_records(spark, sf_dir)
    body = F.when(F.col("star_rating") <= 2, F.concat(F.replace("review_body", F.lit(" "), F.lit("\n")), F.lit(' "q", '))).otherwise(F.col("review_body"))
    path = scratch_path(spark, "s4-csv")
    FS.write_csv(r.select("review_id", "star_rating", body.alias("review_body"), "product_title"), path, ["review_id", "star_rating", "review_body", "product_title"])
    return FS.read_csv(spark, path)


@register("s8_json_array", with_(R) + "SELECT review_id, star_rating, review_body, helpful_votes FROM r")
def s8_array(spark, sf_dir):
    """The feed as one JSON array over ordered text parts, read back by line."""
    path = scratch_path(spark, "s8-array")
    r = review_records(spark, sf_dir).select("review_id", "star_rating", "review_body", "helpful_votes")
    FS.write_json_array(r, path, [F.col("review_id")])
    return FS.read_json_array(spark, path, "review_id string, star_rating int, review_body string, helpful_votes int")


@register("q10_filter_export_csv", with_(R, C, V) + """
SELECT review_id, review_date, customer_id, product_id, product_title, product_category, CAST(star_rating AS VARCHAR) AS star_rating,
       review_body, verified_purchase FROM v WHERE star_rating >= 4 AND CAST(review_date AS DATE) >= DATE '1997-01-01'
""")
def q10_filter_export(spark, sf_dir):
    """Q10, filter and export: clean -> validate -> 4 stars or more from a date on -> CSV,
    read back."""
    path = scratch_path(spark, "q10-csv")
    FS.write_csv(P.apply_filters(RV.valid_reviews(spark, sf_dir), P.star_between(4, 5), P.date_between(start="1997-01-01")), path)
    return FS.read_csv(spark, path)


@register("q10_statistics_recipe", with_(R, C, V) + """
, top AS (SELECT product_category, count(*) AS n FROM v GROUP BY 1 ORDER BY n DESC, product_category LIMIT 3)
SELECT 'pass rate' AS what, '' AS name, round((SELECT count(*) FROM v) / (SELECT count(*) FROM c), 6) AS value
UNION ALL SELECT 'average rating', '', round(avg(star_rating), 6) FROM v
UNION ALL SELECT 'top category', product_category, CAST(n AS DOUBLE) FROM top
UNION ALL SELECT 'rating', CAST(s.i AS VARCHAR), CAST((SELECT count(*) FROM v WHERE star_rating = s.i) AS DOUBLE) FROM range(1, 6) s(i)
""")
def q10_statistics(spark, sf_dir):
    """Q10, statistics: pass rate, average rating, top three categories, histogram, as
    rows; the validated records are written once and read by each."""
    from ..operators import ordering as O
    from ..operators import validate as VA
    from ..session import materialize
    ann = materialize(RV.validated_reviews(spark, sf_dir).select("product_category", "star_rating", "errors"), "q10-valid")
    valid = ann.where(F.size("errors") == 0)
    row = lambda df, what, name, value: df.select(F.lit(what).alias("what"), name.alias("name"), value.cast("double").alias("value"))
    hist = A.rating_histogram(valid)
    return O.union_all(
        row(VA.report_totals(ann), "pass rate", F.lit(""), F.round("pass_rate", 6)),
        row(valid.agg(F.avg("star_rating").alias("a")), "average rating", F.lit(""), F.round("a", 6)),
        row(A.top_counts(valid, "product_category", 3), "top category", F.col("product_category"), F.col("n")),
        row(hist, "rating", F.col("star_rating").cast("string"), F.col("n")))


@register("s9_summary_export", with_(R) + """
SELECT 'total' AS what, '' AS name, CAST(count(*) AS DOUBLE) AS value FROM r
UNION ALL SELECT 'average', '', round(avg(star_rating), 4) FROM r
UNION ALL SELECT 'verified', '', CAST(count(*) FILTER (WHERE verified_purchase = 'Y') AS DOUBLE) FROM r
UNION ALL SELECT 'category', product_category, CAST(count(*) AS DOUBLE) FROM r WHERE product_category IS NOT NULL AND product_category <> '' GROUP BY product_category
""")
def s9_summary(spark, sf_dir):
    """The summary's files, read back."""
    from ..operators import ordering as O
    path = scratch_path(spark, "s9-summary")
    FS.export_summary(review_records(spark, sf_dir), path)
    t = spark.read.schema("total long, avg_star_rating double, verified_count long").json(f"{path}/totals")
    c = spark.read.schema("product_category string, n long").json(f"{path}/categories")
    row = lambda df, what, name, value: df.select(F.lit(what).alias("what"), name.alias("name"), value.cast("double").alias("value"))
    none = F.lit("")
    return O.union_all(row(t, "total", none, F.col("total")), row(t, "average", none, F.col("avg_star_rating")), row(t, "verified", none, F.col("verified_count")),
                       row(c, "category", F.col("product_category"), F.col("n")))


@register("f12_file_digests", """
SELECT c_mktsegment AS segment, sha256(string_agg(c_name || chr(10), '' ORDER BY c_name)) AS digest FROM customer GROUP BY c_mktsegment
""")
def f12_digests(spark, sf_dir):
    """the digests of files, one a market segment, that Spark wrote."""
    from ..functions import text as X
    from ..sources.tables import read_table
    path = scratch_path(spark, "f12-files")
    names = read_table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_name").alias("value"))
    names.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "value").write.partitionBy("c_mktsegment").text(path)
    got = X.file_digests(spark, f"{path}/*/*.txt")
    return got.select(F.url_decode(F.regexp_extract("path", "c_mktsegment=([^/]*)", 1)).alias("segment"), F.col(got.columns[-1]).alias("digest"))
