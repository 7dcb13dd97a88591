"""Filters (P*), validation (V*), deduplication (D*, W1) over the review feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import jsonpath as J
from ..functions import predicates as P
from ..operators import dedup as D
from ..operators import validate as V
from ..operators.fence import fence
from ..plans import reviews as RV
from ..sources import ndjson as N
from ..sources.tables import arrival_order, read_table, review_records
from ._registry import register
from ._sql import ARRIVAL, ARRIVAL_DESC, C, R, REVIEW_COLS, VALID, V as VCTE, pyrepr, with_

RC = ", ".join(REVIEW_COLS)

# --- P: filters -------------------------------------------------------------

CATS = ("STANDARD POLISHED TIN", "PROMO BRUSHED COPPER", "ECONOMY ANODIZED STEEL", "LARGE BURNISHED BRASS")


@register("p1_p2_star_verified", with_(R) + f"SELECT {RC} FROM r WHERE star_rating BETWEEN 4 AND 5 AND verified_purchase = 'Y'")
def p1_p2(spark, sf_dir):
    r = review_records(spark, sf_dir).select(*REVIEW_COLS)
    return P.apply_filters(r, P.star_between(4, 5), P.verified(True))


@register("p3_date_range", with_(R) + f"""
SELECT {RC} FROM r WHERE CAST(review_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'
UNION ALL
SELECT {RC} FROM r WHERE verified_purchase = 'N' AND CAST(review_date AS DATE) >= DATE '2001-01-01'
""")
def p3_date_range(spark, sf_dir):
    """P3 with both bounds, and with an open end (on a disjoint slice)."""
    r = review_records(spark, sf_dir).select(*REVIEW_COLS)
    a = P.apply_filters(r, P.date_between(dt.date(1996, 1, 1), dt.date(1997, 6, 30)))
    b = P.apply_filters(r, P.verified(False), P.date_between(start="2001-01-01"))
    return a.unionByName(b)


@register("p4_p8_category_sets", with_(R) + f"""
SELECT {RC}, 'in' AS side FROM r WHERE product_category IN {CATS}
UNION ALL SELECT {RC}, 'out' FROM r WHERE product_category NOT IN {CATS}
""")
def p4_p8(spark, sf_dir):
    r = review_records(spark, sf_dir).select(*REVIEW_COLS)
    return (r.where(P.category_in(CATS)).withColumn("side", F.lit("in"))
            .unionByName(r.where(P.category_not_in(CATS)).withColumn("side", F.lit("out"))))


@register("p5_min_length", with_(R, C) + f"SELECT {RC} FROM c WHERE length(review_body) >= 15")
def p5_min_length(spark, sf_dir):
    from ..functions import text as X
    r = X.clean_review(review_records(spark, sf_dir)).select(*REVIEW_COLS)
    return r.where(P.min_length(15))


@register("p6_p7_id_sets_semi_join", with_(R) + f"""
SELECT {RC} FROM r
WHERE product_id IN (SELECT 'P' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 10)
  AND customer_id IN (SELECT 'C' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def p6_p7(spark, sf_dir):
    """P6 / P7 / J6 with id sets that grow with the data: left semi joins."""
    r = review_records(spark, sf_dir).select(*REVIEW_COLS)
    parts = read_table(spark, sf_dir, "part").where(F.col("p_size") < 10).select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"))
    custs = read_table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"))
    return P.keep_in(P.keep_in(r, parts, "product_id"), custs, "customer_id")


@register("p9_all_filters", with_(R, C, VCTE) + f"""
SELECT {RC} FROM v WHERE star_rating BETWEEN 2 AND 5 AND verified_purchase = 'N'
  AND CAST(review_date AS DATE) >= DATE '1998-01-01' AND length(review_body) >= 10
  AND product_category NOT IN {CATS}
""")
def p9_all(spark, sf_dir):
    """AND of several predicates on validated records, as one ``where``."""
    valid = RV.valid_reviews(spark, sf_dir).select(*REVIEW_COLS)
    return P.apply_filters(valid, P.star_between(2, 5), P.verified(False), P.date_between(start="1998-01-01"),
                           P.min_length(10), P.category_not_in(CATS))


@register("p10_p11_recent_status", with_(R) + f"""
SELECT {RC} FROM r WHERE loaded_timestamp >= TIMESTAMP '2001-10-15 00:00:00' - INTERVAL 30 DAY
  AND verified_purchase = 'R'
""")
def p10_p11(spark, sf_dir):
    """P10 (recent rows, with ``now`` pinned) and P11 (status equality)."""
    r = review_records(spark, sf_dir)
    now = F.lit(dt.datetime(2001, 10, 15)).cast("timestamp_ntz")
    return P.apply_filters(r, P.recent("loaded_timestamp", now, "30 DAYS"), P.equals("verified_purchase", "R")).select(*REVIEW_COLS)


# --- V: validation ----------------------------------------------------------

def _v6_sql() -> str:
    parts = []
    for f in ("review_id", "customer_id", "product_id", "product_title", "product_category", "review_body"):
        parts.append(f"CASE WHEN {f} IS NULL OR {f} = '' THEN '{f} must be a non-empty string, got ' || {pyrepr(f)} END")
    parts.append("CASE WHEN NOT regexp_full_match(review_date, '\\d{4}-\\d{2}-\\d{2}') "
                 f"THEN 'review_date must be YYYY-MM-DD, got ' || {pyrepr('review_date')} END")
    parts.append("CASE WHEN star_rating NOT BETWEEN 1 AND 5 THEN 'star_rating must be int 1-5, got ' || CAST(star_rating AS VARCHAR) END")
    parts.append("CASE WHEN verified_purchase NOT IN ('Y', 'N') THEN "
                 f"'verified_purchase must be one of [''N'', ''Y''], got ' || {pyrepr('verified_purchase')} END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


V6_SQL = _v6_sql()


@register("v6_validate_records", with_(R, C) + f"""
SELECT review_id, loaded_timestamp, tie1, tie2, tie3, tie4, {V6_SQL} AS error_text,
       CASE WHEN {VALID} THEN 0 ELSE 1 END AS is_invalid FROM c
""")
def v6_validate(spark, sf_dir):
    """V1-V6: every error message of every record (raw JSON -> clean -> rules)."""
    keep = ("loaded_timestamp", "tie1", "tie2", "tie3", "tie4")
    ann = RV.clean_validate(RV.parsed_reviews(spark, sf_dir, keep=keep))
    return ann.select("review_id", *keep, V.error_text().alias("error_text"),
                      (F.size("errors") > 0).cast("int").alias("is_invalid"))


@register("v7_valid_split", with_(R, C, VCTE) + f"SELECT {RC} FROM v")
def v7_valid(spark, sf_dir):
    return RV.valid_reviews(spark, sf_dir).select(*REVIEW_COLS)


@register("v7_invalid_split", with_(R, C) + f"""
SELECT review_id, review_date, star_rating, verified_purchase, review_body,
       length({V6_SQL}) - length(replace({V6_SQL}, ';', '')) + 1 AS n_errors
FROM c WHERE NOT ({VALID})
""")
def v7_invalid(spark, sf_dir):
    ann = RV.validated_reviews(spark, sf_dir)
    _, invalid = V.split(ann)
    return invalid.select("review_id", "review_date", "star_rating", "verified_purchase", "review_body",
                          F.size("errors").alias("n_errors"))


@register("v8_report_totals", with_(R, C) + f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {VALID}) AS valid_count,
       count(*) FILTER (WHERE NOT ({VALID})) AS invalid_count,
       round(COALESCE(count(*) FILTER (WHERE {VALID}) / NULLIF(count(*), 0), 1.0), 6) AS pass_rate
FROM c
""")
def v8_totals(spark, sf_dir):
    t = V.report_totals(RV.validated_reviews(spark, sf_dir))
    return t.withColumn("pass_rate", F.round("pass_rate", 6))


@register("v8_error_summary", with_(R, C) + """
SELECT error_key, count(*) AS n FROM (
  SELECT 'review_body' AS error_key FROM c WHERE review_body = ''
  UNION ALL SELECT 'star_rating' FROM c WHERE star_rating NOT BETWEEN 1 AND 5
  UNION ALL SELECT 'verified_purchase' FROM c WHERE verified_purchase NOT IN ('Y', 'N')
) GROUP BY error_key
""")
def v8_summary(spark, sf_dir):
    return V.error_summary(RV.validated_reviews(spark, sf_dir))


@register("v10_duplicate_keys", with_(R) + "SELECT review_id, count(*) AS n FROM r GROUP BY review_id HAVING count(*) > 1")
def v10_dups(spark, sf_dir):
    return V.duplicate_keys(review_records(spark, sf_dir), "review_id")


@register("v11_orphan_orders", with_(R) + """
SELECT review_id, customer_id FROM r
WHERE customer_id NOT IN (SELECT customer_id FROM r WHERE verified_purchase = 'Y')
""")
def v11_orphans(spark, sf_dir):
    """Facts whose customer is missing from a dimension (here the
    customer dimension is loaded from verified rows only)."""
    r = review_records(spark, sf_dir)
    dim = r.where(F.col("verified_purchase") == "Y").select("customer_id")
    return V.orphans(r, dim, "customer_id").select("review_id", "customer_id")


@register("v13_invalid_preview", with_(R, C) + f"""
SELECT review_id, {V6_SQL} AS error_text FROM c WHERE NOT ({VALID})
ORDER BY review_id LIMIT 20
""")
def v13_preview(spark, sf_dir):
    """First 20 invalid records by review id, with their messages."""
    ann = RV.validated_reviews(spark, sf_dir)
    return V.preview_invalid(ann, ["review_id"], 20).select("review_id", V.error_text().alias("error_text"))


# --- D / W1: deduplication --------------------------------------------------

def _qualify(order: str, key: str = "review_id", where: str = "") -> str:
    return (f"SELECT {RC} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM r {where}) "
            "WHERE rn = 1")


@register("d1_keep_first", with_(R) + _qualify(ARRIVAL))
def d1_first(spark, sf_dir):
    return D.keep_one(review_records(spark, sf_dir), "review_id", arrival_order(), "first").select(*REVIEW_COLS)


@register("d2_keep_last", with_(R) + _qualify(ARRIVAL_DESC))
def d2_last(spark, sf_dir):
    return D.keep_one(review_records(spark, sf_dir), "review_id", arrival_order(), "last").select(*REVIEW_COLS)


@register("d3_custom_key", with_(R) + _qualify(ARRIVAL, "customer_id || '|' || product_id"))
def d3_custom(spark, sf_dir):
    key = F.concat_ws("|", "customer_id", "product_id")
    return D.keep_one(review_records(spark, sf_dir), key, arrival_order(), "first").select(*REVIEW_COLS)


@register("d4_content_dedup", with_(R) + _qualify(ARRIVAL, ", ".join(REVIEW_COLS)))
def d4_content(spark, sf_dir):
    r = review_records(spark, sf_dir)
    return D.dedup_content(r, arrival_order(), list(REVIEW_COLS)).select(*REVIEW_COLS)


@register("d5_find_duplicates", with_(R) + f"""
SELECT {RC}, review_id AS dup_key, count(*) OVER (PARTITION BY review_id) AS n FROM r
QUALIFY count(*) OVER (PARTITION BY review_id) > 1
""")
def d5_find(spark, sf_dir):
    return D.find_duplicates(review_records(spark, sf_dir), "review_id").select(*REVIEW_COLS, "dup_key", "n")


@register("d6_distinct", with_(R) + "SELECT DISTINCT customer_id, product_id, product_category FROM r")
def d6_distinct(spark, sf_dir):
    return review_records(spark, sf_dir).select("customer_id", "product_id", "product_category").distinct()


@register("d7_delete_repeated_keys", with_(R) + f"""
SELECT {RC} FROM r WHERE review_id NOT IN (SELECT review_id FROM r GROUP BY review_id HAVING count(*) > 1)
""")
def d7_delete(spark, sf_dir):
    return D.delete_repeated(review_records(spark, sf_dir), "review_id").select(*REVIEW_COLS)


@register("w1_latest_customer", with_(R) + """
SELECT customer_id, email, name, address FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY loaded_timestamp DESC, tie1 DESC, tie2 DESC,
                                  tie3 DESC, tie4 DESC) AS rn FROM r WHERE customer_id IS NOT NULL) WHERE rn = 1
""")
def w1_latest(spark, sf_dir):
    r = review_records(spark, sf_dir).where(F.col("customer_id").isNotNull())
    return D.latest(r, "customer_id", arrival_order()).select("customer_id", "email", "name", "address")


@register("v9_assert_valid_passes", with_(R, C, VCTE) + "SELECT review_id, star_rating FROM v")
def v9_assert(spark, sf_dir):
    """V9: the fail-on-first-invalid check over the valid split passes every
    row through (an invalid row would fail the task with its messages)."""
    ann = RV.validated_reviews(spark, sf_dir)
    valid = ann.where(F.size("errors") == 0)
    return V.assert_valid(valid).select("review_id", "star_rating")


def _votes_within(batch):
    # A user's validator over an Arrow batch: a list of error texts for each row.
    return [[f"helpful_votes {v} over limit"] if v is not None and v > 45 else [] for v in batch.column("helpful_votes").to_pylist()]


@register("x2_batch_validator", with_(R, C) + f"""
SELECT review_id, {VALID} AND helpful_votes <= 45 AS valid,
       CASE WHEN helpful_votes > 45 THEN 'helpful_votes ' || CAST(helpful_votes AS VARCHAR) || ' over limit' END AS told FROM c
""")
def x2_batch_validator(spark, sf_dir):
    """A Python rule over Arrow batches beside the column rules; its errors come
    after theirs."""
    ann = V.annotate(review_records(spark, sf_dir), v=None)
    got = V.with_batch_validator(ann, _votes_within, columns=["helpful_votes"], field="helpful_votes", rule="votes")
    last = F.element_at("errors", -1)
    return got.select("review_id", (F.size("errors") == 0).alias("valid"), F.when((F.size("errors") > 0) & (last["rule"] == "votes"), last["message"]).alias("told"))


HARD = {  # what a record of each kind has in place of a field's value, and what the rules say of it
    1: ("", "Missing fields: ['review_body', 'star_rating']"),
    2: (',"review_date":"1998-1-5"', "review_date must be YYYY-MM-DD, got '1998-1-5'"),
    3: (',"star_rating":5.0', "star_rating must be int 1-5, got 5"),
    4: (',"star_rating":"5"', "star_rating must be int 1-5, got '5'"),
    5: (',"star_rating":true', "star_rating must be int 1-5, got True"),
    6: (',"verified_purchase":null', "verified_purchase must be one of ['N', 'Y'], got None"),
    7: (',"product_title":17', "product_title must be a non-empty string, got 17"),
    8: (',"review_date":null', "review_date must be YYYY-MM-DD, got None"),
}
_HARD_SQL = " ".join(f"WHEN {k} THEN '{told}'" for k, (_, told) in ((k, (a, b.replace("'", "''"))) for k, (a, b) in HARD.items()))


def hard_lines(r):
    """Review lines (``value``) of the kinds of ``HARD``, with ``m``."""
    m = ((F.col("order_id") + F.substring_index("review_id", "-", -1).cast("int")) % 9).cast("int")
    left_out = {"product_title": (7,), "review_body": (1,), "review_date": (2, 8), "star_rating": (1, 3, 4, 5), "verified_purchase": (6,)}
    plain = [F.when(~m.isin(*left_out[c]), F.col(c)).alias(c) if c in left_out else F.col(c) for c in REVIEW_COLS if c != "helpful_votes"]
    obj = F.to_json(F.struct(*plain))  # null fields are left out
    extra = F.element_at(F.create_map(*[F.lit(x) for k, (text, _) in HARD.items() for x in (k, text)]), m)
    return fence(r.select(F.concat(F.left(obj, F.length(obj) - 1), F.coalesce(extra, F.lit("")), F.lit("}")).alias("value"), m.alias("m")), "feed")


@register("e6_kinds", with_(R) + """
SELECT rating, flag, count(*) AS n FROM (
  SELECT CASE m WHEN 1 THEN 'missing' WHEN 3 THEN 'DECIMAL(1,0)' WHEN 4 THEN 'STRING' WHEN 5 THEN 'BOOLEAN' ELSE 'BIGINT' END AS rating,
         CASE m WHEN 6 THEN 'VOID' ELSE 'STRING' END AS flag
  FROM (SELECT (order_id + CAST(split_part(review_id, '-', 2) AS INTEGER)) % 9 AS m FROM r WHERE star_rating IS NOT NULL AND verified_purchase IS NOT NULL))
GROUP BY ALL
""")
def e6_kinds(spark, sf_dir):
    """The JSON kinds of the rating and the flag over the hard feed."""
    r = review_records(spark, sf_dir).where("star_rating is not null and verified_purchase is not null")
    v = N.parse_lines(hard_lines(r))
    kinds = v.select(F.coalesce(J.kind("v", "star_rating"), F.lit("missing")).alias("rating"), J.kind("v", "verified_purchase").alias("flag"))
    return kinds.groupBy("rating", "flag").agg(F.count(F.lit(1)).alias("n"))


@register("v1_v4_hard_feed", with_(R) + f"""
SELECT review_id, m, CASE m {_HARD_SQL} ELSE '' END AS told
FROM (SELECT review_id, CAST((order_id + CAST(split_part(review_id, '-', 2) AS INTEGER)) % 9 AS INTEGER) AS m FROM r)
""")
def v1_v4_hard_feed(spark, sf_dir):
    """V1, V3, V4 on raw JSON lines with missing fields, bad and null dates, ratings 5.0,
    "5" and true, a null flag and a number for a title, by the record's number."""
    lines = hard_lines(review_records(spark, sf_dir))
    ann = RV.clean_validate(N.parse_lines(lines), keep=["v", "m"])
    field = F.create_map(*[F.lit(x) for k, f in ((2, "review_date"), (3, "star_rating"), (4, "star_rating"), (5, "star_rating"), (6, "verified_purchase"),
                                                 (7, "product_title"), (8, "review_date")) for x in (k, f)])
    own = F.filter("errors", lambda e: (e["rule"] == "missing") | (e["field"] == F.element_at(field, F.col("m"))))
    return ann.select("review_id", "m", F.array_join(F.transform(own, lambda e: e["message"]), "; ").alias("told"))
