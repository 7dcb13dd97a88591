"""Scalar transforms (F*) over the review feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.tables import review_records
from ._register_helpers import line_no
from ._registry import register
from ._sql import C, R, REVIEW_COLS, with_

RC = ", ".join(REVIEW_COLS)


@register("f2_clean_review", with_(R, C) + f"SELECT {RC} FROM c")
def f2_clean_review(spark, sf_dir):
    """F1 + F2: NFC, control characters out, whitespace collapsed, stripped, on
    the 7 text fields; other fields untouched."""
    return X.clean_review(review_records(spark, sf_dir)).select(*REVIEW_COLS)


@register("f3_coerce_rating", with_(R) + """
SELECT review_id,
  CASE WHEN trunc(quantity / 10.0) BETWEEN 1 AND 5 THEN CAST(trunc(quantity / 10.0) AS INT) END AS from_number,
  CASE WHEN CAST(split_part(review_id, '-', 2) AS INT) BETWEEN 1 AND 5
       THEN CAST(split_part(review_id, '-', 2) AS INT) END AS from_text,
  CAST(NULL AS INT) AS from_word
FROM r
""")
def f3_coerce_rating(spark, sf_dir):
    """F3 on a double (truncated: 2.9 -> 2, 5.0 -> 5), numeric text, and words."""
    r = review_records(spark, sf_dir)
    return r.select("review_id",
                    X.coerce_star_rating(F.col("quantity").cast("double") / 10).alias("from_number"),
                    X.coerce_star_rating(line_no("review_id").cast("string")).alias("from_text"),
                    X.coerce_star_rating(F.col("product_title")).alias("from_word"))


@register("f4_coerce_flag", with_(R) + """
SELECT review_id,
  CASE verified_purchase WHEN 'Y' THEN 'Y' WHEN 'N' THEN 'N' END AS from_flag,
  CASE WHEN star_rating % 2 = 0 THEN 'Y' ELSE 'N' END AS from_word,
  CASE split_part(review_id, '-', 2) WHEN '1' THEN 'Y' ELSE NULL END AS from_digit
FROM r
""")
def f4_coerce_flag(spark, sf_dir):
    """F4 on flags with padding and any case, on words, and on digit text."""
    r = review_records(spark, sf_dir)
    padded = F.concat(F.lit(" "), F.lower("verified_purchase"), F.lit("\t"))
    word = F.when(F.col("star_rating") % 2 == 0, F.lit("True")).otherwise(F.lit(" no "))
    return r.select("review_id", X.coerce_flag(padded).alias("from_flag"), X.coerce_flag(word).alias("from_word"),
                    X.coerce_flag(line_no("review_id").cast("string")).alias("from_digit"))


@register("f6_parse_date", with_(R) + """
SELECT review_id, CAST(review_date AS DATE) AS padded, CAST(review_date AS DATE) AS unpadded,
       CAST(NULL AS DATE) AS impossible,
       regexp_full_match(review_date, '\\d{4}-\\d{2}-\\d{2}') AS padded_format_ok,
       regexp_full_match(CAST(year(CAST(review_date AS DATE)) AS VARCHAR) || '-' ||
                         CAST(month(CAST(review_date AS DATE)) AS VARCHAR) || '-' ||
                         CAST(day(CAST(review_date AS DATE)) AS VARCHAR), '\\d{4}-\\d{2}-\\d{2}') AS unpadded_format_ok
FROM r
""")
def f6_parse_date(spark, sf_dir):
    """F6 parse (padded, unpadded, impossible month) and F9 format test."""
    r = review_records(spark, sf_dir)
    d = F.to_date("review_date")
    unpadded = F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))
    impossible = F.concat_ws("-", F.year(d).cast("string"), F.lit("13"), F.dayofmonth(d).cast("string"))
    return r.select("review_id", X.parse_date("review_date").alias("padded"),
                    X.parse_date(unpadded).alias("unpadded"), X.parse_date(impossible).alias("impossible"),
                    X.is_valid_date("review_date").alias("padded_format_ok"),
                    X.is_valid_date(unpadded).alias("unpadded_format_ok"))


@register("f7_f8_truncate_mask", with_(R) + """
SELECT review_id,
  CASE WHEN length(review_body) <= 20 THEN review_body ELSE substr(review_body, 1, 19) || '…' END AS body_short,
  CASE WHEN length(product_title) <= 2 THEN product_title ELSE '...' END AS title_tiny,
  CASE WHEN length(customer_id) <= 4 THEN customer_id
       ELSE repeat('*', length(customer_id) - 4) || right(customer_id, 4) END AS customer_masked,
  repeat('*', length(customer_id)) AS customer_masked0
FROM r
""")
def f7_f8_truncate_mask(spark, sf_dir):
    """F7 (suffix counts toward the limit; a limit shorter than the suffix gives
    the bare suffix) and F8 (visible=4, and visible=0: stars alone)."""
    r = review_records(spark, sf_dir)
    return r.select("review_id", X.truncate_text("review_body", 20).alias("body_short"),
                    X.truncate_text("product_title", 2, "...").alias("title_tiny"),
                    X.mask_id("customer_id", 4).alias("customer_masked"),
                    X.mask_id("customer_id", 0).alias("customer_masked0"))


@register("f10_sanitize_columns", with_(R) + "SELECT review_id AS review_id_, star_rating AS star_rating_, product_id AS product_id FROM r")
def f10_sanitize_columns(spark, sf_dir):
    """rename all columns to [A-Za-z0-9_]."""
    r = review_records(spark, sf_dir)
    return X.sanitize_columns(r.select("review_id", "star_rating", "product_id")
                              .toDF("review_id?", "star rating.", "product_id"))


@register("f11_content_hash", with_(R) + """
SELECT review_id, sha256(to_json({'customer_id': customer_id, 'product_id': product_id,
                                  'review_id': review_id, 'star_rating': star_rating})) AS content_key
FROM r
""")
def f11_content_hash(spark, sf_dir):
    """SHA-256 of the key-sorted JSON of the record."""
    r = review_records(spark, sf_dir)
    return r.select("review_id", X.content_hash(["star_rating", "review_id", "product_id", "customer_id"]).alias("content_key"))


@register("f15_to_date_message", with_(R) + """
SELECT CAST(loaded_timestamp AS DATE) AS load_date, count(*) AS n,
       'Archived ' || CAST(count(*) AS VARCHAR) || ' records successfully' AS message
FROM r GROUP BY 1
""")
def f15_to_date_message(spark, sf_dir):
    """F15 (timestamp -> date) and F16 (null-safe message text) per day."""
    r = review_records(spark, sf_dir)
    return (r.groupBy(F.to_date("loaded_timestamp").alias("load_date")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("message", X.run_message(F.col("n"))))
