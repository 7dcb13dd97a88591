"""Aggregations (A*), ordering / top-k / sample (O*), unions (U1) over reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import ordering as O
from ..plans import reviews as RV
from ..sources.tables import arrival_order, review_records
from ._registry import register
from ._sql import C, R, REVIEW_COLS, V, with_

RC = ", ".join(REVIEW_COLS)


@register("a1_a2_summary", with_(R, C, V) + """
SELECT count(*) AS total, round(COALESCE(avg(star_rating), 0.0), 4) AS avg_star_rating,
       count(*) FILTER (WHERE verified_purchase = 'Y') AS verified_count,
       count(*) FILTER (WHERE verified_purchase = 'N') AS unverified_count,
       round(COALESCE(count(*) FILTER (WHERE verified_purchase = 'Y')
             / NULLIF(count(*) FILTER (WHERE verified_purchase IN ('Y', 'N')), 0), 0.0), 4) AS verified_rate
FROM v
""")
def a1_summary(spark, sf_dir):
    """A1 + A2 (+ S9 rounding to 4 places) over validated reviews, one pass."""
    return A.summary(RV.valid_reviews(spark, sf_dir), digits=4)


@register("a1_star_distribution", with_(R, C, V) + "SELECT star_rating, count(*) AS n FROM v GROUP BY star_rating")
def a1_stars(spark, sf_dir):
    return A.star_distribution(RV.valid_reviews(spark, sf_dir))


@register("a1_category_counts", with_(R) + """
SELECT product_category, count(*) AS n FROM r WHERE COALESCE(product_category, '') <> '' GROUP BY product_category
""")
def a1_categories(spark, sf_dir):
    return A.category_counts(review_records(spark, sf_dir))


@register("a3_top_categories", with_(R) + """
SELECT product_category, count(*) AS n FROM r WHERE COALESCE(product_category, '') <> ''
GROUP BY product_category
ORDER BY n DESC, min(struct_pack(a := loaded_timestamp, b := tie1, c := tie2, d := tie3, e := tie4)) LIMIT 5
""")
def a3_top(spark, sf_dir):
    """A3: top 5 categories; ties go to the category seen first."""
    return A.top_counts(review_records(spark, sf_dir), "product_category", 5, arrival_order())


@register("a4_a5_count_by", with_(R) + """
SELECT COALESCE(CAST(address AS VARCHAR), '') AS key, count(*) AS n FROM r GROUP BY 1
""")
def a5_count_by(spark, sf_dir):
    """A5 count by a field as text (null and missing -> '')."""
    return A.count_by(review_records(spark, sf_dir), "address")


@register("a4_group_sizes", with_(R) + """
SELECT COALESCE(CAST(NULLIF(star_rating, 0) AS VARCHAR), '') AS group_key, count(*) AS n FROM r GROUP BY 1
""")
def a4_group_sizes(spark, sf_dir):
    """A4: rows per text group key, one group of null ratings."""
    r = review_records(spark, sf_dir).withColumn("star_rating", F.when(F.col("star_rating") != 0, F.col("star_rating")))
    return A.group_sizes(r, "star_rating")


@register("a6_rating_histogram", with_(R) + """
SELECT s.star_rating, COALESCE(c.n, 0) AS n
FROM (SELECT CAST(range AS INT) AS star_rating FROM range(1, 6)) s
LEFT JOIN (SELECT star_rating, count(*) AS n FROM r WHERE star_rating BETWEEN 1 AND 5 GROUP BY 1) c USING (star_rating)
""")
def a6_hist(spark, sf_dir):
    """Counts for ratings 1..5 with zeros (raw feed: 0 and 6 are outside)."""
    return A.rating_histogram(review_records(spark, sf_dir))


@register("a7_field_stats", with_(R) + """
SELECT CASE WHEN count(helpful_votes) > 0 THEN count(*) ELSE 0 END AS count, count(helpful_votes) AS non_null,
       min(helpful_votes) AS min, max(helpful_votes) AS max, round(avg(helpful_votes), 6) AS mean FROM r
""")
def a7_stats(spark, sf_dir):
    return A.field_stats(review_records(spark, sf_dir), "helpful_votes")


@register("a8_a9_category_stats", with_(R, C, V) + """
SELECT product_category, count(review_id) AS review_count, round(avg(star_rating), 6) AS avg_rating,
       count(*) FILTER (WHERE helpful_votes > 10) AS helpful_reviews
FROM v GROUP BY product_category
""")
def a8_a9(spark, sf_dir):
    v = RV.valid_reviews(spark, sf_dir)
    return v.groupBy("product_category").agg(
        F.count("review_id").alias("review_count"), F.round(F.avg("star_rating"), 6).alias("avg_rating"),
        A.count_if_above("helpful_votes", 10, "helpful_reviews"))


@register("a12_a13_next_id_count", with_(R) + """
SELECT 'next_id' AS what, CAST(COALESCE(max(order_id), 0) + 1 AS BIGINT) AS value FROM r
UNION ALL SELECT 'n', CAST(count(*) AS BIGINT) FROM r
""")
def a12_a13(spark, sf_dir):
    r = review_records(spark, sf_dir)
    as_rows = lambda df, what: df.select(F.lit(what).alias("what"), F.col(df.columns[0]).cast("bigint").alias("value"))
    return as_rows(A.next_id(r, "order_id"), "next_id").unionByName(as_rows(A.row_count(r), "n"))


@register("o1_o2_top_k", with_(R) + f"""
SELECT {RC} FROM r ORDER BY helpful_votes DESC, review_id LIMIT 20
""")
def o2_topk(spark, sf_dir):
    """O1 + O2: multi-key sort with a limit (TakeOrderedAndProject)."""
    r = review_records(spark, sf_dir).select(*REVIEW_COLS)
    return O.top_k(r, [F.col("helpful_votes").desc(), F.col("review_id")], 20)


@register("o3_preview", with_(R) + f"SELECT {RC} FROM r ORDER BY loaded_timestamp, tie1, tie2, tie3, tie4 LIMIT 10")
def o3_preview(spark, sf_dir):
    """O3: the first 10 records in arrival order."""
    r = review_records(spark, sf_dir)
    return O.top_k(r, arrival_order(), 10).select(*REVIEW_COLS)


@register("o4_seeded_sample", with_(R) + """
SELECT DISTINCT review_id FROM r ORDER BY sha256(review_id || ':42'), review_id LIMIT 25
""")
def o4_sample(spark, sf_dir):
    """Exactly n records, chosen by a seeded portable hash (same rows on
    every run and partitioning)."""
    ids = review_records(spark, sf_dir).select("review_id").distinct()
    return O.sample_exact(ids, 25, "review_id", seed=42)


@register("o4_half_sample", with_(R) + """
SELECT review_id FROM (SELECT DISTINCT review_id FROM r) QUALIFY row_number() OVER (ORDER BY sha256(review_id || ':7'), review_id) <= (SELECT count(DISTINCT review_id) // 2 FROM r)
""")
def o4_half(spark, sf_dir):
    """O4 for large n: half of the ids, by the cut of their hash."""
    ids = review_records(spark, sf_dir).select("review_id").distinct()
    return O.sample_exact(ids, ids.count() // 2, "review_id", seed=7)


@register("u1_union_counts", with_(R, C, V) + """
SELECT 'raw' AS source, count(*) AS n FROM r
UNION ALL SELECT 'valid', count(*) FROM v
UNION ALL SELECT 'verified', count(*) FROM r WHERE verified_purchase = 'Y'
""")
def u1_union(spark, sf_dir):
    r = review_records(spark, sf_dir)
    v = RV.valid_reviews(spark, sf_dir)
    def cnt(df, name):
        return df.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"))
    return O.union_all(cnt(r, "raw"), cnt(v, "valid"), cnt(r.where(F.col("verified_purchase") == "Y"), "verified"))


@register("r10_batch_ids", with_(R) + """
SELECT batch_id, count(*) AS n, min(review_id) AS first_id, max(review_id) AS last_id FROM (
  SELECT review_id, CAST(floor((row_number() OVER (ORDER BY review_id, loaded_timestamp, tie1, tie2, tie3, tie4) - 1)
         / 1000) AS BIGINT) AS batch_id FROM r) GROUP BY batch_id
""")
def r10_batches(spark, sf_dir):
    """Fixed-size slices (1000 rows) as a batch id over a dense position
    computed with partition offsets (no single-task global window)."""
    from ..operators import keys as K
    r = review_records(spark, sf_dir)
    seq = K.dense_index(r, [F.col("review_id")] + arrival_order(), "seq")
    b = O.batch_ids(seq, "seq", 1000)
    return b.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("review_id").alias("first_id"),
                                     F.max("review_id").alias("last_id"))
