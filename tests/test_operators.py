"""Filters, dedup, aggregates, keys, upsert, changes, handlers."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stardust.functions import predicates as P
from stardust.operators import aggregate as A
from stardust.operators import batches as B
from stardust.operators import changes as CH
from stardust.operators import dedup as D
from stardust.operators import keys as K
from stardust.operators import ordering as O
from stardust.operators import upsert as U

REV = "review_id string, star_rating int, verified_purchase string, review_date string, product_category string, review_body string, seq int"


@pytest.fixture()
def reviews(spark):
    rows = [
        ("R1", 5, "Y", "2024-01-01", "A", "long enough body", 1),
        ("R2", 4, "N", "2024-02-01", "B", "short", 2),
        ("R1", 3, "Y", "2024-03-01", "A", "another long body", 3),
        ("", 1, "Y", "bad-date", None, None, 4),
        ("R3", 2, "Y", "2024-1-5", "C", "mid length text", 5),
    ]
    return spark.createDataFrame(rows, REV)


def ids(df, col="review_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_filters(spark, reviews):
    assert ids(reviews.where(P.star_between(4, 5))) == ["R1", "R2"]
    assert ids(reviews.where(P.verified(False))) == ["R2"]
    assert ids(reviews.where(P.date_between(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))) == ["R1", "R3"]
    assert ids(reviews.where(P.date_between())) == ["R1", "R1", "R2", "R3"]  # bad dates dropped
    assert ids(reviews.where(P.category_in({"A"}))) == ["R1", "R1"]
    assert ids(reviews.where(P.category_not_in({"A"}))) == ["", "R2", "R3"]  # missing category kept
    assert ids(reviews.where(P.min_length(10))) == ["R1", "R1", "R3"]
    assert P.apply_filters(reviews).count() == 5


def test_dedup_first_last(spark, reviews):
    first = D.keep_one(reviews, "review_id", [F.col("seq")], "first")
    last = D.keep_one(reviews, "review_id", [F.col("seq")], "last")
    assert ids(first) == ["R1", "R2", "R3"]  # empty key dropped
    assert {r["review_id"]: r["seq"] for r in first.collect()}["R1"] == 1
    assert {r["review_id"]: r["seq"] for r in last.collect()}["R1"] == 3
    with pytest.raises(ValueError):
        D.keep_one(reviews, "review_id", [F.col("seq")], "middle")


def test_find_and_delete_duplicates(spark, reviews):
    assert ids(D.find_duplicates(reviews, "review_id")) == ["R1", "R1"]
    assert ids(D.delete_repeated(reviews, "review_id")) == ["", "R2", "R3"]


def test_summary_and_histogram(spark, reviews):
    s = A.summary(reviews).first()
    assert s["total"] == 5 and s["verified_count"] == 4 and s["unverified_count"] == 1
    assert abs(s["avg_star_rating"] - 3.0) < 1e-9 and abs(s["verified_rate"] - 0.8) < 1e-9
    h = {r[0]: r[1] for r in A.rating_histogram(reviews).collect()}
    assert h == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    empty = spark.createDataFrame([], REV)
    e = A.summary(empty).first()
    assert e["total"] == 0 and e["avg_star_rating"] == 0.0 and e["verified_rate"] == 0.0


def test_top_and_count_by(spark, reviews):
    top = A.top_counts(reviews, "product_category", 2, [F.col("seq")]).collect()
    assert [r[0] for r in top] == ["A", "B"]
    cb = {r["key"]: r["n"] for r in A.count_by(reviews, "product_category").collect()}
    assert cb[""] == 1 and cb["A"] == 2


def test_field_stats(spark, reviews):
    s = A.field_stats(reviews, "star_rating").first()
    assert (s["count"], s["non_null"], s["min"], s["max"], s["mean"]) == (5, 5, 1, 5, 3.0)
    none = spark.createDataFrame([(None,)], "x int")
    assert A.field_stats(none, "x").first()["count"] == 0


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = K.dense_index(df, [F.col("k")], "seq", start=1)
    rows = idx.collect()
    assert sorted(r["seq"] for r in rows) == list(range(1, 1001))
    assert all(r["seq"] == r["k"] + 1 for r in rows)


def test_sample_exact(spark):
    df = spark.range(0, 100).select(F.col("id").cast("string").alias("k"))
    a = ids(O.sample_exact(df, 10, "k", seed=7), "k")
    b = ids(O.sample_exact(df.repartition(5), 10, "k", seed=7), "k")
    assert a == b and len(a) == 10
    assert O.sample_exact(df, 1000, "k").count() == 100
    with pytest.raises(ValueError):
        O.sample_exact(df, 0, "k")


def test_batch_ids(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "seq")
    sizes = {r[0]: r[1] for r in O.batch_ids(df, "seq", 100).groupBy("batch_id").count().collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}
    with pytest.raises(ValueError):
        O.batch_ids(df, "seq", 0)


def test_upsert_null_overwrites_and_keys(spark):
    tgt = spark.createDataFrame([(1, "a", "x@", "old")], "k long, id string, email string, name string")
    src = spark.createDataFrame([("a", None, "new"), ("b", "b@", "bee")], "id string, email string, name string")
    out = U.upsert(tgt, src, ["id"], ["email", "name"], surrogate="k")
    rows = {r["id"]: r for r in out.collect()}
    assert rows["a"]["email"] is None and rows["a"]["name"] == "new" and rows["a"]["k"] == 1
    assert rows["b"]["k"] == 2
    again = U.upsert(out, src, ["id"], ["email", "name"], surrogate="k")
    assert sorted((r["id"], r["k"]) for r in again.collect()) == [("a", 1), ("b", 2)]  # idempotent


def test_update_delete(spark):
    df = spark.createDataFrame([(1, True), (2, True), (3, None)], "k int, active boolean")
    up = U.update_where(df, F.col("k") == 2, {"active": F.lit(False)})
    assert {r["k"]: r["active"] for r in up.collect()} == {1: True, 2: False, 3: None}
    assert sorted(r["k"] for r in U.delete_where(df, F.col("active")).collect()) == [3]


def test_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "id int, v string")
    rows = sorted((r["id"], r["action"], r["is_update"], r["v"]) for r in CH.diff(old, new, ["id"]).collect())
    assert rows == [(2, "DELETE", True, "b"), (2, "INSERT", True, "B"), (3, "DELETE", False, "c"),
                    (4, "INSERT", False, "d")]
    assert sorted(r["id"] for r in CH.appended(old, new, ["id"]).collect()) == [4]


def test_python_handler(spark):
    def _handler(rec):  # nested: shipped to workers by value
        if rec["x"] % 3 == 0:
            raise ValueError(f"bad {rec['x']}")

    df = spark.range(1, 11).select(F.col("id").alias("x"))
    out = B.with_python_handler(df, _handler)
    res = B.result(out).first()
    assert (res["total"], res["processed"], res["failed"]) == (10, 7, 3)
    errs = sorted(r["error"] for r in out.where(~F.col("ok")).collect())
    assert errs[0] == "Record processing error: bad 3"
    with pytest.raises(Exception):
        B.with_python_handler(df, _handler, stop_on_error=True).collect()
    with pytest.raises(ValueError):
        B.with_python_handler(df, _handler, batch_size=0)


def test_python_filter_escape_hatch(spark, reviews):
    pred = P.python_filter(lambda r, s: (s >= 4) & r.str.startswith("R"), "review_id", "star_rating")
    assert ids(reviews.where(pred)) == ["R1", "R2"]


def test_length_rule(spark):
    from stardust.operators import validate as V
    df = spark.createDataFrame([("Y",), ("YES",)], "verified_purchase string")
    rule = V.length_check("verified_purchase", 1)
    out = df.withColumn("errors", V.errors_column([rule])).collect()
    assert [len(r["errors"]) for r in out] == [0, 1]


def test_summary_maps_one_pass(spark, reviews):
    row = A.summary_maps(reviews).first()
    assert row["total"] == 5 and row["verified_count"] == 4 and abs(row["avg_star_rating"] - 3.0) < 1e-9
    assert dict(row["star_distribution"]) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    assert abs(row["verified_rate"] - 0.8) < 1e-9


def test_a_key_column_is_not_copied_for_the_latest_row(spark):
    from stardust.operators import dedup as D
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, at int")
    got = D.latest(df, "k", [F.col("at")])
    assert "__k" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.k or "", r.at) for r in got.collect()) == [("", 3), ("a", 2)] and got.columns == ["k", "at"]
