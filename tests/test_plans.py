"""Plan-shape checks: what the physical plans must (not) contain at any scale."""
import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F
from stardust.catalog import QUERIES
from stardust.operators import keys as K
from stardust.operators import upsert as U
from stardust.operators import validate as V
from stardust.plans import star_load as SL
from stardust.sources import ndjson as N

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_latest_per_key_limits_before_shuffle(spark):
    p = plan(spark, "d2_keep_last")
    assert p.count("WindowGroupLimit") >= 2     # partial (map side) + final


def test_scans_prune_columns_and_push_filters(spark):
    df = E.queries()["p10_p11_recent_status"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in text
    assert "l_tax" not in text                    # unused column never read
    assert "PushedFilters: [IsNotNull(l_orderkey)" in text


def test_aggregates_are_partial_then_final(spark):
    p = plan(spark, "a8_a9_category_stats")
    assert p.count("HashAggregate") >= 2


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "o1_o2_top_k")


def test_a_small_batch_leaves_the_table_in_place(spark, tmpdir_fresh):
    spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("name")).write.parquet(f"{tmpdir_fresh}/t")
    spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("y").alias("name")).write.parquet(f"{tmpdir_fresh}/b")
    out = U.upsert(spark.read.parquet(f"{tmpdir_fresh}/t"), spark.read.parquet(f"{tmpdir_fresh}/b"), ["id"], ["name"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
    assert out.where("name = 'y'").count() == 5 and out.count() == 20_000


def test_dense_index_joins_its_offsets(spark):
    df = spark.range(3_000).select((F.col("id") * 7919 % 3001).alias("k")).repartition(300)
    out = K.dense_index(df, [F.col("k")], "n", partitions=200)
    assert "map(" not in out._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r.k, r.n) for r in out.collect())
    assert [n for _, n in rows] == list(range(3_000))


def test_strict_parse_runs_once(spark):
    # The strict filter stays above the parse.
    lines = spark.range(3).select(F.concat(F.lit('{"a": '), F.col("id").cast("string"), F.lit("}")).alias("value"))
    parsed = N.parse_lines(lines)
    assert parsed._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
    assert parsed.count() == 3


def test_failed_rules_are_tested_once(spark):
    # The error texts read the outcomes of the tests, which run below them.
    df = spark.createDataFrame([("R1", 9), ("R2", 3)], "review_id string, star_rating int")
    rules = [V.Rule("star_rating", "range", ~F.col("star_rating").between(1, 5), F.lit("bad rating"))]
    ann = V.with_errors(df, rules, "errors")
    assert "__bad_0" in ann._jdf.queryExecution().optimizedPlan().toString()
    assert {r.review_id: [e.message for e in r.errors] for r in ann.collect()} == {"R1": ["bad rating"], "R2": []}


def test_first_load_of_a_table_joins_nothing(spark):
    src = spark.createDataFrame([("C1", "e", "n", "a"), ("C2", "e", "n", "a")], "customer_id string, email string, name string, address string")
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    star = SL.empty_star(spark)
    got = SL.merge_customers(star.customers, src, now)
    assert [(r.customer_key, r.customer_id, r.name) for r in got.orderBy("customer_id").collect()] == [(1, "C1", "n"), (2, "C2", "n")]
    facts = spark.createDataFrame([("R1", 1, 2), ("R2", 5, 0)], "review_id string, star_rating int, helpful_votes int")
    rows = SL.merge_reviews(star.reviews, facts, now)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.review_id for r in rows.collect()) == ["R1", "R2"]
