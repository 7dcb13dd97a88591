"""Star load on snapshots and the file stream: idempotent replays, restarts,
empty triggers, quarantine of bad lines, failure logging."""
import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from stardust.plans import star_load as SL
from stardust.plans.deltas import DeltaStore
from stardust.streaming.loader import KEYS, SURROGATES, StarStreamLoader
from conftest import valid_review


def rec(review_id, customer_id, product_id, ts, **kw):
    r = valid_review(review_id=review_id, customer_id=customer_id, product_id=product_id)
    r.update(order_id=int(review_id[1:]), quantity=kw.pop("quantity", 2), email=f"{customer_id}@x",
             name=f"name-{customer_id}", address="addr", price=9.99, loaded_timestamp=ts)
    r.update(kw)
    return r


def drop(path, name, records, extra_lines=()):
    os.makedirs(f"{path}/{name}", exist_ok=True)
    with open(f"{path}/{name}/part-0.json", "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")


def loader(spark, base):
    clock = lambda b: dt.datetime(2026, 1, 1 + b)
    return StarStreamLoader(spark, f"{base}/in/*/*.json", root=f"{base}/star", clock=clock,
                            order_fields={"loaded_timestamp": "timestamp_ntz"})


def test_stream_two_drops_restart_and_empty_trigger(spark, tmpdir_fresh):
    base = tmpdir_fresh
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00"),
                              rec("R2", "C2", "P1", "2024-01-02T00:00:00"),
                              rec("R1", "C1", "P1", "2024-01-03T00:00:00", star_rating=2)],
         extra_lines=["{broken line", ""])
    ld = loader(spark, base)
    ld.run_available()
    cust = {r["customer_id"]: r for r in ld.table("customers").collect()}
    assert sorted((k, v["customer_key"]) for k, v in cust.items()) == [("C1", 1), ("C2", 2)]
    rev = {r["review_id"]: r for r in ld.table("reviews").collect()}
    assert rev["R1"]["star_rating"] == 2            # latest in the batch wins
    # restart (new loader object, same checkpoint): only the new drop is read
    drop(f"{base}/in", "d2", [rec("R1", "C1", "P2", "2024-02-01T00:00:00", star_rating=5, quantity=7),
                              rec("R3", "C3", "P2", "2024-02-02T00:00:00")])
    ld2 = loader(spark, base)
    ld2.run_available()
    ld2.run_available()                               # nothing waits: no batch
    cust = {r["customer_id"]: r for r in ld2.table("customers").collect()}
    assert cust["C3"]["customer_key"] == 3 and cust["C1"]["customer_key"] == 1
    assert cust["C1"]["updated_at"] == dt.datetime(2026, 1, 2)
    rev = {r["review_id"]: r for r in ld2.table("reviews").collect()}
    assert rev["R1"]["star_rating"] == 5 and rev["R1"]["created_at"] == dt.datetime(2026, 1, 1)
    orders = {r["order_id"]: r for r in ld2.table("orders").collect()}
    assert orders[1]["quantity"] == 7
    log = ld2.table("batch_log")
    assert log.where(F.col("status") == "SUCCESS").count() == 2
    assert spark.read.parquet(f"{base}/star/_quarantine").count() == 1
    assert ld2.table("consumption_log").agg(F.sum("records_consumed")).first()[0] == 5


SCHEMA = "customer_id string, email string, name string, address string"


def put(store, rows, load, day=1):
    src = store.spark.createDataFrame(rows, SCHEMA)
    now = F.lit(dt.datetime(2026, 1, day)).cast("timestamp_ntz")
    return store.upsert("customers", src, lambda cur, top: SL.merge_customers(cur, src, now, top), load)


def test_a_load_writes_only_its_keys_and_replays(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    assert put(store, [("C1", "a@", "A", "x"), ("C2", "b@", "B", "y")], 0)
    put(store, [("C3", "c@", "C", "z")], 1)
    put(store, [("C1", "new@", "A", "x")], 2, 2)
    for _ in range(2):                                # replays of a load in the middle
        put(store, [("C3", "c@", "C", "z")], 1)
    rows = {r.customer_id: r for r in DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES).read("customers").collect()}
    assert {k: v.customer_key for k, v in rows.items()} == {"C1": 1, "C2": 2, "C3": 3}
    assert rows["C1"].email == "new@" and rows["C1"].created_at == dt.datetime(2026, 1, 1) and rows["C1"].updated_at == dt.datetime(2026, 1, 2)
    assert store.changes("customers").where("load = 2").count() == 1
    assert store.load_id("x", 5) == 5 and store.load_id("y", 0) == 1 << 40 and store.load_id("x", 6) == 6


def test_fold_keeps_the_rows_and_skips_folded_loads(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    for b in range(4):
        put(store, [(f"C{b + 1}", "e", "n", "a"), ("C0", f"e{b}", "n", "a")], b)
    before = sorted(tuple(r) for r in store.read("customers").collect())
    assert store.fold("customers") == 1 and store.epoch("customers") == (1, 3) and store.epoch("orders") == (0, -1)
    assert sorted(tuple(r) for r in store.read("customers").collect()) == before
    assert not put(store, [("C9", "e", "n", "a")], 3) and put(store, [("C9", "e", "n", "a")], 4)
    assert store.max_key("customers") == 6
    with pytest.raises(ValueError, match="in its base"):
        store.feed("customers", 2)


def customer(spark, rows):
    return spark.createDataFrame([(k, f"C{k}", f"{v}@", "n", "a", None, None, True) for k, v in rows], SL.CUSTOMERS)


def test_a_lookup_opens_only_the_loads_of_its_keys(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    for b in range(50):
        store.put("customers", customer(spark, [(b, "a"), (100 + b % 10, f"v{b}")]), b)
    one = spark.createDataFrame([("C107",)], "customer_id string")
    opened = {f.split("load=")[1].split("/")[0] for f in store.changes("customers", only=one).inputFiles() if "load=" in f}
    assert opened == {"7", "17", "27", "37", "47"}
    assert [r.email for r in store.read("customers", only=one).collect()] == ["v47@"]
    assert [r.email for r in store.read("customers", before=47, only=one).collect()] == ["v37@"]
    assert store.read("customers", only=spark.createDataFrame([(None,), ("zz",)], "customer_id string")).count() == 0
    assert store.max_key("customers") == 109 and store.max_key("customers", before=0) == 0
    store.fold("customers")
    plan = store.changes("customers", only=one)._jdf.queryExecution().executedPlan().toString()
    assert store.state("customers").loads == [] and re.search(r"PartitionFilters: \[[^]]*bucket", plan)
    assert [r.email for r in store.read("customers", only=one).collect()] == ["v47@"] and store.read("customers").count() == 60


def test_the_feed_reads_loads_after_a_number(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    for b, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b"), (3, "a")], [(1, "a"), (2, "c"), (4, "a")]]):
        store.put("customers", customer(spark, rows), b)
    got = lambda *a: sorted((r.customer_key, r.action, r.is_update, r.email) for r in store.feed("customers", *a).collect())
    assert got(1) == [(2, "DELETE", True, "b@"), (2, "INSERT", True, "c@"), (4, "INSERT", False, "a@")]  # 1 is unchanged
    assert got(0, 1) == [(2, "DELETE", True, "a@"), (2, "INSERT", True, "b@"), (3, "INSERT", False, "a@")]
    assert got(0) == [(2, "DELETE", True, "a@"), (2, "INSERT", True, "c@"), (3, "INSERT", False, "a@"), (4, "INSERT", False, "a@")]
    assert got(2) == [] and len(got(-1)) == 4


def test_truncate_and_restore_in_place(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    put(store, [("C1", "a@", "A", "x"), ("C2", "b@", "B", "y")], 0)
    put(store, [("C2", "new@", "B", "y")], 1)
    rows = lambda: sorted(tuple(r) for r in store.read("customers").collect())
    before = rows()
    at = store.truncate("customers")
    assert rows() == [] and store.read("customers", only=spark.createDataFrame([("C1",)], "customer_id string")).count() == 0
    assert not put(store, [("C1", "a@", "A", "x")], 1)             # a replayed load stays out
    put(store, [("C3", "c@", "C", "z")], 2)
    assert [r[:2] for r in rows()] == [(3, "C3")]                  # no key is given twice
    store.restore("customers", at)
    assert rows() == before
    store.restore("customers", customer(spark, [(9, "q")]))
    assert [r[0] for r in rows()] == [9] and store.max_key("customers") == 9


def test_failed_batch_is_logged_and_raised(spark, tmpdir_fresh):
    base = tmpdir_fresh
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00")])
    ld = loader(spark, base)
    ld.clock = lambda b: (_ for _ in ()).throw(RuntimeError("clock down"))
    with pytest.raises(Exception):
        ld.run_available()
    log = ld.table("batch_log").where(F.col("status") == "FAILED").collect()
    assert len(log) == 1 and "clock down" in log[0].error_message


def test_forced_reload_applies_again(spark, tmpdir_fresh):
    base = tmpdir_fresh
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00")])
    loader(spark, base).run_available()
    drop(f"{base}/in", "d2", [rec("R2", "C2", "P1", "2024-01-02T00:00:00", quantity=5)])
    again = loader(spark, base)
    again.checkpoint = f"{base}/star/_checkpoint2"    # S11 FORCE: a fresh checkpoint reads both files again
    again.run_available()
    assert sorted((r.customer_id, r.customer_key) for r in again.table("customers").collect()) == [("C1", 1), ("C2", 2)]
    assert sorted(r.review_id for r in again.table("reviews").collect()) == ["R1", "R2"]


def test_reviews_without_a_customer_are_quarantined(spark, tmpdir_fresh):
    base = tmpdir_fresh
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00"), rec("R2", None, "P1", "2024-01-01T00:00:00")])
    ld = loader(spark, base)
    ld.run_available()
    assert [r.review_id for r in ld.table("reviews").collect()] == ["R1"]
    assert [(r.review_id, r.missing) for r in ld.table("quarantine_reviews").collect()] == [("R2", "customer")]
    assert [r.mydata for r in ld.table("json_data").where("mydata like '%R1%'").collect()] == [json.dumps(rec("R1", "C1", "P1", "2024-01-01T00:00:00"))]


def test_retention_and_skip_existing(spark, tmpdir_fresh):
    base = tmpdir_fresh
    drop(f"{base}/in", "d0", [rec("R9", "C9", "P9", "2024-01-01T00:00:00")])
    days = {1: dt.datetime(2026, 1, 1), 2: dt.datetime(2026, 1, 20)}  # batch 0 = skipped files
    ld = StarStreamLoader(spark, f"{base}/in/*/*.json", root=f"{base}/star",
                          clock=lambda b: days[b], retention_days=7)
    ld.skip_existing()                                # C3: d0 is never loaded
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00")])
    ld.run_available()
    assert [r["customer_id"] for r in ld.table("customers").collect()] == ["C1"]
    drop(f"{base}/in", "d2", [rec("R2", "C2", "P1", "2024-01-02T00:00:00")])
    ld.run_available()                                # 19 days later: batch of d1 is archived
    assert ld.table("json_data_archive").count() == 1
    assert ld.table("json_data").count() == 1         # only the newest batch remains readable
    arch = ld.table("batch_log").where(F.col("data_source") == "ARCHIVAL").collect()
    assert len(arch) == 1 and arch[0]["record_count"] == 1


def test_replay_after_mid_batch_failure(spark, tmpdir_fresh, monkeypatch):
    base = tmpdir_fresh
    drop(f"{base}/in", "d1", [rec("R1", "C1", "P1", "2024-01-01T00:00:00"),
                              rec("R2", "C2", "P2", "2024-01-02T00:00:00")])
    real = SL.merge_reviews
    calls = {"n": 0}

    def flaky(*a, **k):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost")
        return real(*a, **k)

    monkeypatch.setattr(SL, "merge_reviews", flaky)
    with pytest.raises(Exception):
        loader(spark, base).run_available()           # customers + products committed, reviews not
    ld = loader(spark, base)                          # restart from the same checkpoint
    ld.run_available()                                # batch 0 replays: dimensions skipped
    cust = ld.table("customers").collect()
    assert sorted((r["customer_id"], r["customer_key"]) for r in cust) == [("C1", 1), ("C2", 2)]
    assert sorted(r["review_id"] for r in ld.table("reviews").collect()) == ["R1", "R2"]
    log = ld.table("batch_log")
    assert log.where(F.col("status") == "FAILED").count() == 1
    assert log.where(F.col("status") == "SUCCESS").count() == 1


def test_landed_arrays_and_objects_are_read_as_columns(spark, tmpdir_fresh):
    base = tmpdir_fresh
    one, two, lone = rec("R1", "C1", "P1", "2024-01-01T00:00:00"), rec("R2", "C2", "P1", "2024-01-02T00:00:00"), rec("R3", "C3", "P1", "2024-01-03T00:00:00")
    drop(f"{base}/in", "d1", [lone], extra_lines=[json.dumps([one, two, rec("R4", None, "P1", "2024-01-04T00:00:00")]), "[]", "7"])
    ld = loader(spark, base)
    ld.run_available()
    assert sorted(r.review_id for r in ld.table("reviews").collect()) == ["R1", "R2", "R3"]
    assert [r.review_id for r in ld.table("quarantine_reviews").collect()] == ["R4"]
    assert ld.table("consumption_log").first().records_consumed == 5 and ld.table("json_data").count() == 4
    drop(f"{base}/in", "d2", [rec("R3", "C3", "P2", "2024-02-01T00:00:00", star_rating=1)])
    loader(spark, base).run_available()
    landed = spark.read.parquet(f"{base}/star/json_data/load=1")
    assert "__f_customer_id" in landed.columns                    # a scan reads the fields it needs, not whole records
    assert landed.select("__o_loaded_timestamp", "__f_review_id").first() == (dt.datetime(2024, 2, 1), "R3")
    assert {r.review_id: r.star_rating for r in ld.table("reviews").collect()}["R3"] == 1


def test_a_table_of_one_load_is_read_without_an_aggregate_and_merged_once(spark, tmpdir_fresh):
    store = DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, KEYS, SURROGATES)
    store.put("customers", customer(spark, [(1, "a"), (2, "b")]), 0)
    one = spark.createDataFrame([("C2",)], "customer_id string")
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in text(store.read("customers")) and [r.email for r in store.read("customers", only=one).collect()] == ["b@"]
    src = spark.createDataFrame([("C2", "new@", "N", "x"), ("C3", None, "M", "y")], SCHEMA)
    now = F.lit(dt.datetime(2026, 1, 2)).cast("timestamp_ntz")
    cur = store.read("customers", only=src)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(SL.merge_customers(cur, src, now, 2, part=True)) == rows(SL.merge_customers(cur, src, now, 2))
    facts = spark.createDataFrame([("R1", 4, None), ("R2", 5, 0)], "review_id string, star_rating int, helpful_votes int")
    old = SL.merge_reviews(SL.empty_star(spark).reviews, facts.where("review_id = 'R1'").withColumn("star_rating", F.lit(1)), now)
    merged = SL.merge_reviews(old, facts, now, part=True)
    assert rows(merged) == rows(SL.merge_reviews(old, facts, now)) and text(merged).count("Join") == 1
    store.put("customers", customer(spark, [(2, "c")]), 1)
    assert "Aggregate" in text(store.read("customers")) and {r.customer_key: r.email for r in store.read("customers").collect()} == {1: "a@", 2: "c@"}
