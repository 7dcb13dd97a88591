"""Work that is done once: a line is parsed once, looked up once, kept once."""
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import lines_frame, valid_review
from stardust import session
from stardust.catalog._register_helpers import nested_order_documents
from stardust.functions import text as X
from stardust.plans import deltas
from stardust.plans import star_load as SL
from stardust.sources import csv_records
from stardust.streaming.loader import StarStreamLoader
from stardust.streaming.reviews import ReviewStream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nothing_is_cached(monkeypatch):
    def refuse(self, *a):
        raise AssertionError("a micro-batch is kept in memory and local files")
    monkeypatch.setattr(DataFrame, "persist", refuse)


def test_cleaning_stays_in_the_jvm(spark):
    texts = ["é x", "  a   b ", "a\x0bb", " x y ", None, "", "a\tb\n c", "e\x01́", "한", "plain", "a\x7f|", "\U0001f600  ok"]
    df = spark.createDataFrame([(i, t, "p  q") for i, t in enumerate(texts)], "i int, review_body string, product_title string")
    got = X.clean_review(df)
    assert "Python" not in plan(got)
    want = df.select("i", X.clean_text("review_body").alias("b"))  # each field by itself
    assert [r.review_body for r in got.orderBy("i").collect()] == [r.b for r in want.orderBy("i").collect()]
    assert {r.product_title for r in got.collect()} == {"p q"}


def test_a_review_batch_is_written_once_and_not_cached(spark, tmpdir_fresh, monkeypatch):
    nothing_is_cached(monkeypatch)
    base = tmpdir_fresh
    lines_frame(spark, [valid_review(), valid_review(review_id="R2", star_rating=9), "{broken", " "]).write.text(f"{base}/in")
    rs = ReviewStream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    rs.run_available()
    assert rs.totals().select("valid", "invalid", "corrupt", "written", "batches").first() == (1, 1, 1, 1, 1)
    assert [r.review_id for r in rs.output().collect()] == ["R001"]
    assert sorted(r.errors for r in rs.quarantined().collect())[0] == "JSON parse error" and rs.quarantined().count() == 2


def test_a_load_parses_once_and_is_not_cached(spark, tmpdir_fresh, monkeypatch):
    nothing_is_cached(monkeypatch)
    base = tmpdir_fresh
    more = dict(order_id=1, quantity=2, email="e", name="n", address="a", price=1.5)
    lines = [valid_review(**more), valid_review(review_id="R2", customer_id=None, **more), "{broken"]
    lines_frame(spark, lines).coalesce(1).write.text(f"{base}/in")
    ld = StarStreamLoader(spark, f"{base}/in", root=f"{base}/star", clock=lambda b: dt.datetime(2026, 1, 1))
    ld.run_available()
    assert [r.review_id for r in ld.table("reviews").collect()] == ["R001"]
    assert [(r.review_id, r.missing) for r in ld.table("quarantine_reviews").collect()] == [("R2", "customer")]
    assert [r.value for r in ld.table("quarantine").collect()] == ["{broken"]
    assert ld.table("consumption_log").first().records_consumed == 2
    assert ld.table("json_data").columns == ["load", "mydata", "loaded_timestamp", "source_file"] and ld.table("json_data").count() == 2


def staged_rows(spark):
    rows = [("R1", 1, "C1", "P1", 1), ("R1", 1, "C2", "P2", 2), ("R1", 1, None, "P2", 3), ("R2", 1, "C2", None, 4), ("R3", 2, "C2", "P1", 5)]
    rec = F.to_json(F.struct("review_id", "order_id", "customer_id", "product_id", F.lit(3).alias("star_rating")))
    return spark.createDataFrame(rows, "review_id string, order_id long, customer_id string, product_id string, at int").select(F.parse_json(rec).alias("mydata"), "at")


def test_a_batch_is_reduced_and_looked_up_once(spark):
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")
    star = SL.load_batch(SL.empty_star(spark), staged_rows(spark), now, ["at"])
    star = SL.load_batch(star, staged_rows(spark), now, ["at"])
    assert not any("Window" in plan(df) for df in star.tables().values())  # each source is written, not computed for each join of the merge
    names = {r.customer_key: r.customer_id for r in star.customers.collect()}
    assert sorted((r.review_id, names[r.customer_key], r.star_rating) for r in star.reviews.collect()) == [("R1", "C2", 3), ("R3", "C2", 3)]
    assert sorted((r.order_id, names[r.customer_key], r.quantity) for r in star.orders.collect()) == [(1, "C2", 1), (2, "C2", 1)]


def test_batch_sources_equal_the_general_ones(spark):
    st = SL.typed_staging(staged_rows(spark), ["at"])
    c = spark.createDataFrame([("C1", 1), ("C2", 2)], "customer_id string, customer_key long")
    p = spark.createDataFrame([("P1", 1), ("P2", 2)], "product_id string, product_key long")
    for got, want in ((SL.batch_reviews, SL.reviews_source), (SL.batch_orders, SL.orders_source)):
        g, w = got(st, c, p, ["at"]), want(st, c, p, ["at"])
        assert g.columns == w.columns and sorted(map(str, g.collect())) == sorted(map(str, w.collect())) and g.count() == 2


def test_a_load_looks_up_one_row_per_review_and_order(spark, tmpdir_fresh, monkeypatch):
    seen, keys = [], SL._keys
    monkeypatch.setattr(SL, "_keys", lambda st, *a: (seen.append(st.columns), keys(st, *a))[1])
    more = dict(order_id=1, quantity=2, email="e", name="n", address="a", price=1.5)
    lines_frame(spark, [valid_review(**more), valid_review(**more)]).coalesce(1).write.text(f"{tmpdir_fresh}/in")
    ld = StarStreamLoader(spark, f"{tmpdir_fresh}/in", root=f"{tmpdir_fresh}/star", clock=lambda b: dt.datetime(2026, 1, 1))
    ld.run_available()
    assert ld.table("reviews").count() == 1 and ld.table("orders").count() == 1 and ld.table("quarantine_reviews").isEmpty()
    assert seen and not any(c == "f0_pos" or c.startswith("__o_") for cols in seen for c in cols)


def test_records_read_in_one_walk_equal_those_by_path(spark):
    docs = ['[{"customer_id": "C1", "product_id": "P1", "review_id": "R1", "order_id": 1, "star_rating": "4"}, 5, null]',
            '{"customer_id": "C1", "product_id": "P1", "review_id": "R2", "order_id": 1, "quantity": "x"}', "7"]
    stg = spark.createDataFrame(list(enumerate(docs)), "at int, t string").select("at", F.parse_json("t").alias("mydata"))
    walked = SL.staged(stg.select("at", SL.typed_records("mydata").alias("recs")), ["at"], "recs")
    by_path = SL.typed_staging(stg, ["at"])
    assert walked.columns == by_path.columns and sorted(map(str, walked.collect())) == sorted(map(str, by_path.collect())) and by_path.count() == 5


def test_null_ids_take_no_part_in_the_search_for_unmatched(spark):
    st = spark.createDataFrame([("R1", "C1", "P1"), ("R2", None, "P1"), ("R3", "C9", None), (None, None, None)], "review_id string, customer_id string, product_id string")
    c, p = spark.createDataFrame([("C1",)], "customer_id string"), spark.createDataFrame([("P1",)], "product_id string")
    got = SL.unmatched_reviews(st, c, p)
    assert sorted((r.review_id, r.missing) for r in got.collect()) == [("R2", "customer"), ("R3", "customer"), ("R3", "product")]
    assert "isnotnull(customer_id" in plan(got) and "isnull(customer_id" in plan(got)


def test_csv_ranges_are_cut_once_where_they_are_read(spark, tmpdir_fresh):
    spark.createDataFrame([('a,b',), ('1,"x',), ('y ""q"""',), ("2,z",)], "value string").coalesce(1).write.text(f"{tmpdir_fresh}/csv")
    got = csv_records.read(spark, f"{tmpdir_fresh}/csv")
    assert "MapInArrow" not in plan(got)
    assert sorted(tuple(r) for r in got.collect()) == [("1", 'x\ny "q"'), ("2", "z")]


def test_the_nested_documents_read_their_chunks(spark):
    rows = [(1, "R1-1", "2024-01-02", "C1"), (1, "R1-9", "2024-01-01", "C1"), (5, "R5-1", "2024-01-03", None)]
    r = spark.createDataFrame(rows, "order_id long, review_id string, review_date string, customer_id string").select(
        "*", *[F.lit("x").alias(c) for c in ("product_id", "product_title", "product_category", "email", "name", "address")], F.lit(1).alias("quantity"), F.lit(2).cast("decimal(38,2)").alias("price"))
    docs = nested_order_documents(r)
    assert "order-chunks" in plan(docs) and "LocalTableScan" not in plan(docs)
    dates = docs.select(F.explode(F.from_json(F.to_json("mydata"), "array<struct<order_id long, order_date string>>")).alias("o")).select("o.*")
    assert sorted(map(tuple, dates.collect())) == [(1, "2024-01-01"), (1, "2024-01-01"), (5, "2024-01-03")]


def test_only_reviews_that_come_twice_are_ordered(spark, monkeypatch):
    cols = "review_id string, customer_id string, product_id string, at int, f0_pos int"
    rows = [(f"R{i}", "C1", "P1", i, 0) for i in range(50)] + [("R7", "C2", "P1", 90, 0), ("R7", "C2", "P2", 90, 1), ("R9", "C3", "P1", 1, 0), (None, "C4", "P1", 1, 0), (None, "C5", "P1", 2, 0)]
    whole = sorted((r[0], r[1], r[2]) for r in rows[:50] if r[0] != "R7") + [("R7", "C2", "P2")]
    st = spark.createDataFrame(rows, cols)
    once = SL.latest_of_few_repeats(spark.createDataFrame(rows[:50], cols), "review_id", ["at"])
    assert "Window" not in plan(once) and "Exchange" not in plan(once) and once.count() == 50
    few = SL.latest_of_few_repeats(st, "review_id", ["at"])
    assert "LeftSemi" in plan(few) and "LeftAnti" in plan(few)
    monkeypatch.setattr(SL, "FEW", 1)
    many = SL.latest_of_few_repeats(st, "review_id", ["at"])
    assert "LeftSemi" not in plan(many)
    for got in (few, many):
        assert got.columns == st.columns
        assert sorted((r.review_id, r.customer_id, r.product_id) for r in got.collect()) == sorted(whole)
    none = SL.latest_of_few_repeats(spark.createDataFrame([], cols), "review_id", ["at"])
    assert none.count() == 0


def test_what_is_broadcast_of_repeated_reviews_is_a_bitmap(spark, monkeypatch):
    rows = spark.range(6_000).select(F.concat(F.lit("R"), F.pmod(F.xxhash64("id"), F.lit(4_000)).cast("string")).alias("review_id"), F.col("id").alias("at"), F.lit(0).alias("f0_pos")).localCheckpoint()
    whole = sorted(map(tuple, SL._latest(rows, "review_id", ["at"]).collect()))
    for cells in (4096, 1 << 27):  # cells that many hashes share only send more rows to be ordered
        monkeypatch.setattr(SL, "CELLS", cells)
        got = SL.latest_of_few_repeats(rows, "review_id", ["at"])
        assert "repeat-bitmap" in plan(got) and "repeated-keys" not in plan(got)
        assert sorted(map(tuple, got.collect())) == whole
    hashes = rows.groupBy(F.xxhash64("review_id").alias("__h")).count().where("count > 1")
    bits, cells = SL.repeat_bitmap(hashes, hashes.count())
    assert cells >= 16 * hashes.count() and bits.count() <= cells // 4096
    assert bits.select(F.explode("words").alias("w")).agg(F.sum(F.bit_count("w"))).first()[0] <= hashes.count()


def test_tables_of_many_rows_are_not_broadcast(spark, tmpdir_fresh, monkeypatch):
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")
    load = lambda star: SL.load_batch(star, staged_rows(spark), now, ["at"])
    few = load(load(SL.empty_star(spark)))
    monkeypatch.setattr(session, "LOOKUP_ROWS", 0)
    monkeypatch.setattr(deltas, "LOOKUP_ROWS", 0)
    many = load(load(SL.empty_star(spark)))
    for name, df in many.tables().items():
        assert "BroadcastHashJoin" not in plan(df) and sorted(map(str, df.collect())) == sorted(map(str, few.tables()[name].collect()))
    store = deltas.DeltaStore(spark, f"{tmpdir_fresh}/s", SL.SCHEMAS, {"customers": "customer_id"}, {"customers": "customer_key"})
    for n in (0, 1):
        store.put("customers", few.customers, n)
    assert "BroadcastHashJoin" not in plan(store.feed("customers", 0))


def test_the_nested_documents_are_dealt_once(spark):
    cols = [F.lit("x").alias(c) for c in ("product_title", "product_category", "email", "name", "address")]
    rows = [(i // 3, f"R{i // 3}-{i % 3 + 1}", f"2024-01-0{i % 3 + 1}", f"C{i // 3}", f"P{i}") for i in range(30)]
    make = lambda rows: spark.createDataFrame(rows, "order_id long, review_id string, review_date string, customer_id string, product_id string").select(
        "*", *cols, F.lit(1).alias("quantity"), F.lit(2).cast("decimal(38,2)").alias("price"))
    assert "Exchange" not in plan(nested_order_documents(make(rows)))         # no order has several chunks: each has its date
    more = rows + [(4, "R4-9", "2023-12-31", "C4", "P99"), (4, "R4-18", "2024-02-01", "C4", "P98"), (None, "R0-1", "2024-01-01", "C0", "P0")]
    for of in (rows, more):
        docs = nested_order_documents(make(of))
        got = docs.select(F.explode(F.from_json(F.to_json("mydata"), "array<struct<order_id long, order_date string, customer struct<customer_id string>, products array<struct<product_id string>>>>")).alias("o")).select(
            "o.order_id", "o.order_date", "o.customer.customer_id", F.explode("o.products.product_id").alias("p"))
        first = {o: min(r[2] for r in of if r[0] == o) for o in {r[0] for r in of}}
        assert sorted(map(tuple, got.collect())) == sorted((r[0], first[r[0]], r[3], r[4]) for r in of if r[0] is not None)
