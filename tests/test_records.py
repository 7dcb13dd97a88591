"""CSV by ranges, JSON array parts, cut sampling, batch validators, dedup in state."""
import csv
import glob
import io
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stardust.operators import ordering as O
from stardust.operators import validate as V
from stardust.sources import csv_records
from stardust.sources import files as FS
from stardust.streaming.dedup import DedupStream


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "257")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_csv_fields_span_lines_and_ranges(spark, tmpdir_fresh, small_ranges):
    rnd = random.Random(3)
    cells = ["plain", "", 'say "hi"', "two\nlines", "a,b", "x\r\ny", '"', "\n\n", "é\n" * 40, "long " * 90, '"\n"']
    rows = [[str(i), rnd.choice(cells), rnd.choice(cells)] for i in range(300)]
    for name, end, part in (("a", "\n", rows[:200]), ("b", "\r\n", rows[200:])):
        out = io.StringIO(newline="")
        w = csv.writer(out, lineterminator=end)
        w.writerows([["id", "left, \"quoted\"", "right"], *part])
        write_text(f"{tmpdir_fresh}/csv/{name}.csv", out.getvalue())
    got = FS.read_csv(spark, f"{tmpdir_fresh}/csv")
    assert got.columns == ["id", 'left, "quoted"', "right"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in rows)
    lines = csv_records._ranges(spark, f"{tmpdir_fresh}/csv/a.csv")
    assert lines.rdd.getNumPartitions() > 20 and lines.select("block").distinct().count() > 20  # one file, many tasks


def test_csv_edges(spark, tmpdir_fresh):
    write_text(f"{tmpdir_fresh}/e/one.csv", "﻿a,b\n1\n\n2,x,extra\n")
    assert [tuple(r) for r in FS.read_csv(spark, f"{tmpdir_fresh}/e/one.csv").orderBy("a").collect()] == [("1", ""), ("2", "x")]
    write_text(f"{tmpdir_fresh}/e/head.csv", "a,b\n")
    head = FS.read_csv(spark, f"{tmpdir_fresh}/e/head.csv")
    assert head.columns == ["a", "b"] and head.count() == 0
    write_text(f"{tmpdir_fresh}/e/none.csv", "")
    assert FS.read_csv(spark, f"{tmpdir_fresh}/e/none.csv").count() == 0
    write_text(f"{tmpdir_fresh}/e/open.csv", 'a,b\n1,"never closed\n2,x')  # what is left open is one record
    assert FS.read_csv(spark, f"{tmpdir_fresh}/e/open.csv").count() == 1


def test_json_array_parts_are_one_array(spark, tmpdir_fresh):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit('x"\n'), "id")).alias("t")).repartition(7)
    assert FS.write_json_array(df, f"{tmpdir_fresh}/j", [F.col("k")]) == 1000
    parts = sorted(glob.glob(f"{tmpdir_fresh}/j/part-*"))
    got = json.loads("".join(open(p, encoding="utf-8").read() for p in parts))
    assert [r["k"] for r in got] == list(range(1000)) and {r["k"]: r["t"] for r in got} == {r.k: r.t for r in df.collect()}
    assert sorted(r.k for r in FS.read_json_array(spark, f"{tmpdir_fresh}/j", "k long, t string").collect()) == list(range(1000))
    assert FS.write_json_array(df.limit(0), f"{tmpdir_fresh}/none", [F.col("k")]) == 0
    assert json.loads("".join(open(p).read() for p in sorted(glob.glob(f"{tmpdir_fresh}/none/part-*")))) == []


@pytest.mark.parametrize("at_once", [0, 3, 40, 100_000])
def test_large_samples_equal_the_sorted_ones(spark, monkeypatch, at_once):
    df = spark.range(500).select((F.col("id") % 450).alias("k"))  # some keys twice
    for n in (1, 7, 250, 499, 500, 600):
        monkeypatch.setattr(O, "SORTED_AT_ONCE", 100_000)
        want = sorted(r.k for r in O.sample_exact(df, n, "k", 5).collect())
        monkeypatch.setattr(O, "SORTED_AT_ONCE", at_once)
        got = O.sample_exact(df, n, "k", 5)
        assert sorted(r.k for r in got.collect()) == want


def test_a_large_sample_sorts_only_the_last_cell(spark, monkeypatch):
    monkeypatch.setattr(O, "SORTED_AT_ONCE", 100)
    df = spark.range(200_000).select(F.col("id").alias("k"))
    got = O.sample_exact(df, 100_000, "k", 1)
    assert got.count() == 100_000
    limits = [int(x) for x in __import__("re").findall(r"(?:limit=|GlobalLimit )(\d+)", got._jdf.queryExecution().toString())]
    assert limits and max(limits) <= 100


def test_batch_validator_adds_to_the_errors(spark):
    df = spark.createDataFrame([(1, []), (2, [("a", "r", "old")]), (None, [])], "n int, errors array<struct<field:string,rule:string,message:string>>")

    def odd(batch: pa.RecordBatch):
        assert batch.schema.names == ["n"]
        return [None if v is None else [f"{v} is odd", "again"] if v % 2 else [] for v in batch.column("n").to_pylist()]

    rows = {r.n: [e.message for e in r.errors] for r in V.with_batch_validator(df, odd).collect()}
    assert rows == {1: ["1 is odd", "again"], 2: ["old"], None: []}
    assert V.with_batch_validator(df, lambda b: pa.array([["bad"]] * b.num_rows)).columns == df.columns


def test_dedup_stream_forgets_behind_the_watermark(spark, tmpdir_fresh):
    base, fields = tmpdir_fresh, {"id": "string", "at": "timestamp", "n": "int"}

    def run(name, rows):
        write_text(f"{base}/in/{name}/x.json", "".join(json.dumps(dict(zip(fields, r))) + "\n" for r in rows) + "{broken\n")
        q = DedupStream(spark, f"{base}/in/*/*.json", f"{base}/out", f"{base}/ckpt", fields, ["id"], "at", "2 days").run_available()
        return q.lastProgress

    run("d1", [("a", "2024-01-01T00:00:00", 1), ("a", "2024-01-01T00:00:00", 1), ("b", "2024-01-02T00:00:00", 2)])
    run("d2", [("a", "2024-01-02T00:00:00", 9), ("c", "2024-01-30T00:00:00", 3)])  # a is known; then the watermark moves on
    run("d3", [("b", "2024-01-03T00:00:00", 8), ("d", "2024-01-30T00:00:00", 4), ("c", "2024-01-31T00:00:00", 5)])  # b is late
    got = sorted((r.id, r.n) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    last = run("d4", [("e", "2024-03-01T00:00:00", 6)])
    last = run("d5", [("f", "2024-03-01T00:00:00", 7)]) or last
    assert last.stateOperators[0].numRowsTotal <= 2  # e and f alone are still held


def test_interval_trigger_sees_a_second_drop_and_stops(spark, tmpdir_fresh):
    base, fields = tmpdir_fresh, {"id": "string", "at": "timestamp"}
    ds = DedupStream(spark, f"{base}/in/*/*.json", f"{base}/out", f"{base}/ckpt", fields, ["id"], "at")
    write_text(f"{base}/in/d1/x.json", '{"id": "a", "at": "2024-01-01T00:00:00"}\n')
    q = ds.start("processingTime", "1 second")
    q.processAllAvailable()
    assert [r.id for r in ds.output().collect()] == ["a"] and q.isActive
    write_text(f"{base}/in/d2/x.json", '{"id": "b", "at": "2024-01-01T00:00:00"}\n')
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in ds.output().collect()) == ["a", "b"] and not q.isActive and q.exception() is None
