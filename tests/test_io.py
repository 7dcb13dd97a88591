"""Sources and sinks (S*): NDJSON strict/permissive, JSON documents, CSV, counts."""
import json
import os

import pytest
from pyspark.sql import functions as F

from stardust.functions import jsonpath as J
from stardust.sources import files as FS
from stardust.sources import ndjson as N
from conftest import lines_frame, valid_review


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_read_ndjson_skips_blank(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/in/a.jsonl"
    write_text(p, json.dumps(valid_review()) + "\n\n   \n" + json.dumps(valid_review(review_id="R2")) + "\n")
    df = N.read_ndjson(spark, f"{tmpdir_fresh}/in")
    assert sorted(r[0] for r in df.select(J.get("v", "review_id")).collect()) == ["R001", "R2"]


def test_read_ndjson_strict_fails(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/in/a.jsonl"
    write_text(p, json.dumps(valid_review()) + "\n{not json\n")
    with pytest.raises(Exception, match="JSON parse error"):
        N.read_ndjson(spark, f"{tmpdir_fresh}/in").collect()


def test_permissive_keeps_bad_lines(spark):
    df = N.parse_lines(lines_frame(spark, [valid_review(), "{broken", ""]), N.PERMISSIVE)
    rows = df.select("is_corrupt").collect()
    assert sorted(r[0] for r in rows) == [False, True]


def test_empty_file(spark, tmpdir_fresh):
    write_text(f"{tmpdir_fresh}/in/empty.jsonl", "")
    assert N.read_ndjson(spark, f"{tmpdir_fresh}/in").count() == 0


def test_duplicate_keys_keep_last(spark):
    df = N.parse_lines(lines_frame(spark, ['{"a": 1, "a": 2}']))
    assert df.select(J.get("v", "a", "int")).first()[0] == 2


def test_json_document_object_or_array(spark, tmpdir_fresh):
    write_text(f"{tmpdir_fresh}/docs/one.json", json.dumps(valid_review()))
    write_text(f"{tmpdir_fresh}/docs/many.json", json.dumps([valid_review(review_id="A"), valid_review(review_id="B")], indent=2))
    df = N.read_json_document(spark, f"{tmpdir_fresh}/docs")
    assert sorted(r[0] for r in df.select(J.get("v", "review_id")).collect()) == ["A", "B", "R001"]


def test_ndjson_round_trip_count(spark, tmpdir_fresh):
    df = spark.createDataFrame([("R1", 5, None), ("R2", 3, "x")], "review_id string, star_rating int, note string")
    n = FS.write_ndjson(df, f"{tmpdir_fresh}/out")
    assert n == 2
    back = N.read_ndjson(spark, f"{tmpdir_fresh}/out")
    # null fields are left out by default (a missing key stays missing)
    assert back.where(J.is_missing("v", "note")).count() == 1


def test_csv_export_and_read(spark, tmpdir_fresh):
    df = spark.createDataFrame([valid_review(helpful_votes=3, extra="drop me")])
    n = FS.write_csv(df, f"{tmpdir_fresh}/csv")
    assert n == 1
    back = FS.read_csv(spark, f"{tmpdir_fresh}/csv")
    assert back.columns == ["review_id", "review_date", "customer_id", "product_id", "product_title",
                            "product_category", "star_rating", "review_body", "verified_purchase"]
    row = back.first()
    assert row["star_rating"] == "5"      # CSV values stay text


def test_csv_custom_columns_missing_blank(spark, tmpdir_fresh):
    df = spark.createDataFrame([("R1", None)], "review_id string, review_body string")
    FS.write_csv(df, f"{tmpdir_fresh}/csv", fieldnames=["review_id", "review_body", "not_there"])
    row = FS.read_csv(spark, f"{tmpdir_fresh}/csv").first()
    assert (row["review_id"], row["review_body"], row["not_there"]) == ("R1", "", "")


def test_csv_empty_input(spark, tmpdir_fresh):
    df = spark.createDataFrame([], "review_id string")
    assert FS.write_csv(df, f"{tmpdir_fresh}/csv") == 0


def test_flatten_bare_object_and_array(spark):
    df = lines_frame(spark, ['{"a": 1}', '[{"a": 2}, {"a": 3}]'])
    parsed = N.parse_lines(df)
    flat = J.flatten(parsed, "v", "rec", keep=[])
    assert sorted(r[0] for r in flat.select(J.get("rec", "a", "int")).collect()) == [1, 2, 3]


def test_kinds(spark):
    df = N.parse_lines(lines_frame(spark, ['{"a": 5, "b": 5.0, "c": "5", "d": true, "e": null}']))
    row = df.select(*[J.kind("v", k).alias(k) for k in "abcdez"]).first()
    assert row["a"] == "BIGINT" and row["b"].startswith("DECIMAL") and row["c"] == "STRING"
    assert row["d"] == "BOOLEAN" and row["e"] == "VOID" and row["z"] is None


def test_export_summary(spark, tmpdir_fresh):
    import glob
    df = spark.createDataFrame([valid_review(star_rating=5), valid_review(star_rating=4, verified_purchase="N",
                                                                          product_category="Audio")])
    assert FS.export_summary(df, f"{tmpdir_fresh}/summary") == 2
    read = lambda part: [json.loads(x) for f in glob.glob(f"{tmpdir_fresh}/summary/{part}/part-*") for x in open(f)]
    (data,) = read("totals")
    assert data["total"] == 2 and data["avg_star_rating"] == 4.5 and data["verified_rate"] == 0.5
    assert data["star_distribution"] == {"5": 1, "4": 1}
    assert {r["product_category"]: r["n"] for r in read("categories")} == {"Electronics": 1, "Audio": 1}


def test_cli_validate(spark, tmpdir_fresh, capsys):
    from stardust import cli
    p = f"{tmpdir_fresh}/in/a.jsonl"
    write_text(p, "\n".join(json.dumps(r) for r in [valid_review(), {"review_id": "X"}, valid_review(review_id="R2")]) + "\n")
    assert cli.main(["validate", f"{tmpdir_fresh}/in"]) == 0
    assert cli.main(["validate", f"{tmpdir_fresh}/in", "--strict"]) == 1
    out = capsys.readouterr().out
    assert '"invalid_count": 1' in out and "X: Missing fields" in out
    assert cli.main(["validate", f"{tmpdir_fresh}/in", "--limit", "2"]) == 0


def test_cli_run(spark, tmpdir_fresh, capsys):
    from stardust import cli
    write_text(f"{tmpdir_fresh}/in/a.jsonl", "\n".join(json.dumps(valid_review(review_id=f"R{i}", star_rating=1 + i % 5))
                                                      for i in range(10)) + "\n")
    assert cli.main(["run", f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out", "--min-stars", "4", "--verified"]) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["processed_records"] == 4 and stats["total_records"] == 10


def test_strict_check_survives_a_count(spark, tmpdir_fresh):
    write_text(f"{tmpdir_fresh}/in/a.jsonl", '{"a": 1}\n\t \n{broken\n')
    with pytest.raises(Exception, match="JSON parse error"):
        N.read_ndjson(spark, f"{tmpdir_fresh}/in").count()
    assert N.read_ndjson(spark, f"{tmpdir_fresh}/in", N.PERMISSIVE).count() == 2


def test_cli_counts_broken_lines(spark, tmpdir_fresh, capsys):
    from stardust import cli
    write_text(f"{tmpdir_fresh}/in/a.jsonl", json.dumps(valid_review(review_id="Z")) + "\n{broken\n" + json.dumps(valid_review(review_id="A")) + "\n")
    assert cli.main(["validate", f"{tmpdir_fresh}/in", "--strict"]) == 1
    out = json.loads(capsys.readouterr().out.splitlines()[0])
    assert (out["total"], out["invalid_count"], out["corrupt_count"]) == (3, 1, 1)
    assert cli.main(["validate", f"{tmpdir_fresh}/in", "--limit", "1", "--strict"]) == 0  # the first line of the file, not the first by spelling


def test_library_names_no_master_and_wants_a_shared_folder(spark, monkeypatch):
    from stardust import session

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: {})

    class Fake:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake)
    import inspect
    assert "local[" not in inspect.signature(session.get_spark).__str__()
