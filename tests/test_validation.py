"""Validation (V*) on raw JSON records: missing vs null vs wrong type."""
import pytest
from pyspark.sql import functions as F

from stardust.operators import validate as V
from stardust.plans import reviews as RV
from stardust.sources import ndjson as N
from conftest import lines_frame, valid_review


def errors_of(spark, records):
    parsed = N.parse_lines(lines_frame(spark, records))
    ann = RV.clean_validate(parsed)
    return [[e["message"] for e in r["errors"]] for r in ann.select("errors").collect()]


def test_valid_record(spark):
    assert errors_of(spark, [valid_review()]) == [[]]


def test_missing_fields(spark):
    errs = errors_of(spark, [{"review_id": "R999"}])[0]
    assert errs[0].startswith("Missing fields: ['customer_id', 'product_category'")
    assert len(errs) == 1


@pytest.mark.parametrize("rating", [0, 6, -1, 100, "five", 5.0, True])
def test_bad_rating(spark, rating):
    errs = errors_of(spark, [valid_review(star_rating=rating)])[0]
    assert any("star_rating" in e for e in errs)


@pytest.mark.parametrize("vp", ["X", "y", "n", "", "YES", "maybe"])
def test_bad_flag(spark, vp):
    errs = errors_of(spark, [valid_review(verified_purchase=vp)])[0]
    assert any("verified_purchase" in e for e in errs)


@pytest.mark.parametrize("d", ["01-01-2024", "2024/01/01", "not-a-date", "20240101", 20240101])
def test_bad_date(spark, d):
    errs = errors_of(spark, [valid_review(review_date=d)])[0]
    assert any("review_date" in e for e in errs)


@pytest.mark.parametrize("field", ["review_id", "customer_id", "product_id", "product_title",
                                   "product_category", "review_body"])
def test_blank_string(spark, field):
    errs = errors_of(spark, [valid_review(**{field: "   "})])[0]
    assert errs == [f"{field} must be a non-empty string, got ''"]  # cleaned before validation


def test_null_is_present(spark):
    errs = errors_of(spark, [valid_review(review_body=None)])[0]
    assert errs == ["review_body must be a non-empty string, got None"]


def test_message_texts(spark):
    errs = errors_of(spark, [valid_review(star_rating=99, verified_purchase="X")])[0]
    assert errs == ["star_rating must be int 1-5, got 99", "verified_purchase must be one of ['N', 'Y'], got 'X'"]


def test_split_and_report(spark):
    recs = [valid_review(), valid_review(review_id="R2"), {"review_id": "R999"}, valid_review(star_rating=99)]
    ann = RV.clean_validate(N.parse_lines(lines_frame(spark, recs)))
    valid, invalid = V.split(ann)
    assert valid.count() == 2 and invalid.count() == 2
    t = V.report_totals(ann).first()
    assert (t["total"], t["valid_count"], t["invalid_count"], t["pass_rate"]) == (4, 2, 2, 0.5)
    summary = {r["error_key"]: r["n"] for r in V.error_summary(ann).collect()}
    assert summary["star_rating"] == 1 and any(k.startswith("Missing fields") for k in summary)


def test_report_empty(spark):
    empty = spark.createDataFrame([], "value string")
    ann = RV.clean_validate(N.parse_lines(empty))
    t = V.report_totals(ann).first()
    assert t["total"] == 0 and t["pass_rate"] == 1.0


def test_assert_valid_raises(spark):
    ann = RV.clean_validate(N.parse_lines(lines_frame(spark, [{"review_id": "R1"}])))
    with pytest.raises(Exception):
        V.assert_valid(ann).collect()


def test_bool_is_int_option(spark):
    parsed = N.parse_lines(lines_frame(spark, [valid_review(star_rating=True)]))
    ann = V.annotate(RV.extract(parsed), bool_is_int=True)
    assert ann.select(F.size("errors")).first()[0] == 0


def test_review_run_metrics(spark, tmpdir_fresh):
    import json as _json
    import os as _os
    from stardust.functions import predicates as P
    from stardust.plans.review_job import run_reviews
    src = f"{tmpdir_fresh}/in"
    _os.makedirs(src)
    recs = [valid_review(review_id=f"R{i}", star_rating=1 + i % 5) for i in range(10)]
    recs += [{"review_id": "X"}, valid_review(review_id="Y", star_rating=9)]
    with open(f"{src}/a.jsonl", "w") as fh:
        fh.write("\n".join(_json.dumps(r) for r in recs) + "\n")
    m = run_reviews(spark, src, f"{tmpdir_fresh}/out", filters=[P.star_between(4, 5)], batch_size=3)
    r = m.first()
    assert (r.total_records, r.valid_records, r.invalid_records) == (12, 10, 2)
    assert (r.processed_records, r.failed_records, r.batches_processed) == (4, 0, 1)
    assert r.validation_errors == {"Missing fields": 1, "star_rating": 1}
    assert spark.read.json(f"{tmpdir_fresh}/out").count() == 4
    assert len(r.run_id) == 12 and r.duration_s > 0 and r.throughput_rps > 0
    for _ in range(2):
        run_reviews(spark, src, f"{tmpdir_fresh}/out{_}", metrics=f"{tmpdir_fresh}/metrics")
    assert spark.read.parquet(f"{tmpdir_fresh}/metrics").count() == 2


def test_extra_rule(spark):
    recs = [valid_review(), valid_review(review_body="x" * 3000)]
    ann = V.annotate(RV.extract(N.parse_lines(lines_frame(spark, recs))),
                     extra_rules=[V.length_check("review_body", 2000)])
    assert sorted(r[0] for r in ann.select(F.size("errors")).collect()) == [0, 1]
