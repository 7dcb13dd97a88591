"""Property checks: Spark column functions against plain-Python statements of
the same rules, over many generated values in one Spark job each."""
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stardust.functions import text as X

_CTRL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_WS = re.compile(r"\s+")


def py_clean(s):
    s = unicodedata.normalize("NFC", s)
    s = _CTRL.sub("", s)
    return _WS.sub(" ", s).strip()


def py_rating(s):
    try:
        v = float(s)
        if v != v or v in (float("inf"), float("-inf")):
            return None
        i = int(v)
    except (ValueError, TypeError, OverflowError):
        return None
    return i if 1 <= i <= 5 else None


ALPHABET = st.sampled_from(list("ab Z9-_.") + ["\t", "\n", "\r", "\x0b", "\x0c", "\x01", "\x1f", "\x7f",
                                                " ", " ", "　", "é", "é", "Å"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=150)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_clean_text_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(X.clean_text("x")).collect()]
    assert got == [py_clean(v) for v in values]


NUMS = st.lists(st.one_of(
    st.integers(-3, 9).map(str), st.floats(-2, 8, allow_nan=False).map(lambda f: f"{f:.3f}"),
    st.sampled_from(["", " 3 ", "4.", ".5", "1e0", "5e-1", "abc", "4d", "inf", "nan", "+2", "-0"])),
    min_size=1, max_size=150)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(NUMS)
def test_coerce_rating_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(X.coerce_star_rating("x")).collect()]
    assert got == [py_rating(v) for v in values]


_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
DATES = st.lists(st.tuples(st.integers(1990, 2030), st.integers(0, 14), st.integers(0, 33), st.booleans()).map(
    lambda t: f"{t[0]}-{t[1]:02d}-{t[2]:02d}" if t[3] else f"{t[0]}-{t[1]}-{t[2]}"), min_size=1, max_size=150)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(DATES)
def test_date_rules_match_python(spark, values):
    import datetime as dt
    df = spark.createDataFrame([(v,) for v in values], "x string")
    rows = df.select(X.is_valid_date("x").alias("ok"), X.parse_date("x").alias("d")).collect()

    def py_parse(s):
        try:
            return dt.datetime.strptime(s, "%Y-%m-%d").date()
        except ValueError:
            return None
    assert [r["ok"] for r in rows] == [bool(_DATE.match(v)) for v in values]
    assert [r["d"] for r in rows] == [py_parse(v) for v in values]
