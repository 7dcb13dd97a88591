"""Scalar transforms (F*), one or more inputs for each rule."""
import pytest
from pyspark.sql import functions as F

from stardust.functions import text as X


def one(spark, col_expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(col_expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", [
    ("\n one \n\n two\t", "one two"),          # runs of blanks become one, none at the ends
    ("first\r\r\nsecond", "first second"),
    ("\x7fde\x02lete\x1e me", "delete me"),     # control characters go
    ("left\x0c\x0bright", "leftright"),         # so do form feed and vertical tab, before blanks are looked at
    ("wide\u2003and\u00a0hard", "wide and hard"),  # Unicode blanks count
    ("u\u0308ber A\u030a", "\u00fcber \u00c5"),   # NFC composes
    ("\u3000", ""), (" ", ""),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, X.clean_text, raw) == expected


def test_clean_text_null(spark):
    assert one(spark, X.clean_text, None) is None


@pytest.mark.parametrize("value,expected", [
    ("1", 1), ("5", 5), ("3.999", 3), ("1.0", 1), ("5.49", 5), ("0.9", None), ("-3", None), ("6.0", None),
    ("four", None), ("", None), (None, None), ("3f", None), ("nan", None), ("-inf", None), ("\t2\n", 2), ("2e0", 2),
])
def test_coerce_star_rating_text(spark, value, expected):
    assert one(spark, X.coerce_star_rating, value) == expected


def test_coerce_star_rating_numbers(spark):
    assert one(spark, X.coerce_star_rating, 4.75, "double") == 4
    assert one(spark, X.coerce_star_rating, 0.25, "double") is None
    assert one(spark, X.coerce_star_rating, 1, "int") == 1
    assert one(spark, X.coerce_star_rating, 11, "int") is None


@pytest.mark.parametrize("value,expected", [
    ("y", "Y"), ("Yes", "Y"), ("true", "Y"), (" 1", "Y"), ("n", "N"), ("NO", "N"), ("False", "N"), ("0\t", "N"),
    ("yep", None), ("", None), (None, None), ("10", None), ("t", None),
])
def test_coerce_flag(spark, value, expected):
    assert one(spark, X.coerce_flag, value) == expected


def test_coerce_flag_on_numbers_is_null(spark):
    assert one(spark, X.coerce_flag, 1, "int") is None
    assert one(spark, X.coerce_flag, True, "boolean") == "Y"


def test_coerce_flag_bool(spark):
    assert one(spark, X.coerce_flag_bool, True, "boolean") == "Y"
    assert one(spark, X.coerce_flag_bool, False, "boolean") == "N"


@pytest.mark.parametrize("value,ok", [
    ("1999-12-31", True), ("2000-2-9", True), ("2023-02-30", False), ("31.12.1999", False), ("", False), (None, False),
])
def test_parse_date(spark, value, ok):
    assert (one(spark, X.parse_date, value) is not None) == ok


@pytest.mark.parametrize("value,ok", [
    ("1999-12-31", True), ("0000-99-99", True), ("2000-2-09", False), ("1999-12-31 ", False), ("1999.12.31", False), ("991231", False),
])
def test_is_valid_date(spark, value, ok):
    assert one(spark, X.is_valid_date, value) == ok


def test_truncate(spark):
    assert one(spark, lambda c: X.truncate_text(c, 10), "short") == "short"
    assert one(spark, lambda c: X.truncate_text(c, 5), "abcdefghij") == "abcd…"
    assert one(spark, lambda c: X.truncate_text(c, 2, "..."), "abcdef") == "..."


def test_mask(spark):
    assert one(spark, lambda c: X.mask_id(c, 4), "C12345678") == "*****5678"
    assert one(spark, lambda c: X.mask_id(c, 4), "C12") == "C12"
    assert one(spark, lambda c: X.mask_id(c, 0), "C12") == "***"


def test_stringify(spark):
    df = spark.createDataFrame([(True, None, 3, [1, 2])], "a boolean, b string, c int, d array<int>")
    row = X.stringify_frame(df).first()
    assert row["a"] == "True" and row["b"] == "" and row["c"] == "3" and row["d"] == "[1,2]"


def test_sanitize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c-d` int")
    assert X.sanitize_columns(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        X.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_content_hash_key_order(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    h1 = df.select(X.content_hash(["b", "a"]).alias("h")).first()["h"]
    h2 = df.select(X.content_hash(["a", "b"]).alias("h")).first()["h"]
    assert h1 == h2 and len(h1) == 64
