"""DuckDB text fragments for the oracle queries. The oracle is written
independently of the Spark plans: plain SQL over the same parquet tables."""

from __future__ import annotations

from ..sources.tables import REVIEW_VIEW_SQL

# Unicode whitespace (Python's \s on str); DuckDB's \s is ASCII only.
WS_CLASS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CTRL_CLASS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def clean(x: str) -> str:
    """F1 in DuckDB: NFC, drop control characters, collapse whitespace, strip."""
    s = f"regexp_replace(nfc_normalize({x}), '{CTRL_CLASS}', '', 'g')"
    s = f"regexp_replace({s}, '{WS_CLASS}+', ' ', 'g')"
    return f"regexp_replace({s}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


TEXT_FIELDS = ("review_id", "customer_id", "product_id", "product_title", "product_category", "review_body", "review_date")

# r = raw review view; c = review view with the text fields cleaned.
R = f"r AS ({REVIEW_VIEW_SQL})"
C_COLS = ", ".join(
    f"{clean(f)} AS {f}" if f in TEXT_FIELDS else f
    for f in ("review_id", "review_date", "customer_id", "product_id", "product_title", "product_category",
              "star_rating", "review_body", "helpful_votes", "verified_purchase", "order_id", "quantity",
              "email", "name", "address", "price", "loaded_timestamp", "tie1", "tie2", "tie3", "tie4")
)
C = f"c AS (SELECT {C_COLS} FROM r)"

# Validity of a cleaned, typed review (all rule checks pass).
VALID = (
    "review_id <> '' AND customer_id <> '' AND product_id <> '' AND product_title <> '' "
    "AND product_category <> '' AND review_body <> '' "
    r"AND regexp_full_match(review_date, '\d{4}-\d{2}-\d{2}') "
    "AND star_rating BETWEEN 1 AND 5 AND verified_purchase IN ('Y', 'N') "
    "AND review_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL "
    "AND product_title IS NOT NULL AND product_category IS NOT NULL AND review_body IS NOT NULL "
    "AND review_date IS NOT NULL AND star_rating IS NOT NULL AND verified_purchase IS NOT NULL"
)
V = f"v AS (SELECT * FROM c WHERE {VALID})"

REVIEW_COLS = ("review_id", "review_date", "customer_id", "product_id", "product_title", "product_category",
               "star_rating", "review_body", "helpful_votes", "verified_purchase")
ARRIVAL = "loaded_timestamp, tie1, tie2, tie3, tie4"
ARRIVAL_DESC = "loaded_timestamp DESC, tie1 DESC, tie2 DESC, tie3 DESC, tie4 DESC"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def pyrepr(x: str) -> str:
    """Python repr of a string value (simple cases: no quotes or escapes of both kinds)."""
    return (f"CASE WHEN {x} IS NULL THEN 'None' WHEN contains({x}, '''') AND NOT contains({x}, '\"') "
            f"THEN '\"' || {x} || '\"' ELSE '''' || replace({x}, '''', '\\''') || '''' END")
