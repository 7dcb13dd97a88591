"""Record shape of a review and the fixed values the rules depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for right results) -----------
# Required fields of a review record, and the subset that must be non-blank text.
REQUIRED_FIELDS = (
    "review_id", "review_date", "customer_id", "product_id",
    "product_title", "product_category", "star_rating", "review_body", "verified_purchase",
)
STRING_FIELDS = ("review_id", "customer_id", "product_id", "product_title", "product_category", "review_body")
# Text fields cleaned by the review normaliser, in this order.
TEXT_FIELDS = ("review_id", "customer_id", "product_id", "product_title", "product_category", "review_body", "review_date")
VERIFIED_VALUES = ("N", "Y")
STAR_MIN = 1
STAR_MAX = 5
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# Default CSV columns (helpful_votes is not among them).
CSV_FIELDS = (
    "review_id", "review_date", "customer_id", "product_id",
    "product_title", "product_category", "star_rating",
    "review_body", "verified_purchase",
)
# Flag words accepted by the verified-purchase coercion (after trim + upper).
FLAG_YES = ("Y", "YES", "TRUE", "1")
FLAG_NO = ("N", "NO", "FALSE", "0")
# Control characters removed by text cleaning: \x00-\x08, \x0b, \x0c, \x0e-\x1f, \x7f.
CONTROL_CHARS_CLASS = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]"
DEFAULT_BATCH_SIZE = 100
# ---------------------------------------------------------------------------

# Typed form of a review (what a JSON record becomes after extraction).
REVIEW_TYPES = {
    "review_id": "string",
    "review_date": "string",
    "customer_id": "string",
    "product_id": "string",
    "product_title": "string",
    "product_category": "string",
    "star_rating": "int",
    "review_body": "string",
    "helpful_votes": "int",
    "verified_purchase": "string",
}

# Extra fields the warehouse loads read from the same record.
STAR_TYPES = {
    "order_id": "bigint",
    "quantity": "int",
    "email": "string",
    "name": "string",
    "address": "string",
    "price": "decimal(38,2)",
}

_SIMPLE = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "decimal(38,2)": T.DecimalType(38, 2)}

REVIEW_SCHEMA = T.StructType([T.StructField(k, _SIMPLE[v]) for k, v in REVIEW_TYPES.items()])
