import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stardust.session import get_spark
    s = get_spark(master="local[4]", extra={"spark.sql.shuffle.partitions": "4"})
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="stardust-test-")


def valid_review(**over):
    rec = {
        "review_id": "R001", "review_date": "2024-01-15", "customer_id": "C12345",
        "product_id": "P999", "product_title": "Wireless Mouse", "product_category": "Electronics",
        "star_rating": 5, "review_body": "Great product, works perfectly.", "verified_purchase": "Y",
    }
    rec.update(over)
    return rec


def lines_frame(spark, records):
    """Literal JSON lines (each a dict, or raw text) as a text frame."""
    rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(rows, "value string")
