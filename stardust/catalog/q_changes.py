"""Change capture (C1-C4) and retention (R1) over snapshots derived from the feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import changes as CH
from ..operators import dedup as D
from ..plans import audit as AU
from ..sources.tables import arrival_order, review_records
from ._register_helpers import line_no
from ._registry import register
from ._sql import R, with_

COLS = ("review_id", "star_rating", "helpful_votes", "verified_purchase")


def snapshots(spark, sf_dir):
    """Old snapshot: latest row per review among rows loaded before 2000;
    new snapshot: latest row per review over all rows, with line 7 deleted."""
    r = review_records(spark, sf_dir)
    old = D.latest(r.where(F.col("loaded_timestamp") < F.lit("2000-01-01").cast("timestamp_ntz")),
                   "review_id", arrival_order()).select(*COLS)
    new = D.latest(r.where(line_no() != 7), "review_id", arrival_order()).select(*COLS)
    return old, new


def _latest_sql(where: str) -> str:
    return (f"SELECT review_id, star_rating, helpful_votes, verified_purchase FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY review_id ORDER BY loaded_timestamp DESC, tie1 DESC, tie2 DESC, tie3 DESC, tie4 DESC) "
            f"AS rn FROM r WHERE {where}) WHERE rn = 1")


OLD_WHERE = "loaded_timestamp < TIMESTAMP '2000-01-01 00:00:00'"
NEW_WHERE = "split_part(review_id, '-', 2) <> '7'"
SNAP = with_(R, f"o AS ({_latest_sql(OLD_WHERE)})", f"n AS ({_latest_sql(NEW_WHERE)})")
CHANGED = ("(o.star_rating, o.helpful_votes, o.verified_purchase) IS DISTINCT FROM "
           "(n.star_rating, n.helpful_votes, n.verified_purchase)")
DIFF = SNAP + f"""
, d AS (
  SELECT n.review_id, 'INSERT' AS action, o.review_id IS NOT NULL AS is_update,
         n.star_rating, n.helpful_votes, n.verified_purchase
  FROM n LEFT JOIN o ON o.review_id = n.review_id WHERE o.review_id IS NULL OR {CHANGED}
  UNION ALL
  SELECT o.review_id, 'DELETE', n.review_id IS NOT NULL, o.star_rating, o.helpful_votes, o.verified_purchase
  FROM o LEFT JOIN n ON o.review_id = n.review_id WHERE n.review_id IS NULL OR {CHANGED})
"""


@register("c1_appended_rows", SNAP + "SELECT n.* FROM n WHERE review_id NOT IN (SELECT review_id FROM o)")
def c1_appended(spark, sf_dir):
    """Rows new since the last read (append-only change set)."""
    old, new = snapshots(spark, sf_dir)
    return CH.appended(old, new, ["review_id"])


@register("c2_change_rows", DIFF + "SELECT * FROM d")
def c2_changes(spark, sf_dir):
    """INSERT / DELETE action rows; updates are a DELETE + INSERT pair
    flagged ``is_update``."""
    old, new = snapshots(spark, sf_dir)
    return CH.diff(old, new, ["review_id"])


@register("c4_inserts_only", DIFF + "SELECT * FROM d WHERE action = 'INSERT'")
def c4_inserts(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return CH.inserts_only(CH.diff(old, new, ["review_id"]))


@register("r1_archive_and_purge", with_(R) + """
SELECT 'archived' AS part, count(*) AS n FROM r WHERE loaded_timestamp < TIMESTAMP '1998-07-08 00:00:00' - INTERVAL 7 DAY
UNION ALL
SELECT 'kept', count(*) FROM r WHERE NOT (loaded_timestamp < TIMESTAMP '1998-07-08 00:00:00' - INTERVAL 7 DAY)
""")
def r1_archive(spark, sf_dir):
    """Rows older than 7 days (one pinned clock) go to the archive, the
    rest stay; archived + kept = before."""
    landing = review_records(spark, sf_dir).select("review_id", "loaded_timestamp")
    archive, kept = AU.archive_split(landing, F.lit(dt.datetime(1998, 7, 8)).cast("timestamp_ntz"), 7)
    return (archive.agg(F.lit("archived").alias("part"), F.count(F.lit(1)).alias("n"))
            .unionByName(kept.agg(F.lit("kept").alias("part"), F.count(F.lit(1)).alias("n"))))
