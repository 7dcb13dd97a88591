"""Session helpers: one place for the settings every job relies on.

On a cluster the session already exists and carries the cluster's settings;
``get_spark`` only fills in what is unset, so it never overrides them.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library depends on for correct results (not tuning).
REQUIRED_CONF = {
    # Compare timestamps the same way on every node and in the oracle.
    "spark.sql.session.timeZone": "UTC",
    # json.loads keeps the last of repeated keys; variant parsing does the same
    # only with this flag (otherwise the whole record parses to null).
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for local runs (tests, bench). A cluster sets its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # One-row-group test files scan in one task; see ``sources.tables.spread``.
    "spark.stardust.minScanPartitions": "8",
}


def get_spark(master: str | None = None, app: str = "stardust", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one. The library names no master: on a
    cluster ``spark-submit`` does; tests and the bench pass a local one, which
    also brings the settings for local runs."""
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_required_conf(active)
        return active
    builder = SparkSession.builder.appName(app)
    local = master is not None and master.startswith("local")
    if master is not None:
        builder = builder.master(master)
    for k, v in {**(LOCAL_CONF if local else {}), **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (what the cluster names). Only under a
    local master (tests), where one machine holds all, may it be unset: then a
    fresh folder is made and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="stardust-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused, never deleted here)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def no_rows(spark: SparkSession, schema) -> DataFrame:
    """A frame that the optimizer knows to be empty: it takes the joins with it out of
    a plan, and with them the shuffles of the other side."""
    return spark.createDataFrame([], schema).where(F.lit(False))


LOOKUP_ROWS = 1 << 18  # rows of a table that may be broadcast


def for_lookup(df: DataFrame) -> DataFrame:
    """A written table as the side of a join in which it is looked up. Spark takes a table
    to be as small as its packed files, and broadcasts some of millions of rows through
    the driver: one of more than ``LOOKUP_ROWS`` (told by the files' footers) is joined
    by a shuffle."""
    return df.hint("merge") if df.count() > LOOKUP_ROWS else df


def materialize(df, label: str = "stage", path: str | None = None):
    """Cut lineage by writing ``df`` once as Parquet to the shared folder and
    reading it back (one pass; a reliable RDD checkpoint of an uncached plan
    would compute it twice). Survives executor loss: the files are shared. ``path``
    names a folder that the caller's next batch overwrites."""
    mode = "overwrite" if path else "errorifexists"
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
