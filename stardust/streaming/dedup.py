"""Dedup across micro-batches in state (D8): NDJSON files land in a folder, and each
record whose key was not seen within ``delay`` of event time before goes to a Parquet
sink. The state holds a row per key and is dropped by the watermark, so it is bounded by
the keys of ``delay`` and not by the stream. State and sink are in the checkpoint: a
restart goes on where the last micro-batch was committed, and a replayed one writes the
same rows once.

Records older than the watermark (``delay`` behind the newest event seen) are late and
left out, as their keys may be forgotten. Of records of one key the first to arrive
stays; within a micro-batch it is any one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonpath as J


class DedupStream:
    def __init__(self, spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str, fields: dict[str, str],
                 key: list[str], event_time: str, delay: str = "7 days", max_files_per_trigger: int | None = 1000):
        """``fields`` are the paths read from a record and their types; ``event_time`` is one
        of them (a timestamp), ``key`` some."""
        self.spark, self.input_dir, self.output_dir, self.checkpoint = spark, input_dir, output_dir.rstrip("/"), checkpoint
        self.fields, self.key, self.event_time, self.delay = fields, key, event_time, delay
        self.max_files = max_files_per_trigger

    def records(self) -> DataFrame:
        r = self.spark.readStream.format("text")
        if self.max_files:
            r = r.option("maxFilesPerTrigger", self.max_files)
        record = F.try_parse_json("value")
        parsed = r.load(self.input_dir).select(record.alias("v")).where("v is not null")
        return parsed.select(*[J.get("v", n, t).alias(n) for n, t in self.fields.items()])

    def start(self, trigger: str = "availableNow", interval: str = "1 minute"):
        first = self.records().withWatermark(self.event_time, self.delay).dropDuplicatesWithinWatermark(self.key)
        w = first.writeStream.format("parquet").option("path", self.output_dir).option("checkpointLocation", self.checkpoint).outputMode("append")
        w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=interval)
        return w.start()

    def run_available(self):
        q = self.start()
        q.awaitTermination()
        return q

    def output(self) -> DataFrame:
        return self.spark.read.parquet(self.output_dir)
