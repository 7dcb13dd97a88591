"""CSV files whose quoted fields may span lines, read by many tasks a file.

A line end inside quotes is no record end, and whether a place is inside depends on
the quotes before it. The text source splits files at byte ranges and gives whole
lines with the range they came from. So: count the quotes of every range, sum their
parities up over the ranges of a file (a row a range), and every range knows whether it
begins inside quotes. Each range then cuts its own lines into records, in order. What is
open at a range's end is joined with what the next ranges hold of it before its close:
at most two fragments a range take part. A doubled quote is two quotes, so it changes no
parity.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

RECORD, OPEN, INSIDE, CLOSE = 0, 1, 2, 3  # a whole record; the begin, middle and end of one that spans ranges


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    """Lines (without their newline) with file, range and place."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _cut(batches):
    """Lines sorted by file, range and place, with ``inside`` (the range begins inside
    quotes), as pieces ``file, block, nth, kind, text``."""
    names = ["file", "block", "nth", "kind", "text"]
    where = held = None
    nth, out = 0, []

    def piece(kind, lines):
        nonlocal nth
        out.append((*where, nth, kind, "\n".join(lines)))
        nth += 1

    def close():
        if held:  # the range ends inside quotes
            piece(INSIDE if fresh else OPEN, held)

    fresh = False  # still in the record that an earlier range began
    quoted = False
    for b in batches:
        for file, block, inside, line in zip(*[b.column(c).to_pylist() for c in ("file", "block", "inside", "value")]):
            if (file, block) != where:
                if where is not None:
                    close()
                where, held, nth = (file, block), [], 0
                quoted = fresh = bool(inside)
            held.append(line)
            quoted ^= bool(line.count('"') & 1)
            if not quoted:
                piece(CLOSE if fresh else RECORD, held)
                held, fresh = [], False
        if len(out) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), _KINDS)], names=names)
            out.clear()
    if where is not None:
        close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), _KINDS)], names=names)


_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, nth, text``: the records of CSV files, the header with them; blank
    ones are left out, a carriage return at a record's end is none of it."""
    lines = _ranges(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    odd = odd.select(F.col("file").alias("f"), F.col("block").alias("b"), (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # ``odd`` is a row a range, so it goes to the lines: a range stays in the task that read it.
    told = lines.join(F.broadcast(odd), (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select("file", "block", "at", "inside", "value")
    told = told.sortWithinPartitions("file", "block", "at")
    # Written once: whole records, fragments and the header's search all read it.
    cut = materialize(told.mapInArrow(_cut, "file string, block long, nth long, kind int, text string"), "csv-pieces")
    whole = cut.where(F.col("kind") == RECORD).select("file", "block", "nth", "text")
    # Fragments: two a range at most. An opening one names the record, those after it belong to it.
    part = cut.where(F.col("kind") != RECORD)
    upto = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, 0)
    part = part.withColumn("of", F.max(F.when(F.col("kind") == OPEN, F.struct("block", "nth"))).over(upto))
    joined = part.groupBy("file", F.col("of.block").alias("block"), F.col("of.nth").alias("nth")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), F.col("nth").alias("k"), "text"))), lambda x: x["text"]), "\n").alias("text"))
    every = whole.unionByName(joined).withColumn("text", F.regexp_replace("text", "\r$", ""))
    return every.where(F.length("text") > 0)


def read(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 CSV files with a header of the same columns each, every column text; empty
    and absent cells are ''."""
    rows = records(spark, path)
    first = rows.groupBy("file").agg(F.min(F.struct("block", "nth")).alias("head"))
    rows = rows.join(F.broadcast(first.withColumnRenamed("file", "of")), F.col("file") == F.col("of"))
    head = F.struct("block", "nth").eqNullSafe(F.col("head"))
    line = rows.where(head).orderBy("file").select("text").first()  # one record
    if line is None:
        return spark.createDataFrame([], T.StructType([]))
    options = {"escape": '"', "multiLine": "true", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "maxCharsPerColumn": "-1"}
    width = line.text.count(",") + 1
    cells = spark.createDataFrame([(line.text.lstrip("﻿"),)], "text string").select(
        F.from_csv("text", ", ".join(f"c{i} string" for i in range(width)), options).alias("r")).first().r
    names = [c for c in cells if c is not None]
    got = rows.where(~head).select(F.from_csv("text", _ddl(names), options).alias("r"))
    return got.select(*[F.coalesce(F.col("r")[n], F.lit("")).alias(n) for n in names])


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
