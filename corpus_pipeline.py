"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing and
best-fit packing over whole documents.

Every stage takes the documents that the one before it kept (read again from
Parquet) and returns the columns of ``documents``; the last returns the packed
pieces. A stage's column names never clash with the documents': results that a
stage needs beside them are joined or dropped inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stardust.llm import op3_lines, op4_langid, op5_mix, op7_jaccard, op10_pack
from stardust.llm._common import free_name, word_count
from stardust.session import materialize

MIN_SCORE = 0.3  # language ID below this is a rejection
ORACLE_SQL = None  # tests hold brute-force versions of the stages


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text has a language: rejected are null texts,
    texts without a letter, and texts of no sure language (score under 0.3). The
    language predicted replaces a missing label; a label that is there stays."""
    model = op4_langid.fit_documents(docs)
    got = op4_langid.identify(docs, model)
    found = got.where((F.col("lang_pred") != op4_langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return found.select(*[F.coalesce("lang", "lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; a document that loses every line
    with a word goes. ``n_chars`` follows the text. A null text stays as it is, rows of
    equal id and text share their result, the first of equal runs (by ``doc_id``, null
    first, then text hash, then line) stays; an empty table gives an empty result."""
    got = op3_lines.dedup_lines(docs, drop_emptied=True).select(*docs.columns)
    return got.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else got


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: of five-word shingles and a
    Jaccard similarity of 0.8 or more, the one with the smallest ``doc_id`` (of
    rows of that id, the smallest text hash). Documents without words all stay."""
    every, classes, links = op7_jaccard.jaccard_links(docs, k=5, percent=80)
    comp = op7_jaccard.components(materialize(links, "pipeline-links"))
    c = classes.join(comp, classes["cid"] == comp["id"], "left").select("f1", "f2", F.coalesce("component", "cid").alias("comp"))
    rows = every.where("n > 0").join(c, ["f1", "f2"])
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")
    keep = materialize(rows.groupBy("comp").agg(F.min(order).alias("x")).select(F.col("x.doc_id").alias("d"), F.col("x.th").alias("h")), "pipeline-kept")
    th = free_name(docs, "th")
    src = docs.withColumn(th, F.xxhash64("text"))
    worded = F.coalesce(src["text"].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = src.where(worded).join(keep.hint("merge"), (src[th] == keep["h"]) & src["doc_id"].cast("long").eqNullSafe(keep["d"])).select(*[src[c] for c in src.columns])
    own = own.dropDuplicates(["doc_id", th])  # rows that repeat
    return own.select(*docs.columns).unionByName(src.where(~worded).select(*docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; its copies are rows.

    Rows that are equal in all columns are one group with the sum of their copies, so
    repeated rows take no more than their share. A null or wordless text has size 0 and
    ties of size are ordered by ``doc_id`` (null first), then by hash; a null source is a
    source of its own; an empty table gives an empty result."""
    k1, k2, size, copies = (free_name(docs, n) for n in ("k1", "k2", "words", "copies"))
    every = [F.col(f"`{c}`") for c in docs.columns]
    src = docs.withColumn(k1, F.xxhash64(*every)).withColumn(k2, F.xxhash64(F.lit(1), *every))
    thin = src.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), "doc_id", "source", word_count(F.col("text")).alias("words"))
    got = op5_mix.mix(thin, F.col("words"), F.struct("doc_id", "k1", "k2"))
    got = got.groupBy("k1", "k2").agg(F.sum("copies").alias("n")).withColumnsRenamed({"k1": "of1", "k2": "of2"})
    rows = src.join(got.hint("merge"), (F.col(k1) == F.col("of1")) & (F.col(k2) == F.col("of2"))).where("n > 0")
    one = rows.withColumn(size, F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1))).where(F.col(size) == 1)
    return one.select(*every, F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias(copies)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens. A null
    text is an empty one (a piece of the end id alone); rows that repeat are pieces of
    their own; pieces of equal size go where the packing meets them first; an empty table
    gives an empty result."""
    import public_tokenizers

    rows = op10_pack.pieces(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return op10_pack.pack(rows)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("mixed", mixed), ("packed", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
