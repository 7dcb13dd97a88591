"""Quality rule: distribution divergence against language references.

Every document has a histogram of character classes and one of its language's
commonest words. The reference of a language is the sum of the histograms of
all its documents. A document is dropped when the Jensen-Shannon distance (base
2, 0 to 1) of one of its histograms to its language's reference is above that
histogram's limit; the test of a histogram is skipped when the document, or the
reference, is too short for it.

The text is read twice, with DataFrame functions only: once for a frequent-item
sketch of each language's words, once for the row's counts. The counts are
written without the texts; references and distances come from them.

Defined results: a null text has no words and counts as the empty text; rows
whose language is null share a reference; rows that repeat are rows of their
own; an empty table gives an empty result; columns of the input but ``text``
are passed on unless they have the name of a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._common import GAP, WORD

SKETCH = 32            # candidate words of a language
COMMON = 24            # words of a language's histogram
SKETCH_ITEMS = 10_000  # items that the sketch of a language tracks
MIN_WORDS = 50         # shorter documents skip the word test
MIN_CHARS = 200        # and the character test
MIN_REFERENCE_WORDS = 2_000
MAX_WORD_DISTANCE = 0.42
MAX_CHAR_DISTANCE = 0.32
WINDOW = 5
# Peeled off the text one after another; what is left is the last class.
CLASSES = (("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("other_lower", r"\p{Ll}+"), ("other_letter", r"\p{L}+"),
           ("sentence", r"[.,;:!?'\"()\-]+"), ("digit", r"\p{N}+"))
OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(hashes: Column, k: int = WINDOW) -> Column:
    """Number of words that lie in a ``k``-word window found twice or more.
    ``hashes``: the words' 64-bit hashes, in order."""
    def covered(windows: Column) -> Column:
        by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(by_hash, lambda s: F.filter(F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        gaps = let(F.array_sort(again), lambda p: F.transform(p, lambda x, j: F.when(j == 0, k).otherwise(F.least(F.lit(k), x - F.get(p, j - 1)))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    return F.when(F.size(hashes) < k + 1, F.lit(0)).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))).cast("long")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def candidates(df: DataFrame) -> DataFrame:
    """Per language the hashes of its commonest words, by a frequent-item sketch."""
    w = df.select("lang", F.explode(words_of(F.col("text"))).alias("w"))
    top = w.groupBy("lang").agg(F.expr(f"approx_top_k(w, {SKETCH}, {SKETCH_ITEMS})").alias("top"))
    return top.select(F.col("lang").alias("of"), F.array_sort(F.transform("top", lambda x: F.xxhash64(x["item"]))).alias("common"))


def counts(df: DataFrame, common: DataFrame) -> DataFrame:
    """The row-local counts of every document, without its text."""
    kept = [c for c in df.columns if c.lower() not in OUT and c != "text"]
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("lang"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.join(common, F.col("lang").eqNullSafe(F.col("of")), "left")
    d = d.select("row", "lang", "text", "common", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"),
                 F.regexp_replace("text", GAP, "").alias("rest"))
    d = d.withColumn("n_symbols", F.regexp_count("rest", F.lit(r"[#*$%&|<>]"))).withColumn("word_chars", F.length("rest"))
    sizes = []
    for i, (name, pattern) in enumerate(CLASSES):
        d = d.withColumn("left", F.regexp_replace("rest", pattern, ""))
        d = d.withColumn(f"c{i}", F.length("rest") - F.length("left")).drop("rest").withColumnRenamed("left", "rest")
        sizes.append(f"c{i}")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    hist = let(F.filter("h", lambda x: F.array_contains(F.col("common"), x)), lambda own: F.transform(
        F.col("common"), lambda c: F.size(F.filter(own, lambda x: x == c)).cast("long")))
    return d.select(
        "row", "lang", F.size("h").cast("long").alias("n_words"), F.col("word_chars").cast("long"), F.col("n_symbols").cast("long"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("h")).alias("n_repeat_words"),
        F.array(*[F.col(c).cast("long") for c in sizes], F.length("rest").cast("long")).alias("chars"),
        F.when(F.col("common").isNull(), F.array().cast("array<long>")).otherwise(hist).alias("words"))


def references(c: DataFrame) -> DataFrame:
    """Per language the summed histograms: ``ref_chars``, the positions ``pick``
    of its ``COMMON`` commonest candidate words and their counts ``ref_words``."""
    n = len(CLASSES) + 1
    s = c.groupBy("lang").agg(F.sum("n_words").alias("ref_n"), F.array(*[F.sum(F.col("chars")[i]) for i in range(n)]).alias("ref_chars"),
                              F.array(*[F.coalesce(F.sum(F.get("words", F.lit(i))), F.lit(0)) for i in range(SKETCH)]).alias("sums"))
    order = F.array_sort(F.transform("sums", lambda x, i: F.struct((-x).alias("n"), i.alias("i"))))
    s = s.withColumn("order", F.slice(order, 1, COMMON))
    pick, seen = F.transform("order", lambda x: x["i"]), F.transform("order", lambda x: -x["n"])
    return s.select(F.col("lang").alias("of"), "ref_n", "ref_chars", pick.alias("pick"), with_rest(seen, F.col("ref_n")).alias("ref_words"))


def with_rest(hist: Column, total: Column) -> Column:
    """The histogram with what else there is as its last entry."""
    return let(hist, lambda h: F.concat(h, F.array(total - F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + x))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms (counts)."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    both = F.arrays_zip(let(p, lambda h: F.transform(h, lambda x: x / total(h))).alias("p"), let(q, lambda h: F.transform(h, lambda x: x / total(h))).alias("q"))
    gap = F.aggregate(both, F.lit(0.0), lambda a, x: a + part(x["p"], x["q"]) / 2 + part(x["q"], x["p"]) / 2)
    return F.sqrt(F.greatest(gap, F.lit(0.0)))


def diverging(df: DataFrame, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Every row of ``df`` (with ``text`` and ``lang``) without its text, with the
    base counts, both distances (null where skipped) and ``kept``."""
    kept = [c for c in df.columns if c.lower() not in OUT and c != "text"]
    c = materialize(counts(df, materialize(candidates(df), "divergence-words")), "divergence-counts")
    ref = materialize(references(c), "divergence-references")
    j = c.join(ref, F.col("lang").eqNullSafe(F.col("of")), "left")
    enough = F.col("ref_n") >= MIN_REFERENCE_WORDS
    own = with_rest(F.transform("pick", lambda i: F.get("words", i)), F.col("n_words"))
    j = j.withColumn("char_distance", F.when(enough & (F.col("word_chars") >= MIN_CHARS), distance(F.col("chars"), F.col("ref_chars"))))
    j = j.withColumn("word_distance", F.when(enough & (F.col("n_words") >= MIN_WORDS), distance(own, F.col("ref_words"))))
    j = j.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    ok = F.coalesce(F.col("char_distance") <= max_char, F.lit(True)) & F.coalesce(F.col("word_distance") <= max_word, F.lit(True))
    j = j.withColumn("kept", ~F.col("base_failed") & ok)
    return j.select(*[F.col("row")[x].alias(x) for x in kept], *OUT)


def op1_divergence(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return diverging(docs.select("doc_id", "lang", "text")).select("doc_id", *OUT)
