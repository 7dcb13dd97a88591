"""Language identification in two steps: the family first, then the languages
within it, both by one-versus-one linear support vector machines.

A text's features are the shares of its hashed letter bigrams and trigrams (over
bytes; ASCII folded to lower case, other ASCII read as blanks). ``fit`` learns
from a bounded sample: ``PER_FAMILY`` texts of each family, shared by its
languages, distinct texts with the lowest hashes among those whose low 30 bits
pass a share of the language's size; every pair of classes is
trained in a task of its own on at most twice that number of vectors. ``identify``
then reads every whole text once.

Defined results: ``lang_pred`` is ``und`` with score 0 for a null text, a text
without a letter, or when nothing was learned; rows that repeat are rows of
their own; an empty table gives an empty result; a very long text is one row of
counts; columns of the input are passed on unless they have the name of a result
column.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ._common import bounded_batches, mix, slices, text_bytes

DIM = 4096
PER_FAMILY = 1000
ROWS = 256  # texts whose dense vectors a worker holds at once
ROUNDS = 300
PENALTY = 1e-3
UNKNOWN = "und"
OUT = ("lang_pred", "family_pred", "score")

# Families of ISO 639-1 languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi bn mr ne pa gu si ur",
    "semitic": "ar he mt am",
}


def family_of(lang: Column) -> Column:
    pairs = [F.lit(x) for name, langs in FAMILIES.items() for code in langs.split() for x in (code, name)]
    return F.coalesce(F.element_at(F.create_map(*pairs), lang), lang)


_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def vectors(arr: pa.Array) -> np.ndarray:
    """One row of feature shares for every text (zeros where it has no letters)."""
    data, off = text_bytes(arr)
    n = len(off) - 1
    b = _FOLD[data].astype(np.uint32)
    prev, after = np.full(len(b), 0x20, np.uint32), np.full(len(b), 0x20, np.uint32)
    prev[1:], after[:-1] = b[:-1], b[1:]
    edge = off[(off > 0) & (off < len(b))]
    prev[edge], after[edge - 1] = 0x20, 0x20
    at = np.flatnonzero(b != 0x20)
    row = np.searchsorted(off, at, "right") - 1
    two = b[at] << np.uint32(8) | after[at]
    three = two | prev[at] << np.uint32(16) | np.uint32(1 << 24)
    bits = np.uint32(32 - (DIM.bit_length() - 1))
    cell = lambda x: (x * np.uint32(2654435761)) >> bits
    base = row * DIM
    x = np.bincount(base + cell(two), minlength=n * DIM).astype(np.float32)
    x += np.bincount(base + cell(three), minlength=n * DIM)
    x = x.reshape(n, DIM)
    x /= np.maximum(x.sum(1, keepdims=True), 1)
    return x


def train(x: np.ndarray, y: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a linear SVM with squared hinge loss:
    accelerated gradient steps on the scaled features, classes weighed alike."""
    x = np.hstack([x * scale, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    c = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())).astype(np.float32)
    step = 1 / (2 * float((c * (x * x).sum(1)).sum()) + PENALTY)
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(ROUNDS):
        gap = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (PENALTY * v - 2 * x.T @ (c * y * gap))
        v = new + k / (k + 3) * (new - w)
        w = new
    return np.append(w[:-1] * scale, w[-1]).astype(np.float32)


def fit(df: DataFrame, per_family: int = PER_FAMILY) -> dict:
    """Learns from ``df(text, lang)``; rows with a null of either are left out.
    Returns the classes and the weights of each pair (small: DIM floats each)."""
    spark = df.sparkSession
    rows = df.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}")).select("lang", family_of(F.col("lang")).alias("family"), "text", F.xxhash64("text").alias("h"))
    keys = materialize(rows.select("family", "lang", "h").distinct(), "langid-keys")
    # about 3 * per_family hashes of each language go on to be ranked, however many it has
    size = materialize(keys.groupBy("lang").agg(F.count("*").alias("n")), "langid-sizes")
    near = keys.join(size, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.lit(3.0 * per_family * (1 << 30)) / F.col("n"))
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy("family", "lang").orderBy("h"))).where(F.col("k") <= per_family)
    ranked = ranked.withColumn("j", F.row_number().over(Window.partitionBy("family").orderBy("k", "lang"))).where(F.col("j") <= per_family)
    chosen = materialize(ranked.select("lang", "h"), "langid-chosen")
    sample = rows.join(chosen, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])

    def featured(batches):
        for b in slices(batches, "text", 1 << 20, most_rows=ROWS):
            x = vectors(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("family"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "family", "x"])

    sample = materialize(bounded_batches(sample.select("lang", "family", "text")).mapInArrow(featured, "lang string, family string, x binary"), "langid-sample")
    langs = sample.select("family", "lang").distinct().orderBy("family", "lang").collect()  # one row per language
    tree: dict[str, list[str]] = {}
    for r in langs:
        tree.setdefault(r.family, []).append(r.lang)
    levels = [("", list(tree))] + [(f, ls) for f, ls in tree.items()]
    pairs = [(f, a, b) for f, names in levels for i, a in enumerate(names) for b in names[i + 1:]]
    if not pairs:
        return {"tree": tree, "pairs": [], "w": np.zeros((0, DIM + 1), np.float32)}
    of = spark.createDataFrame(pairs, "level string, a string, b string")
    own = sample.select("x", F.explode(F.array(F.struct(F.lit("").alias("level"), F.col("family").alias("name")),
                                               F.struct(F.col("family").alias("level"), F.col("lang").alias("name")))).alias("c")).select("x", "c.*")
    task = own.join(of, "level").where("name = a or name = b").select("level", "a", "b", "x", (F.col("name") == F.col("a")).alias("is_a"))

    def one(key, pdf):
        order = np.argsort(pdf["x"].map(hash_of).to_numpy())  # rows may arrive in any order
        x = np.stack([np.frombuffer(v, np.float32) for v in pdf["x"].iloc[order]])
        y = np.where(pdf["is_a"].to_numpy()[order], 1, -1).astype(np.float32)
        w = train(x, y, 1 / np.sqrt(x.mean(0) + 1e-5))
        return pd.DataFrame({"level": [key[0]], "a": [key[1]], "b": [key[2]], "w": [w.tobytes()]})

    got = {(r.level, r.a, r.b): np.frombuffer(r.w, np.float32) for r in
           task.groupBy("level", "a", "b").applyInPandas(one, "level string, a string, b string, w binary").collect()}
    return {"tree": tree, "pairs": pairs, "w": np.stack([got[p] for p in pairs])}


def hash_of(v: bytes) -> int:
    return int(mix(np.frombuffer(v, np.uint64)).sum(dtype=np.uint64) >> np.uint64(1))


def decide(names: list[str], pairs: list[tuple[int, str, str]], margins: np.ndarray):
    """The class with the most duels won (then the surest) for every row, and the
    mean probability of its duels."""
    n = len(margins)
    if len(names) == 1:
        return np.zeros(n, int), np.ones(n)
    won, sure = np.zeros((n, len(names))), np.zeros((n, len(names)))
    for k, a, b in pairs:
        p = 1 / (1 + np.exp(-np.clip(2.0 * margins[:, k], -30, 30)))
        for name, q in ((a, p), (b, 1 - p)):
            i = names.index(name)
            won[:, i] += q >= 0.5
            sure[:, i] += q / (len(names) - 1)
    best = np.argmax(won + 0.5 * sure, 1)
    return best, sure[np.arange(n), best]


def identify(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Every row of ``df`` with ``lang_pred``, ``family_pred`` and ``score``."""
    kept = [c for c in df.columns if c.lower() not in OUT]
    # The text goes to Python once, inside its row.
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                    F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    out = T.StructType([src.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("family_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    tree, pairs, w = model["tree"], model["pairs"], model["w"]
    families = list(tree)
    duels: dict[str, list] = {}
    for k, (level, a, b) in enumerate(pairs):
        duels.setdefault(level, []).append((k, a, b))

    def run(batches):
        for b in slices(batches, text, 1 << 20, "row", ROWS):
            letters = b.column("letters").to_numpy(zero_copy_only=False)
            lang, fam, score = np.full(len(letters), UNKNOWN, object), np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            if families and letters.any():
                m = vectors(b.column("row").field(text)) @ w[:, :-1].T + w[:, -1]
                first, p = decide(families, duels.get("", []), m)
                for i, f in enumerate(families):
                    mine = np.flatnonzero((first == i) & letters)
                    if len(mine):
                        second, q = decide(tree[f], duels.get(f, []), m[mine])
                        lang[mine], fam[mine] = np.array(tree[f], object)[second], f
                        score[mine] = p[mine] * q
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(lang, pa.string()), pa.array(fam, pa.string()), pa.array(score)], names=out.names)

    got = bounded_batches(src).mapInArrow(run, out)
    return got.select(*[F.col("row")[c].alias(c) for c in kept], *OUT)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_documents(docs: DataFrame) -> dict:
    """Learns from the rows whose key's checksum leaves another remainder than 1."""
    known = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return fit(known.select("text", "lang"))


def op4_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    got = identify(docs.select("doc_id", "text"), fit_documents(docs))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "family_pred")
