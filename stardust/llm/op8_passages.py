"""Substring dedup: paragraphs that repeat, by MinHash banding.

A text is cut into paragraphs where a line ends, and after a sentence of
``SENTENCE`` words or more; shorter sentences stay with what follows them. The
cuts depend on the words before them alone, so a passage copied into the middle
of another text has the same paragraphs there but for its first. Paragraphs of
fewer words are left out. ASCII case and blanks do not count.

Equal paragraphs are one by their fingerprint. Each other one has ``bands`` keys
of ``rows`` MinHash values of its five-word shingles, the fewest bands that find
a pair at the similarity asked for with the recall asked for (``tune``). Those
that share a key are candidates, their exact Jaccard similarity decides, and the
links' components are the clusters. All occurrences in a cluster after the first
(by ``doc_id``, null first, then text hash, then place) are later copies. Runs of
neighbouring later copies of ``RUN_WORDS`` words or more are what goes: half of
a 50-word passage, as its ends may be cut off.

The paragraphs of a bucket of more than ``ALL_PAIRS`` different ones are not paired
there: all paragraphs of such buckets are joined by ``op7_jaccard``'s exact join, whose
prefix filter and signature trees spread them by their shingles. No link is lost to the
size of a bucket.

Defined results: a null or wordless text has no paragraphs; rows of equal id and
text share their result; a very long text is many rows; an empty table gives an
empty result; other columns are left out by ``repeated`` and kept by ``without``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import op7_jaccard
from ._common import Words, bounded_batches, components, mix, slices

SENTENCE = 5
SHINGLE = 5
SIMILAR = 0.8
RECALL = 0.98
MOST_BANDS = 4
RUN_WORDS = 25
ALL_PAIRS = 64
_K = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * _K) | np.uint64(1)


def tune(similar: float = SIMILAR, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """``(bands, rows)``: the most rows a band for which ``most`` bands or fewer
    find a pair of that similarity with that recall."""
    best = None
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similar**rows))
        if bands <= most or best is None:
            best = (bands, rows)
    return best


class Paragraphs:
    """The paragraphs of every text of an Arrow string array: ``doc`` (row),
    ``nth`` (in its text), ``begin`` and ``stop`` (word numbers), ``fp``."""

    def __init__(self, texts: pa.Array, sentence: int = SENTENCE):
        w = self.w = Words(texts, fold_ascii=True)
        n = len(w.start)
        if not n:
            self.doc = self.nth = self.begin = self.stop = np.zeros(0, np.int64)
            self.fp = np.zeros(0, np.uint64)
            return
        line = np.cumsum(w.data == 10)
        last = np.zeros(n, bool)
        last[:-1] = line[w.start[1:]] > line[w.end[:-1] - 1]
        last[w.first[1:][w.first[1:] > 0] - 1] = True
        tail = w.data[w.end - 1]
        ends = np.flatnonzero(last | (tail == 46) | (tail == 33) | (tail == 63))
        cut = ends[last[ends] | (np.diff(ends, prepend=-1) >= sentence)] + 1
        begin = np.concatenate([[0], cut[:-1]])
        long = cut - begin >= sentence
        begin, stop = begin[long], cut[long]
        self.begin, self.stop = begin, stop
        self.doc = np.searchsorted(w.first, begin, "right") - 1
        firsts = np.searchsorted(self.doc, np.arange(len(w.first)))
        self.nth = np.arange(len(begin)) - firsts[self.doc]
        at, place, seg = self._ragged(stop - begin)
        self.fp = np.add.reduceat(mix(w.hash[at] + place.astype(np.uint64) * _K), seg) if len(begin) else np.zeros(0, np.uint64)

    def _ragged(self, size):
        seg = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(seg, size)
        return np.repeat(self.begin, size) + place, place, seg

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the five-word windows, paragraph by paragraph, and where each begins."""
        h = self.w.hash
        acc = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
        for j in range(SHINGLE):
            acc = mix(acc * _K + h[j:len(h) - SHINGLE + 1 + j])
        at, _, seg = self._ragged(self.stop - self.begin - (SHINGLE - 1))
        return acc[at], seg

    def bands(self, bands: int, rows: int) -> np.ndarray:
        """A 32-bit key for every paragraph (rows) and band (columns)."""
        if not len(self.begin):
            return np.zeros((0, bands), np.uint32)
        s, seg = self.shingles()
        keys = []
        for b in range(bands):
            key = np.zeros(len(seg), np.uint64)
            for r in range(rows):
                seed = _SEEDS[b * rows + r]
                key = mix(key * _K + np.minimum.reduceat((s ^ seed) * seed >> np.uint64(16), seg))
            keys.append((key >> np.uint64(32)).astype(np.uint32))
        return np.stack(keys, 1)

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of every paragraph in code points of its text."""
        w = self.w
        points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        base = points[w.off[self.doc]]
        a, b = points[w.start[self.begin]], points[w.end[self.stop - 1]]
        return a - base, b - a


def paragraphs(df: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, th, nth, start, length, words, fp, k0…`` (two band keys to a long)."""
    src = df.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").where("text is not null")
    pairs = -(-bands // 2)
    names = ["doc_id", "th", "nth", "start", "length", "words", "fp", *[f"k{i}" for i in range(pairs)]]

    def run(batches):
        for b in slices(batches, "text"):
            p = Paragraphs(b.column("text"))
            if not len(p.begin):
                continue
            start, length = p.spans()
            key = np.zeros((len(p.begin), 2 * pairs), np.uint32)
            key[:, :bands] = p.bands(bands, rows)
            key = np.ascontiguousarray(key).view(np.int64)
            own = pa.array(p.doc)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(own), b.column("th").take(own), pa.array(p.nth.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)),
                 pa.array((p.stop - p.begin).astype(np.int32)), pa.array(p.fp.astype(np.int64)), *[pa.array(key[:, i]) for i in range(pairs)]], names=names)

    return bounded_batches(src).mapInArrow(run, "doc_id long, th long, nth int, start int, length int, words int, fp long" + "".join(f", k{i} long" for i in range(pairs)))


def colliding(distinct: DataFrame, bands: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of different paragraphs (fingerprints) that share a band's key,
    and the paragraphs ``fp`` whose buckets hold too many to be paired."""
    pairs = -(-bands // 2)

    def keys(batches):
        for b in batches:
            raw = np.ascontiguousarray(np.stack([b.column(f"k{i}").to_numpy() for i in range(pairs)], 1)).view(np.uint32)[:, :bands]
            key = (np.arange(bands, dtype=np.int64) << 32) | raw.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(b.column("fp").to_numpy(), bands))], names=["key", "fp"])

    rows = distinct.select("fp", *[f"k{i}" for i in range(pairs)]).mapInArrow(keys, "key long, fp long")
    # Buckets are counted first (partial sums: a hot one is a row a task). Most have one
    # paragraph, then two: those need no more than this.
    met = materialize(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "passages-buckets")
    two = met.where("n = 2").select("a", "b")
    # The larger buckets' paragraphs are picked once, for both kinds: picking them deals all keys.
    more = rows.join(met.where("n > 2").select("key", "n"), "key")
    more = materialize(more.select("key", "fp", (F.col("n") > ALL_PAIRS).alias("crowd")), "passages-larger")
    some = more.where("not crowd").groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))  # ALL_PAIRS at most
    some = some.select("fps", F.posexplode("fps").alias("i", "b")).where("i > 0").select(F.explode(F.expr("slice(fps, 1, i)")).alias("a"), "b")
    crowded = more.where("crowd").select("fp").distinct()
    return two.unionByName(some).distinct(), crowded


def fetched(df: DataFrame, first: DataFrame, wanted: DataFrame, take, schema: str) -> DataFrame:
    """``take(paragraphs, numbers)`` (Arrow columns) of the paragraphs ``wanted(w)``, each
    read from its first place ``first(fp, x)``."""
    at = first.join(wanted, F.col("fp") == F.col("w"))
    at = at.groupBy(F.col("x.doc_id").alias("d"), F.col("x.th").alias("h")).agg(F.collect_list("x.nth").alias("nths"))
    src = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").where("text is not null")
    src = src.join(at.hint("merge"), (F.col("th") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("text", "nths")
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches):
        for b in slices(batches, "text"):
            p = Paragraphs(b.column("text"))
            if not len(p.begin):
                continue
            first = np.searchsorted(p.doc, np.arange(b.num_rows))
            own = [first[i] + n for i, x in enumerate(b.column("nths").to_pylist()) for n in x]
            yield pa.RecordBatch.from_arrays([pa.array(p.fp[own].astype(np.int64)), take(p, own)], names=names)

    return bounded_batches(src).mapInArrow(run, schema).dropDuplicates([names[0]])


def similar(df: DataFrame, first: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose exact Jaccard similarity is ``least`` or more."""
    def sets(p, own):
        s, seg = p.shingles()
        seg = np.append(seg, len(s))
        return pa.array([np.unique(s[seg[i]:seg[i + 1]]).tobytes() for i in own], pa.binary())

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct()
    held = materialize(fetched(df, first, wanted, sets, "fp long, s binary"), "passages-sets")
    both = pairs.join(held.select(F.col("fp").alias("a"), F.col("s").alias("sa")), "a").join(held.select(F.col("fp").alias("b"), F.col("s").alias("sb")), "b")

    def compared(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(shared >= least * (len(x) + len(y) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in (b.column("a"), b.column("b"))], names=["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(compared, "a long, b long")


def crowded_links(df: DataFrame, first: DataFrame, crowded: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` among the paragraphs ``crowded(fp)`` that connect all whose exact
    similarity is ``least`` or more."""
    def texts(p, own):
        w = p.w
        return pa.array([w.data[w.start[p.begin[i]]:w.end[p.stop[i] - 1]].tobytes().decode() for i in own])

    rows = materialize(fetched(df, first, crowded.withColumnRenamed("fp", "w"), texts, "doc_id long, text string"), "passages-crowded")
    every, classes, links = op7_jaccard.jaccard_links(rows, SHINGLE, math.ceil(100 * least))
    of = classes.select("cid", "doc")
    same = every.join(classes, ["f1", "f2"]).select(F.col("doc").alias("a"), every["doc_id"].alias("b"))
    near = links.join(of.select(F.col("cid").alias("a"), F.col("doc").alias("da")), "a").join(of.select(F.col("cid").alias("b"), F.col("doc").alias("db")), "b")
    return same.unionByName(near.select(F.col("da").alias("a"), F.col("db").alias("b"))).where("a <> b")


def repeated(df: DataFrame, least: float = SIMILAR, recall: float = RECALL, run_words: int = RUN_WORDS) -> DataFrame:
    """The later copies in ``df(doc_id, text)``, a row per run: ``doc_id, th``
    (``xxhash64`` of the text), ``start, length`` (code points), ``words,
    paragraphs, cluster`` and ``first_doc_id`` (of the first paragraph's cluster)."""
    bands, rows = tune(least, recall)
    every = materialize(paragraphs(df, bands, rows), "passages-paragraphs")
    keys = [c for c in every.columns if c[0] == "k"]
    distinct = materialize(every.groupBy("fp").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "nth")).alias("x"), *[F.first(c).alias(c) for c in keys]), "passages-distinct")
    pairs, crowded = (materialize(x, "passages-pairs") for x in colliding(distinct, bands))
    first = distinct.select("fp", "x")
    links = similar(df, first, pairs, least)
    if not crowded.isEmpty():
        links = links.unionByName(crowded_links(df, first, crowded, least))
    links = materialize(links, "passages-links")
    near = components(links)
    known = distinct.where("n > 1").select(F.col("fp").alias("id")).join(near, "id", "full_outer")
    known = materialize(known.select(F.col("id").alias("of"), F.coalesce("component", "id").alias("cluster")), "passages-clusters")
    hit = every.drop(*keys).join(known, F.col("fp") == F.col("of")).drop("of", "fp").dropDuplicates(["doc_id", "th", "nth"])
    hit = materialize(hit, "passages-hits")
    place = F.struct("doc_id", "th", "nth")
    first = hit.groupBy("cluster").agg(F.min(place).alias("first")).withColumnRenamed("cluster", "c")
    later = hit.join(first, F.col("cluster") == F.col("c")).where(place != F.col("first"))
    w = Window.partitionBy("doc_id", "th").orderBy("nth")
    later = later.withColumn("run", F.col("nth") - F.row_number().over(w))
    runs = later.groupBy("doc_id", "th", "run").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("stop"), F.sum("words").alias("words"), F.count("*").alias("paragraphs"),
        F.min_by(F.struct("cluster", F.col("first.doc_id").alias("d")), "nth").alias("x"))
    return runs.where(F.col("words") >= run_words).select(
        "doc_id", "th", F.col("start").cast("long"), (F.col("stop") - F.col("start")).cast("long").alias("length"), F.col("words").cast("long"), "paragraphs",
        F.col("x.cluster").alias("cluster"), F.col("x.d").alias("first_doc_id"))


def without(df: DataFrame, runs: DataFrame) -> DataFrame:
    """``df`` with the runs taken out of its texts."""
    cut = runs.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("h")).agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    text, spans = df["text"], cut["spans"]
    j = df.join(cut.hint("merge"), F.xxhash64(text).eqNullSafe(cut["h"]) & df["doc_id"].cast("long").eqNullSafe(cut["d"]), "left")
    start = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))
    kept = F.aggregate(spans, start, lambda a, s: F.struct(
        F.concat(a["kept"], F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))).alias("kept"), (s["start"] + s["length"]).alias("at")))
    rest = F.concat(kept["kept"], F.substr(text, (kept["at"] + 1).cast("int")))
    return j.select(*[F.when(spans.isNull(), text).otherwise(rest).alias(c) if c == "text" else df[c] for c in df.columns])


def op8_passages(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeated(docs).drop("th")
