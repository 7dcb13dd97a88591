"""Collocations by stripes: every prefix keys a counter of what comes after it.

Texts (ASCII capitals folded) are cut into pieces at stops and line ends, pieces
into words. A phrase is 64 bits: a word's hash with its language; of more words the
hash of (all but the last, all but the first). The stripe of a prefix of ``k`` words
maps each phrase that is the prefix moved on by a word to how often it follows. A
task adds its stripes up as it reads; equal prefixes meet by a shuffle and their
stripes are added elementwise. One structure tells all: its elements are the counts
of the phrases of ``k + 1`` words, its total is the count of the prefix, and its
maximum tells whether a longer phrase occurs as often as the prefix does.

Level by level, only prefixes that occur ``LEAST`` times or more have stripes, and
only such continuations are elements (all others are in the total): a phrase is
never more frequent than its parts, so nothing is lost. The workers know the
frequent phrases of a level by a bitmap of at most ``MOST_BITS`` bits; what passes by
chance falls to the exact counts later. The stripes of prefixes that make up more
than one in ``HOT`` words of the corpus are kept in ``PARTS`` parts, by what follows.

Results: ``score`` of a phrase with count ``a`` cut into parts with counts ``l`` and
``r`` among ``n`` words is ``floor(1000 * a * n / (l * r))``, of the cut with the lowest
(the first of equal ones), exact in 38 digits. A phrase is subsumed when one of one
word more around it is as frequent; a longer one that is implies a chain of those.

Defined results: a null text has no words; a null language is ``und``; rows that
repeat count again; a very long text is words like any others; equal scores are
ordered by count, then by the phrase's bytes; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ._common import Words, bounded_batches, mix, slices, text_bytes

LEAST = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"
MOST_BITS = 1 << 27
HOT = 4096
PARTS = 64
HELD = 600_000   # stripe elements that a worker adds up before it passes them on
SLICE = 2 << 20
_K = np.uint64(0x9E3779B97F4A7C15)
_GAP, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_STOP[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Pieces(Words):
    """The words of every text, ASCII capitals folded: ``start``, ``end``, ``first`` and
    ``hash`` as in ``Words``, and ``left`` (the words of the piece from each on)."""

    def __init__(self, arr: pa.Array):
        data, off = text_bytes(arr)
        fold = np.arange(256, dtype=np.uint8)
        fold[65:91] += 32
        self.data, self.off = fold[data], off
        stop = _STOP[data]
        inside = ~(_GAP[data] | stop)
        edge = np.zeros(len(data) + 1, bool)  # a text begins here
        edge[off] = True
        begin, last = inside.copy(), inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, off)
        self.hash = self._hash(inside, begin)
        n = len(self.start)
        stops = np.cumsum(stop)
        close = np.ones(n, bool)  # the last word of its piece
        if n:
            close[:-1] = stops[self.start[1:]] > stops[self.end[:-1] - 1]
            close[self.first[1:][self.first[1:] > 0] - 1] = True
        at = np.flatnonzero(close)
        self.left = at[np.searchsorted(at, np.arange(n))] - np.arange(n) + 1 if n else np.zeros(0, np.int64)

    def text_of(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode()


def phrase(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of the phrase whose all but last words are ``a``, all but first ``b``."""
    return mix(a * _K + b)


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def _levels(b: pa.RecordBatch, k: int):
    """Of a batch ``(lang, text)``: its pieces, the row of each word and the hashes of
    the phrases of ``k`` words from each word on (of no meaning where too few are left)."""
    p = Pieces(b.column("text"))
    row = np.repeat(np.arange(b.num_rows), np.diff(p.first))
    coded = b.column("lang").dictionary_encode()
    own = _seeds(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    h = mix(p.hash ^ mix(own[row])) if len(row) else p.hash
    for _ in range(k - 1):
        h = np.append(phrase(h[:-1], h[1:]), h[-1:])
    return p, row, h


def words(src: DataFrame) -> DataFrame:
    """``lang, h, phrase, f``: every word of ``src(lang, text)``."""
    names = ["lang", "h", "phrase", "f"]

    def run(batches):
        held: dict = {}

        def out():
            lang, h, text, f = zip(*[(*k, *v) for k, v in held.items()])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(h, pa.int64()), pa.array(text), pa.array(f, pa.int64())], names=names)

        for b in slices(batches, "text", SLICE):
            p, row, h = _levels(b, 1)
            langs = b.column("lang").to_pylist()
            own, at, n = np.unique(h, return_index=True, return_counts=True)
            for x, i, c in zip(own.view(np.int64).tolist(), at.tolist(), n.tolist()):
                key = (langs[row[i]], x)
                had = held.get(key)
                held[key] = (had[0], had[1] + c) if had else (p.text_of(i), c)
            if len(held) > HELD // 4:
                yield out()
        if held:
            yield out()

    got = bounded_batches(src).mapInArrow(run, "lang string, h long, phrase string, f long")
    return got.groupBy("lang", "h", "phrase").agg(F.sum("f").alias("f"))


def bitmap(level: DataFrame) -> np.ndarray:
    """The phrases ``h`` of a level as bits: about 16 a phrase, ``MOST_BITS`` at most."""
    n = level.count()
    bits = min(MOST_BITS, 1 << max(10, (16 * n - 1).bit_length()))
    at = F.col("h").bitwiseAND(F.lit(bits - 1).cast("long"))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    cells = level.groupBy(F.shiftright(at, 6).alias("cell")).agg(F.bit_or(flag).alias("w")).collect()  # bits / 64 rows at most
    out = np.zeros(bits >> 6, np.int64)
    out[[r.cell for r in cells]] = [r.w for r in cells]
    return out.view(np.uint64)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _added(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of equal keys as one, in order of the keys, with their ``n`` added up."""
    if not len(n):
        return keys, n
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.zeros(len(n), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(n[order], at)


def _binary(x: np.ndarray, at: np.ndarray) -> pa.Array:
    """The parts ``x[at[i]:at[i + 1]]`` as binary values."""
    x = np.ascontiguousarray(x)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer((at * x.itemsize).astype(np.int64)), pa.py_buffer(x)]).cast(pa.binary())


STRIPE = "prefix long, part int, rest long, next binary, n binary"


def partial_stripes(src: DataFrame, k: int, bits: np.ndarray, hot: np.ndarray) -> DataFrame:
    """The tasks' stripes of prefixes of ``k`` words: ``next`` and ``n`` are arrays
    (64 bits an element), ``rest`` counts what ends a piece or goes on unfrequently."""
    def run(batches):
        prefix, after, n = [], [], []  # an element 0 is the rest

        def out(final: bool):
            if not prefix:
                return
            keys, count = _added([np.concatenate(prefix), np.concatenate(after)], np.concatenate(n))
            if not final and len(count) < HELD // 2:
                prefix[:], after[:], n[:] = [keys[0]], [keys[1]], [count]
                return
            prefix.clear(), after.clear(), n.clear()
            part = np.where(np.isin(keys[0], hot), (keys[1] >> np.uint64(20)) % np.uint64(PARTS), 0).astype(np.int32)
            order = np.lexsort((part, keys[0]))
            p, a, part, count = keys[0][order], keys[1][order], part[order], count[order]
            at = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (part[1:] != part[:-1])))
            rest = np.add.reduceat(np.where(a == 0, count, 0), at)
            real = a != 0
            cut = np.append(np.cumsum(real) - real, real.sum())[np.append(at, len(p))]
            for i in range(0, len(at), 100_000):
                to = min(i + 100_000, len(at))
                yield pa.RecordBatch.from_arrays([pa.array(p[at[i:to]].view(np.int64)), pa.array(part[at[i:to]]), pa.array(rest[i:to]),
                                                  _binary(a[real][cut[i]:cut[to]], cut[i:to + 1] - cut[i]), _binary(count[real][cut[i]:cut[to]], cut[i:to + 1] - cut[i])],
                                                 names=["prefix", "part", "rest", "next", "n"])

        for b in slices(batches, "text", SLICE):
            p, _, h = _levels(b, k)
            known = (p.left >= k) & _has(bits, h)
            at = np.flatnonzero(known)
            if not len(at):
                continue
            more = p.left[at] > k
            more[more] = known[at[more] + 1]
            a = np.where(more, h[np.minimum(at + 1, len(h) - 1)], np.uint64(0))
            keys, count = _added([h[at], a], np.ones(len(at), np.int64))
            prefix.append(keys[0])
            after.append(keys[1])
            n.append(count)
            if sum(map(len, n)) > HELD:
                yield from out(False)
        yield from out(True)

    return bounded_batches(src).mapInArrow(run, STRIPE)


def merged_stripes(partial: DataFrame, least: int) -> DataFrame:
    """Stripes added elementwise: ``prefix, part, total, most`` and the elements of
    ``least`` or more as ``found`` (``next``, the whole phrase ``h`` and its count ``f``)."""
    kind = pa.list_(pa.struct([("next", pa.int64()), ("h", pa.int64()), ("f", pa.int64())]))

    def run(batches):
        held = None  # the stripe that the next batch may go on with: prefix, part, rest, next, n

        def done(p, part, rest, a, n, size):
            """Stripes of whole rows, sorted by (prefix, part); ``size`` elements each."""
            new = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (part[1:] != part[:-1])))
            group = np.cumsum(np.append(True, (p[1:] != p[:-1]) | (part[1:] != part[:-1]))) - 1
            keys, count = _added([np.repeat(group, size), a], n)
            cut = np.searchsorted(keys[0], np.arange(len(new) + 1))
            return p[new], part[new], np.add.reduceat(rest, new), keys[1], count, cut

        def emit(p, part, rest, a, count, cut):
            own = np.repeat(np.arange(len(p)), np.diff(cut))
            total = rest + np.bincount(own, count, len(p)).astype(np.int64)
            most = np.zeros(len(p), np.int64)
            np.maximum.at(most, own, count)
            ok = count >= least
            f = pa.StructArray.from_arrays([pa.array(a[ok].view(np.int64)), pa.array(phrase(p[own[ok]].view(np.uint64), a[ok]).view(np.int64)), pa.array(count[ok])], names=["next", "h", "f"])
            at = np.append(0, np.cumsum(ok))[cut].astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(p), pa.array(part), pa.array(total), pa.array(most), pa.ListArray.from_arrays(pa.array(at), f).cast(kind)],
                                              names=["prefix", "part", "total", "most", "found"])

        for b in batches:
            if not b.num_rows:
                continue
            p, part, rest = (b.column(c).to_numpy() for c in ("prefix", "part", "rest"))
            size = pc.binary_length(b.column("next")).to_numpy().astype(np.int64) // 8
            a = text_bytes_of(b.column("next")).view(np.uint64)
            n = text_bytes_of(b.column("n")).view(np.int64)
            if held is not None:
                p, part, rest = np.append(held[0], p), np.append(held[1], part).astype(np.int32), np.append(held[2], rest)
                a, n, size = np.append(held[3], a), np.append(held[4], n), np.append(len(held[3]), size)
            p, part, rest, a, count, cut = done(p, part, rest, a, n, size)
            held = (p[-1:], part[-1:], rest[-1:], a[cut[-2]:], count[cut[-2]:])
            if len(p) > 1:
                yield emit(p[:-1], part[:-1], rest[:-1], a[:cut[-2]], count[:cut[-2]], cut[:-1])
        if held is not None:
            yield emit(*held, np.array([0, len(held[3])]))

    rows = partial.repartition("prefix", "part").sortWithinPartitions("prefix", "part")
    return bounded_batches(rows).mapInArrow(run, "prefix long, part int, total long, most long, found array<struct<next: long, h: long, f: long>>")


def text_bytes_of(arr: pa.Array) -> np.ndarray:
    """The bytes of a binary array end to end, as an array of their own."""
    off = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    return np.frombuffer(raw, np.uint8)[off[0]:off[-1]].copy() if raw is not None else np.zeros(0, np.uint8)


def phrases(df: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Of ``df(text, lang)``: for each length from 1 on the frequent phrases (``lang, h,
    phrase, last, f, ls, rs``: the counts of their first 1, 2, … words and of what is
    left after these), for each the merged stripes they are the prefixes of, and ``n``
    by language."""
    src = df.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = materialize(words(src), "phrases-words")
    n = every.groupBy("lang").agg(F.sum("f").alias("n"))
    total = every.agg(F.sum("f")).first()[0] or 0
    none = F.array().cast("array<long>")
    level = materialize(every.where(F.col("f") >= least).select("lang", "h", "phrase", F.col("phrase").alias("last"), "f", none.alias("ls"), none.alias("rs")), "phrases-1")
    levels, stripes = [level], []
    for k in range(1, longest):
        if level.isEmpty():
            break
        hot = [r.h for r in level.where(F.col("f") > total / HOT).select("h").collect()]  # fewer than HOT rows
        part = partial_stripes(src, k, bitmap(level), np.array(hot, np.int64).view(np.uint64))
        s = materialize(merged_stripes(part, least), f"phrases-stripes{k}")
        got = s.select("prefix", F.explode("found").alias("e")).select("prefix", "e.*")
        a = level.select(F.col("h").alias("prefix"), "lang", F.col("phrase").alias("ahead"), F.col("f").alias("l"), "ls")
        b = level.select(F.col("h").alias("next"), "last", F.col("f").alias("r"), "rs")
        level = materialize(got.join(a, "prefix").join(b, "next").select(
            "lang", "h", F.concat_ws(" ", "ahead", "last").alias("phrase"), "last", "f", F.concat("ls", F.array("l")).alias("ls"), F.concat(F.array("r"), "rs").alias("rs"), "next"), f"phrases-{k + 1}")
        levels.append(level)
        stripes.append(s)
    return levels, stripes, n


def collocations(df: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """The candidates of ``df(text, lang)`` that no longer one subsumes: ``lang, phrase, a,
    l, r, n, score``."""
    levels, stripes, n = phrases(df, least, longest)
    found = []
    for k, own in enumerate(levels[1:], 2):
        own = own.select("lang", "h", "phrase", F.col("f").alias("a"), "ls", "rs")
        if k <= len(stripes):
            right = stripes[k - 1].groupBy("prefix").agg(F.max("most").alias("most")).withColumnRenamed("prefix", "h")
            left = levels[k].groupBy(F.col("next").alias("h")).agg(F.max("f").alias("most"))
            more = right.unionByName(left).where(F.col("most") >= least).groupBy("h").agg(F.max("most").alias("most"))
            own = own.join(more, "h", "left").where(F.coalesce(F.col("most") < F.col("a"), F.lit(True))).drop("most")
        found.append(own.drop("h"))
    if not found:
        spark = df.sparkSession
        return spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return scored(every.join(n, "lang"))


def scored(found: DataFrame) -> DataFrame:
    """Phrases ``lang, phrase, a, n, ls, rs`` with the lowest score of their cuts."""
    big = lambda c: c.cast("decimal(38,0)")

    def cut(x, i):
        score = F.call_function("div", big(F.lit(1000)) * F.col("a") * F.col("n"), big(x["ls"]) * x["rs"])
        return F.struct(score.cast("long").alias("score"), i.alias("k"), x["ls"].alias("l"), x["rs"].alias("r"))

    best = found.select("lang", "phrase", "a", "n", F.array_min(F.transform(F.arrays_zip("ls", "rs"), cut)).alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of every language: first of 64 parts of it, then of those."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    got = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return got.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return ranked(collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
c AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, g, count(*) AS a FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g FROM w, range(1, 6) t(m) WHERE len(w) >= m)
  GROUP BY lang, g HAVING count(*) >= 100),
cuts AS (
  SELECT g.lang, g.g, g.a, k, x.a AS l, y.a AS r, c.n, CAST((1000::HUGEINT * g.a * c.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM g JOIN c USING (lang), range(1, 5) t(k), g x, g y
  WHERE k < len(g.g) AND x.lang = g.lang AND x.g = g.g[1:k] AND y.lang = g.lang AND y.g = g.g[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, unnest(list_transform(range(1, len(g) - m + 2), lambda i: g[i:i + m - 1])) AS g, a FROM g, range(2, 5) t(m) WHERE m < len(g)),
cover AS (SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY lang, g)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM (SELECT best.lang, array_to_string(best.g, ' ') AS phrase, best.a, l, r, n, score FROM best LEFT JOIN cover USING (lang, g) WHERE coalesce(most, 0) < best.a)
QUALIFY rank <= 2000
"""
