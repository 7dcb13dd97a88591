"""N-gram Jaccard join with signature trees, and the components of its links.

A document's set is its distinct ``k``-word shingles (64-bit hashes); rows of
equal sets are one class. Classes meet where they share a shingle of their
prefixes: of two sets with a Jaccard similarity of ``percent`` or more, the
``n - ceil(percent * n) + 1`` smallest shingles of each share one, in any one
order of all shingles. The classes at a shingle are a block; equal blocks are
one. In every block a signature tree (nodes hold the OR of their sets' token
bitmaps and the range of their sizes) is joined with itself: a pair of nodes goes
no further when the most that two of their sets could share is too little. What
is left are candidates; only enough of them to connect the block are put out.

The whole sets of candidates that hang together then meet in groups, cut into
chunks of ``CHUNK`` sets, and a second tree join there compares the sets
themselves, but for pairs that are connected already. Groups of more than one
chunk share pivots first; what that leaves apart is compared chunk by chunk.

Very common shingles (the heaviest ``HOT_MOST``, found by counting) come last in
the order of shingles. A set that has too few others keeps them in its prefix and
meets everything there; so the choice of common shingles changes no result.

Defined results: a null or wordless text has an empty set, linked with nothing; a
null id is never the smallest; rows that repeat are linked; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ._common import Words, bounded_batches, components, mix, slices

PERCENT = 90
CHUNK = 4096     # sets of a chunk of a group
PIVOTS = 64      # sets of a large group that meet all its chunks
BUCKET = 2048    # classes of a block
HOT_AT = 256     # classes that make a shingle common
HOT_MOST = 100_000
SPARE = 16
LEAF = 16
K1, K2 = np.uint64(0xA5A5F00D12345678), np.uint64(0x5BD1E995CAFEBABE)


def needed(a, b, percent: int = PERCENT):
    """The least overlap of two sets of these sizes that are similar enough."""
    return -((-percent * (a + b)) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -((-percent * n) // 100) + 1


def signature(s: np.ndarray, width: int) -> np.ndarray:
    """A bitmap of a set (64-bit words, a power of two of bits), of ``width`` bits a
    shingle or more."""
    bits = 1 << max(6, int(max(1, len(s) * width) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[s & np.uint64(bits - 1)] = True
    return np.packbits(flags).view(np.uint64)


def fold(b: np.ndarray, words: int) -> np.ndarray:
    """The bitmap at a smaller width (as if it had been made at that width)."""
    return np.bitwise_or.reduce(b.reshape(-1, words), 0) if len(b) > words else b


class Tree:
    """Nodes over sets in order of size: leaves of ``LEAF`` sets, inner nodes of as
    many nodes. A node has the OR of its sets' bitmaps, the range of their sizes and
    the most shingles of a set that share a bit with others of it."""

    def __init__(self, sizes, bits):
        self.order = np.lexsort((np.arange(len(sizes)), sizes))
        self.n = np.asarray(sizes, np.int64)[self.order]
        words = min(len(b) for b in bits)
        own = np.stack([fold(bits[i], words) for i in self.order])
        extra = self.n - np.bitwise_count(own).sum(1).astype(np.int64)
        self.levels = [(own, self.n, self.n, extra, np.arange(len(self.n)), np.arange(len(self.n)) + 1)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, ex, s, e = self.levels[-1]
            at = np.arange(0, len(lo), LEAF)
            self.levels.append((np.bitwise_or.reduceat(b, at, 0), lo[at], np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at), s[at], np.append(s[at][1:], e[-1])))

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether sets of nodes ``i`` and ``j`` (arrays) could be similar enough."""
        b, lo, hi, ex, _, _ = self.levels[level]
        fits = (100 * lo[j] <= 100 * 100 * hi[i] // percent) & (100 * lo[i] <= 100 * 100 * hi[j] // percent)
        most = np.bitwise_count(b[i] & b[j]).sum(1).astype(np.int64) + np.minimum(ex[i], ex[j])
        return fits & (most >= needed(lo[i], lo[j], percent))


def link(tree: Tree, percent: int, labels=None, verify=None, wanted=None) -> list[tuple[int, int]]:
    """A forest of links among the sets of a tree that ``labels`` does not connect
    yet: of pairs that pass the bounds and ``verify(i, j)``. ``wanted(i, j)``
    (arrays) leaves pairs out."""
    n = len(tree.n)
    root = np.arange(n) if labels is None else np.unique(np.asarray(labels)[tree.order], return_inverse=True)[1].astype(np.int64)
    out: list[tuple[int, int]] = []

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            if root[x] != root[y] and (verify is None or verify(int(tree.order[x]), int(tree.order[y]))):
                root[root == root[y]] = root[x]
                out.append((int(tree.order[x]), int(tree.order[y])))

    top = len(tree.levels) - 1
    stack = [(top, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        _, _, _, _, s, e = tree.levels[level]
        own = root[s[a]]
        if (root[s[a]:e[a]] == own).all() and (root[s[b]:e[b]] == own).all():
            continue
        if level == 0:
            continue
        width = len(tree.levels[level - 1][1])
        i, j = np.arange(a * LEAF, min(width, (a + 1) * LEAF)), np.arange(b * LEAF, min(width, (b + 1) * LEAF))
        x, y = (v.ravel() for v in np.meshgrid(i, j, indexing="ij"))
        if a == b:
            up = x < y if level == 1 else x <= y
            x, y = x[up], y[up]
        ok = tree.possible(level - 1, x, y, percent)
        x, y = x[ok], y[ok]
        if level == 1:
            apart = root[x] != root[y]
            if wanted is not None:
                apart &= wanted(tree.order[x], tree.order[y])
            join(x[apart], y[apart])
        else:  # nodes with themselves come off the stack first
            far = np.argsort(-(y - x), kind="stable")
            stack.extend((level - 1, int(p), int(q)) for p, q in zip(x[far], y[far]))
    return out


def parts(sizes: np.ndarray, widths: np.ndarray, percent: int):
    """Which sets go to one tree: those of one bitmap width, and, for each next
    width, those of both whose sizes are near enough to the other's. So no bitmap
    is folded to less than half."""
    each = [np.flatnonzero(widths == w) for w in np.unique(widths)]
    yield from each
    for a, b in zip(each, each[1:]):
        low = a[100 * sizes[a] >= percent * sizes[b].min()]
        high = b[percent * sizes[b] <= 100 * sizes[a].max()]
        if len(low) and len(high):
            yield np.concatenate([low, high])


def forest(bits: list[np.ndarray], sizes, percent: int, labels=None, verify=None, wanted=None) -> list[tuple[int, int]]:
    """``link`` over all sets of a block or group, tree by tree."""
    sizes, out = np.asarray(sizes, np.int64), []
    label = np.arange(len(sizes)) if labels is None else np.unique(np.asarray(labels), return_inverse=True)[1]
    for at in parts(sizes, np.array([len(b) for b in bits]), percent):
        if len(at) < 2 or (label[at] == label[at[0]]).all():
            continue
        tree = Tree(sizes[at], [bits[i] for i in at])
        check = None if verify is None else lambda i, j, at=at: verify(int(at[i]), int(at[j]))
        want = None if wanted is None else lambda x, y, at=at: wanted(at[x], at[y])
        for i, j in link(tree, percent, label[at], check, want):
            out.append((int(at[i]), int(at[j])))
            label[label == label[at[j]]] = label[at[i]]
    return out


def sets_of(texts: pa.Array, k: int):
    """The sorted distinct shingles of every text."""
    sh, first = Words(texts, fold_ascii=True).shingles(k)
    return [np.unique(sh[first[i]:first[i + 1]]) for i in range(len(first) - 1)]


def summarise(df: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, th`` and of every row's set the size, a fingerprint, the smallest
    shingles and a bitmap."""
    src = df.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    names = ["doc_id", "th", "n", "f1", "f2", "low", "bits"]

    def run(batches):
        for b in slices(batches, "text"):
            n, f1, f2, low, bits = [], [], [], [], []
            for s in sets_of(b.column("text"), k):
                n.append(len(s))
                f1.append(int(np.add.reduce(mix(s ^ K1)).astype(np.int64)) if len(s) else 0)
                f2.append(int(np.add.reduce(mix(s ^ K2)).astype(np.int64)) if len(s) else 0)
                low.append(s[:2 * prefix(len(s), percent) + SPARE].tobytes())
                bits.append(signature(s, 2).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                                              pa.array(low, pa.binary()), pa.array(bits, pa.binary())], names=names)

    return bounded_batches(src).mapInArrow(run, "doc_id long, th long, n long, f1 long, f2 long, low binary, bits binary")


def common_shingles(classes: DataFrame, percent: int) -> np.ndarray:
    """The heaviest shingles of the classes' prefixes, at most ``HOT_MOST``."""
    def run(batches):
        got = [np.frombuffer(r.as_py(), np.uint64)[:prefix(n, percent)] for b in batches for n, r in zip(b.column("n").to_pylist(), b.column("low"))]
        t, c = np.unique(np.concatenate(got) if got else np.zeros(0, np.uint64), return_counts=True)
        some = c > 3
        yield pa.RecordBatch.from_arrays([pa.array(t[some].astype(np.int64)), pa.array(c[some])], names=["t", "c"])

    heavy = classes.select("n", "low").mapInArrow(run, "t long, c long").groupBy("t").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT_AT)
    rows = heavy.orderBy(F.desc("c"), "t").limit(HOT_MOST).collect()  # HOT_MOST rows at most; the choice changes no result
    return np.sort(np.array([r.t for r in rows], np.int64).astype(np.uint64))


def blocks(classes: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    """``block, cid``: the classes that meet at a shingle, apart where their sizes are
    too far from the next ones; equal blocks once. Blocks of common shingles pair
    the sets that depend on them with all."""
    def spread(batches):
        for b in batches:
            ts, cs, ks = [], [], []
            for cid, n, r in zip(b.column("cid").to_pylist(), b.column("n").to_pylist(), b.column("low")):
                low, p = np.frombuffer(r.as_py(), np.uint64), prefix(n, percent)
                common = np.isin(low, hot)
                rare = low[~common]
                enough = len(rare) >= p
                own = np.union1d(low[:p], rare[:p]) if common[:p].any() else low[:p]
                kind = np.where(np.isin(own, hot), 1 if enough else 0, 2)
                ts.append(own)
                cs.append(np.full(len(own), cid, np.int64))
                ks.append(kind.astype(np.int64) << 40 | n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ts).astype(np.int64)), pa.array(np.concatenate(cs)), pa.array(np.concatenate(ks))], names=["t", "cid", "kn"])

    rows = classes.select("cid", "n", "low").mapInArrow(spread, "t long, cid long, kn long").repartition("t").sortWithinPartitions("t", "kn", "cid")

    bucket = BUCKET

    def gathered(batches):
        """Runs of equal shingles and near sizes, cut to chunks of ``bucket``; a chunk
        pair is a block."""
        held, kinds, at, last = [], [], None, 0

        def flush():
            if len(held) < 2 or kinds[0] == 1:  # alone, or common and needed by none
                return
            lead = held if kinds[0] == 2 else [c for c, k in zip(held, kinds) if k == 0]
            for a in range(0, len(lead), bucket):
                for b in range(a if kinds[0] == 2 else 0, len(held), bucket):
                    left, right = lead[a:a + bucket], held[b:b + bucket]
                    both = sorted(set(left) | set(right))
                    if len(both) > 1:
                        yield both

        out = []
        for b in batches:
            for t, cid, kn in zip(*[b.column(c).to_pylist() for c in ("t", "cid", "kn")]):
                kind, n = kn >> 40, kn & (1 << 40) - 1
                if t != at or kind == 2 and 100 * last < percent * n:
                    out += flush()
                    held, kinds, at = [], [], t
                elif kinds[0] == 1:
                    continue
                held.append(cid)
                kinds.append(kind)
                last = n
                if len(out) >= 2000:
                    yield packed(out)
                    out = []
        out += flush()
        if out:
            yield packed(out)

    def packed(lists):
        h = [int(np.add.reduce(mix(np.array(x, np.uint64) ^ K2)).astype(np.int64)) for x in lists]
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array([len(x) for x in lists], pa.int32()), pa.array(lists, pa.list_(pa.int64()))], names=["block", "size", "cids"])

    got = rows.mapInArrow(gathered, "block long, size int, cids array<long>")
    return materialize(got.dropDuplicates(["block", "size"]).select("block", F.explode("cids").alias("cid")), "jaccard-blocks")


def _runs(batches, key: str, columns: list[str], work, made=None):
    """Calls ``work(rows)`` for every run of equal ``key`` in sorted batches; with
    ``made``, each row ends with what ``made(batch)`` has for it."""
    held, at = [], None
    for b in batches:
        more = [made(b)] if made else []
        for row in zip(*[b.column(c).to_pylist() for c in [key, *columns]], *more):
            if row[0] != at:
                if held:
                    yield from work(held)
                held, at = [], row[0]
            held.append(row[1:])
    if held:
        yield from work(held)


def _links(pairs, size: int = 5000):
    """Pairs as batches."""
    out = []
    for p in pairs:
        out.append(p)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], names=["a", "b"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], names=["a", "b"])


def candidates(classes: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that connect the candidates of every block."""
    def work(rows):
        cid, n, bits = zip(*rows)
        if len(cid) > 1:
            for i, j in forest([np.frombuffer(x, np.uint64) for x in bits], n, percent):
                yield (min(cid[i], cid[j]), max(cid[i], cid[j]))

    rows = met.join(classes.select("cid", "n", "bits"), "cid").repartition("block").sortWithinPartitions("block", "n", "cid")
    pairs = rows.mapInArrow(lambda bs: _links(_runs(bs, "block", ["cid", "n", "bits"], work)), "a long, b long")
    return materialize(pairs.distinct(), "jaccard-candidates")


def verified(texts: DataFrame, tasks: DataFrame, k: int, percent: int, cross: bool) -> DataFrame:
    """Links among the whole sets of every task ``(task, cid, label, side, d, h)``, a
    forest of them. ``texts(doc_id, th, text)`` has the texts: ``d, h`` says which.
    ``cross``: only pairs of different sides."""
    def work(rows):
        rows = list({r[0]: r for r in rows}.values())  # rows of the same id and text
        cid, label, side, s = zip(*rows)
        far = np.array(side)

        def same(i, j):
            both = np.concatenate([s[i], s[j]])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            return 100 * shared >= percent * (len(s[i]) + len(s[j]) - shared)

        apart = (lambda x, y: far[x] != far[y]) if cross else None
        for i, j in forest([signature(x, 4) for x in s], [len(x) for x in s], percent, label, same, apart):
            yield (min(cid[i], cid[j]), max(cid[i], cid[j]))

    def run(batches):
        return _links(_runs(slices(batches, "text"), "task", ["cid", "label", "side"], work, lambda b: sets_of(b.column("text"), k)))

    # texts travel, not sets: a text is smaller than the hashes of its shingles;
    # the members grow with the documents, so the join is a shuffle at every size
    rows = texts.join(tasks.hint("merge"), F.col("th").eqNullSafe(F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("task", "cid", "label", "side", "text")
    return rows.repartition("task").sortWithinPartitions("task", "cid").mapInArrow(run, "a long, b long")


def jaccard_links(df: DataFrame, k: int = 3, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows(doc_id, th, n, f1, f2)``, ``classes(cid, f1, f2, doc)`` and
    ``links(a, b)`` between classes that connect all that are linked."""
    every = materialize(summarise(df, k, percent), "jaccard-rows")
    first = F.min_by(F.struct("n", "low", "bits", "doc_id", "th"), F.struct("doc_id", "th"))
    classes = every.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("doc"), first.alias("x"))
    classes = materialize(classes.select("f1", "f2", "doc", "x.*").withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    hot = common_shingles(classes, percent)
    near = candidates(classes, blocks(classes, hot, percent), percent)
    groups = materialize(components(near).withColumnRenamed("component", "group"), "jaccard-groups")
    size = groups.groupBy("group").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    who = groups.join(size, "group").join(classes.select(F.col("cid").alias("id"), F.col("doc_id").alias("d"), F.col("th").alias("h")), "id")
    who = materialize(who.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")), "jaccard-members")

    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    one = who.select(F.col("id").alias("cid"), F.col("id").alias("label"), F.lit(0).alias("side"), "group", "chunk", "chunks", "d", "h")
    nth = F.row_number().over(Window.partitionBy("group").orderBy("cid"))
    pivots = one.where("chunks > 1").withColumn("nth", nth).where(F.col("nth") <= PIVOTS)
    pivots = pivots.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("to <> chunk").withColumn("chunk", F.col("to"))
    key = F.xxhash64("group", "chunk").alias("task")
    cols = ["cid", "label", "side", "d", "h"]
    links = materialize(verified(texts, one.select(key, *cols).unionByName(pivots.select(key, *cols)), k, percent, False), "jaccard-links")

    # groups of several chunks that the pivots did not connect: every pair of chunks
    large = one.where("chunks > 1")
    if not large.isEmpty():
        now = components(links)
        large = large.join(now, F.col("cid") == F.col("id"), "left").withColumn("label", F.coalesce("component", "cid")).drop("id", "component")
        large = materialize(large, "jaccard-large")
        apart = large.groupBy("group").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("group")
        large = large.join(apart, "group")
        other = large.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("to <> chunk")
        pair = F.xxhash64("group", F.least("chunk", "to"), F.greatest("chunk", "to"))
        links = links.unionByName(verified(texts, other.select(pair.alias("task"), "cid", "label", F.col("chunk").alias("side"), "d", "h"), k, percent, True))
    return every, classes, links


def jaccard_components(df: DataFrame, k: int = 3, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``df(doc_id, text)``, and
    ``class_id`` (rows of equal sets; null for an empty one)."""
    every, classes, links = jaccard_links(df, k, percent)
    comp = components(materialize(links, "jaccard-all-links"))
    c = classes.select("cid", "f1", "f2", "doc").join(comp, F.col("cid") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "cid"))
    c = materialize(c.select("cid", "f1", "f2", "doc", "comp"), "jaccard-components")
    low = c.groupBy("comp").agg(F.min("doc").alias("component_id"))
    c = c.join(low, "comp").select(F.col("f1").alias("x1"), F.col("f2").alias("x2"), F.col("cid").alias("class_id"), "component_id")
    j = every.join(c, (F.col("n") > 0) & (F.col("f1") == F.col("x1")) & (F.col("f2") == F.col("x2")), "left")
    return j.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "class_id")


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])
                               WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)
"""
