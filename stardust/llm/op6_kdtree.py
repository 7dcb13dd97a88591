"""Exact top-k by inner product with a KD-tree per shard.

Shards are cells of space: rounds of median splits on the widest side, each found
on a bounded sample of a cell's vectors (``SAMPLE``) and applied to every vector by
a column expression, cut the vectors into cells of about a shard; a cell that no
plane can cut further is dealt by hash. Each shard builds one tree (median splits,
tight bounding boxes). A query goes best first through a tree: the bound of a box is
the largest inner product that a point in it could have, and boxes below the k-th
best score so far are left out. Every query first searches the shard of its own
cell; with its k-th score there it is held against the boxes of all shards, by
blocks, and goes only to the shards whose bound reaches that score. Trees that no
query reaches are not read again; a tree that many reach goes to several tasks.

Of equal vectors only the k + 1 smallest ids can be among the k best of any query, so
only these are candidates: a very common vector is no hot group. The sample only
places the planes; wherever they lie, the result is exact.

Trees and blocks of queries are rows of bytes. A task gets a shard's tree, then
the blocks of queries one after another, so it holds one tree and one block.

Defined results: a vector that is null or holds a null or non-finite component,
and a row without an id, takes no part; only vectors of the same length are
compared; rows with the same id are queries and candidates of their own, none
meets itself; ties go to the smaller id; fewer candidates than k: all of them; an
empty table gives an empty result; columns other than ``vec_id``, ``vector`` and
those ``query`` names are left aside, whatever their names. Scores beyond 64 bits
stop at the limits.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SHARD = 16_384      # vectors of a shard
BLOCK = 1_024       # queries of a block
BYTES = 32 << 20    # most bytes of the vectors of a shard or block (wide vectors: fewer of them)
SAMPLE = 8_192      # vectors of a cell that place its planes
LEVELS = 6          # median splits of a cell in a round: up to 64 cells
ROUNDS = 4          # 64 ** 4 cells at most; larger cells are dealt by hash
PAGE = 1_024        # boxes of shards that a block of queries is held against at once
SPREAD = 16         # tasks that share the blocks held against a page
PART = 64           # blocks of queries that a task takes to one tree
LEAF = 256
TOP = 5
BIG = 2**63 - 1


def scaled(vector: Column, by: int = 256) -> Column:
    """floor(by * x) of every component, or null where the vector takes no part."""
    d = F.transform(vector, lambda x: x.cast("double") * by)
    odd = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(odd, F.lit(False)), F.transform(d, lambda x: F.floor(x).cast("long")))


def matrix(rows) -> np.ndarray:
    """Vectors as integers wide enough for exact sums of products."""
    x = np.array(list(rows), np.int64).reshape(len(rows), -1)
    return x


def largest(*parts: np.ndarray) -> int:
    """The largest size of a component."""
    return max((int(max(v.max(), -v.min())) for v in parts if v.size), default=0)


def build(points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> dict:
    """The tree: points in leaf order and, per node, box, children and range. Numbers are
    doubles where their sums of products are exact as such."""
    order = np.arange(len(points))
    lo, hi, kids, span = [], [], [], []

    def grow(a: int, b: int) -> int:
        own = points[order[a:b]]
        me = len(lo)
        lo.append(own.min(0) if own.shape[1] else own[:0].sum(0))
        hi.append(own.max(0) if own.shape[1] else own[:0].sum(0))
        kids.append((-1, -1))
        span.append((a, b))
        if b - a > LEAF and own.shape[1] and (hi[me] > lo[me]).any():
            side = int(np.argmax(hi[me].astype(float) - lo[me]))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, side], mid)]
            left = grow(a, a + mid)
            kids[me] = (left, grow(a + mid, b))
        return me

    grow(0, len(points))
    kind = np.float64 if max(points.shape[1], 1) * largest(points) ** 2 < 2**53 else np.int64
    return {"x": points[order].astype(kind), "id": ids[order], "row": rows[order], "lo": np.array(lo, kind), "hi": np.array(hi, kind),
            "kids": np.array(kids), "span": np.array(span)}


def search(tree: dict, q: np.ndarray, row: int, k: int, least: int | None) -> list[tuple[int, int, int]]:
    """The up to ``k`` best ``(score, id, row)`` of a tree for one query, none below
    ``least`` (a k-th score that is already known)."""
    x, lo, hi = tree["x"], tree["lo"], tree["hi"]
    most = max(len(q), 1) * largest(lo[0], hi[0]) * largest(q)
    if x.dtype == np.float64 and most < 2**53:
        q = q.astype(np.float64)
    else:
        x, lo, hi = (v.astype(np.int64) for v in (x, lo, hi))
        if most >= 2**62:
            x, lo, hi, q = (v.astype(object) for v in (x, lo, hi, q))
    bound = np.maximum(lo * q, hi * q).sum(1)
    best: list[tuple[int, int, int]] = []  # a heap: worst first (lowest score, then largest id)
    heap = [(-bound[0], 0)]
    kids, span = tree["kids"], tree["span"]
    while heap:
        up, node = heapq.heappop(heap)
        floor = best[0][0] if len(best) == k else least
        if least is not None and floor is not None:
            floor = max(floor, least)
        if floor is not None and -up < floor:
            break
        left, right = kids[node]
        if left >= 0:
            for c in (left, right):
                if floor is None or bound[c] >= floor:
                    heapq.heappush(heap, (-bound[c], int(c)))
            continue
        a, b = span[node]
        s = x[a:b] @ q
        at = np.flatnonzero(s >= floor) if floor is not None else np.arange(b - a)
        for i in at:
            r = int(tree["row"][a + i])
            if r == row:
                continue
            item = (int(s[i]), -int(tree["id"][a + i]), -r)
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
    return [(max(-BIG - 1, min(BIG, s)), -i, -r) for s, i, r in best]


def planes(x: np.ndarray, levels: int) -> tuple[list[int], list[int]]:
    """Side and place of the splits of a complete binary tree, node n above 2n and
    2n + 1: ``x[side] >= at`` goes right. Where all vectors are equal, all go left."""
    side, at = [0] * (1 << levels), [BIG] * (1 << levels)
    parts = {1: x}
    for node in range(1, 1 << levels):
        own = parts.pop(node, x[:0])
        wide = own.max(0).astype(float) - own.min(0) if own.size else np.zeros(1)
        if wide.max() <= 0:
            continue
        side[node] = int(np.argmax(wide))
        col = own[:, side[node]]
        cut = np.partition(col, len(col) // 2)[len(col) // 2]
        if cut == col.min():
            cut = col[col > cut].min()
        at[node] = int(cut)
        parts[2 * node], parts[2 * node + 1] = own[col < cut], own[col >= cut]
    return side, at


def reaches(q: np.ndarray, least: list, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which boxes (columns) may hold a point whose inner product with a query (rows) is at
    least its ``least`` (None: all). Rounding is allowed for, so none is missed."""
    q, lo, hi = (v.astype(np.float64) for v in (q, lo, hi))
    up = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    up += 2.0**-50 * (q.shape[1] + 2) * (np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T)
    floor = np.array([-np.inf if s is None else s - abs(s) * 2.0**-50 for s in least], np.float64)
    return np.maximum(up, -(2.0**63)) >= floor[:, None]


def _keyed(batches, keys: list[str]):
    """The rows of bytes of a task in order: what the key's row of kind 0 holds, then each
    row of another kind. Rows whose key has no row of kind 0 are passed over."""
    held, at = None, None
    for b in batches:
        key = list(zip(*[b.column(c).to_pylist() for c in keys]))
        for i, kind in enumerate(b.column("kind").to_pylist()):
            if kind == 0:
                held, at = pickle.loads(b.column("raw")[i].as_py()), key[i]  # bytes this job wrote itself
            elif key[i] == at:
                yield held, b, i, pickle.loads(b.column("raw")[i].as_py())


def _reached(batches):
    names = ["dim", "shard", "block", "raw"]
    out, size = [], 0
    for page, b, i, got in _keyed(batches, ["dim", "page"]):
        dim, own, block = (b.column(c)[i].as_py() for c in ("dim", "shard", "block"))
        hit = reaches(got["x"], got["least"], page["lo"], page["hi"])
        for j in np.flatnonzero(hit.any(0)):
            if int(page["shard"][j]) == own:
                continue
            at = np.flatnonzero(hit[:, j])
            out.append((dim, int(page["shard"][j]), block, pickle.dumps({c: [v[n] for n in at] if c == "least" else v[at] for c, v in got.items()})))
            size += len(out[-1][3])
            if size > 4 << 20:
                yield _batch(out, names)
                out, size = [], 0
    if out:
        yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"dim": pa.int32(), "block": pa.int32(), "raw": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(n, pa.int64())) for n, v in zip(names, zip(*rows))], names=names)


def _searched(k: int):
    names = ["q", "query_id", "vec_id", "row", "score"]

    def run(batches):
        for tree, _, _, got in _keyed(batches, ["dim", "shard", "part"]):
            out = [(row, vec, i, r, s) for q, vec, row, least in zip(got["x"], got["id"].tolist(), got["row"].tolist(), got["least"])
                   for s, i, r in search(tree, q, row, k, least)]
            if out:
                yield _batch(out, names)

    return run


def _bytes(frame: DataFrame, keys: list[str], make, schema: str) -> DataFrame:
    def run(key, pdf):
        return pd.DataFrame([(*key, pickle.dumps(make(pdf)))], columns=[*keys, "raw"])

    return frame.groupBy(*keys).applyInPandas(run, schema)


def _most(count: int) -> Column:
    """``count``, or as many vectors of length ``dim`` as ``BYTES`` hold."""
    return F.greatest(F.lit(1), F.least(F.lit(count), F.floor(F.lit(BYTES) / (8 * F.greatest(F.col("dim"), F.lit(1)))).cast("int")))


def _cells(v: DataFrame) -> DataFrame:
    """Candidates (``n``) and queries (``m``) of each cell."""
    return v.groupBy("dim", "cell").agg(F.sum((~F.col("is_query")).cast("long")).alias("n"), F.sum(F.col("is_query").cast("long")).alias("m"))


def cut_space(v: DataFrame, shard: int = SHARD) -> DataFrame:
    """``v(dim, x, row, is_query, ...)`` with ``cell``: cells of about ``shard`` candidates
    by rounds of median splits. One number a round comes to the driver."""
    v = v.withColumn("cell", F.lit(0).cast("long"))
    last = None
    for turn in range(ROUNDS):
        big = _cells(v).withColumn("size", _most(shard)).where(F.col("n") > 2 * F.col("size"))
        largest = big.agg(F.max("n")).first()[0]
        if largest is None or (last is not None and 2 * largest > last):
            break
        last = largest

        def split(key, pdf):
            levels = min(LEVELS, max(1, int(np.ceil(np.log2(pdf["n"].iloc[0] / pdf["size"].iloc[0])))))
            return pd.DataFrame([(*key, levels, *planes(matrix(pdf["x"]), levels))], columns=["dim", "cell", "levels", "side", "at"])

        taken = v.where("not is_query").join(big, ["dim", "cell"]).where(F.pmod(F.xxhash64("row", F.lit(turn)), F.col("n")) < SAMPLE)
        cuts = taken.select("dim", "cell", "n", "size", "x").groupBy("dim", "cell").applyInPandas(split, "dim int, cell long, levels int, side array<int>, at array<long>")
        cuts = materialize(cuts, "kd-planes")
        node = F.aggregate(F.sequence(F.lit(1), F.col("levels")), F.lit(1),
                           lambda n, _: n * 2 + F.when(F.get("x", F.get("side", n)) >= F.get("at", n), 1).otherwise(0))
        leaf = F.coalesce(node - F.expr("shiftleft(1, levels)"), F.lit(0))
        v = materialize(v.join(cuts, ["dim", "cell"], "left").withColumn("cell", F.col("cell") * (1 << LEVELS) + leaf).drop("levels", "side", "at"), "kd-cells")
    return v


def nearest(df: DataFrame, query: Column, k: int = TOP, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The ``k`` best rows for each row of ``df(vec_id, vector)`` for which
    ``query`` holds: ``query_id, rank, vec_id, score``."""
    v = df.select(F.col("vec_id").cast("long"), scaled(F.col("vector")).alias("x"), F.coalesce(query, F.lit(False)).alias("is_query"))
    v = materialize(v.where("vec_id is not null and x is not null").withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("x")), "kd-vectors")
    equal = Window.partitionBy(F.xxhash64("x"), "x").orderBy("vec_id", "row")
    rows = v.withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= k + 1).drop("nth").withColumn("is_query", F.lit(False))
    v = cut_space(materialize(rows.unionByName(v.where("is_query")), "kd-rows"), shard)
    # a cell is a shard, or several by hash where no plane could cut it
    cells = _cells(v).select("dim", "cell", F.greatest(F.lit(1), F.floor(F.col("n") / _most(shard))).alias("salts"), F.greatest(F.lit(1), F.ceil(F.col("m") / _most(block))).alias("blocks"))
    v = v.join(cells, ["dim", "cell"]).withColumn("shard", F.shiftleft("cell", 31) + F.pmod(F.xxhash64("row"), F.col("salts")))

    def tree(key, pdf):
        t = build(matrix(pdf["x"]), pdf["vec_id"].to_numpy(), pdf["row"].to_numpy())
        return pd.DataFrame([(*key, pickle.dumps(t), t["lo"][0].astype(np.int64).tolist(), t["hi"][0].astype(np.int64).tolist())], columns=["dim", "shard", "raw", "lo", "hi"])

    trees = v.where("not is_query").select("dim", "shard", "vec_id", "row", "x").groupBy("dim", "shard")
    trees = materialize(trees.applyInPandas(tree, "dim int, shard long, raw binary, lo array<long>, hi array<long>"), "kd-trees")

    def queries(pdf):
        least = [None if s is None or s != s else int(s) for s in pdf["least"]]
        return {"x": matrix(pdf["x"]), "id": pdf["vec_id"].to_numpy(), "row": pdf["row"].to_numpy(), "least": least}

    def blocks(q: DataFrame) -> DataFrame:
        return _bytes(q.select("dim", "shard", "block", "vec_id", "row", "x", "least"), ["dim", "shard", "block"], queries, "dim int, shard long, block int, raw binary")

    def answered(asked: DataFrame) -> DataFrame:
        parts = asked.groupBy("dim", "shard").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        held = trees.join(parts, ["dim", "shard"]).select("dim", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "raw")
        asked = asked.join(parts, ["dim", "shard"]).select("dim", "shard", F.pmod(F.hash("block", F.length("raw")), "parts").alias("part"), F.lit(1).alias("kind"), "raw")
        rows = held.unionByName(asked).repartition("dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "kind")
        return rows.mapInArrow(_searched(k), "q long, query_id long, vec_id long, row long, score long")

    q = v.where("is_query").withColumn("block", F.pmod(F.hash("row"), F.col("blocks")).cast("int"))
    first = materialize(answered(materialize(blocks(q.withColumn("least", F.lit(None).cast("string"))), "kd-own")), "kd-home")
    known = first.groupBy(F.col("q").alias("k_row")).agg(F.when(F.count("*") >= k, F.min("score")).cast("string").alias("least"))
    asked = blocks(q.join(known, F.col("row") == F.col("k_row"), "left"))

    def page(pdf):
        return {"shard": pdf["shard"].to_numpy(), "lo": matrix(pdf["lo"]), "hi": matrix(pdf["hi"])}

    pages = trees.groupBy("dim").agg(F.ceil(F.count("*") / F.least(F.lit(PAGE), _most(PAGE))).cast("int").alias("pages"))
    boxes = trees.join(pages, "dim").select("dim", "shard", F.pmod(F.hash("shard"), "pages").alias("page"), "lo", "hi")
    boxes = _bytes(boxes, ["dim", "page"], page, "dim int, page int, raw binary").select("dim", "page", F.lit(None).cast("long").alias("shard"), F.lit(None).cast("int").alias("block"), F.lit(0).alias("kind"), "raw")
    asked = asked.join(pages, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"), "shard", "block", F.lit(1).alias("kind"), "raw")
    # a block meets a page of boxes once; the blocks of a page are dealt to several tasks
    spread = F.pmod(F.hash("shard", "block"), F.lit(SPREAD))
    asked = asked.withColumn("part", spread)
    boxes = boxes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    rows = boxes.unionByName(asked).repartition("dim", "page", "part").sortWithinPartitions("dim", "page", "part", "kind")
    reached = materialize(rows.mapInArrow(_reached, "dim int, shard long, block int, raw binary"), "kd-reached")
    found = first.unionByName(answered(reached))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op6_kdtree(spark, sf_dir: str) -> DataFrame:
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(v.select("vec_id", F.col("embedding").alias("vector")), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""
