import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from stardust.llm import op6_kdtree, op7_jaccard, op8_passages, op9_rans, op10_pack
from stardust.llm._tokens import tokenizer
from stardust.session import scratch_path

from .conftest import documents
from .test_shared import find

W = re.compile(r"[^\x20\x09-\x0D]+")


def test_op6_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op6_kdtree, "LEAF", 8)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], 1) for i in range(400)]
    rows += [(400 + i, rows[i][1], 1) for i in range(60)]  # ties
    rows += [(None, [1.0] * 6, 1), (700, None, 1), (750, [1.0, None] * 3, 1), (800, [math.nan] + [1.0] * 5, 1), (850, [math.inf] + [0.0] * 5, 1), (900, [1.0, 2.0], 1),
             (950, [], 1), (901, [3.0, -2.0], 1), (50, rows[3][1], 1), (1000, [1e13, -1e13, 1e13], 1), (1001, [1e13, -1e13, 1e13], 1)]
    rows += [(1100 + i, rows[7][1], 1) for i in range(150)]  # a very common vector
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>, rank int").withColumn("row", F.lit("x")).withColumn("score", F.lit(1)).withColumn("shard", F.lit(None))
    v = [(i, r[0], [math.floor(256 * x) for x in r[1]]) for i, r in enumerate(rows) if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    want = []
    for n, q, x in v:
        if q % 50 == 0:
            c = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), i, m) for m, i, y in v if m != n and len(y) == len(x))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i, _) in enumerate(c)]
    for shard, block, bounds in ((64, 3, {}), (10_000, 1000, {}), (8, 2, {"SAMPLE": 20, "LEVELS": 1, "ROUNDS": 2, "PAGE": 3, "PART": 1})):
        for name, most in bounds.items():
            monkeypatch.setattr(op6_kdtree, name, most)
        got = op6_kdtree.nearest(df, F.col("vec_id") % 50 == 0, shard=shard, block=block).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert op6_kdtree.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_op6_queries_go_to_few_shards(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(16, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 16] + rng.normal(size=8) * 0.2]) for i in range(3200)]
    kept = {}
    write = op6_kdtree.materialize
    monkeypatch.setattr(op6_kdtree, "materialize", lambda df, label: kept.setdefault(label, write(df, label)))
    got = op6_kdtree.nearest(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") % 50 == 0, shard=100)
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    want = []
    for q in range(0, 3200, 50):
        s = x @ x[q]
        best = sorted((-int(s[i]), i) for i in range(3200) if i != q)[:5]
        want += [(q, n + 1, i, -t) for n, (t, i) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    shards = kept["kd-trees"].count()
    sent = sum(len(op6_kdtree.pickle.loads(r.raw)["row"]) for r in kept["kd-reached"].collect())
    assert shards >= 20 and 2 * sent < 64 * shards


def test_op6_planes_and_bounds():
    rng = np.random.default_rng(9)
    x = rng.integers(-3, 4, size=(500, 3))
    side, at = op6_kdtree.planes(x, 3)
    node = np.ones(500, int)
    for _ in range(3):
        node = 2 * node + (x[np.arange(500), np.array(side)[node]] >= np.array(at)[node])
    assert len(np.unique(node)) == 8 and np.bincount(node).max() < 150
    assert op6_kdtree.planes(x[:1].repeat(9, 0), 2) == ([0] * 4, [op6_kdtree.BIG] * 4)
    q, lo, hi = rng.integers(-9, 9, (20, 3)), np.array([x[:9].min(0)]), np.array([x[:9].max(0)])
    top = [int(v) for v in np.maximum(q * lo, q * hi).sum(1)]
    assert op6_kdtree.reaches(q, top, lo, hi).all() and not op6_kdtree.reaches(q, [t + 1 for t in top], lo, hi).any()
    assert op6_kdtree.reaches(q, [None] * 20, lo, hi).all()


def jaccard_classes(texts, k, percent):
    sets = []
    for t in texts:
        w = W.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= percent * len(a | b)]
    return sets, {i: i for i in range(len(texts))} | find(edges)


def near_copies(rnd, n_base=25, words=60, copies=6):
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    line = " ".join(rnd.choice(vocabulary) for _ in range(14))
    texts = []
    for _ in range(n_base):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(2, words))] + line.split()
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.randrange(0, 4)):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            texts.append(rnd.choice([" ", "\n"]).join(t))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_op7_against_brute_force(spark, edge, empty, monkeypatch, small):
    rnd = random.Random(6)
    texts = near_copies(rnd) + [None, "", " ", "a", "A", "a b", "a  B", "x"] + near_copies(rnd, 1, 200, 40)
    if small:  # many chunks, blocks and common shingles
        for name, v in (("CHUNK", 8), ("PIVOTS", 1), ("BUCKET", 5), ("HOT_AT", 4), ("HOT_MOST", 30)):
            monkeypatch.setattr(op7_jaccard, name, v)
    for k, percent in ((3, 90), (5, 80)):
        sets, comp = jaccard_classes(texts, k, percent)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard.jaccard_components(documents(spark, texts), k, percent).collect()}
        assert got == {i: (len(s), comp[i]) for i, s in enumerate(sets)}
    if not small:
        rows = op7_jaccard.jaccard_components(edge).collect()
        assert len(rows) == edge.count()
        assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
        assert op7_jaccard.jaccard_components(empty).count() == 0


def test_op7_tree_bounds_lose_nothing():
    rng = np.random.default_rng(0)
    base = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (5, 40, 40, 300)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.05], rng.integers(0, 2**63, 1, dtype=np.uint64)])) for b in base for _ in range(20)]
    sets = [s for s in sets if len(s)]
    for width in (1, 2, 4):
        bits = [op7_jaccard.signature(s, width) for s in sets]
        tested = lambda i, j: len(np.intersect1d(sets[i], sets[j])) * 100 >= 90 * len(np.union1d(sets[i], sets[j]))
        got = find(op7_jaccard.forest(bits, [len(s) for s in sets], 90, verify=tested))
        want = find([(i, j) for i in range(len(sets)) for j in range(i) if tested(i, j)])
        assert {i: got.get(i, i) for i in range(len(sets))} == {i: want.get(i, i) for i in range(len(sets))}


def prose(rnd, n):
    out = []
    while sum(len(s.split()) for s in out) < n:
        out.append(" ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 8))) for _ in range(rnd.randrange(4, 14))).capitalize() + ".")
    return " ".join(out)


def test_op8_catches_planted_passages(spark, edge, empty):
    rnd = random.Random(11)
    texts = [prose(rnd, 150) for _ in range(60)]
    passage, cut = prose(rnd, 60), {}
    for i in (3, 17, 29, 44):
        w = texts[i].split(" ")
        at = rnd.randrange(20, 100)
        texts[i] = " ".join(w[:at] + passage.split(" ") + w[at:])
    near = passage.split(" ")
    near[30] = "changed"
    texts[50] = texts[50] + "\n" + " ".join(near)
    df = documents(spark, texts)
    runs = op8_passages.repeated(df.select("doc_id", "text")).cache()
    got = runs.collect()
    assert {r.doc_id for r in got} == {17, 29, 44, 50} and {r.first_doc_id for r in got} == {3}
    for r in got:
        piece = texts[r.doc_id][r.start:r.start + r.length]
        assert len(W.findall(piece)) == r.words >= op8_passages.RUN_WORDS
        cut.setdefault(r.doc_id, texts[r.doc_id]).replace(piece, "")
    left = {r.doc_id: r.text for r in op8_passages.without(df, runs).collect()}
    assert len(left) == len(texts) and all(left[i] == t for i, t in enumerate(texts) if i not in cut)
    assert all(len(left[i]) < len(texts[i]) - 100 for i in cut)
    assert op8_passages.repeated(edge).count() == 0 and op8_passages.repeated(empty.select("doc_id", "text")).count() == 0


def test_op8_bands_reach_the_recall():
    bands, rows = op8_passages.tune(0.8, 0.98)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.98
    assert 1 - (1 - 0.5 ** op8_passages.tune(0.5, 0.9)[1]) ** op8_passages.tune(0.5, 0.9)[0] >= 0.9


def test_op8_pairs_of_small_buckets_and_crowded_ones(spark):
    two = lambda a, b: a << 32 | b  # noqa: E731  a long holds the keys of two bands
    rows = [(i, two(6, 5), two(8, 7)) for i in range(300)] + [(1000, two(9, 9), two(9, 9)), (1001, two(10, 9), two(11, 10)), (1002, two(20, 19), two(21, 9))]
    pairs, crowded = op8_passages.colliding(spark.createDataFrame(rows, "fp long, k0 long, k1 long"), 4)
    assert {(r.a, r.b) for r in pairs.collect()} == {(1000, 1001), (1000, 1002)}
    assert {r.fp for r in crowded.collect()} == set(range(300))


def shingle_set(text):
    w = W.findall(text.lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_op8_deals_the_keys_of_larger_buckets_once(spark):
    rows = [(i, 7 if i < 70 else 8 if i < 75 else i, 0) for i in range(90)]
    pairs, crowded = op8_passages.colliding(spark.createDataFrame(rows, "fp long, k0 long, k1 long"), 1)
    for df in (pairs, crowded):  # both read what was picked, and do not cut the keys again
        assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert pairs.count() == 10 and crowded.count() == 70


@pytest.mark.parametrize("most", [64, 2, 1])
def test_op8_links_every_similar_pair_of_a_crowded_bucket(spark, monkeypatch, most):
    """150 pairs of near copies that all share one frame of words."""
    monkeypatch.setattr(op8_passages, "ALL_PAIRS", most)
    rnd = random.Random(5)
    frame = prose(rnd, 40).replace(".", "").split(" ")
    texts = []
    for k in range(150):
        own = [f"w{k}x{j}" for j in range(26)]
        a = [*frame, *own]
        b = [*a[:-1], "changed"]
        texts += [" ".join(a), " ".join(b)]
    texts = texts[0::2] + texts[1::2]
    df = documents(spark, texts)
    got = {r.doc_id: r.first_doc_id for r in op8_passages.repeated(df.select("doc_id", "text")).collect()}
    edges = [(i, j) for i in range(300) for j in range(i) if len(x := shingle_set(texts[i]) & shingle_set(texts[j])) >= 0.8 * len(shingle_set(texts[i]) | shingle_set(texts[j]))]
    want = {i: c for i, c in find(edges).items() if i != c}
    found = sum(got.get(i) == c for i, c in want.items())
    assert set(got) <= set(want) and len(want) == 150
    assert found == 150


def test_op8_recall_of_similar_paragraphs(spark):
    """Pairs at a similarity of 0.8 to 0.85, in buckets of their own."""
    rnd, texts = random.Random(9), []
    for k in range(300):
        a = [f"p{k}q{j}" for j in range(54)]
        b = [*a]
        b[rnd.randrange(8, 46)] = "other"
        texts += [" ".join(a), " ".join(b)]
    df = documents(spark, texts)
    sims = [len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b)) for a, b in zip(texts[::2], texts[1::2])]
    assert all(0.8 <= s <= 0.85 for s in sims)
    assert op8_passages.repeated(df.select("doc_id", "text")).count() >= 0.96 * 300


def test_op9_coder_checkpoints_and_checksums():
    rng = np.random.default_rng(1)
    for n in (1, 5, 64, 1000, 300_000):
        ids = np.minimum(rng.zipf(1.3, n) - 1, 70_000).astype(np.uint32)
        u, c = np.unique(ids, return_counts=True)
        coder = op9_rans.Coder(*op9_rans.table(dict(zip(u.tolist(), c.tolist()))))
        block = coder.encode(ids)
        assert (coder.decode(block, n) == ids).all()
        part = op9_rans.EVERY * block["lanes"]
        for k in range(1, len(block["marks"])):
            assert (coder.decode(block, n, first=k) == ids[k * part:]).all()
            assert (coder.decode(block, n, first=k - 1, last=k) == ids[(k - 1) * part:k * part]).all()


def test_op9_coder_refuses_ids_that_its_table_lacks():
    coder = op9_rans.Coder(*op9_rans.table({3: 5, 9: 1}))
    for odd in (0, 4, 10):
        with pytest.raises(IndexError):
            coder.encode(np.array([3, odd, 9], np.uint32))
    own = np.array([9, 3, 3, 9], np.uint32)
    assert coder.decode(coder.encode(own), 4).tolist() == own.tolist()


def test_op9_round_trip_edges_and_damage(spark, edge, empty):
    path, tk = P.path("byte_bpe_50k.json"), tokenizer(P.path("byte_bpe_50k.json"))
    out = scratch_path(spark, "t-rans")
    src = edge.withColumn("key", F.col("doc_id"))
    op9_rans.write_ids(src, path, out, block=100)
    got = op9_rans.starts(op9_rans.read_ids(spark, out), out).orderBy("start").collect()
    want = sorted(([-1 if r.doc_id is None else r.doc_id, tk.encode(r.text or "", add_special_tokens=False).ids + [0]] for r in edge.collect()), key=lambda x: x[0])
    assert [-1 if r.key is None else r.key for r in got] == [w[0] for w in want]
    at = 0
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n, r.ids_crc32) == (at, len(own), zlib.crc32(r.ids)) and [-1 if r.key is None else r.key, own] in want
        at += r.n
    none = scratch_path(spark, "t-rans")
    op9_rans.write_ids(empty.withColumn("key", F.col("doc_id")), path, none)
    assert op9_rans.read_ids(spark, none).count() == 0
    bad = scratch_path(spark, "t-rans")
    blocks = spark.read.schema(op9_rans.FORMAT).parquet(f"{out}/blocks")
    spark.read.parquet(f"{out}/table").write.parquet(f"{bad}/table")
    blocks.withColumn("ids_crc", F.col("ids_crc") + 1).write.partitionBy("part").parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="damaged"):
        op9_rans.read_ids(spark, bad).count() or op9_rans.read_ids(spark, bad).collect()


def test_op10_pieces_and_places(spark, edge, empty):
    path, tk = P.path("word_bpe_49k.json"), tokenizer(P.path("word_bpe_49k.json"))
    df = edge.drop("length")
    got = op10_pack.pack(op10_pack.pieces(df, path)).collect()
    want = []
    for r in df.collect():
        ids = np.array(tk.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(r.doc_id, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048])) for k in range(0, len(ids), 2048)]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for v in bins.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == -(-sum(r.length for r in got) // 2048)
    assert op10_pack.pack(op10_pack.pieces(empty, path)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_op10_every_capacity_holds(spark, monkeypatch, rule):
    monkeypatch.setattr(op10_pack, "GROUP", 300)
    rnd = random.Random(1)
    rows = [(i, rnd.choice([1, 3, 10, 40, 64, 90, 100])) for i in range(1500)]
    cap = (100, 4, 6000)
    got = op10_pack.pack(spark.createDataFrame(rows, "id long, length long"), cap, (1, 0.5, 0.5), rule).collect()
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    assert sorted(r.id for r in got) == list(range(1500))
    for v in bins.values():
        assert sum(n for _, n in v) <= 100 and len(v) <= 4 and (len(v) == 1 or sum(n * n for _, n in v) <= 6000)
        assert [o for o, _ in sorted(v)] == [sum(n for _, n in sorted(v)[:i]) for i in range(len(v))]
    low = max(-(-sum(n for _, n in rows) // 100), -(-len(rows) // 4), -(-sum(n * n for _, n in rows) // 6000))
    assert len(bins) <= 1.35 * low + 5
