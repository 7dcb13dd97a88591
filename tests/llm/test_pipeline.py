import re
from collections import Counter

import corpus_pipeline as C
from stardust.session import materialize

from .conftest import CLASHES, documents
from .test_ops_6_10 import jaccard_classes, near_copies, W
import random


def clean(n, rnd):
    return [" ".join(rnd.choice(["the", "of", "and", "house", "river", "walk", "green", "stone"]) + rnd.choice("abcdefgh") for _ in range(40)) for _ in range(n)]


def test_stages_on_edges_and_planted_cases(spark, edge, empty):
    rnd = random.Random(3)
    base = clean(12, rnd)
    texts = [None, "", "123 !!"] + base + ["same line with more than ten words in it for the test\n" + t for t in base[:2]] + near_copies(rnd, 4, 60, 5)
    docs = documents(spark, texts, langs=["en"] * len(texts))
    lid = materialize(C.language_id(spark, docs, ""), "t")
    ids = {r.doc_id for r in lid.collect()}
    assert lid.columns == docs.columns and ids.isdisjoint({0, 1, 2}) and set(range(3, 15)) <= ids

    lines = materialize(C.line_dedup(spark, lid, ""), "t")
    got = {r.doc_id: r.text for r in lines.collect()}
    assert lines.columns == docs.columns and set(range(3, 15)) <= set(got)
    assert all(got[i] == texts[i] for i in range(3, 15)) and 16 not in got  # both of its lines came before

    near = C.near_duplicates(spark, documents(spark, texts), "").collect()
    _, comp = jaccard_classes(texts, 5, 80)
    kept = {r.doc_id for r in near}
    worded = [i for i, t in enumerate(texts) if t and W.search(t)]
    assert kept == {comp[i] for i in worded} | {0, 1}

    twice = C.near_duplicates(spark, documents(spark, base[:2] * 2, ids=[1, 2, 1, 2]), "").collect()
    assert sorted(r.doc_id for r in twice) == [1, 2]

    mixed = C.mixed(spark, docs, "")
    n = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and max(n.values()) <= 2
    again = C.mixed(spark, documents(spark, ["w " * 100] * 60 + ["v " * 50] * 2, ids=[1] * 60 + [2, 3], sources=["a"] * 60 + ["b"] * 2, langs=["en"] * 62), "")
    taken = Counter()
    for r in again.collect():
        taken[r.source] += len(W.findall(r.text))
    size = {"a": 6000, "b": 100}  # 150% of 6100 words: b stops at 200, a takes the rest
    assert abs(taken["a"] - (1.5 * sum(size.values()) - 200)) <= 200 and abs(taken["b"] - 200) <= 100
    for stage in (f for _, f in C.STAGES):
        assert stage(spark, empty, "").count() == 0
    for stage in (f for _, f in C.STAGES[:-1]):
        out = stage(spark, edge, "")
        assert out.columns == edge.columns and out.count() >= 1
    pieces = C.packed(spark, edge, "").collect()
    assert Counter((r.doc_id, r.piece) for r in pieces)[(10, 0)] == 1 and set(re.findall(r"\w+", " ".join(CLASHES)))


def test_run_packs_whole_documents(spark):
    got = C.run(spark, "/root/testdata/sf0.001").collect()
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1
