import hashlib
import random
import re
from collections import defaultdict

import pytest

from stardust.llm import op1_divergence, op2_chat, op3_lines, op4_langid, op5_mix
from stardust.llm._common import word_count
from pyspark.sql import functions as F

from .conftest import documents

W = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def test_op1_base_counts_and_edges(spark, edge, empty):
    df = edge.unionByName(documents(spark, ["a b c d e a b c d e a b c d e f g\nq r\nq r", "p q r s t u p q r s t"], [50, 51], ["a"] * 2, ["en"] * 2))
    got = op1_divergence.diverging(df)
    assert "text" not in got.columns and "row" in got.columns and got.count() == df.count()
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    for d in df.collect():
        t = d.text or ""
        ws = W.findall(t)
        seen, cover = defaultdict(list), set()
        for i in range(len(ws) - 4):
            seen[tuple(ws[i:i + 5])].append(i)
        for v in seen.values():
            if len(v) > 1:
                cover |= {i + j for i in v for j in range(5)}
        lines = [x for x in t.split("\n") if W.search(x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        rows = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in by[d.doc_id]]
        assert want in rows
        r = by[d.doc_id][rows.index(want)]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.kept and r.base_failed)
    assert op1_divergence.diverging(empty).count() == 0


def test_op1_junk_goes_clean_stays(spark):
    got = op1_divergence.op1_divergence(spark, SF).alias("g").join(spark.read.parquet(f"{SF}/documents.parquet").alias("d"), "doc_id")
    rows = got.where("not base_failed").select("doc_id", "kept", "char_distance", "text").collect()
    junk = [r for r in rows if len(re.findall(r"[#$%&*]{3}", r.text)) > 20]
    assert junk and not any(r.kept for r in junk)
    assert sum(r.kept for r in rows) > 0.9 * len(rows)


def turns_of(rows):
    g = defaultdict(list)
    for c, t, r, x in rows:
        g[c].append(((t is not None, t or 0), r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in g.items()}


def test_op2_digests_windows_and_edges(spark):
    rnd = random.Random(5)
    mark = ["</s>[INST] ok [/INST]", "<s>", r"<\s>", "[\\/INST]", "<", "[", "\\", "ü\n", ""]
    rows = [(1, 0, "system", "be kind " * 5)] + [(1, i, "user" if i % 2 else "assistant", "word " * rnd.randrange(1, 300)) for i in range(1, 60)]
    rows += [(2, 0, "system", "alone")] + [(3, i, rnd.choice(["user", "assistant", None, "<s>x", "system"]), rnd.choice(mark) + rnd.choice(mark)) for i in range(30)]
    rows += [(None, 0, "user", None), (None, None, "assistant", "b"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (4, 1, "a", "z")]
    rows += [(5, 0, "system", "s " * 3000), (5, 1, "user", "u"), (5, 2, "assistant", "long " * 3000), (5, 3, "assistant", "short")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, window int")
    w = op2_chat.windows(df).cache()
    got = {r.conv_id: r for r in op2_chat.digests(w).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = turns_of(rows)
    assert set(got) == set(want)
    for c, ts in want.items():
        loss = "".join(x for r, x in ts if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(ts), sha("".join(f"{r}\n{x}\n" for r, x in ts))), c
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss)), c
    one = sorted(w.where("conv_id = 1").collect(), key=lambda r: r.window)
    assert len(one) > 3 and all(r.tokens <= op2_chat.BUDGET for r in one) and all(r.formatted.startswith("<s>[INST]system[/INST]be kind") for r in one)
    assert [r.window for r in one] == list(range(len(one))) and any(r.repeated > 1 for r in one[1:])
    assert op2_chat.digests(op2_chat.windows(df.limit(0))).count() == 0


def greedy(toks, sys, budget, history):
    """Where windows begin: each takes the turns that fit beside the system turn and its history."""
    out, s = [], 0
    while s < len(toks):
        out.append(s)
        h, i = 0, s
        while i and h + toks[i - 1] <= history:
            i -= 1
            h += toks[i]
        used, e = sys + h, s
        while e < len(toks) and (e == s or used + toks[e] <= budget):
            used += toks[e]
            e += 1
        s = e
    return out


def test_op2_windows_are_full(spark):
    rnd = random.Random(12)
    rows = [(1, i, "user" if i % 2 else "assistant", "word " * rnd.randrange(1, 60)) for i in range(400)]
    rows += [(2, 0, "system", "be kind")] + [(2, i, "user" if i % 2 else "assistant", "word " * rnd.choice([1, 5, 300, 900, 1100])) for i in range(1, 120)]
    w = op2_chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    one = w.where("conv_id = 1").collect()
    assert sum(r.tokens for r in one) / len(one) > 0.8 * op2_chat.BUDGET and all(r.tokens <= op2_chat.BUDGET for r in one)
    for c, sys in ((1, 0), (2, 1 + 2 + op2_chat.FRAME)):
        toks = [1 + len(x.split()) + op2_chat.FRAME for k, i, r, x in rows if k == c and r != "system"]
        begins = greedy(toks, sys, op2_chat.BUDGET, op2_chat.HISTORY)
        own = sorted(w.where(f"conv_id = {c}").collect(), key=lambda r: r.window)
        new = [r.formatted.count(op2_chat.OPEN) - r.repeated for r in own]
        if c == 2:
            new[0] -= 1  # the system turn itself
        assert new == [b - a for a, b in zip(begins, [*begins[1:], len(toks)])]
    assert "Python" not in op2_chat.windows(spark.range(3).selectExpr("id conv_id", "id turn", "'user' role", "'x' text"))._jdf.queryExecution().executedPlan().toString()


def later(texts, least=10):
    """The lines of every later copy of a run of any length with ``least`` words."""
    lines = [t.split("\n") if t is not None else [] for t in texts]
    gone = [set() for _ in lines]
    for depth in range(1, max(map(len, lines)) + 1):
        seen = set()
        for a, ls in enumerate(lines):
            for q in range(len(ls) - depth + 1):
                b = tuple(ls[q:q + depth])
                if b in seen and sum(len(W.findall(x)) for x in b) >= least:
                    gone[a].update(range(q, q + depth))
                seen.add(b)
    return lines, gone


def longest(gone):
    best = 0
    for x in gone:
        n = 0
        while x + n in gone:
            n += 1
        best = max(best, n)
    return best


def test_op3_against_brute_force(spark, edge, empty):
    rnd = random.Random(8)
    pool = ["a b c", "d", "", "e f g h i j k l m n o", "p q r s", "t u v w x y z a b c d e"]
    texts = [None, "", "\n\n", "x"] + ["\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12))) for _ in range(40)]
    texts += [texts[9], texts[9], "\n".join(["d"] * 64), "x\n" + "\n" * 20 + "p q r s", "\n" * 20 + "p q r s t u v w x y"]
    for n in (3, 5, 6, 7):  # runs that have the words only as a whole
        run = "\n".join(f"{n} u{i} v{i} w{i}"[:8 if n == 3 else 4] for i in range(n))
        texts += [f"begin {n}\n{run}\nend {n}", f"other {n}\n{run}\nlast {n}"]
    texts += ["q1 b c d\nq2 b c d\nq3 b c d", "top\nq1 b c d\nq2 b c d\nq3 b c d\nlow"]
    got = {r.doc_id: r for r in op3_lines.dedup_lines(documents(spark, texts)).collect()}
    lines, gone = later(texts)
    for i, t in enumerate(texts):
        want = t if not gone[i] else "\n".join(x for q, x in enumerate(lines[i]) if q not in gone[i])
        assert (got[i].text, got[i]._n_lines, got[i].n_removed, got[i].longest_run) == (want, len(lines[i]), len(gone[i]), longest(gone[i])), i
    assert len(gone[-1]) == 3  # three lines of four words
    kept = op3_lines.dedup_lines(documents(spark, ["e f g h i j k l m n o", "e f g h i j k l m n o", "d", "d", None]), drop_emptied=True)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]
    out = op3_lines.dedup_lines(edge)
    assert out.count() == edge.count() and set(edge.columns) <= set(out.columns)
    assert op3_lines.dedup_lines(empty).count() == 0


def test_op4_accuracy_and_edges(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op4_langid.fit_documents(docs)
    got = op4_langid.identify(docs, model).withColumn("held_out", op4_langid.held_out(F.col("doc_id")))
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    rows = op4_langid.identify(edge, model).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text)) and 0 <= r.score <= 1
        assert (r.score == 0) == (r.lang_pred == "und")
    none = op4_langid.fit(empty)
    assert op4_langid.identify(empty, model).count() == 0
    assert {r.lang_pred for r in op4_langid.identify(edge, none).collect()} == {"und"}
    one = op4_langid.fit(documents(spark, ["ab cd"], langs=["xx"]))
    assert {r.lang_pred for r in op4_langid.identify(edge, one).collect()} == {"und", "xx"}


def water(sizes, weights, share=1.5, most=2.0):
    left, open_ = share * sum(sizes.values()), set(sizes)
    out = {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= most * sizes[s]}
        if not full:
            return out | {s: level * weights[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("kind", ["edge", "many"])
def test_op5_targets_and_copies(spark, edge, kind):
    rnd = random.Random(2)
    if kind == "edge":
        df = edge
    else:
        df = documents(spark, ["w " * (rnd.randrange(1, 400) if i % 9 else 0) for i in range(600)], sources=[rnd.choice(["a", "b", "é", "Z", None, "zz"]) if i % 3 else "hot" for i in range(600)])
    df = df.withColumn("n_words", word_count(F.col("text")))
    once = [op5_mix.mix(df, F.col("n_words"), F.col("doc_id")).collect() for _ in range(2)]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.copies)
    rows = sorted(once[0], key=key)
    assert rows == sorted(once[1], key=key) and len(rows) == df.count()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)})
    for s in names:
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == sizes[s] for r in own)
        assert all(r.taken == r.size * r.copies and r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 2 * max(r.size for r in own) + 1


def test_op5_empty(spark, empty):
    assert op5_mix.mix(empty, word_count(F.col("text")), F.col("doc_id")).count() == 0
