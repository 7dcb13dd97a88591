"""Prefix counts, collocations and the Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stardust.llm import op11_prefix_counts as op11
from stardust.llm import op12_collocations as op12
from stardust.llm import op13_merkle as op13

from .conftest import documents

MODEL = P.path("piece_bpe_32k.model")
HARD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\nb", "\t\t x", "▁a▁b", "a▁", "<s></s><unk> <0x0A>", "a\x00b", "日本語 の文", "🙂🙂 x", "é é", "ﬁ x", "1234 56.78",
        "the theatre of the theories", "      indented    more", " " * 40 + "x", "aaaaaaaaaaaaaaaaaaaaaaaa", "Donaudampfschifffahrt", ";\r\n}\r\n", "x=y;//==----####", "\x85 \xa0 　z"]


def processor():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_op11_every_prefix_against_the_library():
    rnd = random.Random(4)
    words = "the of tion ing un able  re   straße naïve ; \r\n <s> 12 été жизнь 日 ▁ \t == -- ( ) a b c ab abc bcd theory".split(" ")
    texts = HARD + ["".join(rnd.choice(words) + rnd.choice(["", " ", "  "]) for _ in range(30)) for _ in range(60)]
    texts += ["".join(rnd.choice("abeinrst ") for _ in range(60)) for _ in range(40)]
    p, sp = op11.Prefixes(MODEL), processor()
    steps, first = p.changes(pa.array([*texts, None]))
    for i, t in enumerate(texts):
        got = op11.running(steps[first[i]:first[i + 1]].tobytes())
        assert got.tolist() == [len(sp.encode(t[:k])) for k in range(len(t) + 1)], t
    assert first[-1] == first[-2]


def test_op11_table_answers_and_edges(spark, edge, empty):
    sp, df = processor(), edge.withColumn("uid", F.monotonically_increasing_id())
    table = op11.prefix_table(df, MODEL).cache()
    texts = {r.uid: r.text or "" for r in df.collect()}
    rows = op11.count_at(op11.fit(table, F.lit(37)), F.lit(50)).collect()
    assert len(rows) == len(texts) and set(df.columns) - {"text"} <= set(table.columns)
    for r in rows:
        t = texts[r.uid]
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(sp.encode(t)))
        assert r.tokens_at == len(sp.encode(t[:50]))
        assert len(sp.encode(t[:r.fit_chars])) <= 37 and (r.fit_chars == len(t) or all(len(sp.encode(t[:k])) > 37 for k in range(r.fit_chars + 1, min(len(t), r.fit_chars + 40) + 1)))
    cut = {r.uid: r.text for r in op11.truncated(df, table, "uid", F.lit(37)).collect()}
    assert all((cut[r.uid] or "") == texts[r.uid][:r.fit_chars] for r in rows)
    assert op11.prefix_table(empty, MODEL).count() == 0


def test_op11_memory_begins_anew_with_equal_results(monkeypatch):
    texts = pa.array(["the theory of theories then", "there is the thing"] * 3)
    want = op11.Prefixes(MODEL).changes(texts)
    monkeypatch.setattr(op11, "MEMO", 2)
    monkeypatch.setattr(op11, "PAIRS", 3)
    got = op11.Prefixes(MODEL).changes(texts)
    assert all((a == b).all() for a, b in zip(want, got))


def test_op11_query_against_the_library(spark):
    sp = processor()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op11.op11_prefix_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def by_hand(rows, least, top):
    """Collocations of (text, lang) as the contract words them."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        every = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        inside = defaultdict(int)
        for g, a in every.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[g[i:i + m]] = max(inside[g[i:i + m]], a)
        kept = []
        for g, a in every.items():
            if inside[g] < a:
                score, _, l, r = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
                kept.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def sentences(rnd, n):
    vocab = ["a", "b", "c", "d", "é", "ß", "new", "york", "city", "x", "the"]
    rows = []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 60))]
        if rnd.random() < 0.5:
            w[3:3] = ["New", "York", "Stock", "Exchange", "opens"]
        rows.append(("".join(x + rnd.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n "]) for x in w), rnd.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("   ", "zz"), ("one two three", "one")]


@pytest.mark.parametrize("held,hot", [(600_000, 4096), (50, 3)])
def test_op12_against_brute_force(spark, monkeypatch, held, hot):
    monkeypatch.setattr(op12, "HELD", held)
    monkeypatch.setattr(op12, "HOT", hot)
    monkeypatch.setattr(op12, "SLICE", 2000 if held == 50 else 1 << 20)
    rows = sentences(random.Random(6), 400)
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(1) for c in ("h", "prefix", "next", "phrase", "f", "n", "rank")})
    for top in (2000, 7):
        got = op12.ranked(op12.collocations(df.repartition(5), least=8), top).collect()
        assert sorted(tuple(r) for r in got) == by_hand(rows, 8, top)
    levels, stripes, _ = op12.phrases(df, least=8)
    for own, s in zip(levels, stripes):  # a stripe's total is its prefix's count
        both = own.join(s.groupBy(F.col("prefix").alias("h")).agg(F.sum("total").alias("total")), "h").collect()
        assert len(both) == own.count() and all(r.f == r.total for r in both)


def test_op12_edges(spark, edge, empty):
    rows = [(r.text, r.lang) for r in edge.collect()]
    assert sorted(tuple(r) for r in op12.ranked(op12.collocations(edge, least=2)).collect()) == by_hand(rows, 2, 2000)
    assert op12.collocations(empty).count() == 0
    big = spark.createDataFrame([("x y", 10**12, 10**12 + 7, 10**12 + 9, 2 * 10**13)], "phrase string, a long, l long, r long, n long")
    assert op12.scored(big.withColumns({"ls": F.array("l"), "rs": F.array("r"), "lang": F.lit("en")})).first().score == 1000 * 10**12 * 2 * 10**13 // ((10**12 + 7) * (10**12 + 9))


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(hashes, arity=3):
    """The root of the nodes and, for each, what stands beside it on the way up."""
    at, paths, own = list(hashes), [[] for _ in hashes], list(range(len(hashes)))
    while len(at) > 1:
        for i, o in enumerate(own):
            run = at[o // arity * arity:o // arity * arity + arity]
            paths[i].append(("".join(run[:o % arity]), "".join(run[o % arity + 1:])))
            own[i] = o // arity
        at = [sha(*at[i:i + arity]) for i in range(0, len(at), arity)]
    return at[0], paths


def manifest_by_hand(rows):
    """(doc_id, source, lang, n_chars, text) rows as the contract words it."""
    def leaf(r):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    groups = defaultdict(list)
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        seen = (*r[:4], r[4].replace("\n", "") if even and r[4] is not None else r[4])
        groups[r[1]].append(((r[0] is not None, r[0] or 0), leaf(r), leaf(seen)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: merkle([x[1] for x in sorted(groups[s])]) for s in names}
    root, outer = merkle([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, up in zip(names, outer):
        for ((some, d), own, seen), path in zip(sorted(groups[s]), trees[s][1]):
            now = seen
            for a, b in path + up:
                now = sha(a, now, b)
            out.append((d if some else None, own, trees[s][0], root, sha(*[a + b for a, b in path + up]), now, now == root))
    return out


def none_first(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r))


def manifest_of(docs):
    fields = [F.col(c) for c in op13.FIELDS]
    got = op13.manifest(docs.select("source", F.col("doc_id").alias("key"), op13.leaf(fields).alias("leaf"), op13.leaf([*fields[:-1], op13.tampered(docs)]).alias("seen")))
    return [tuple(r) for r in got.select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


@pytest.mark.parametrize("digits", [6, 1, 2])
def test_op13_against_brute_force(spark, monkeypatch, digits):
    monkeypatch.setattr(op13, "DIGITS", digits)
    rnd = random.Random(digits)
    sizes = {"hot": 100, "one": 1, None: 4, "é": 9, "z": 28, "": 3, "b": 10} if digits < 6 else {"hot": 2300, "one": 1, None: 3, "y": 730, "z": 729}
    rows = []
    for s, n in sizes.items():
        ids = rnd.sample(range(10_000_000), n)
        rows += [(i, s, rnd.choice(["en", None]), rnd.choice([5, None]), rnd.choice(["a\nb", "\n", "x", "", None, "ü\n"])) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert none_first(manifest_of(docs)) == none_first(manifest_by_hand(rows))


def test_op13_many_sources(spark, monkeypatch):
    monkeypatch.setattr(op13, "DIGITS", 2)
    rows = [(i, f"s{i % 40}", "en", 1, "a\nb") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert none_first(manifest_of(docs)) == none_first(manifest_by_hand(rows))


def test_op13_edges(spark, edge, empty):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in edge.collect()]
    assert none_first(manifest_of(edge)) == none_first(manifest_by_hand(rows))
    assert manifest_of(empty) == []
    one = spark.createDataFrame([(8, "s", "en", 3, "a\nb")], "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest_of(one)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("") and got == manifest_by_hand([(8, "s", "en", 3, "a\nb")])


def test_op13_plan_joins_no_leaves_within_blocks(spark):
    """The paths come from exploding: the only joins are with a row a block or a source."""
    rows = [(i, "s", "en", 1, "a") for i in range(50)]
    own = spark.createDataFrame([(r[1], r[0], "h", r[0], 50) for r in rows], "source string, key long, h string, rank long, size long")
    plan = op13._tops(own, "source", ["key"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "Join" not in plan
