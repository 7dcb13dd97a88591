import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stardust.llm import _common as C
from stardust.llm._tokens import Encoder, tokenizer


def find(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, x) for x in range(501, 560)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)] + [(7, 7)]
    got = C.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = find([(a, b) for a, b in edges if a != b])
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_sums(spark):
    rows = [(i * 7919 % 1000, i % 5) for i in range(1000)]
    got = C.prefix_sums(spark.createDataFrame(rows, "k long, v long"), [F.col("k")], {"before": "v"}, "t").collect()
    at = 0
    for r in sorted(got, key=lambda r: r.k):
        assert r.before == at
        at += r.v
    assert at == sum(v for _, v in rows)


def test_words_and_shingles():
    texts = ["", None, " a\tbb  c\n", "x", "é ü\x0bz", "a bb c", "A BB C"]
    w = C.Words(pa.array(texts))
    assert np.diff(w.first).tolist() == [0, 0, 3, 1, 3, 3, 3]
    s, first = w.shingles(2)
    assert np.diff(first).tolist() == [0, 0, 2, 1, 2, 2, 2]
    assert s[first[2]:first[3]].tolist() == s[first[5]:first[6]].tolist() != s[first[6]:first[7]].tolist()
    f = C.Words(pa.array(texts), fold_ascii=True)
    assert f.hash[f.first[5]:f.first[6]].tolist() == f.hash[f.first[6]:f.first[7]].tolist()


def test_pieces_give_the_ids_of_the_whole_text():
    import public_tokenizers as P
    texts = ["", None, " ", "a  b", " a ", "a\n\n b", "x  y", "  x  y", "é  é ", "é b", "<|endoftext|> a<|endoftext|>b <|x|>", "it's 'til  's", "á ́c",
             "\tfoo\r\n bar\x0b\x0c", "ΑΣ ΣΑΣ.", "123 456", "İ i", "日本 語", "\x85 a", "a\x1c b", "!!! ...", "a.b,c;;d é, €, x.!y", "don.t 's.a", "a\x00 b", "　 　x"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e, tk = Encoder(P.path(name)), tokenizer(P.path(name))
        for _ in range(2):  # the second time from memory
            ids, off = e.encode(pa.array(texts))
            for i, t in enumerate(texts):
                assert ids[off[i]:off[i + 1]].tolist() == tk.encode(t or "", add_special_tokens=False).ids, (name, t)


def test_memory_of_a_worker_is_bounded(spark, monkeypatch):
    import public_tokenizers as P

    from stardust.llm import _tokens, op4_langid
    batch = pa.RecordBatch.from_arrays([pa.array(["hello"] * 10_000)], names=["text"])
    cut = list(C.slices([batch], "text", 1 << 20, most_rows=op4_langid.ROWS))
    assert sum(b.num_rows for b in cut) == 10_000 and max(op4_langid.vectors(b.column("text")).nbytes for b in cut) <= 8 << 20
    monkeypatch.setattr(_tokens, "MEMO_BYTES", 4000)
    e, tk = Encoder(P.path("byte_bpe_50k.json")), tokenizer(P.path("byte_bpe_50k.json"))
    for k in range(8):
        texts = [f"word{i} then {i}" for i in range(100 * k, 100 * k + 100)]
        ids, off = e.encode(pa.array(texts))
        assert [ids[off[i]:off[i + 1]].tolist() for i in range(100)] == [tk.encode(t).ids for t in texts]
        assert e.known.nbytes + e.ids.nbytes + e.sizes.nbytes <= 4000
    df = spark.createDataFrame([("x" * 1000,)] * 30_000, "text string").coalesce(1)
    sizes = C.bounded_batches(df).mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in bs), "n long").collect()
    assert max(r.n for r in sizes) * 1000 <= 9 << 20


def test_encoder_tells_apart_pieces_of_one_key():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"abcdefgh{x}ijklmnop {x}abcdefgh" for x in ("one", "two", "six")] + ["", "a", "éè <|endoftext|> a"]
    enc = Encoder(path)
    for own in (texts[:1], texts, texts[::-1], texts):  # the first of a key is known from then on
        ids, off = enc.encode(pa.array(own))
        for i, t in enumerate(own):
            assert ids[off[i]:off[i + 1]].tolist() == tokenizer(path).encode(t, add_special_tokens=False).ids
