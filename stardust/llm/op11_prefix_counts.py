"""Token counts of every prefix of a text, by dynamic programming over prefixes.

A byte-pair vocabulary encodes by merging neighbours, best score first, the
leftmost of equal ones. Whether two tokens may stand side by side depends on the
two alone: they may when their joined text is encoded as these two. And a sequence
of tokens is the encoding of its text exactly when all neighbours in it may stand
side by side. So the encoding of a prefix that ends at ``i`` is that of the prefix
that ends at ``j``, then a token from ``j`` to ``i``, for the one ``j`` where that
token may follow the last one of prefix ``j``: ``count[i] = count[j] + 1``. One
pass gives the exact count of every prefix; nothing is encoded again afterwards.

No token reaches over two characters that stand side by side in no token of the
vocabulary; there the counting begins anew (``Prefixes.cuts``). The pieces between
such places repeat a lot: a worker counts each distinct one once.

``prefix_table`` keeps, for every row, how much the count changes with each
character (a byte each); ``count_at``, ``fit`` and ``truncated`` answer from it how
many tokens a prefix has and which longest prefix stays within a budget. Counts are
those of ``sentencepiece`` without control tokens: a blank before the text, blanks
and U+2581 alike, a character outside the vocabulary as its bytes.

Defined results: a null or empty text has no tokens (null has a null prefix
table, counted as empty); a very long text is one row, whose working arrays are a
small multiple of it; rows that repeat are rows of their own; an empty table gives
an empty result; other columns are passed on unless they have the name of a result
column.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ._common import bounded_batches, slices, text_bytes

LIMIT = 4096
SLICE = 2 << 20        # bytes of text counted at once
MEMO = 400_000         # distinct pieces that a worker remembers, then it begins anew
LONG = 64              # bytes of a piece beyond which it is not remembered
PAIRS = 400_000        # pairs of neighbours that it remembers
OUT = ("n_bytes", "n_tokens", "prefix")
BLANK = "▁"


class Prefixes:
    """Prefix counts with the vocabulary of a ``sentencepiece`` BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        if sp.decode(sp.encode("ﬁ  x ")) != "ﬁ  x ":
            raise ValueError("the model changes texts before it encodes them; only models without normalisation are counted")
        own = {sp.id_to_piece(i).replace(BLANK, " "): sp.get_score(i) for i in own}
        self.score, self.number, self.tokens = own, {t: n for n, t in enumerate(own, 1)}, ["", *own]
        sizes: dict[str, set[int]] = {}
        self.joined = np.zeros((256, 256), bool)  # bytes on either side of a place inside a token
        for t in own:
            if len(t) > 2:
                sizes.setdefault(t[-3:], {1, 2}).add(len(t))
            for a, b in zip(t, t[1:]):
                self.joined[a.encode()[-1], b.encode()[0]] = True
        # by the last three characters, the lengths of tokens that may end there, longest first
        self.sizes = {k: tuple(sorted(v, reverse=True)) for k, v in sizes.items()}
        self.pairs: dict[int, bool] = {}
        self.known: dict[bytes, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text by the merges themselves."""
        parts, score = list(text), self.score.get
        near = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, s in enumerate(near):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del near[at]
            if at < len(near):
                near[at] = score(parts[at] + parts[at + 1])
            if at:
                near[at - 1] = score(parts[at - 1] + parts[at])

    def text_of(self, n: int) -> str:
        return self.tokens[n] if n >= 0 else chr(~n)

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` may stand after token ``a`` (0: at the start)."""
        key = a << 32 | b & 0xFFFFFFFF
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            x, y = self.text_of(a), self.text_of(b)
            ok = self.pairs[key] = self.merged(x + y) == ([x, y] if x else [y])
        return ok

    def counts(self, piece: str) -> list[int]:
        """The number of tokens of every prefix of ``piece``, of no character first."""
        count, last = [0], [0]
        self.carry_on(piece, count, last)
        return count

    def carry_on(self, piece: str, count: list[int], last: list[int]) -> None:
        """Adds to ``count`` and ``last`` (the tokens' numbers) what the prefixes of
        ``piece`` longer than those in them have."""
        number, sizes, pairs = self.number.get, self.sizes.get, self.pairs.get
        for i in range(len(count), len(piece) + 1):
            for n in sizes(piece[i - 3:i], (2, 1)) if i > 2 else (2, 1):
                if n > i:
                    continue
                t = piece[i - n:i]
                b = number(t)
                if b is None:
                    if n > 1:
                        continue
                    b = ~ord(t)  # a character outside the vocabulary
                a = last[i - n]
                ok = pairs(a << 32 | b & 0xFFFFFFFF)
                if self.follows(a, b) if ok is None else ok:
                    count.append(count[i - n] + (1 if b > 0 else len(t.encode())))
                    last.append(b)
                    break
            else:
                raise AssertionError(f"no token ends at character {i} of {piece!r}")

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where the pieces begin (bytes), and the end."""
        begin = np.zeros(len(data), bool)
        if len(data):
            begin[1:] = ~self.joined[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80)
            begin[off[off < len(data)]] = True
        return np.append(np.flatnonzero(begin), len(data))

    def steps(self, pieces: list[bytes]) -> list[bytes]:
        """How the count changes with each character of every piece (signed bytes): it
        falls by less than a token's characters in bytes, so it fits. New pieces are
        counted in order, each from the prefix it shares with the one before it on."""
        new = sorted(x.decode() for x in pieces if x not in self.known)
        if len(self.known) + len(new) > MEMO:
            self.known.clear()
            new = sorted(x.decode() for x in pieces)
        got, before, count, last = {}, "", [0], [0]
        for piece in new:
            same = 0
            for x, y in zip(piece, before):
                if x != y:
                    break
                same += 1
            del count[same + 1:], last[same + 1:]
            self.carry_on(piece, count, last)
            before, key = piece, piece.encode()
            own = bytes([b - a & 0xFF for a, b in zip(count, count[1:])])
            (self.known if len(key) <= LONG else got)[key] = own
        known = self.known
        return [known.get(x) or got[x] for x in pieces]

    def changes(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of all texts end to end, how the count changes with each character, and
        where each text's characters begin (one more)."""
        arr = pc.replace_substring(arr.cast(pa.large_string()).fill_null(""), BLANK, " ")
        some = pc.not_equal(pc.binary_length(arr), 0)
        arr = pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), arr, pa.scalar("", pa.large_string())), arr)
        data, off = text_bytes(arr)
        at = self.cuts(data, off)
        if len(at) < 2:
            return np.zeros(0, np.int8), np.zeros(len(off), np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        pool = self.steps(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, pool), np.int64, len(pool))
        flat, begin = np.frombuffer(b"".join(pool), np.int8), np.cumsum(size) - size
        which = coded.indices.to_numpy()
        take = size[which]
        ends = np.cumsum(take)
        steps = flat[np.arange(int(ends[-1])) + np.repeat(begin[which] - (ends - take), take)]
        first = np.append(0, ends)[np.searchsorted(at[:-1], off)]
        # the blank before a text is no character of it: its token counts with the first
        lead = first[:-1][np.diff(first) > 0]
        steps[lead + 1] += steps[lead]
        return np.delete(steps, lead), first - np.searchsorted(lead, first)


@lru_cache(maxsize=1)
def prefixes(path: str) -> Prefixes:
    """The worker's counter: what it has met serves the tasks that come after."""
    return Prefixes(path)


def prefix_table(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Every row of ``df``, without its text, with ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``prefix``; written once to the shared folder."""
    kept = [c for c in df.columns if c.lower() not in OUT and c != text]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    out = T.StructType([src.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("prefix", T.BinaryType())])

    def run(batches):
        p = prefixes(model)
        for b in slices(batches, "text", SLICE):
            steps, first = p.changes(b.column("text"))
            whole = np.append(0, np.cumsum(steps, dtype=np.int64))[first]
            own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(first.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(steps))])
            own = pc.if_else(b.column("text").is_valid(), own.cast(pa.binary()), pa.scalar(None, pa.binary()))
            n_bytes = pc.binary_length(b.column("text")).cast(pa.int64()).fill_null(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), n_bytes, pa.array(np.diff(whole)), own], names=out.names)

    got = bounded_batches(src).mapInArrow(run, out)
    return materialize(got.select(*[F.col("row")[c].alias(c) for c in kept], *OUT), "prefix-counts")


def running(raw: bytes) -> np.ndarray:
    """The count of every prefix, of no character first, from a row's ``prefix``."""
    return np.append(0, np.cumsum(np.frombuffer(raw or b"", np.int8), dtype=np.int64))


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def _asked(table: DataFrame, name: str, answer, arg: Column) -> DataFrame:
    """``table`` with a long column ``name``: ``answer(counts, arg)`` row by row."""
    src = table.select(F.struct(*[F.col(f"`{c}`") for c in table.columns if c != name]).alias("row"), arg.cast("long").alias("arg"))
    out = T.StructType([src.schema["row"], T.StructField(name, T.LongType())])

    def run(batches):
        for b in batches:
            got = [answer(running(raw.as_py()), a) for raw, a in zip(b.column("row").field("prefix"), b.column("arg").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(got, pa.int64())], names=out.names)

    return bounded_batches(src).mapInArrow(run, out).select("row.*", name)


def count_at(table: DataFrame, chars: Column, name: str = "tokens_at") -> DataFrame:
    """The tokens of each row's first ``chars`` characters (all, if it has fewer; none
    for a null or negative number)."""
    return _asked(table, name, lambda counts, k: int(counts[min(max(0, k or 0), len(counts) - 1)]), chars)


def fit(table: DataFrame, budget: Column, name: str = "fit_chars") -> DataFrame:
    """The characters of each row's longest prefix of at most ``budget`` tokens (a
    null budget: 0 tokens). Counts may fall as a text goes on, so the longest counts."""
    return _asked(table, name, lambda counts, most: longest_within(counts, max(0, most or 0)), budget)


def truncated(df: DataFrame, table: DataFrame, key: str, budget: Column, text: str = "text") -> DataFrame:
    """``df`` with its texts cut to the longest prefix within the budget. ``key`` names
    a column without repeats in both."""
    cut = fit(table, budget, "_fit").select(F.col(key).alias("_of"), "_fit")
    j = df.join(cut, df[key].eqNullSafe(cut["_of"]))
    return j.select(*[F.substring(df[c], F.lit(1), F.col("_fit").cast("int")).alias(c) if c == text else df[c] for c in df.columns])


def op11_prefix_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    table = prefix_table(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return fit(table, F.lit(LIMIT)).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
