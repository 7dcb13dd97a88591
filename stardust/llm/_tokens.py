"""Whole texts to token ids with a tokenizer file of the ``tokenizers`` library,
encoding every distinct piece of a batch once.

A text is cut before each run of ASCII blanks that follows a non-blank. No
pre-tokenizer rule of the two byte-level vocabularies used here reaches across
such a cut (their rules keep a run of blanks with what follows it, or drop it),
nor across one between an ASCII letter and a stop or comma, which is made too;
so the ids of the pieces, put end to end, are the ids of the whole text. There
is no cut where the character before might be a blank outside ASCII.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._common import _BASE, _BLANK, mix, text_bytes


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_LEAD = np.zeros(256, bool)  # lead bytes of characters that hold a blank outside ASCII
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[list(b".,!?;:")] = True


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts begin, and the end."""
    blank = _BLANK[data]
    begin = blank.copy()
    if len(data):
        begin[0] = False
        begin[1:] &= ~blank[:-1]
        at = np.flatnonzero(begin)
        odd = data[at - 1] >= 0x80  # rare: look at the character's lead byte
        bad = odd & (_LEAD[data[np.maximum(at - 2, 0)]] & (data[np.maximum(at - 2, 0)] == 0xC2) | _LEAD[data[np.maximum(at - 3, 0)]])
        begin[at[bad]] = False
        begin[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
        begin[off[off < len(data)]] = True
    return np.append(np.flatnonzero(begin), len(data))


MEMO_BYTES = 32 << 20  # of pieces and their ids that a worker keeps, the first it meets
SLICE = 2 << 20        # bytes of text encoded at once
SEPARATOR = "<|endoftext|>"  # an added token of both vocabularies: texts are encoded apart on either side of it
JOINED = 64
AT_ONCE = 128  # joined texts given to the tokenizer in a call: its results are objects of many bytes a token


def _encode(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces end to end, and each piece's number of ids. Pieces go
    to the tokenizer ``JOINED`` at a time with the separator token between them;
    those that hold the start of an added token (all of a call, or none) go alone."""
    tk = tokenizer(path)
    mark = tk.token_to_id(SEPARATOR)
    if mark is None or "<|" in pieces[0]:
        parts = [np.array(g.ids, np.uint32) for g in tk.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    texts = [SEPARATOR.join(pieces[i:i + JOINED]) + SEPARATOR for i in range(0, len(pieces), JOINED)]
    flat = np.concatenate([np.array(g.ids, np.uint32) for i in range(0, len(texts), AT_ONCE)
                           for g in tk.encode_batch_fast(texts[i:i + AT_ONCE], add_special_tokens=False)])
    stop = np.flatnonzero(flat == mark)
    return flat[flat != mark], np.diff(stop, prepend=-1) - 1


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first bytes of a word of eight


def keys(pieces: pa.LargeBinaryArray) -> np.ndarray:
    """64 bits of each piece: its first and last eight bytes and its length, mixed."""
    off = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
    data = np.append(np.frombuffer(pieces.buffers()[2], np.uint8)[off[0]:off[-1]], np.zeros(8, np.uint8))
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each place on
    begin, size = off[:-1] - off[0], np.diff(off)
    some = np.minimum(size, 8)
    return mix(mix(words[begin] & _KEEP[some]) + (words[begin + size - some] & _KEEP[some]) * _BASE + size.astype(np.uint64))


class Encoder:
    """Encodes Arrow string arrays."""

    def __init__(self, path: str):
        self.path = path
        self.known = pa.array([], pa.large_binary())
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # in the order of the keys
        self.ids, self.begin, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _find(self, uniq: pa.Array, key: np.ndarray) -> np.ndarray:
        """Where each piece is in what is known, or -1: the first of its key, if it is the piece."""
        at = np.full(len(uniq), -1, np.int64)
        if len(self.keys):
            order = np.argsort(key)
            i = np.empty(len(key), np.int64)
            i[order] = np.searchsorted(self.keys, key[order])
            i = np.minimum(i, len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[i] == key)
            own = self.place[i[hit]]
            same = pc.equal(uniq.take(pa.array(hit)), self.known.take(pa.array(own))).to_numpy(zero_copy_only=False)
            at[hit[same]] = own[same]
        return at

    def _pieces(self, uniq: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A pool of ids, and for each piece where its ids begin there and how many they are."""
        key = keys(uniq)
        at = self._find(uniq, key)
        new = np.flatnonzero(at < 0)
        ids, begin, sizes = self.ids, self.begin, self.sizes
        if len(new):
            fresh = uniq.take(pa.array(new))
            texts = fresh.cast(pa.large_string()).to_pylist()
            odd = np.fromiter(("<|" in x for x in texts), bool, len(texts))
            parts = []
            for group in (np.flatnonzero(~odd), np.flatnonzero(odd)):
                if len(group):
                    parts.append((group, *_encode(self.path, [texts[i] for i in group])))
            order = np.concatenate([p[0] for p in parts])
            more = np.concatenate([p[2] for p in parts])
            place = len(sizes) + np.arange(len(order))
            at[new[order]] = place
            begin = np.concatenate([begin, len(ids) + np.cumsum(more) - more])
            ids, sizes = np.concatenate([ids, *[p[1] for p in parts]]), np.concatenate([sizes, more])
            if self.known.nbytes + fresh.nbytes + ids.nbytes + 32 * len(sizes) <= MEMO_BYTES:
                self.known = pa.concat_arrays([self.known, fresh.take(pa.array(order))])
                self.ids, self.begin, self.sizes = ids, begin, sizes
                key = key[new[order]]
                by = np.argsort(key)
                to = np.searchsorted(self.keys, key[by])
                self.keys, self.place = np.insert(self.keys, to, key[by]), np.insert(self.place, to, place[by])
        return ids, begin[at], sizes[at]

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end (uint32), and where each text's begin (one more)."""
        data, off = text_bytes(arr)
        at = cuts(data, off)
        n = len(at) - 1
        if n <= 0:
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        ids, begin, sizes = self._pieces(coded.dictionary)
        take = sizes[which]
        ends = np.cumsum(take)
        total = int(ends[-1])
        place = np.arange(total) + np.repeat(begin[which] - (ends - take), take)
        first = np.searchsorted(at[:-1], off)  # each text's first piece
        return ids[place], np.concatenate([[0], ends])[first]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder: what it has met, ``MEMO_BYTES`` of it, serves the tasks
    that come after; that of another vocabulary takes its place."""
    return Encoder(path)
