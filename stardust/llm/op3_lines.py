"""Line dedup by a suffix array over the documents' sequences of line ids.

Every line is a 64-bit id (a hash of its bytes). Distributed prefix doubling
ranks all suffixes of the sequences: a suffix has the rank of its first line,
then of its first 2, 4, 8, … lines, each a pair of earlier ranks in one global
order. Suffixes of one rank at depth d are an interval of longest common prefix d
or more: a run of d lines that occurs at each of them. A suffix alone in its
interval is settled and takes no part from then on.

An occurrence after the first, in order of document (``doc_id``, null first, then
text hash) and line, is a later copy. Every line that lies in a repeated run of
``MIN_WORDS`` words or more, of whatever length, that is a later copy goes. Such a run
is the union of the shortest runs of that many words inside it: those that begin at
each of its lines, and those that end there. The shortest runs are known from the text
alone; one of m lines, d <= m < 2 d, is told from others by the ranks at depth d of its
first and of its last d lines: their interval of longest common prefix m. Where later
copies overlap they join to the maximal repeated runs. The suffixes are sorted as deep
as the longest of the shortest runs; deeper ranks would tell nothing more.

A document that loses every line with a word goes as a whole, if asked.

Defined results: a null text has no lines and stays as it is; blank lines are
lines of no words; rows of equal id and text share their result; a very long text is
many lines; an empty table gives an empty result; other columns are passed on. Hot
lines are spread: equal ranks meet in partial aggregates and in joins on one row a rank.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._common import Words, bounded_batches, free_name, mix, prefix_sums, slices

MIN_WORDS = 10
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Lines(Words):
    """The lines of every text, end to end: ``text`` (which one), ``pos``, ``id``, and how
    many lines the shortest run of ``min_words`` words has that begins (``ahead``) and
    that ends (``back``) at each; 0 where the text has none."""

    def __init__(self, arr: pa.Array, min_words: int):
        super().__init__(arr)
        data, off = self.data, self.off
        cut = np.flatnonzero(data == 10)
        some = np.arange(len(off) - 1)
        n = np.searchsorted(cut, off)
        per = np.diff(n) + 1  # an empty text is one empty line
        self.text = np.repeat(some, per)
        first = np.cumsum(per) - per
        self.pos = np.arange(len(self.text)) - np.repeat(first, per)
        begin, end = np.empty(len(self.text), np.int64), np.empty(len(self.text), np.int64)
        begin[first] = off[:-1]
        end[first + per - 1] = off[1:]
        inner = np.flatnonzero(self.pos > 0)
        begin[inner], end[inner - 1] = cut + 1, cut
        # a polynomial in the bytes, from running sums (all modulo 2 ** 64)
        size = end - begin
        power = np.cumprod(np.full(int(size.max(initial=0)) + 1, _BASE, np.uint64), dtype=np.uint64)
        at = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data)))) if len(data) else np.zeros(0, np.int64)
        # a line end itself stands one past its line: it is in no line's sum
        run = np.append(np.uint64(0), np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * power[np.minimum(at, len(power) - 1)], dtype=np.uint64))
        self.id = mix(run[end] - run[begin] + size.astype(np.uint64) * _BASE)
        # words before each line, and after the last
        before = np.searchsorted(self.start, begin)
        total = np.searchsorted(self.start, end)
        stop = np.repeat(first + per, per)
        line = np.arange(len(self.text))
        self.words = total - before
        # the texts' words are numbered on, so one search serves all lines
        to = np.searchsorted(total, before + min_words)
        self.ahead = np.where((to < stop) & (min_words > 0), to - line + 1, 0)
        frm = np.searchsorted(before, total - min_words, "right") - 1
        self.back = np.where((frm >= np.repeat(first, per)) & (total - min_words >= 0), line - frm + 1, 0)


def line_rows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs(doc, text)`` as ``doc, th`` (the text's hash), ``pos, id, ahead, back``, a row
    per line."""
    src = docs.where(F.col("text").isNotNull()).select("doc", F.xxhash64("text").alias("th"), "text")
    names = ["doc", "th", "pos", "id", "ahead", "back"]

    def run(batches):
        for b in slices(batches, "text"):
            x = Lines(b.column("text"), min_words)
            own = pa.array(x.text)
            yield pa.RecordBatch.from_arrays([b.column("doc").take(own), b.column("th").take(own), pa.array(x.pos.astype(np.int32)), pa.array(x.id.view(np.int64)),
                                              pa.array(x.ahead.astype(np.int32)), pa.array(x.back.astype(np.int32))], names=names)

    got = bounded_batches(src).mapInArrow(run, "doc long, th long, pos int, id long, ahead int, back int")
    return materialize(got.dropDuplicates(["doc", "th", "pos"]), "lines-ids")


def intervals(s: DataFrame, depth: int) -> DataFrame:
    """From suffixes ``s(doc, th, pos, a, b)`` of equal first halves ``a`` and second
    halves ``b`` at ``depth`` lines: the suffixes that share theirs with others, with
    the rank of the interval and ``copy`` (not the first)."""
    keys = s.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("doc", "th", "pos")).alias("first")).where("n > 1")
    ranked = prefix_sums(keys, [F.col("a"), F.col("b").asc_nulls_first()], {"rank": "n"}, f"lines-rank{depth}")
    ranked = ranked.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "rank", "first")
    j = s.join(ranked, (F.col("a") == F.col("ra")) & F.col("b").eqNullSafe(F.col("rb")))
    return materialize(j.select("doc", "th", "pos", "rank", (~F.struct("doc", "th", "pos").eqNullSafe(F.col("first"))).alias("copy")), f"lines-depth{depth}")


def _at(level: DataFrame, shift: int, rank: str) -> DataFrame:
    """A level's ranks by the place ``shift`` lines before."""
    return level.select(F.col("doc").alias("d"), F.col("th").alias("t"), (F.col("pos") - shift).alias("p"), F.col("rank").alias(rank))


def _same() -> Column:
    return F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("pos") == F.col("p"))


def suffix_levels(lines: DataFrame, longest: int) -> list[tuple[int, DataFrame]]:
    """The suffixes that share their first 1, 2, 4, … lines with others, a frame
    per depth, up to ``longest`` lines or until none are left."""
    at = intervals(lines.select("doc", "th", "pos", F.col("id").alias("a"), F.lit(0).cast("long").alias("b")), 1)
    levels, depth = [], 1
    while depth <= longest and not at.isEmpty():
        levels.append((depth, at))
        if 2 * depth > longest:
            break
        # a suffix whose second half is settled, or past the end, is settled itself
        s = at.join(_at(at, depth, "b"), _same()).select("doc", "th", "pos", F.col("rank").alias("a"), "b")
        depth *= 2
        at = intervals(s, depth)
    return levels


def later_runs(runs: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """Of ``runs(doc, th, pos, size)`` those that are later copies."""
    found = []
    for depth, level in levels:
        own = runs.where((F.col("size") >= depth) & (F.col("size") < 2 * depth))
        copies = level.where("copy").select(F.col("doc").alias("d"), F.col("th").alias("t"), F.col("pos").alias("p"))
        found.append(own.where(F.col("size") == depth).join(copies, _same(), "left_semi"))
        if depth > 1:
            # the last ``depth`` lines begin where the run's end is ``depth`` away
            odd = own.where(F.col("size") > depth)
            head = odd.join(_at(level, 0, "a"), _same()).drop("d", "t", "p")
            tail = _at(level, 0, "b")
            both = head.join(tail, F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("pos") + F.col("size") - depth == F.col("p"))).drop("d", "t", "p")
            first = both.groupBy("a", "b", "size").agg(F.min(F.struct("doc", "th", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
            first = first.select(F.col("a").alias("fa"), F.col("b").alias("fb"), F.col("size").alias("fs"), "first")
            hit = both.join(first, (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")) & (F.col("size") == F.col("fs")))
            found.append(hit.where(~F.struct("doc", "th", "pos").eqNullSafe(F.col("first"))).select("doc", "th", "pos", "size"))
    return reduce(DataFrame.unionByName, found)


def covered(runs: DataFrame) -> DataFrame:
    """``doc, th, lines`` (the numbers of the lines in a run) and ``longest`` (the most
    neighbouring ones)."""
    spans = runs.groupBy("doc", "th").agg(F.collect_list("pos").alias("pos"), F.collect_list("size").alias("size"))  # at most two a line

    def run(batches):
        for b in batches:
            lines, longest = [], []
            for pos, size in zip(b.column("pos"), b.column("size")):
                pos, size = np.array(pos.as_py(), np.int64), np.array(size.as_py(), np.int64)
                step = np.zeros(int((pos + size).max()) + 1, np.int64)
                np.add.at(step, pos, 1)
                np.add.at(step, pos + size, -1)
                at = np.flatnonzero(np.cumsum(step) > 0)
                lines.append(at)
                gap = np.flatnonzero(np.diff(at) > 1)
                longest.append(int(np.diff(np.concatenate([[-1], gap, [len(at) - 1]])).max()))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("th"), pa.array(lines, pa.list_(pa.int32())), pa.array(longest, pa.int32())], names=["doc", "th", "lines", "longest"])

    return bounded_batches(spans).mapInArrow(run, "doc long, th long, lines array<int>, longest int")


def dedup_lines(df: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False, key: str = "doc_id") -> DataFrame:
    """Every row of ``df`` (with ``text``) without its later copies of line runs,
    with ``n_lines``, ``n_removed`` and ``longest_run`` (the most neighbouring lines that
    go) added under free names."""
    names = [free_name(df, n) for n in ("n_lines", "n_removed", "longest_run")]
    lines = line_rows(df.select(F.col(key).cast("long").alias("doc"), F.col("text").alias("text")), min_words)
    longest = lines.agg(F.max(F.greatest("ahead", "back"))).first()[0] or 0
    levels = suffix_levels(lines, longest)
    if not levels:
        gone = df.sparkSession.createDataFrame([], "doc long, th long, lines array<int>, longest int")
    else:
        ahead = lines.where("ahead > 0").select("doc", "th", "pos", F.col("ahead").alias("size"))
        back = lines.where("back > 0").select("doc", "th", (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("size"))
        # a run of one line begins and ends there
        gone = materialize(covered(later_runs(ahead.unionByName(back.where("size > 1")), levels)), "lines-gone")
    # What goes grows with the documents: the texts meet it by a shuffle at every size.
    gone = gone.hint("merge")
    j = df.join(gone, F.xxhash64(df["text"]).eqNullSafe(gone["th"]) & df[key].cast("long").eqNullSafe(gone["doc"]), "left")
    none = F.array().cast("array<int>")
    parts = F.split(df["text"], "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.coalesce(gone["lines"], none))
    left = F.transform(stay, lambda i: F.get(parts, i))
    new = F.when(gone["lines"].isNull(), df["text"]).otherwise(F.array_join(left, "\n"))
    out = j.select(*[(new.alias(c) if c == "text" else df[c]) for c in df.columns], F.coalesce(F.size(parts), F.lit(0)).alias(names[0]),
                   F.coalesce(F.size(gone["lines"]), F.lit(0)).alias(names[1]), F.coalesce(gone["longest"], F.lit(0)).alias(names[2]))
    if drop_emptied:
        out = out.where((F.col(names[1]) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out


def op3_lines(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = dedup_lines(docs)
    return got.select("doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"), F.col("longest_run").cast("long"),
                      F.length("text").cast("long").alias("kept_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
