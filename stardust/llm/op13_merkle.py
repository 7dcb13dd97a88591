"""A Merkle manifest of a dataset by nested-struct rollup.

Every row is a leaf; the leaves of a source stand in order of their key. A leaf's
rank is written in digits of base ``ARITY``. Leaves meet in blocks of ``ARITY **
DIGITS`` ranks, and inside a block the digit columns are grouped away one after the
other: a group's rows become an array of structs (digit, hash, what they nest), and
their hashes in order the group's hash. All groupings of a block follow its one
shuffle. A block ends as one row that nests its whole tree; exploding it digit by
digit, with what stands left and right of each child, gives every leaf its path
without a join.

Blocks are bounded, so a hot source is many blocks. The block roots of a source are
the leaves of the next tier of blocks, and so on; the sources' roots are a group of
their own. A tier's paths are handed down to the rows of the blocks below it (a row
a block), never to leaves.

While several nodes remain, every ``ARITY`` consecutive ones become the hash of
their hashes end to end; a last run of fewer, even of one, too. A lone leaf is the
root itself.

Defined results: a null value is ``-`` in a leaf; a null key comes first, a null
source too; rows of equal source and key stand in order of their leaves; rows that
repeat are leaves of their own; a row with a null key is not tampered with; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._common import prefix_sums

ARITY = 3
DIGITS = 6  # of a block: 729 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(values: list[Column]) -> Column:
    """The hash of a row: each value with its UTF-8 length, ``-`` where null."""
    def one(c: Column) -> Column:
        t = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))

    return digest(*[one(c) for c in values])


def ranked(leaves: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """``leaves`` with ``rank`` (from 0, in its group) and ``size`` (of the group)."""
    at = prefix_sums(leaves.withColumn("one", F.lit(1).cast("long")), [F.col(group).asc_nulls_first(), *order], {"at": "one"}, label)
    at = materialize(at.drop("one"), f"{label}-placed")
    first = at.groupBy(F.col(group).alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    return at.join(first, F.col(group).eqNullSafe(F.col("of"))).withColumn("rank", F.col("at") - F.col("first")).drop("of", "at", "first")


def _tops(nodes: DataFrame, group: str, payload: list[str], label: str, tier: int = 0) -> DataFrame:
    """Of ``nodes(group, rank, size, h, *payload)``, each with ``top`` (its group's root)
    and ``path``: from the leaf up, what stands ``left`` and ``right`` of the node that
    holds it (their hashes end to end)."""
    block = ARITY**DIGITS
    digit = [F.pmod(F.floor(F.col("rank") / F.lit(ARITY**i)), F.lit(ARITY)).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    at = nodes.select(group, "size", F.floor(F.col("rank") / block).alias("block"), *digit, "h", F.struct(*payload).alias("nested") if payload else F.lit(0).alias("nested"))
    at = at.repartition(group, "block")
    for i in range(DIGITS):
        keys = [group, "block", "size", *[f"d{j}" for j in range(i + 1, DIGITS)]]
        at = at.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(f"d{i}", "h", "nested"))).alias("nested"))
        hashes = F.transform("nested", lambda x: x["h"])
        # a group of one node at this height is done: its root goes up as it is
        at = at.withColumn("h", F.when(F.col("size") > ARITY**i, digest(F.array_join(hashes, ""))).otherwise(hashes[0]))
    trees = materialize(at, f"{label}-blocks{tier}")
    above = trees.select(group, F.col("block").alias("rank"), F.ceil(F.col("size") / block).alias("size"), "h")
    if trees.where(F.col("size") > block).isEmpty():
        tops = trees.select("*", F.col("h").alias("top"), F.array().cast("array<struct<left: string, right: string>>").alias("path"))
    else:
        up = _tops(above, group, [], label, tier + 1).select(F.col(group).alias("of"), F.col("rank").alias("at"), "top", "path")
        tops = trees.join(up, F.col(group).eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at")
    out = tops.withColumn("rank", F.col("block"))
    for i in reversed(range(DIGITS)):
        def child(x, k):
            before, after = F.slice("nested", F.lit(1), k), F.slice("nested", k + 2, F.lit(ARITY))
            beside = F.struct(F.array_join(F.transform(before, lambda y: y["h"]), "").alias("left"), F.array_join(F.transform(after, lambda y: y["h"]), "").alias("right"))
            return F.struct(x[f"d{i}"].alias("d"), x["h"].alias("h"), x["nested"].alias("nested"), beside.alias("beside"))

        kids = out.select(group, "size", "rank", "top", "path", F.explode(F.transform("nested", child)).alias("c"))
        path = F.when(F.col("size") > ARITY**i, F.concat(F.array("c.beside"), "path")).otherwise(F.col("path"))
        out = kids.select(group, "size", (F.col("rank") * ARITY + F.col("c.d")).alias("rank"), "top", path.alias("path"), "c.h", "c.nested")
    return out.select(group, "rank", "size", "h", "top", "path", *[F.col(f"nested.{c}").alias(c) for c in payload])


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path lead to."""
    return F.aggregate(path, start, lambda h, x: digest(x["left"], h, x["right"]))


def manifest(leaves: DataFrame) -> DataFrame:
    """Of ``leaves(source, key, leaf, seen)`` (``seen``: the leaf as found now), each with
    ``subroot``, ``root``, ``path`` (to the root), ``proof_sha256`` (of the path's hashes,
    left to right), ``folded_root`` and ``verified``."""
    own = ranked(leaves.select("source", "key", F.col("leaf").alias("h"), "seen"), "source", [F.col("key").asc_nulls_first(), F.col("h"), F.col("seen")], "merkle-leaves")
    own = _tops(own, "source", ["key", "seen"], "merkle").withColumnRenamed("top", "subroot").withColumnRenamed("path", "inner")
    own = materialize(own, "merkle-paths")
    # the sources' roots are the nodes of one more group
    subs = own.groupBy("source").agg(F.min("subroot").alias("h")).withColumn("all", F.lit(0))
    subs = ranked(subs, "all", [F.col("source").asc_nulls_first()], "merkle-sources")
    roots = _tops(subs, "all", ["source"], "merkle-top").select(F.col("source").alias("of"), F.col("top").alias("root"), F.col("path").alias("outer"))
    got = own.join(roots, F.col("source").eqNullSafe(F.col("of"))).withColumn("path", F.concat("inner", "outer"))
    beside = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    got = got.select("source", "key", F.col("h").alias("leaf"), "subroot", "root", "path", digest(beside).alias("proof_sha256"), folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame) -> Column:
    """The text of a document as the check finds it: without line ends where 2 divides
    the key's checksum."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = [F.col(c) for c in FIELDS]
    leaves = docs.select(F.col("source"), F.col("doc_id").cast("long").alias("key"), leaf(fields).alias("leaf"), leaf([*fields[:-1], tampered(docs)]).alias("seen"))
    got = manifest(leaves)
    return got.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# DuckDB has no crc32: its register runs over the digits' bits; the checksum's last bit
# is that of the register turned over.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda r, x: xor(xor(r, x) >> 1, 3988292384 * (xor(r, x) & 1))) & 1 = 1 AS even FROM documents),
e AS (SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS now FROM d),
f AS (
  SELECT doc_id, source,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS own, coalesce(strlen(now) || ':' || now, '-') AS late FROM e),
l AS (SELECT doc_id, source, sha256(head || own) AS leaf, sha256(head || late) AS seen FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, seen) - 1 AS nth, count(*) OVER (PARTITION BY source) AS n FROM l),
t AS (
  SELECT 0 AS lvl, source, nth AS i, leaf AS h, n FROM k
  UNION ALL
  SELECT lvl + 1, source, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY lvl, source, i // 3, n),
r AS (SELECT lvl, source, i // 3 AS r, list(h ORDER BY i) AS hs FROM t WHERE n > 1 GROUP BY ALL),
p AS (
  SELECT 0 AS lvl, source, nth, nth AS i, '' AS beside, seen AS h FROM k
  UNION ALL
  SELECT p.lvl + 1, p.source, nth, i // 3, beside || array_to_string(hs[1:i % 3], '') || array_to_string(hs[i % 3 + 2:], ''),
    sha256(array_to_string(hs[1:i % 3], '') || h || array_to_string(hs[i % 3 + 2:], '')) FROM p JOIN r ON r.lvl = p.lvl AND r.source IS NOT DISTINCT FROM p.source AND r.r = i // 3),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS nth, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, nth AS i, subroot AS h, n FROM s
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3, n),
v AS (SELECT lvl, i // 3 AS r, list(h ORDER BY i) AS hs FROM u WHERE n > 1 GROUP BY ALL),
q AS (
  SELECT 0 AS lvl, k.source, k.nth, s.nth AS i, beside, p.h FROM k JOIN s ON s.source IS NOT DISTINCT FROM k.source
    JOIN p ON p.source IS NOT DISTINCT FROM k.source AND p.nth = k.nth QUALIFY p.lvl = max(p.lvl) OVER (PARTITION BY k.source)
  UNION ALL
  SELECT q.lvl + 1, source, nth, i // 3, beside || array_to_string(hs[1:i % 3], '') || array_to_string(hs[i % 3 + 2:], ''),
    sha256(array_to_string(hs[1:i % 3], '') || h || array_to_string(hs[i % 3 + 2:], '')) FROM q JOIN v ON v.lvl = q.lvl AND v.r = i // 3),
z AS (SELECT * FROM q WHERE lvl = (SELECT max(lvl) FROM u))
SELECT k.doc_id, k.leaf, s.subroot, u.h AS root, sha256(beside) AS proof_sha256, z.h AS folded_root, z.h = u.h AS verified
FROM z JOIN k ON k.source IS NOT DISTINCT FROM z.source AND k.nth = z.nth JOIN s ON s.source IS NOT DISTINCT FROM z.source JOIN u ON u.n = 1
"""
