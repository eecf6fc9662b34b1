"""Merkle manifest of a dataset: a hash tree for every group of rows and one over the groups' roots.

Slot pivot: the children of a parent are spread into one column for each slot by conditional
aggregates. The parent's digest hashes all slots; what a child's proof needs of its parent are the
same columns without the child's own. Levels shrink by the fanout, so all but the lowest are small.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlab.llm.common import UPPER, need
from barlab.operators.ranking import positions
from barlab.session import materialize

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A row of the table of groups is about 100 bytes; beyond so many it is not broadcast.
BROADCAST_GROUPS = 100_000
PATH = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """Hash of fields: `-` for null, else the count of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def place(leaves: DataFrame) -> DataFrame:
    """Number the leaves of every tree: idx from 0, and n, how many the tree has.

    `leaves` holds tree (never null), sort_key, digest and a struct `node`. Equal keys are ordered by
    digest; rows equal in both are interchangeable, and a number of their own keeps the range sort
    from putting copies of one row into one task.
    """
    kept = materialize(leaves.withColumn("_tie", F.monotonically_increasing_id()), "merkle-leaves")
    placed = positions(kept, [F.col("tree").asc(), F.asc_nulls_first("sort_key"), F.col("digest").asc(), F.col("_tie").asc()], "_all")
    spans = materialize(placed.groupBy("tree").agg(F.min("_all").alias("_first"), F.count(F.lit(1)).alias("n")), "merkle-trees")
    spans = F.broadcast(spans) if spans.count() <= BROADCAST_GROUPS else spans
    return placed.join(spans, "tree").select("tree", (F.col("_all") - F.col("_first")).alias("idx"), "n", "digest", "node")


def grow(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees from the lowest up, and (tree, height, digest) of every root.

    A row of a level is a parent: tree, idx, n (parents of the tree on this level), the slots s0 to
    s7 and their digest. A tree stops where one node remains; a lone leaf is its own root.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0  # one number: leaves of the largest tree
    roots = leaves.where("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    levels, nodes = [], leaves.select("tree", "idx", "n", "node")
    while most > 1:
        rows = nodes.where("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
            F.expr(f"max((n + {FANOUT - 1}) div {FANOUT}) AS n"),
            *[F.expr(f"max(node) FILTER (WHERE idx % {FANOUT} = {k}) AS s{k}") for k in range(FANOUT)])
        rows = materialize(rows.withColumn("digest", F.expr(f"sha2({slots(range(FANOUT))}, 256)")), "merkle-level")
        levels.append(rows)
        roots = roots.unionByName(rows.where("n = 1").select("tree", F.lit(len(levels)).alias("height"), "digest"))
        nodes = rows.select("tree", "idx", "n", F.struct("digest").alias("node"))
        most = -(-most // FANOUT)
    return levels, roots


def slots(which) -> str:
    """The digests in some slots of a parent, joined; an empty slot adds nothing."""
    return f"concat_ws({', '.join(['""', *[f's{k}.digest' for k in which]])})"


def proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every leaf with its path: what lies left and right of it and of its ancestors, lowest first.

    `tops` has tree, height, path (what follows after the tree's root) and any columns that every leaf
    of the tree is to get. Paths go down level by level; only parents' paths are ever shuffled, the
    leaves are unfolded inside their parents' rows.
    """
    more = [c for c in tops.columns if c not in ("tree", "height", "path")]
    known = None
    for height in range(len(levels), 0, -1):
        at = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("bigint").alias("idx"), "path", *more)
        at = at if known is None else at.unionByName(known.drop("node"))
        kids = ", ".join(f"struct({k} AS slot, s{k} AS node, {slots(range(k))} AS left, {slots(range(k + 1, FANOUT))} AS right)" for k in range(FANOUT))
        known = (levels[height - 1].join(at, ["tree", "idx"])
                 .select("tree", "idx", "path", *more, F.expr(f"explode(array({kids}))").alias("kid")).where("kid.node is not null")
                 .select("tree", (F.col("idx") * FANOUT + F.col("kid.slot")).alias("idx"), "kid.node",
                         F.concat(F.array(F.struct("kid.left", "kid.right")), F.col("path")).cast(PATH).alias("path"), *more))
    lone = leaves.where("n = 1").join(tops.where("height = 0").drop("height"), "tree").select("tree", "idx", "node", "path", *more)
    return lone if known is None else known.unionByName(lone)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, the roots above it, its proof, and whether its present text
    still leads to the root.

    A tree per lang (null is a lang of its own, unlike ''), leaves by doc_id: null ids first, equal
    ids by leaf, equal rows in any order, all kept. Where 3 divides the checksum of doc_id the text is
    checked with its capitals lowered, as a tampered copy would be; a null id has no checksum and is
    never tampered with. An empty table gives no rows and no root.
    """
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    whole = [F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(hit, digest(*whole[:-1], lowered(F.col("text"))))
    leaves = need(docs, *FIELDS).select(tree.alias("tree"), "doc_id", digest(*whole).alias("digest"), changed.alias("changed"))
    node = F.struct("doc_id", "digest", F.coalesce("changed", "digest").alias("present"))
    placed = materialize(place(leaves.select("tree", F.col("doc_id").alias("sort_key"), "digest", node.alias("node"))), "merkle-placed")
    levels, roots = grow(placed)

    roots = materialize(roots, "merkle-roots")
    top = materialize(place(roots.select(F.lit("").alias("tree"), F.col("tree").alias("sort_key"), "digest",
                                         F.struct(F.col("tree").alias("of"), "height", "digest").alias("node"))), "merkle-placed")
    top_levels, top_roots = grow(top)
    top_roots = top_roots.select("tree", "height", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    above = proofs(top, top_levels, top_roots).select(
        F.col("node.of").alias("tree"), F.col("node.height").alias("height"), "path", F.col("node.digest").alias("subroot"), "root")

    found = proofs(placed, levels, materialize(above, "merkle-tops"))
    return found.select("node.doc_id", F.col("node.digest").alias("leaf"), "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.col("node.present"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


# The checksum is spelled out bit by bit (polynomial EDB88320): the first of a byte's eight steps takes the byte in.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT *, 4294967295 - list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))) AS crc FROM documents),
h AS (SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head, text,
  coalesce(crc % 3 = 0, false) AS hit FROM d),
l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS present FROM h),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM l),
up AS (SELECT 0 AS level, lang, idx::BIGINT AS idx, n::BIGINT AS n, leaf AS digest FROM p
  UNION ALL SELECT level + 1, lang, idx // 8, max((n + 7) // 8)::BIGINT, sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY level, lang, idx // 8),
sub AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, idx::BIGINT AS idx, n::BIGINT AS n, subroot AS digest FROM sub
  UNION ALL SELECT level + 1, idx // 8, max((n + 7) // 8)::BIGINT, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8),
way AS (SELECT a.lang, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
  FROM up a JOIN up b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL),
topway AS (SELECT a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lft,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rgt
  FROM top a JOIN top b ON a.level = b.level AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL),
climb AS (SELECT p.doc_id, p.lang, p.idx AS own, 0 AS level, p.idx::BIGINT AS idx, p.present AS acc, '' AS proof FROM p
  UNION ALL SELECT doc_id, c.lang, own, c.level + 1, c.idx // 8, sha256(lft || acc || rgt), proof || lft || rgt
  FROM climb c JOIN way w ON c.lang IS NOT DISTINCT FROM w.lang AND c.level = w.level AND c.idx = w.idx),
half AS (SELECT lang, own, max_by(acc, level) AS acc, max_by(proof, level) AS proof FROM climb GROUP BY ALL),
rest AS (SELECT half.lang, own, 0 AS level, s.idx::BIGINT AS idx, acc, proof FROM half JOIN sub s ON half.lang IS NOT DISTINCT FROM s.lang
  UNION ALL SELECT lang, own, r.level + 1, r.idx // 8, sha256(lft || acc || rgt), proof || lft || rgt FROM rest r JOIN topway w ON r.level = w.level AND r.idx = w.idx),
done AS (SELECT lang, own, max_by(acc, level) AS acc, max_by(proof, level) AS proof FROM rest GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(e.proof) AS proof_sha256, e.acc AS folded_root, e.acc = t.digest AS verified
FROM p JOIN done e ON p.lang IS NOT DISTINCT FROM e.lang AND p.idx = e.own JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang
JOIN top t ON t.n = 1"""
