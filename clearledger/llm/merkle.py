"""Merkle manifest of a table: a content-addressed tree of digests, and inclusion proofs found by descent from the root.

Rows become leaves; within a tree, leaves in order are joined in runs of FAN, run by run and level by level, until one node stays. The trees'
roots are the leaves of one tree more, whose root stands for the whole table. Each inner node is a record from its digest to its children's
digests, kept by level. A request for a leaf starts at the root and takes the child that the next base-FAN digit of its rank names; what it
leaves unselected is that level's segment of the path, and the segments, reversed, are the proof from the leaf upwards. Requests with a
common way down go it together, so a level is two equality joins over an FAN-th of the rows of the level below, and no key is shared by all requests.

Rows: null columns are framed apart from empty ones. Rows with a null id come first in their tree; equal ids are ordered by their leaf, and equal
leaves take neighbouring places, each with its own proof. Rows with a null tree name make a tree of their own, before all others. An empty table
has no rows in the result. Texts of any length are hashed whole. Further columns are not hashed and don't matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fold, materialise

BITS = 3
FAN = 1 << BITS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


@dataclass(frozen=True)
class Forest:
    """levels[k]: (tree, pos, n, digest, children) of the nodes k levels above the leaves, n of them in the tree; roots: (tree, digest, depth)."""

    levels: list[DataFrame]
    roots: DataFrame


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _above(n: str = "n") -> Column:
    return F.shiftright(F.col(n) + (FAN - 1), BITS)


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """leaves (tree, ...) with pos, the place in the tree by `order` from 0, and n, the tree's number of leaves.

    One range sort over all trees, which is written; places in a written partition, and an offset for each tree in each partition. Rows that are
    equal in `order` are told apart by where they were read, so that many equal rows are no single partition either.
    """
    parts = max(int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = ["tree", *order, "_row"]
    told = leaves.withColumn("_row", F.monotonically_increasing_id())
    placed = told.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, "ranked").withColumn("_part", F.shiftright("_at", 33))
    of = W.partitionBy("tree")
    before = F.sum("_count").over(of.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    runs = placed.groupBy("tree", "_part").agg(F.count("*").alias("_count")).select("tree", "_part", F.coalesce(before, F.lit(0)).alias("_skip"), F.sum("_count").over(of).alias("n"))
    inside = placed.withColumn("_in", F.row_number().over(W.partitionBy("tree", "_part").orderBy("_at")) - 1)
    return inside.join(runs, ["tree", "_part"]).select(*leaves.columns, (F.col("_skip") + F.col("_in")).alias("pos"), "n")


def build(leaves: DataFrame) -> Forest:
    """The forest over leaves (tree, pos, n, digest). A level is one grouping of the level below into runs of FAN at most, and is written."""
    levels = [leaves.select("tree", "pos", "n", "digest")]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = levels[-1].where("n > 1").groupBy("tree", F.shiftright("pos", BITS).alias("pos"), _above().alias("n")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run"))
        children = runs.select("tree", "pos", "n", F.transform("run", lambda x: x["digest"]).alias("children"))
        levels.append(materialise(children.select("tree", "pos", "n", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children"), "level"))
        most = -(-most // FAN)
    roots = levels[0].where("n = 1").select("tree", "digest", F.lit(0).alias("depth"))
    for k, level in enumerate(levels[1:], 1):
        roots = roots.unionByName(level.where("n = 1").select("tree", "digest", F.lit(k).alias("depth")))
    return Forest(levels, roots)


def descend(forest: Forest, roots: DataFrame, requests: DataFrame) -> DataFrame:
    """(want, carry, digest, path) of each request (tree, pos, n, want): the leaf at its place, and what was left unselected from the root down.

    roots: (tree, digest, depth, carry, path), path holding what was gathered before. A leaf is requested once at most.
    """
    wanted, asked = [], requests.select("tree", "pos", "n", "want")
    for _ in forest.levels[1:]:  # the digits that are wanted below each node; FAN at most
        digit = F.col("pos").bitwiseAND(FAN - 1).cast("int").alias("digit")
        below = asked.where("n > 1").groupBy("tree", F.shiftright("pos", BITS).alias("pos"), _above().alias("n")).agg(F.collect_list(F.struct(digit, *(["want"] if not wanted else []))).alias("below"))
        wanted.append(asked := materialise(below, "wanted"))
    front = None
    for k in range(len(wanted), 0, -1):
        start = roots.where(F.col("depth") == k).select("tree", F.lit(0).cast("long").alias("pos"), "digest", "carry", "path")
        front = start if front is None else front.unionByName(start)
        records = forest.levels[k].select("digest", "children").dropDuplicates(["digest"])
        here = front.join(wanted[k - 1].drop("n"), ["tree", "pos"]).join(records, "digest").withColumn("one", F.explode("below")).drop("below", "digest")
        i = F.col("one.digit")
        rest = F.struct(F.array_join(F.slice("children", 1, i), "").alias("left"), F.array_join(F.slice("children", i + 2, FAN), "").alias("right"))
        front = here.select("tree", (F.col("pos") * FAN + i).alias("pos"), F.get("children", i).alias("digest"), "carry", F.concat("path", F.array(rest)).alias("path"), *(["one.want"] if k == 1 else []))
    lone = roots.where("depth = 0").join(requests.where("n = 1").select("tree", "want"), "tree").select("want", "carry", "digest", "path")
    return lone if front is None else lone.unionByName(front.select("want", "carry", "digest", "path"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path (from the root down), in the order from the leaf up."""
    return F.sha2(F.array_join(F.transform(F.reverse(path), lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold_up(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (from the root down) give."""
    return F.aggregate(F.reverse(path), leaf, lambda at, p: hashed(p["left"], at, p["right"]))


def prove(leaves: DataFrame, order: list[str]) -> DataFrame:
    """leaves (tree, digest, ...) with leaf, subroot, root and path (from the root down, through the tree of trees and the leaf's own).

    tree: a name that isn't null and sorts as the trees do.
    """
    placed = materialise(ranked(leaves, order), "placed")
    forest = build(placed)
    names = materialise(ranked(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]), "names")
    top = build(names)
    crown = top.roots.select("tree", "digest", "depth", F.struct(F.col("digest").alias("root")).alias("carry"), F.array().cast(PATH).alias("path"))
    trees = descend(top, crown, names.withColumn("want", F.struct("name"))).select(F.col("want.name").alias("tree"), F.col("carry.root").alias("root"), "path")
    roots = materialise(forest.roots.join(trees, "tree").select("tree", "digest", "depth", F.struct("root", F.col("digest").alias("subroot")).alias("carry"), "path"), "roots")
    found = descend(forest, roots, placed.withColumn("want", F.struct(*leaves.columns)))
    return found.select("want.*", F.col("digest").alias("leaf"), "carry.subroot", "carry.root", "path")


def audit(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tampered: str = "text", every: int = 3) -> DataFrame:
    """Proofs of all rows of docs, checked after every `every`-th row (by crc32 of its id) had its `tampered` column put into lower case (A-Z only).

    doc_id, leaf, subroot, root, proof_sha256 of the untampered table; folded_root of the row as it is after tampering; verified: equals root.
    Rows with a null id are not tampered with.
    """
    other = [framed(F.translate(F.col(c), UPPER, LOWER) if c == tampered else F.col(c)) for c in columns]
    tree = F.when(F.col(tree_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(tree_col)))  # null before all names
    leaves = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), hashed(*[framed(F.col(c)) for c in columns]).alias("digest"), F.when(fold(F.col(id_col), every) == 0, hashed(*other)).alias("changed"))
    proved = prove(materialise(leaves, "leaves"), ["id", "digest"])
    folded = fold_up(F.coalesce("changed", "leaf"), F.col("path"))
    done = proved.select(F.col("id").alias(id_col), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 is a table of 256 remainders, made by eight shifts each, and a fold over the bytes.
MERKLE_SQL = """
WITH RECURSIVE t AS (SELECT LIST(LIST_REDUCE(RANGE(8), lambda c, i: CASE WHEN c % 2 = 1 THEN XOR(c >> 1, 3988292384) ELSE c >> 1 END, k) ORDER BY k) AS crc FROM (SELECT UNNEST(RANGE(256)) AS k)),
f AS (SELECT doc_id, lang, COALESCE(STRLEN(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || COALESCE(STRLEN(source) || ':' || source, '-') || COALESCE(STRLEN(lang) || ':' || lang, '-')
    || COALESCE(STRLEN(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text, TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    XOR(LIST_REDUCE(LIST_TRANSFORM(STRING_SPLIT(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ASCII(x) AS BIGINT)), lambda c, b: XOR(c >> 8, crc[1 + XOR(c, b) % 256]), 4294967295), 4294967295) % 3 = 0 AS hit FROM documents, t),
d AS (SELECT doc_id, lang, SHA256(head || COALESCE(STRLEN(text) || ':' || text, '-')) AS leaf, SHA256(head || COALESCE(STRLEN(low) || ':' || low, '-')) AS changed, hit FROM f),
e AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY lang) AS n FROM d),
l AS (SELECT lang, 0 AS lvl, pos, n, leaf AS digest FROM e
  UNION ALL SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, SHA256(STRING_AGG(digest, '' ORDER BY pos)) FROM l WHERE n > 1 GROUP BY lang, lvl, pos // 8, n),
s AS (SELECT lang, digest AS subroot, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, COUNT(*) OVER () AS n FROM l WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, n, subroot AS digest FROM s UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, SHA256(STRING_AGG(digest, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 8, n),
r AS (SELECT lang, lvl, pos // 8 AS run, LIST(digest ORDER BY pos) AS kids FROM l WHERE n > 1 GROUP BY ALL),
v AS (SELECT lvl, pos // 8 AS run, LIST(digest ORDER BY pos) AS kids FROM u WHERE n > 1 GROUP BY ALL),
w AS (SELECT *, ROW_NUMBER() OVER () AS k FROM e),
p AS (SELECT k, lang, 0 AS lvl, pos, CASE WHEN hit THEN changed ELSE leaf END AS cur, '' AS path FROM w
  UNION ALL SELECT k, p.lang, p.lvl + 1, pos // 8, SHA256(ARRAY_TO_STRING(kids[:pos % 8], '') || cur || ARRAY_TO_STRING(kids[pos % 8 + 2:], '')), path || ARRAY_TO_STRING(kids[:pos % 8], '') || ARRAY_TO_STRING(kids[pos % 8 + 2:], '')
  FROM p JOIN r ON r.lang IS NOT DISTINCT FROM p.lang AND r.lvl = p.lvl AND r.run = pos // 8),
q AS (SELECT k, 0 AS lvl, s.pos AS pos, subroot, cur, path FROM (SELECT k, lang, ARG_MAX(cur, lvl) AS cur, ARG_MAX(path, lvl) AS path FROM p GROUP BY ALL) b JOIN s ON s.lang IS NOT DISTINCT FROM b.lang
  UNION ALL SELECT k, q.lvl + 1, pos // 8, subroot, SHA256(ARRAY_TO_STRING(kids[:pos % 8], '') || cur || ARRAY_TO_STRING(kids[pos % 8 + 2:], '')), path || ARRAY_TO_STRING(kids[:pos % 8], '') || ARRAY_TO_STRING(kids[pos % 8 + 2:], '')
  FROM q JOIN v ON v.lvl = q.lvl AND v.run = pos // 8),
x AS (SELECT k, subroot, ARG_MAX(cur, lvl) AS folded_root, ARG_MAX(path, lvl) AS path FROM q GROUP BY ALL),
y AS (SELECT digest AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, SHA256(path) AS proof_sha256, folded_root, folded_root = root AS verified FROM w JOIN x USING (k), y
"""
