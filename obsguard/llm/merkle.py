"""Merkle manifest of a table by nested-interval labels.

Every row is a leaf. The leaves of a group form a tree of fan-out three, the groups' roots form one more
such tree above them. A node is labelled with the interval of leaf ranks that it covers, so that

* an ancestor is a node whose interval contains the leaf's,
* the siblings at a level are what the parent's interval covers and the node's own does not.

Labels are attached by bands of ``BAND`` levels. On the way up the nodes of a band's lowest level meet in
buckets of ``FAN ** BAND`` ranks, each of which becomes one node of the next band. On the way down a
containment join inside such buckets hands every node the siblings on its way from its bucket's top
to the root. So a bucket holds at most ``FAN ** BAND`` nodes however large a group is, each band is one
exchange, and of a leaf's way only the lowest band is worked out leaf by leaf.

Ranks come from a range sort that is written down, and from the counts of its parts.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsguard.llm.common import stored

FAN = 3
#: Levels of a band; a bucket holds at most FAN ** BAND = 729 nodes.
BAND = 6
#: Columns of a document that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree string, n long, lo long, hi long, digest string"
WAYS = "tree string, lo long, hi long, digest string, before array<string>, after array<string>, subroot string, root string"
PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, siblings array<string>"
)

Node = tuple[int, int, str]
Way = tuple[tuple[str, ...], tuple[str, ...]]


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def document_leaves(documents: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, changed): the leaf of each row, and that of its altered text where it differs.

    The text of rows with an even crc32 of the id loses its line feeds; a null id or text is not altered.
    The tree's name keeps the order of the sources, null first.
    """
    text = F.col("text")
    parts = [F.col(c) for c in LEAF_COLUMNS[:-1]]
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.contains(text, F.lit("\n"))
    return documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(*parts, text).alias("digest"),
        F.when(altered, leaf_digest(*parts, F.replace(text, F.lit("\n"), F.lit("")))).alias("changed"),
    )


def labelled(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their interval [lo, hi) of one rank among the ``n`` of their tree, ascending in ``order``.

    The sorted rows are written down, so ranks hold if executors are lost. A row's rank is its place
    among its tree's rows of the same part, and the count of that tree's rows in the parts before.
    """
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stored(placed.withColumn("_place", F.monotonically_increasing_id()), "leaf-order")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy("tree", "_part").agg(F.count("*").alias("_k"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree", "_part", "_first", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_k").over(Window.partitionBy("tree")).alias("n"),
    )
    ranked = placed.join(parts, ["tree", "_part"]).withColumn("lo", F.col("_place") - F.col("_first") + F.col("_before"))
    return ranked.withColumn("hi", F.col("lo") + 1).drop("_place", "_part", "_first", "_before")


def grown(nodes: list[Node], n: int) -> list[list[Node]]:
    """The levels above ``nodes``, which a bucket holds in order: BAND of them, or up to the node that covers all ``n``."""
    levels = [nodes]
    while len(levels) <= BAND and levels[-1][0][:2] != (0, n):
        below = levels[-1]
        runs = [below[i : i + FAN] for i in range(0, len(below), FAN)]
        levels.append([(run[0][0], run[-1][1], digest_of("".join(x[2] for x in run))) for run in runs])
    return levels


def ways_to_top(levels: list[list[Node]]) -> list[Way]:
    """Of each lowest node the siblings before and after it, level by level up to the one top node.

    A parent's children are the nodes that its interval contains; the siblings of a child lie in the
    parent's interval less its own.
    """
    ways: list[Way] = [((), ())]
    for level in range(len(levels) - 1, 0, -1):
        below = levels[level - 1]
        starts = [x[0] for x in below]
        lower: list[Way] = []
        for (lo, hi, _), (before, after) in zip(levels[level], ways, strict=True):
            inside = below[bisect_left(starts, lo) : bisect_left(starts, hi)]
            for own_lo, own_hi, _ in inside:
                left = "".join(d for _, b, d in inside if b <= own_lo)
                right = "".join(d for a, _, d in inside if a >= own_hi)
                lower.append(((left, *before), (right, *after)))
        ways = lower
    return ways


def in_order(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("lo")


def listed(nodes: pa.Table) -> list[Node]:
    return list(zip(*(nodes.column(c).to_pylist() for c in ("lo", "hi", "digest")), strict=True))


def bucket(level: int) -> Column:
    return F.expr(f"lo div {FAN ** (level + BAND)}")


@dataclass
class Forest:
    """Stored nodes of every BAND-th level, without those below the next band's, and the tops of all trees."""

    bases: list[DataFrame]
    tops: DataFrame


def raise_forest(leaves: DataFrame) -> Forest:
    """Raise ``leaves`` (NODES and further columns, stored) to the tops of their trees, a band at a time."""

    def raised(nodes: pa.Table) -> pa.Table:
        nodes = in_order(nodes)
        tree, n = nodes.column("tree")[0].as_py(), nodes.column("n")[0].as_py()
        ((lo, hi, digest),) = grown(listed(nodes), n)[-1]
        return pa.table({"tree": [tree], "n": [n], "lo": [lo], "hi": [hi], "digest": [digest]})

    most = leaves.agg(F.max("n")).first()[0] or 0
    bases, tops, level = [leaves], None, 0
    while True:
        nodes = bases[-1].select("tree", "n", "lo", "hi", "digest", bucket(level).alias("bucket"))
        above = stored(nodes.groupBy("tree", "bucket").applyInArrow(raised, NODES), "merkle-nodes")
        done = above.where("lo = 0 and hi = n").select("tree", "n", "digest")
        tops = done if tops is None else tops.unionByName(done)
        level += BAND
        if FAN**level >= most:
            return Forest(bases, tops)
        bases.append(above.where("lo <> 0 or hi <> n"))


def bucket_ways(forest: Forest, above: DataFrame, band: int, upper: DataFrame | None) -> DataFrame:
    """WAYS and bucket of the top of every bucket of ``band``: nodes of the ``upper`` band, or tops of trees."""
    level = band * BAND
    # trees that end in this band are those of the sizes between its lowest and its highest level
    ended = forest.tops.where(f"n <= {FAN ** (level + BAND)}" + (f" and n > {FAN**level}" if band else ""))
    ways = ended.select("tree", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), "digest").join(above, "tree")
    if upper is not None:
        ways = ways.unionByName(upper)
    # nodes and tops are read from the same stored table; columns of their own keep the two sides of a cogroup apart
    return ways.withColumn("bucket", bucket(level)).select(*[F.col(c).alias(c) for c in [*ways.columns, "bucket"]])


def ways_down(forest: Forest, above: DataFrame, lowest: int) -> DataFrame | None:
    """WAYS of the nodes of the band ``lowest``, from ``above`` (tree, before, after, subroot, root) of the tops."""

    def attach(nodes: pa.Table, ways: pa.Table) -> pa.Table:
        nodes, way = in_order(nodes), ways.to_pylist()[0]
        levels = grown(listed(nodes), nodes.column("n")[0].as_py())
        assert levels[-1][0] == (way["lo"], way["hi"], way["digest"]), "a bucket's top is not the node above it"
        mine = ways_to_top(levels)
        size = len(mine)
        return pa.table(
            [
                nodes.column("tree"), nodes.column("lo"), nodes.column("hi"), nodes.column("digest"),
                pa.array([[*b, *way["before"]] for b, _ in mine], pa.list_(pa.string())),
                pa.array([[*a, *way["after"]] for _, a in mine], pa.list_(pa.string())),
                pa.array([way["subroot"]] * size, pa.string()), pa.array([way["root"]] * size, pa.string()),
            ],
            names=["tree", "lo", "hi", "digest", "before", "after", "subroot", "root"],
        )

    found = None
    for band in range(len(forest.bases) - 1, lowest - 1, -1):
        nodes = forest.bases[band].select("tree", "n", "lo", "hi", "digest", bucket(band * BAND).alias("bucket"))
        ways = bucket_ways(forest, above, band, found)
        pairs = nodes.groupBy("tree", "bucket").cogroup(ways.groupBy("tree", "bucket"))
        found = stored(pairs.applyInArrow(attach, WAYS), "merkle-ways")
    return found


@dataclass
class Manifest:
    """Forest of the groups' trees; (tree, before, after, subroot, root) of every group's way to the root."""

    forest: Forest
    above: DataFrame


def build_manifest(leaves: DataFrame, order: list[str]) -> Manifest:
    """The trees of ``leaves`` (tree, digest and further columns; a tree's leaves ascend by ``order``) and the one above them."""
    forest = raise_forest(stored(labelled(leaves, order), "merkle-leaves"))
    groups = forest.tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = stored(labelled(groups, ["name"]), "merkle-groups")
    upper = raise_forest(groups)
    nothing = F.array().cast("array<string>")
    root = upper.tops.select("tree", nothing.alias("before"), nothing.alias("after"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    ways = ways_down(upper, root, 0).select("lo", "before", "after", "root")
    above = groups.select(F.col("name").alias("tree"), "lo", F.col("digest").alias("subroot")).join(ways, "lo").drop("lo")
    return Manifest(forest, stored(above, "merkle-group-ways"))


def prove(manifest: Manifest, with_siblings: bool = True) -> DataFrame:
    """PROOFS of every leaf (doc_id, digest, changed): the siblings on its way, and the root that they fold to.

    The fold starts from ``changed`` where that is set, so such a row is not verified. ``siblings`` are
    the digests level by level, left to right; they are null unless asked for.
    """

    def fold(leaves: pa.Table, ways: pa.Table) -> pa.Table:
        leaves, way = in_order(leaves), ways.to_pylist()[0]
        levels = grown(listed(leaves), leaves.column("n")[0].as_py())
        assert levels[-1][0] == (way["lo"], way["hi"], way["digest"]), "a bucket's top is not the node above it"
        rest = "".join(b + a for b, a in zip(way["before"], way["after"], strict=True))
        proof, folded, listing = [], [], []
        own, changed = leaves.column("digest").to_pylist(), leaves.column("changed").to_pylist()
        for digest, other, (before, after) in zip(own, changed, ways_to_top(levels), strict=True):
            siblings = "".join(b + a for b, a in zip(before, after, strict=True)) + rest
            proof.append(digest_of(siblings))
            at = other or digest
            for b, a in zip((*before, *way["before"]), (*after, *way["after"]), strict=True):
                at = digest_of(b + at + a)
            folded.append(at)
            listing.append([siblings[i : i + 64] for i in range(0, len(siblings), 64)] if with_siblings else None)
        size = len(own)
        return pa.table(
            [
                leaves.column("doc_id"), leaves.column("digest"), pa.array([way["subroot"]] * size, pa.string()),
                pa.array([way["root"]] * size, pa.string()), pa.array(proof, pa.string()), pa.array(folded, pa.string()),
                pa.array([f == way["root"] for f in folded], pa.bool_()), pa.array(listing, pa.list_(pa.string())),
            ],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "siblings"],
        )

    forest = manifest.forest
    upper = ways_down(forest, manifest.above, 1) if len(forest.bases) > 1 else None
    ways = bucket_ways(forest, manifest.above, 0, upper)
    leaves = forest.bases[0].select("tree", "n", "lo", "hi", "digest", "doc_id", "changed", bucket(0).alias("bucket"))
    return leaves.groupBy("tree", "bucket").cogroup(ways.groupBy("tree", "bucket")).applyInArrow(fold, PROOFS)


def manifest_proofs(documents: DataFrame, with_siblings: bool = False) -> DataFrame:
    """PROOFS of every row of ``documents`` (doc_id, source, lang, n_chars, text; other columns are not read).

    A null in any column is part of its leaf. Null sources form one group, the first; null ids come
    first in their group and are never altered. Rows that share an id are leaves each, in the order of their digests;
    equal rows may swap places. An empty table gives no rows.
    """
    leaves = stored(document_leaves(documents), "document-leaves")
    return prove(build_manifest(leaves, ["doc_id", "digest"]), with_siblings)


#: The same in SQL: trees level by level, every leaf's ways gathered and folded.
MANIFEST_SQL = """
WITH RECURSIVE
crc_steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
),
docs AS (
    SELECT d.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) & 1 = 0 AS altered
    FROM documents d, crc_steps
),
hashed AS (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, altered AND contains(text, chr(10)) AS differs,
        coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
        || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head, text, replace(text, chr(10), '') AS shorter
    FROM docs
),
leaves AS (
    SELECT doc_id, tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        CASE WHEN differs THEN sha256(head || octet_length(encode(shorter)) || ':' || shorter) END AS changed
    FROM hashed
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY tree) AS n FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, r AS i, leaf AS digest, n FROM ranked
    UNION ALL
    SELECT tree, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3, n
),
subroots AS (
    SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
),
upper AS (
    SELECT 0 AS level, r AS i, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, i // 3, n
),
steps AS (
    SELECT tree, r, 0 AS stage, level, own.i AS at,
        coalesce(string_agg(other.digest, '' ORDER BY other.i) FILTER (other.i < own.i), '') AS before,
        coalesce(string_agg(other.digest, '' ORDER BY other.i) FILTER (other.i > own.i), '') AS after
    FROM (SELECT k.tree, k.r, n.level, n.i FROM ranked k JOIN nodes n ON n.tree = k.tree AND n.n > 1 AND n.i = k.r // (3 ** n.level)::BIGINT) own
    JOIN nodes other USING (tree, level) WHERE other.i // 3 = own.i // 3
    GROUP BY tree, r, level, own.i
),
upper_steps AS (
    SELECT tree, 1 AS stage, level,
        coalesce(string_agg(other.digest, '' ORDER BY other.i) FILTER (other.i < own.i), '') AS before,
        coalesce(string_agg(other.digest, '' ORDER BY other.i) FILTER (other.i > own.i), '') AS after
    FROM (SELECT s.tree, u.level, u.i FROM subroots s JOIN upper u ON u.n > 1 AND u.i = s.r // (3 ** u.level)::BIGINT) own
    JOIN upper other USING (level) WHERE other.i // 3 = own.i // 3
    GROUP BY tree, level, own.i
),
all_steps AS (
    SELECT tree, r, stage, level, before, after FROM steps
    UNION ALL SELECT k.tree, k.r, u.stage, u.level, u.before, u.after FROM ranked k JOIN upper_steps u USING (tree)
),
ways AS (
    SELECT tree, r, string_agg(before || after, '' ORDER BY stage, level) AS siblings, list(before || '|' || after ORDER BY stage, level) AS pairs
    FROM all_steps GROUP BY tree, r
),
folded AS (
    SELECT k.doc_id, k.leaf, s.subroot, u.digest AS root, sha256(coalesce(w.siblings, '')) AS proof_sha256,
        list_reduce(list_concat([coalesce(k.changed, k.leaf)], coalesce(w.pairs, [])),
            lambda h, p: sha256(split_part(p, '|', 1) || h || split_part(p, '|', 2))) AS folded_root
    FROM ranked k JOIN subroots s USING (tree) JOIN upper u ON u.n = 1 LEFT JOIN ways w ON w.tree = k.tree AND w.r = k.r
)
SELECT *, folded_root = root AS verified FROM folded
"""
