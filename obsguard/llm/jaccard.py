"""Exact n-gram Jaccard join with adaptive multi-match prefixes.

Documents with equal shingle sets form a class; classes are linked when 100 * intersection reaches
share * union. A class's tokens are ordered by hash, tokens held by more than ``HEAVY`` prefixes last.
Two linked classes share at least l tokens of their l-prefixes (the n - ceil(share n / 100) + l first
tokens), so each class picks the l for which index touches plus expected verifications cost least,
and a pair is verified when it shares as many prefix tokens as the smaller l of the two asks.

Classes whose listed tokens are heavy for the most part are looked at with their whole sets, against
each other and against the rest. Pairs that share only heavy tokens are found through hubs: every
class is verified against the class with most heavy tokens for its size; those outside a token's main
component then meet the whole group, unless the counts of heavy tokens rule the pair out. So a large
group of near copies costs about its size, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import free_worker, mix64, stored, text_chunks, tidy
from obsguard.llm.graph import components
from obsguard.llm.shingles import shingle_sets

#: Words a shingle and least similarity in percent of op4's contract.
WIDTH, SHARE = 4, 85
#: A token in more prefixes than this is ordered last.
HEAVY = 16
#: Cost of a verification, in index touches; greatest l that is tried.
VERIFY, MOST_SHARED = 20.0, 6
#: Up to so many document ids (8 bytes each) are broadcast to pick texts; beyond, texts are joined by id.
BROADCAST_IDS = 400_000

#: Bytes of text hashed at once; the arrays take some fifty times as much.
CHUNK = 1 << 20

#: Hits after which the index rows found so far are handed on.
INDEX_ROWS = 500_000

INDEX = "token long, node long, n int, l int, heavy int, hub boolean"


def least_overlap(n: np.ndarray | int, share: int) -> np.ndarray | int:
    return -(-share * n // 100)


def listed(n: int, share: int) -> int:
    """How many first tokens of a set of n are listed: a 1-prefix and some to lengthen it by."""
    return min(n, n - int(least_overlap(n, share)) + 5 + n // 20)


def set_node(tokens: np.ndarray) -> int:
    """A set's 64-bit name."""
    spread = mix64(tokens + np.uint64(0x51ED270B))
    ends = np.array([spread.sum(dtype=np.uint64) ^ np.bitwise_xor.reduce(mix64(spread)) ^ np.uint64(len(tokens) << 40)])
    return int(mix64(ends).view(np.int64)[0])


def shingled(documents: DataFrame, width: int, share: int) -> DataFrame:
    """(doc_id, node, n, tokens): the name and size of each row's set, and its first tokens."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for batch in batches:
            for part in text_chunks(batch, CHUNK):
                texts = [(t or "").encode("utf-8", "replace") for t in part.column("text").to_pylist()]
                sets = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([set_node(s) if len(s) else 0 for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([s[: listed(len(s), share)].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "node", "n", "tokens"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(apply), "doc_id long, node long, n int, tokens array<long>")


def whole_sets(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, n, tokens) of the stored ``wanted`` (doc_id, node), read from the texts again."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for batch in batches:
            for part in text_chunks(batch, CHUNK):
                texts = [(t or "").encode("utf-8", "replace") for t in part.column("text").to_pylist()]
                sets = shingle_sets(texts, width)
                asked = part.column("node").to_pylist()
                keep = [i for i, s in enumerate(sets) if len(s) and set_node(s) == asked[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([asked[i] for i in keep], pa.int64()), pa.array([len(sets[i]) for i in keep], pa.int32()),
                        pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64())),
                    ],
                    names=["node", "n", "tokens"],
                )

    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(side, "doc_id")
    return rows.select("node", "text").mapInArrow(tidy(apply), "node long, n int, tokens array<long>").dropDuplicates(["node"])


def indexed(lists: DataFrame, counts: DataFrame, share: int) -> DataFrame:
    """Index rows of ``lists`` (node, n, tokens) under ``counts`` (token, df of at least 2).

    Rows with hub false are prefix tokens with the class's l. A class whose listed tokens hold too few
    light ones gets all of those with l = 1, and a 1-prefix's remainder of heavy tokens with hub true.
    Classes without a shared listed token have no rows.
    """
    rows = lists.select("node", "n", F.size("tokens").alias("m"), F.posexplode("tokens").alias("pos", "token"))
    hits = rows.join(counts, "token").groupBy("node", "n", "m").agg(
        F.sort_array(F.collect_list(F.struct("pos", "token", "df"))).alias("hits")
    )

    names = ["token", "node", "n", "l", "heavy", "hub"]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for batch in batches:
            # hits stay flat Arrow values; only numbers of one class are looked at at a time
            column = batch.column("hits")
            flat = column.flatten()
            all_pos, all_token, all_df = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("pos", "token", "df"))
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            out: list[tuple[np.ndarray, int, int, int, int, bool]] = []
            held = 0

            def give(out: list) -> pa.RecordBatch:
                size = [len(x[0]) for x in out]
                columns = [np.concatenate([x[0] for x in out])] + [np.repeat(np.array([x[k] for x in out], kind), size) for k, kind in (
                    (1, np.int64), (2, np.int32), (3, np.int32), (4, np.int32), (5, bool))]
                return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

            rows = zip(*(batch.column(c).to_pylist() for c in ("node", "n", "m")), [0, *ends[:-1]], ends, strict=True)
            for node, n, m, a, b in rows:
                pos, token, df = all_pos[a:b], all_token[a:b], all_df[a:b].astype(float)
                is_heavy = df > HEAVY
                heavy, first = int(is_heavy.sum()), n - int(least_overlap(n, share)) + 1
                rank = pos - (np.cumsum(is_heavy) - is_heavy)  # place among the light tokens
                if m - heavy < first:
                    out.append((token[~is_heavy], node, n, 1, heavy, False))
                    out.append((token[is_heavy][: first - (m - heavy)], node, n, 1, heavy, True))
                else:
                    best = None
                    for shared in range(1, min(MOST_SHARED, m - heavy - first + 1) + 1):
                        use = ~is_heavy & (rank < first + shared - 1)
                        touches = (df[use] - 1).sum()
                        cost = touches + VERIFY * touches / shared
                        if best is None or cost < best[0]:
                            best = (cost, shared, use)
                    out.append((token[best[2]], node, n, best[1], heavy, False))
                held += b - a
                if held > INDEX_ROWS:
                    yield give(out)
                    out, held = [], 0
            if out:
                yield give(out)
            del flat, all_pos, all_token, all_df

    return hits.mapInArrow(tidy(choose), INDEX)


def sizes_allow(a: str, b: str, share: int) -> str:
    return f"100 * least({a}, {b}) >= {share} * greatest({a}, {b})"


def sharing_pairs(left: DataFrame, right: DataFrame, same: bool, share: int) -> DataFrame:
    """Pairs (a, b) whose index rows share enough tokens; ``same``: both sides are one index."""
    x = left.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("l").alias("la"))
    y = right.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("l").alias("lb"))
    met = x.join(y, "token").where(sizes_allow("na", "nb", share)).where("a < b" if same else "a <> b")
    enough = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min(F.least("la", "lb")).alias("asked")).where("shared >= asked")
    return enough.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The links among ``pairs``: exact intersections of whole sets."""
    x = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
    both = x.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(100 * common >= share * (F.size("x") + F.size("y") - common)).select("a", "b")


def counted(lists: DataFrame) -> DataFrame:
    return lists.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")


def jaccard_components(documents: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``documents``; shingles of ``width`` words, links from ``share`` percent.

    A null or empty text has no shingles and is linked with nothing; rows with a null doc_id are
    returned with component_id null and link nothing. Rows that share a doc_id are documents each, with
    one id. Other columns are not read; an empty table gives no rows.
    """
    rows = stored(shingled(documents, width, share), "shingles")
    real = rows.where("doc_id is not null and n > 0")
    classes = stored(real.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")
    lists = real.join(classes, ["node", "doc_id"], "left_semi").select("node", "n", "tokens")
    counts = stored(counted(lists), "token-counts")
    index = stored(indexed(lists, counts, share), "index")
    unresolved = index.where("hub").select("node").distinct()
    whole = stored(whole_sets(documents, stored(unresolved.join(classes, "node").select("doc_id", "node"), "unresolved"), width), "whole")

    light = index.where("not hub").join(unresolved, "node", "left_anti")
    heavy = counts.where(F.col("df") > HEAVY).select("token")
    # unresolved classes against the others: a 1-prefix of tokens that the others may list as light
    first = whole.select("node", "n", F.posexplode("tokens").alias("pos", "token")).join(heavy, "token", "left_anti")
    met = sharing_pairs(first.withColumn("l", F.lit(1)), light, False, share).unionByName(sharing_pairs(light, light, True, share))
    # unresolved classes against each other, counted anew over their whole sets
    inner = stored(indexed(whole, counted(whole), share), "inner-index")
    met = met.unionByName(sharing_pairs(inner.where("not hub"), inner.where("not hub"), True, share))
    hubs = inner.where("hub")
    hub_of = hubs.groupBy("token").agg(F.max_by(F.struct("node", "n"), F.struct(F.col("heavy") / F.col("n"), "node")).alias("_hub"))
    star = hubs.join(hub_of, "token").select(F.col("node"), "n", F.col("_hub.node").alias("h"), F.col("_hub.n").alias("hn"))
    star = star.where("node <> h").where(sizes_allow("n", "hn", share)).select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b"))
    pairs = stored(met.unionByName(star).distinct(), "pairs")

    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    missing = asked.join(whole, "node", "left_anti").join(classes, "node").select("doc_id", "node")
    sets = whole_sets(documents, stored(missing, "asked"), width)
    sets = stored(sets.unionByName(whole), "sets")
    links = stored(verified(pairs, sets, share), "links")
    root = stored(components(links), "roots")

    listed_hubs = hubs.groupBy("node").agg(F.collect_list("token").alias("hub_tokens"))
    group = hubs.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")).join(listed_hubs, "node")
    before = F.filter("hub_tokens", lambda t: t < F.col("token")).alias("before")
    group = stored(group.select("token", "node", "n", "heavy", "root", before), "hub-groups")
    main = group.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"))
    placed = group.join(main, "token").withColumn("out", F.col("root") != F.col("main"))
    outside = placed.where("out").select(
        "token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("heavy").alias("ha"), F.col("root").alias("ra"), F.col("before").alias("xa")
    )
    other = placed.select(
        "token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("heavy").alias("hb"), F.col("root").alias("rb"), F.col("before").alias("xb"), "out"
    )
    # such a pair has only heavy tokens in common, so at most the fewer heavy tokens of the two; it meets at the first
    # token that both list, and once there: of different components at least one is outside the token's main one
    possible = f"100 * least(ha, hb) >= {share} * (na + nb - least(ha, hb))"
    late = outside.join(other, "token").where("ra <> rb and (not out or a < b) and " + possible).where(sizes_allow("na", "nb", share))
    late = late.where(~F.arrays_overlap("xa", "xb"))
    late = late.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stored(verified(late.join(pairs, ["a", "b"], "left_anti"), whole, share), "late-links")
    if not more.isEmpty():
        root = stored(components(links.unionByName(more)), "roots")

    labels = classes.join(root, "node")
    named = labels.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = labels.join(named, "root").select("node", "component_id")
    of_class = classes.join(linked, "node", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    found = rows.select("doc_id", "node", "n").join(of_class, "node", "left")
    alone = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), alone.alias("component_id"))


def keep_one_of_each(documents: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """``documents`` without the rows whose component has a smaller doc_id; all columns stay.

    Rows with a null doc_id and rows without shingles stay; of equal rows with one doc_id one stays.
    """
    found = stored(jaccard_components(documents, width, share), "components")
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    kept = documents.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti")
    again = stored(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1").select("doc_id"), "repeated-ids")
    if not again.isEmpty():
        one = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(again, "doc_id", "left_anti").unionByName(one)
    return kept.select(*documents.columns)
