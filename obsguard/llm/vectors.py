"""Exact impact-ordered top-k and multiprobe p-stable nearest neighbours over a vector table."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsguard.llm.common import mix64, stored

# ---- shared ----------------------------------------------------------------------------------


def is_usable(vector: Column) -> Column:
    """Not null, no null and no non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int, kind: type) -> np.ndarray:
    """Rows of a list column as a matrix; missing trailing components count as 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    out = np.zeros((len(column), dims), kind)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims).astype(kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# ---- exact top-k -----------------------------------------------------------------------------

BLOCK_ROWS, BLOCK_QUERIES = 8192, 512
#: Least magnitudes of the impact levels, highest first; the last level takes the rest.
LEVELS = (32, 16, 8, 0)
#: With so many possible members left, exact rescoring is cheaper than another level.
FEW = 48


class ImpactIndex:
    """A block of integer vectors as posting segments by falling quantised impact.

    The segment of a level and a dimension holds the components whose magnitude falls in the level;
    all segments of a level are kept as one matrix with zeros elsewhere. ``rest[l]`` bounds what the
    levels after ``l`` can add: the norm of each vector's components there.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        size, above, self.segments, self.rest = np.abs(vectors), np.inf, [], []
        for least in LEVELS:
            self.segments.append(np.where((size >= least) & (size < above), vectors, 0.0))
            self.rest.append(np.sqrt((np.where(size < least, vectors, 0.0) ** 2).sum(axis=1)))
            above = least

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows and exact scores of its k best, ties to the smaller id."""
        own = query_ids[:, None] == self.ids[None, :]
        score = np.where(own, -np.inf, 0.0)
        norm = np.sqrt((queries**2).sum(axis=1))
        out: list = [None] * len(queries)
        live = np.arange(len(queries))
        for level, segment in enumerate(self.segments):
            score[live] += queries[live] @ segment.T
            last = level == len(self.segments) - 1
            slack = norm[live, None] * self.rest[level][None, :] * (1 + 1e-12)
            sure = score[live] - slack
            kth = min(k, sure.shape[1]) - 1
            floor = -np.partition(-sure, kth, axis=1)[:, kth]
            possible = score[live] + slack >= floor[:, None]
            if not last:
                done = possible.sum(axis=1) <= FEW
            else:
                done = np.ones(len(live), bool)
            for at in np.flatnonzero(done):
                q = live[at]
                rows = np.flatnonzero(possible[at] & ~own[q])
                exact = self.vectors[rows] @ queries[q]
                best = np.lexsort((self.ids[rows], -exact))[:k]
                out[q] = (rows[best], exact[best])
            live = live[~done]
            if not len(live):
                break
        return out


def exact_top_k(embeddings: DataFrame, k: int = 5, query_every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` greatest integer inner products.

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by
    ``query_every``; candidates are all rows with another vec_id. Rows with a null id, a null vector or
    a null or non-finite component take no part; a shorter vector counts as padded with zeros; equal
    scores go to the smaller vec_id. Vectors and queries are dealt in blocks by a hash, so copies of
    one vector spread; every block of queries meets every block of vectors, and a block returns at
    most ``k`` rows for a query. An empty table gives no rows.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & is_usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )
    is_query = F.col("vec_id") % query_every == 0
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, math.ceil(size["n"] / BLOCK_ROWS))
    query_blocks = max(1, math.ceil(size["q"] / BLOCK_QUERIES))
    dims = int(size["d"] or 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spot = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")
    left = rows.select("vec_id", "v", spot(blocks, 1).alias("block"), every(query_blocks).alias("query_block"))
    right = rows.where(is_query).select("vec_id", "v", every(blocks).alias("block"), spot(query_blocks, 2).alias("query_block"))

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if vectors.num_rows and queries.num_rows:
            ids = vectors.column("vec_id").to_numpy()
            index = ImpactIndex(ids, matrix(vectors.column("v"), dims, np.float64))
            names = queries.column("vec_id").to_numpy()
            for name, (at, score) in zip(names, index.search(names, matrix(queries.column("v"), dims, np.float64), k), strict=True):
                found["query_id"].append(np.full(len(at), name))
                found["vec_id"].append(ids[at])
                found["score"].append(score.astype(np.int64))
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in found.items()})

    key = ("block", "query_block")
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score long")
    return ranked(met, k)


EXACT_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""

# ---- approximate nearest neighbours ----------------------------------------------------------

TABLES, HASHES, WIDTH = 2, 4, 1.0
#: Share of true neighbours that the visited buckets are expected to hold.
SUCCESS = 0.93
FIT_ROWS, FIT_QUERIES = 4096, 256
#: Rows of a bucket in one part; a larger bucket is split, all its parts are visited.
PART_ROWS = 4096
CELL_ROWS = 16_384
REACH = 4

_erf = np.vectorize(math.erf)


def below(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / math.sqrt(2)))


class PStable:
    """Projections of the tables; inner product becomes distance by one more component."""

    def __init__(self, dims: int, largest: float, tables: int = TABLES, hashes: int = HASHES, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.dims, self.largest, self.tables, self.hashes = dims, max(largest, 1e-300), tables, hashes
        self.lines = rng.normal(size=(tables, dims + 1, hashes))
        self.shift = rng.uniform(0, WIDTH, size=(tables, 1, hashes))
        self.odd = (rng.integers(1, 1 << 62, size=(tables, hashes)) * 2 + 1).astype(np.uint64)

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Within the unit ball, one component more: on it for data; scaled onto it for queries."""
        norm = np.sqrt((x**2).sum(axis=1, keepdims=True))
        if query:
            return np.hstack([x / norm, np.zeros_like(norm)])
        x = x / self.largest
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x**2).sum(axis=1, keepdims=True)))])

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """(tables, rows, hashes): positions on the lines in bucket widths."""
        return (lifted[None] @ self.lines + self.shift) / WIDTH

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One 64-bit key for each table and row from whole cells (tables, rows, hashes)."""
        return mix64((cells.astype(np.int64).astype(np.uint64) * self.odd[:, None, :]).sum(axis=2, dtype=np.uint64)).view(np.int64)

    def probes(self, lifted: np.ndarray, radius: float, success: float) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, table, keys): buckets by falling chance of holding a neighbour at ``radius``, until
        the tables together are expected to hold ``success`` of them."""
        each = 1 - (1 - success) ** (1 / self.tables)
        places = self.places(lifted)
        moves = np.arange(-REACH, REACH + 1)
        grid = np.stack(np.meshgrid(*[np.arange(len(moves))] * self.hashes, indexing="ij"), axis=-1).reshape(-1, self.hashes)
        for t in range(self.tables):
            cell = np.floor(places[t])
            edge = cell[:, :, None] + moves - places[t][:, :, None]  # lower ends, seen from the query
            spread = radius / WIDTH
            chance = below((edge + 1) / spread) - below(edge / spread)
            for row in range(len(lifted)):
                p = chance[row, 0][grid[:, 0]]
                for h in range(1, self.hashes):
                    p = p * chance[row, h][grid[:, h]]
                order = np.argsort(-p, kind="stable")
                visit = order[: int(np.searchsorted(np.cumsum(p[order]), each)) + 1]
                cells = cell[row] + moves[grid[visit]]
                key = (cells.astype(np.int64).astype(np.uint64) * self.odd[t]).sum(axis=1, dtype=np.uint64)
                yield row, t, mix64(key).view(np.int64)


def neighbour_radius(sample: np.ndarray, index: PStable, n: int, k: int) -> float:
    """Distance within which the k-th neighbour of most queries is expected among n rows."""
    data, asked = index.lifted(sample, False), index.lifted(sample[:FIT_QUERIES], True)
    gap = np.sqrt(np.maximum(0.0, ((asked[:, None, :] - data[None]) ** 2).sum(axis=2))) if len(sample) <= 256 else np.sqrt(
        np.maximum(0.0, 1 + (data**2).sum(axis=1)[None] - 2 * asked @ data.T)
    )
    gap[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    rank = min(len(sample) - 1, max(1, round(k * len(sample) / max(n, 1))))
    near = np.partition(gap, rank - 1, axis=1)[:, rank - 1] if len(sample) > 1 else np.ones(1)
    near = near[np.isfinite(near)]
    return float(np.quantile(near, 0.9)) if len(near) and near.max() > 0 else 1.0


def nearest_neighbours(embeddings: DataFrame, k: int = 20, query_every: int = 20, success: float = SUCCESS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest found by inner product.

    Queries are the rows whose vec_id is divisible by ``query_every``; candidates are the rows with
    another vec_id in the visited buckets of any table, reranked by the exact inner product in double
    precision. Rows with a null id, a null or zero vector, or a null or non-finite component take no
    part; shorter vectors count as padded with zeros; ties go to the smaller vec_id; repeated rows, and
    rows that share an id, are candidates each. Of several rows with a query's id the least vector asks. The radius is fitted on at most about FIT_ROWS vectors, every row is indexed.
    A query that finds fewer than ``k`` candidates is searched again over all rows. An empty table
    gives no rows.
    """
    usable = is_usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = embeddings.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")
    )
    # rows get a number that holds once written, so that rows with one id stay apart when tables are merged
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.max(length).alias("norm")).first()
    n, dims = int(size["n"]), int(size["d"] or 1)
    index = PStable(dims, float(size["norm"] or 1.0))
    step = max(1, n // FIT_ROWS)
    sample = [r["v"] for r in rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(step)) == 0).select("v").limit(2 * FIT_ROWS).collect()]
    fitted = np.array([v + [0.0] * (dims - len(v)) for v in sample]).reshape(-1, dims)
    radius = neighbour_radius(fitted, index, n, k) if len(fitted) else 1.0
    cells = max(1, math.ceil(n * TABLES / CELL_ROWS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = index.keys(np.floor(index.places(index.lifted(matrix(batch.column("v"), dims, np.float64), False))))
            for t in range(index.tables):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("vec_id"), batch.column("v"), pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(keys[t])],
                    names=["row", "vec_id", "v", "t", "key"],
                )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for row, t, keys in index.probes(index.lifted(matrix(batch.column("v"), dims, np.float64), True), radius, success):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), ids[row])), pa.array(np.full(len(keys), t, np.int32)), pa.array(keys)],
                    names=["query_id", "t", "key"],
                )

    placed = stored(rows.mapInArrow(place, "row long, vec_id long, v array<double>, t int, key long"), "buckets")
    asked = rows.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    counts = placed.groupBy("t", "key").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    counts = stored(counts, "bucket-parts")
    cell = F.pmod(F.xxhash64("t", "key", "part"), F.lit(cells)).cast("int")
    entries = placed.join(counts, ["t", "key"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    entries = entries.select("row", "vec_id", "v", "t", "key", cell.alias("cell"))
    visits = asked.select("vec_id", "v").mapInArrow(probe, "query_id long, t int, key long").join(counts, ["t", "key"])
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("query_id", "t", "key", cell.alias("cell"))
    lists = visits.groupBy("query_id", "cell").agg(F.collect_set("key").alias("keys"))
    lists = lists.join(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")

    def rerank(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = {"query_id": [], "row": [], "vec_id": [], "score": []}
        if vectors.num_rows and queries.num_rows:
            ids, key, numbers = (vectors.column(c).to_numpy() for c in ("vec_id", "key", "row"))
            data, asked_for = matrix(vectors.column("v"), dims, np.float64), matrix(queries.column("q"), dims, np.float64)
            names = queries.column("query_id").to_numpy()
            bucket, at = np.unique(key, return_inverse=True)
            for name, q, keys in zip(names, asked_for, queries.column("keys"), strict=True):
                visited = np.zeros(len(bucket) + 1, bool)
                wanted = np.asarray(keys.values.to_numpy())
                spot = np.searchsorted(bucket, wanted)
                visited[np.where((spot < len(bucket)) & (bucket[np.minimum(spot, len(bucket) - 1)] == wanted), spot, len(bucket))] = True
                rows_at = np.flatnonzero(visited[:-1][at] & (ids != name))
                score = (data[rows_at] * q).sum(axis=1) if len(rows_at) < 64 else data[rows_at] @ q
                best = top_rows(ids[rows_at], score, k)
                found["query_id"].append(np.full(len(best), name))
                found["row"].append(numbers[rows_at[best]])
                found["vec_id"].append(ids[rows_at[best]])
                found["score"].append((data[rows_at[best]] * q).sum(axis=1))
        kinds = {"query_id": pa.int64(), "row": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in found.items()})

    met = entries.groupBy("cell").cogroup(lists.groupBy("cell")).applyInArrow(rerank, "query_id long, row long, vec_id long, score double")
    found = stored(met.dropDuplicates(["query_id", "row"]), "neighbours")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = stored(asked.join(enough, asked["vec_id"] == enough["query_id"], "left_anti"), "short-queries")
    if short.isEmpty():
        return ranked(found, k)
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(cells)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    asked_all = short.select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), every.alias("cell"), F.array(F.lit(0).cast("long")).alias("keys")
    )
    all_rows = rows.select("row", "vec_id", "v", F.lit(0).alias("t"), F.lit(0).cast("long").alias("key"), spot("row").alias("cell"))
    again = all_rows.groupBy("cell").cogroup(asked_all.groupBy("cell")).applyInArrow(rerank, "query_id long, row long, vec_id long, score double")
    return ranked(found.unionByName(again).dropDuplicates(["query_id", "row"]), k)


def top_rows(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id; a little slack against rounding."""
    if len(score) > 4 * k:
        floor = -np.partition(-score, k - 1)[k - 1]
        keep = np.flatnonzero(score >= floor - 1e-9 * max(1.0, abs(floor)))
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))][:k]
