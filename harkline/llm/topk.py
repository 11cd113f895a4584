"""Exact top-k search by inner product: ball trees per shard, branch and bound.

Rows are dealt into shards of about `SHARD` vectors by a hash. A task builds a ball tree
over a shard and then takes the queries in blocks: from the root down, a node is kept for a
query only while its upper bound q.c + |q| r reaches the query's current k-th score; the
leaves that are left are visited in order of falling bound, and the k-th score rises as
they are.

The k-th score is shared between shards: each query is searched in its own shard first,
and starts in all others with the k-th score found there. Memory is bounded by a shard and
a block of queries; results of a shard are at most k rows per query.

Vectors are whole numbers and scores are exact: products below 2^53 go through float64
matrix products, larger ones through 64-bit integers. Bounds carry a margin for rounding.

Defined cases: vectors that are null or hold null or non-finite components, and rows
without vec_id, take no part; vectors of different lengths have no score; ties go to the
smaller vec_id; a row that repeats a vec_id is a candidate of its own, and a query of its
own; with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harkline.session import written

SHARD = 1 << 13
LEAF = 256
QUERIES_AT_A_TIME = 256
#: Share of a bound's size added for rounding.
MARGIN = 1e-9
_EXACT = float(1 << 53)


class BallTree:
    """Balls over the rows of a matrix, as arrays by level; halves along the widest spread."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(vectors))
        points = vectors.astype(np.float64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        edges = [(0, len(order))]
        while True:
            centres, radii = [], []
            for a, b in edges:
                part = points[order[a:b]]
                centre = part.mean(axis=0)
                centres.append(centre)
                radii.append(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            self.levels.append((np.array(centres), np.array(radii)))
            if all(b - a <= LEAF for a, b in edges) or any(b - a < 2 for a, b in edges):
                break
            halves = []
            for a, b in edges:
                part = points[order[a:b]]
                first = part[((part - part.mean(axis=0)) ** 2).sum(axis=1).argmax()]
                second = part[((part - first) ** 2).sum(axis=1).argmax()]
                middle = (a + b) // 2
                along = np.argsort(part @ (second - first), kind="stable")
                order[a:b] = order[a:b][along]
                halves += [(a, middle), (middle, b)]
            edges = halves
        self.leaves = edges
        self.vectors, self.ids, self.rows = vectors[order], ids[order], rows[order]
        self.points = points[order]
        self.largest = np.abs(self.points).max(initial=0.0)

    def scores(self, leaf: int, queries: np.ndarray, floats: np.ndarray) -> np.ndarray:
        a, b = self.leaves[leaf]
        size = np.abs(floats).max(initial=0.0) * self.largest * queries.shape[1]
        if size < _EXACT:
            return (floats @ self.points[a:b].T).astype(np.int64)
        return queries @ self.vectors[a:b].T

    def search(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place, ids, scores) of the candidates of each query that reach its k-th score.

        `own`: the query's row, which is no candidate of it. `least`: the shared k-th score.
        """
        floats = queries.astype(np.float64)
        lengths = np.sqrt((floats**2).sum(axis=1))
        which, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        bound = np.zeros(0)
        for depth, (centres, radii) in enumerate(self.levels):
            if depth:
                which, node = np.repeat(which, 2), np.stack((2 * node, 2 * node + 1), axis=1).ravel()
            products = floats @ centres.T
            far = lengths[which] * radii[node]
            bound = products[which, node] + far
            bound += MARGIN * (np.abs(products[which, node]) + far + 1)
            stays = bound >= least[which]
            which, node, bound = which[stays], node[stays], bound[stays]
        # each query's leaves by falling bound; all queries take their next leaf together
        by = np.lexsort((-bound, which))
        which, node, bound = which[by], node[by], bound[by]
        begins = np.searchsorted(which, np.arange(len(queries)))
        turns = np.arange(len(which)) - begins[which]
        known = least.copy()
        empty = np.iinfo(np.int64).min
        best_scores = np.full((len(queries), k), empty, dtype=np.int64)
        best_places = np.full((len(queries), k), -1, dtype=np.int64)
        for turn in range(int(turns.max(initial=-1)) + 1):
            now = np.flatnonzero(turns == turn)
            now = now[bound[now] >= known[which[now]]]
            for leaf in np.unique(node[now]):
                asked = which[now[node[now] == leaf]]
                a, b = self.leaves[leaf]
                found = self.scores(leaf, queries[asked], floats[asked])
                found = np.where(self.rows[None, a:b] == own[asked, None], empty, found)
                scores = np.concatenate((best_scores[asked], found), axis=1)
                places = np.concatenate((best_places[asked], np.broadcast_to(np.arange(a, b), found.shape)), axis=1)
                ids = np.where(places >= 0, self.ids[places], np.iinfo(np.int64).max)
                top = np.lexsort((ids, ~scores), axis=1)[:, :k]  # ~s falls as s rises, without overflow
                best_scores[asked] = np.take_along_axis(scores, top, axis=1)
                best_places[asked] = np.take_along_axis(places, top, axis=1)
                full = best_scores[asked, k - 1]
                known[asked] = np.where(full > empty, np.maximum(known[asked], full.astype(np.float64)), known[asked])
        for place in range(len(queries)):
            good = (best_scores[place] > empty) & (best_places[place] >= 0)
            if good.any():
                yield place, self.ids[best_places[place][good]], best_scores[place][good]


def whole_vectors(table: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """`id` and `v` (array of long, floor of scale * x) of the rows that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return (
        table.where(F.col(key).isNotNull() & x.isNotNull() & ~bad)
        .select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.int64)
    return values.reshape(len(column), -1)


def _search_shards(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Candidates `q` (query row), `vec_id`, `score` of the queries in the shards they are sent to.

    `vectors`: `row`, `id`, `v`, `shard`, `dim`; `asked`: `row`, `v`, `shard`, `dim`, `least`.
    """
    columns = ["shard", "dim", "kind", "row", "id", "v", "least"]
    base = vectors.select("shard", "dim", F.lit(0).alias("kind"), "row", "id", "v", F.lit(0.0).alias("least"))
    ask = asked.select("shard", "dim", F.lit(1).alias("kind"), "row", F.lit(0).cast("long").alias("id"), "v", "least")
    placed = base.unionByName(ask).repartition("shard", "dim").sortWithinPartitions("shard", "dim", "kind", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at, parts = None, None, []

        def built() -> BallTree | None:
            if not parts:
                return None
            return BallTree(*(np.concatenate([p[i] for p in parts]) for i in range(3)))

        for batch in batches:
            shard, dim, kind = (np.asarray(batch[c], dtype=np.int64) for c in columns[:3])
            change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(dim) != 0) | (np.diff(kind) != 0)) + 1
            for begin, end in zip([0, *change], [*change, batch.num_rows]):
                if begin == end:
                    continue
                if (shard[begin], dim[begin]) != at:
                    at, tree, parts = (shard[begin], dim[begin]), None, []
                piece = batch.slice(begin, end - begin)
                if kind[begin] == 0:
                    parts.append((_matrix(piece["v"]), np.asarray(piece["id"], dtype=np.int64), np.asarray(piece["row"], dtype=np.int64)))
                    tree = None
                    continue
                tree = tree or built()
                if tree is None:
                    continue
                for first in range(0, piece.num_rows, QUERIES_AT_A_TIME):
                    some = piece.slice(first, QUERIES_AT_A_TIME)
                    rows = np.asarray(some["row"], dtype=np.int64)
                    least = np.asarray(some["least"], dtype=np.float64)
                    q, ids, scores = [], [], []
                    for place, got, score in tree.search(_matrix(some["v"]), rows, least, k):
                        q.append(np.full(len(got), rows[place]))
                        ids.append(got)
                        scores.append(score)
                    if q:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate(c)) for c in (q, ids, scores)], ["q", "vec_id", "score"]
                        )

    return placed.mapInArrow(run, "q long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(
    table: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k highest inner products of every query row.

    `is_query` is a condition on the column `id`, the key as a long.
    """
    whole = whole_vectors(table, key, vector, scale).select(
        F.monotonically_increasing_id().alias("row"), "id", "v", F.size("v").alias("dim")
    )
    whole = written(whole.where("dim > 0"), "vectors")
    shards = max(1, -(-whole.count() // SHARD))
    own = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    vectors = whole.withColumn("shard", own)
    queries = vectors.where(is_query)
    none = F.lit(float("-inf"))

    at_home = written(_search_shards(vectors, queries.withColumn("least", none), k), "top-k-home")
    kth = _best(at_home, k).where(F.col("rank") == k).select(F.col("q").alias("row"), F.col("score").cast("double").alias("least"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    sent = (
        queries.join(kth, "row", "left")
        .select("row", "v", "dim", F.coalesce("least", none).alias("least"), F.explode(others).alias("shard"))
    )
    found = at_home.unionByName(_search_shards(vectors, sent, k))
    names = queries.select(F.col("row").alias("q"), F.col("id").alias("query_id"))
    return _best(found, k).join(names, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
