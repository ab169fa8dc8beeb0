"""Exact top-k by inner product: ball trees over shards, searched by branch and bound for blocks of queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinewise.llm.common import staged

#: Vectors of a leaf; queries of a block; vectors of a shard (fewer than 65,536, which a search key relies on).
LEAF, QUERY_BLOCK, SHARD_ROWS = 128, 4096, 4096


def quantised(frame: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """(id, dim, v): floor(scale * x) of every component; vectors null, empty or with a null, NaN or infinite part are left out."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = frame.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("x")).where(F.col("id").isNotNull())
    kept = kept.withColumnRenamed("x", vector).where(finite & (F.size(vector) > 0))
    return kept.select("id", F.size(vector).alias("dim"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


class BallTree:
    """Nodes in preorder over reordered vectors: each has a centre, a radius and a range of rows."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray | None = None):
        self.nodes: list[tuple[np.ndarray, float, int, int, int, int]] = []
        order = np.argsort(ids, kind="stable")
        order = order[np.concatenate(self._split(x, order))] if len(order) else order
        self.x, self.ids = x[order], ids[order]
        self.rows = order if rows is None else rows[order]
        # Of equal scores the smaller id counts more: places by descending id.
        self.less = np.empty(len(ids), np.int64)
        self.less[np.argsort(self.ids, kind="stable")[::-1]] = np.arange(len(ids))

    def _split(self, x: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
        leaves: list[np.ndarray] = []

        def build(rows: np.ndarray, at: int) -> int:
            own = x[order[rows]]
            centre = own.mean(0)
            radius = float(np.sqrt(((own - centre) ** 2).sum(1).max()))
            me = len(self.nodes)
            self.nodes.append((centre, radius, at, at + len(rows), -1, -1))
            if len(rows) <= LEAF or radius == 0:
                leaves.append(rows)
                return me
            # Halves by nearness to two far points, cut in the middle, so that equal vectors split as well.
            a = own[((own - own[0]) ** 2).sum(1).argmax()]
            b = own[((own - a) ** 2).sum(1).argmax()]
            halves = rows[np.argsort(own @ (b - a), kind="stable")]
            middle = len(rows) // 2
            left = build(halves[:middle], at)
            right = build(halves[middle:], at + middle)
            self.nodes[me] = (centre, radius, at, at + len(rows), left, right)
            return me

        build(np.arange(len(order)), 0)
        return leaves

    def search(self, queries: np.ndarray, own_ids: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of each query's k best here that reach its `floor`; its own id is no candidate."""
        lengths = np.sqrt((queries**2).sum(1))
        best = np.full((len(queries), k), -np.inf)
        rows = np.full((len(queries), k), -1, np.int64)
        kth = floor.astype(float).copy()

        def bound(node: int, q: np.ndarray) -> np.ndarray:
            # What rounding may have taken from the product, the centre or the radius is put on top, whatever the sign.
            centre, radius = self.nodes[node][:2]
            spare = lengths[q] * (float(np.sqrt((centre**2).sum())) + radius) * 1e-12 + 1e-6
            return queries[q] @ centre + lengths[q] * radius + spare

        def visit(node: int, q: np.ndarray, upper: np.ndarray) -> None:
            q = q[upper >= kth[q]]
            if not len(q):
                return
            _, _, lo, hi, left, right = self.nodes[node]
            if left < 0:
                scores = queries[q] @ self.x[lo:hi].T
                scores[own_ids[q, None] == self.ids[lo:hi]] = -np.inf
                hit = (scores >= kth[q, None]).any(1)
                if hit.any():
                    self._merge(best, rows, q[hit], scores[hit], lo, hi)
                    kth[q[hit]] = np.maximum(kth[q[hit]], best[q[hit], -1])
                return
            to_left, to_right = bound(left, q), bound(right, q)
            first = to_left >= to_right
            visit(left, q[first], to_left[first])
            visit(right, q[~first], to_right[~first])
            visit(right, q[first], to_right[first])
            visit(left, q[~first], to_left[~first])

        if len(queries) and len(self.ids):
            everyone = np.arange(len(queries))
            visit(0, everyone, bound(0, everyone))
        query, place = np.nonzero((rows >= 0) & (best >= floor[:, None]))
        return query, rows[query, place], best[query, place]

    def _merge(self, best: np.ndarray, rows: np.ndarray, q: np.ndarray, scores: np.ndarray, lo: int, hi: int) -> None:
        k = best.shape[1]
        all_scores = np.concatenate([best[q], scores], 1)
        all_rows = np.concatenate([rows[q], np.broadcast_to(np.arange(lo, hi), scores.shape)], 1)
        all_rows[all_scores == -np.inf] = -1
        tie = np.where(all_rows >= 0, self.less[all_rows], -1)
        if all_scores.shape[1] > 4 * k:  # what is below the k-th score cannot stay
            cut = np.partition(all_scores, -k, axis=1)[:, -k]
            width = int((all_scores >= cut[:, None]).sum(1).max())
            near = np.argpartition(-all_scores, min(width, all_scores.shape[1] - 1), axis=1)[:, :width]
            all_scores, all_rows, tie = (np.take_along_axis(v, near, 1) for v in (all_scores, all_rows, tie))
        top = np.lexsort((-tie, -all_scores), axis=1)[:, :k]
        best[q], rows[q] = np.take_along_axis(all_scores, top, 1), np.take_along_axis(all_rows, top, 1)


def _searched(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, row, id, score) of each task's k best: one task for a shard of candidates and a block of queries."""
    schema = "query long, row long, id long, score double"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="float64" if c.endswith("double") else "int64") for c in schema.split(", ")})
        left = left.sort_values(["id", "row"])
        tree = BallTree(np.stack(left["v"].to_numpy()), left["id"].to_numpy(), left["row"].to_numpy())
        floor = right["floor"].to_numpy(dtype=float, na_value=-np.inf)
        query, row, score = tree.search(np.stack(right["v"].to_numpy()), right["id"].to_numpy(), np.where(np.isnan(floor), -np.inf, floor), k)
        return pd.DataFrame({"query": right["query"].to_numpy()[query], "row": tree.rows[row], "id": tree.ids[row], "score": score})

    # Little data and much work: as many tasks as there may be, not as many as the bytes call for.
    keys, tasks = ["dim", "shard", "block"], int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [F.col(c).alias(c) for c in queries.columns]  # columns of their own, apart from the candidates'
    candidates, queries = candidates.repartition(tasks, *keys), queries.select(*own).repartition(tasks, *keys)
    return candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, schema)


def _best(found: DataFrame, k: int, by: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_top_k(
    vectors: DataFrame,
    k: int = 20,
    query_step: int = 20,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k highest integer inner products of every query (ids divisible by `query_step`) with all other rows.

    Rows are numbered once and go to shards by a hash of their number, so that the rows of one id are spread; a
    shard's ball tree is searched for a block of queries at once, the child of the higher bound first, and a node is
    left out for queries whose k-th score is above its bound. The first round searches one shard for each query. Its
    k-th scores are the floors from which the second round searches all others, so most of their results end below
    the floor and never leave the task.

    Bounds are rounded upward; products are exact while they stay below 2^53. Ties go to the smaller id.
    Ids null, vectors null, empty or with a null or non-finite component take no part; vectors of different
    lengths do not meet. Rows of one id are each a candidate, with a rank each. A query id with several different vectors asks
    with all of them: a candidate row counts once, by its best score. Fewer than k candidates give all of them.
    An empty table gives an empty result; other columns of the input are left out.
    """
    whole = staged(quantised(vectors, scale, key, vector).withColumn("row", F.monotonically_increasing_id()), "top-k-rows")
    shards = max(1, -(-whole.count() // shard_rows))
    placed = whole.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(shards)))
    distinct = whole.where(F.col("id") % query_step == 0).select("id", "dim", "v").distinct()
    asked = staged(distinct.withColumn("query", F.monotonically_increasing_id()), "top-k-queries")
    blocks = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query", F.lit(7)), F.lit(blocks)))
    asked = asked.withColumn("shard", F.pmod(F.xxhash64("query", F.lit(5)), F.lit(shards)))
    candidates = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    first = staged(_searched(candidates, asked.withColumn("floor", F.lit(None).cast("double")), k), "top-k-home")
    if shards > 1:
        floors = _best(first, k, "query").where(F.col("rank") == k).select("query", F.col("score").alias("floor"))
        others = asked.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
        others = others.where(F.col("n") != F.col("shard")).drop("shard").withColumnRenamed("n", "shard")
        found = first.union(_searched(candidates, others.join(floors, "query", "left"), k))
    else:
        found = first
    named = found.join(asked.select("query", F.col("id").alias("query_id")), "query")
    # The k best rows of an id are among the k best of its vectors.
    once = named.groupBy("query_id", "row", "id").agg(F.max("score").alias("score"))
    return _best(once, k, "query_id").select("query_id", "rank", F.col("id").alias("vec_id"), F.col("score").cast("long").alias("score"))
