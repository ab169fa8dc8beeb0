"""Approximate nearest neighbours by shifted space-filling curves: windows of several Hilbert orderings, reranked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinewise.llm.common import staged

#: Rows of a curve that are scored together, and rows of a curve whose queries they are scored for.
BLOCK, GROUP = 4096, 81_920
#: Vectors from which the scale of the projections is fitted.
SAMPLE = 2048


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Where each row of integer cells (0 <= cell < 2**bits) stands on the Hilbert curve; bits times columns is 62 at most.

    The transform that turns coordinates into the transposed index by exchanges and inversions, from the high bit
    down, followed by Gray decoding; the bits are then read across the columns.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    q = top
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for column in x:
            key = key << 1 | ((column ^ flip) >> b) & 1
    return key


class Curves:
    """The projections, shifts and scales of all curves for vectors of one length; the same on every machine."""

    def __init__(self, dim: int, curves: int, columns: int, bits: int, seed: int, norm: float, sample: np.ndarray):
        rng = np.random.default_rng([seed, dim])
        self.bits, self.norm = bits, norm
        self.columns = min(columns, dim + 1)
        self.rotations = [np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0][:, : self.columns] for _ in range(curves)]
        self.shifts = [rng.uniform(0, 0.5, self.columns) for _ in range(curves)]
        placed = self.candidates(sample) if len(sample) else np.zeros((0, dim + 1))
        self.centre = placed.mean(0) if len(placed) else np.zeros(dim + 1)
        spread = float(placed.std(0).mean()) if len(placed) else 0.0
        self.reach = 4 * (spread or 1 / np.sqrt(dim + 1))

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """On the unit sphere, with one more component, so that nearness there orders inner products as they are."""
        x = x / self.norm
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1 - (x**2).sum(1)))])

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x / np.sqrt((x**2).sum(1))[:, None], np.zeros(len(x))])

    def keys(self, placed: np.ndarray) -> list[np.ndarray]:
        out = []
        for rotation, shift in zip(self.rotations, self.shifts, strict=True):
            y = ((placed - self.centre) @ rotation / self.reach + 1) / 3 + shift / 1.5  # within 0..1, wherever shifted
            cells = np.clip((y * (1 << self.bits)).astype(np.int64), 0, (1 << self.bits) - 1)
            out.append(hilbert_keys(cells, self.bits))
        return out


def _usable(rows: DataFrame) -> DataFrame:
    """Rows (row, id, v) that take part, v in doubles, with the length of v."""
    kept = rows.select("row", "id", F.col("v").cast("array<double>").alias("v")).where(F.col("id").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return kept.where(finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame,
    k: int = 20,
    query_step: int = 20,
    curves: int = 64,
    columns: int = 20,
    bits: int = 3,
    share: float = 0.0038,
    least: int = 60,
    seed: int = 11,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k largest inner products of every query (ids divisible by `query_step`) among rows near it on a curve.

    Each curve projects vectors at random to `columns` dimensions, shifts them and orders them by their place
    on a Hilbert curve; Spark sorts every ordering by ranges. A query meets the rows at most max(`least`, `share` of
    all rows) places away on any curve. Many curves with narrow windows find more than few with wide ones: the nearer
    a cell, the more of what is in it is near. On the curves vectors travel as bytes, with the bound of what that
    takes from a product; whatever the bounds leave among the k best is compared again, in double precision, by the
    vectors themselves, so that the bytes decide nothing. A row that is near on several curves is compared again once.

    Vectors need not have one norm: a component is added under which nearness orders inner products.
    The scale of the grid is fitted on a sample of 2,048 rows; every row is indexed and can be found.

    Ids null, vectors null, zero or with null or non-finite components take no part; vectors of different
    lengths do not meet; ties go to the smaller id; rows of the query's id are not its neighbours. Rows with the
    same id and vector are one row from the start; an id's different vectors have places on the curves each, and
    the best for a query takes one of its k places; a query id with several vectors asks with all of them. An empty
    table gives an empty result; other columns are left out.
    """
    spark = vectors.sparkSession
    distinct = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).distinct()
    kept = staged(distinct.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = _usable(kept)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    stats = {r["dim"]: r for r in usable.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm")).collect()}
    sample = usable.orderBy(F.xxhash64("id")).limit(SAMPLE).collect()
    fitted = {
        dim: Curves(dim, curves, columns, bits, seed, r["norm"], np.array([s["v"] for s in sample if s["dim"] == dim]).reshape(-1, dim))
        for dim, r in stats.items()
    }
    radius = {dim: max(least, int(np.ceil(share * r["n"]))) for dim, r in stats.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                x, ids, own = np.stack(rows["v"].to_numpy()), rows["id"].to_numpy(), fitted[dim]
                number, asked = rows["row"].to_numpy(), ids % query_step == 0
                steps = np.abs(x).max(1) / 127
                small = np.rint(x / steps[:, None]).astype(np.int8)
                # A query travels whole, in doubles.
                for role, some, at, raw in ((0, np.ones(len(ids), bool), own.candidates(x), small), (1, asked, own.queries(x[asked]), x[asked].astype("<f8"))):
                    raw = [v.tobytes() for v in np.ascontiguousarray(raw)]
                    for curve, keys in enumerate(own.keys(at)):
                        yield pd.DataFrame({"dim": dim, "curve": curve, "key": keys, "role": role, "id": ids[some], "row": number[some], "step": steps[some], "v": raw})

    order = ["dim", "curve", "key", "role", "row"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = usable.mapInPandas(place, "dim int, curve int, key long, role int, id long, row long, step double, v binary")
    placed = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one curve stand together; each gets the count of candidates before it in this task."""
        task, last, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            curve = np.asarray(batch.column(0), np.int64) << 32 | np.asarray(batch.column(1), np.int64)
            own = np.asarray(batch.column(3)) == 0
            count = np.cumsum(own)
            heads = np.flatnonzero(np.concatenate([[True], curve[1:] != curve[:-1]])) if len(curve) else np.zeros(0, int)
            reset = (count - own)[heads]
            if len(heads) and curve[0] == last:
                reset[0] = -before
            local = count - own - np.repeat(reset, np.diff(np.append(heads, len(curve))))
            if len(curve):
                last, before = curve[-1], int(local[-1] + own[-1])
            columns = [batch.column(c) for c in (0, 1, 3, 4, 5, 6, 7)]
            names = ["dim", "curve", "role", "id", "row", "step", "v", "task", "local"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([task] * len(curve), pa.int32()), pa.array(local, pa.int64())], names=names)

    rows = staged(placed.mapInArrow(number, "dim int, curve int, role int, id long, row long, step double, v binary, task int, local long"), "curves")
    earlier = Window.partitionBy("dim", "curve").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("dim", "curve", "task").agg(F.sum(1 - F.col("role")).alias("n"))
    counts = counts.select("dim", "curve", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    reach = F.create_map(*[F.lit(v) for d, r in radius.items() for v in (d, r)]) if radius else F.create_map(F.lit(0), F.lit(0))
    rows = rows.join(counts, ["dim", "curve", "task"]).withColumn("pos", F.col("base") + F.col("local")).withColumn("r", reach[F.col("dim")].cast("long"))
    rows = rows.withColumn("grp", F.expr(f"pos div {GROUP}"))
    blocks = F.expr(f"sequence(greatest(pos - r, 0L) div {BLOCK}, (pos + r) div {BLOCK})")
    if max(radius.values(), default=0) <= BLOCK // 4:
        # Narrow windows: a query goes to its own block alone, and rows near a block's ends go to the next one too.
        candidates = rows.where("role = 0").withColumn("grp", F.lit(0).cast("long")).withColumn("block", F.explode(blocks))
        queries = rows.where("role = 1").withColumn("grp", F.lit(0).cast("long")).withColumn("block", F.expr(f"pos div {BLOCK}"))
    else:
        # Wide ones: a row is in one block, a query goes to all its window touches; blocks are scored for some of them at a time.
        groups = F.expr(f"sequence(greatest(block * {BLOCK} - r, 0L) div {GROUP}, ((block + 1) * {BLOCK} + r) div {GROUP})")
        candidates = rows.where("role = 0").withColumn("block", F.expr(f"pos div {BLOCK}")).withColumn("grp", F.explode(groups))
        queries = rows.where("role = 1").withColumn("block", F.explode(blocks))
    return _reranked(_near(candidates, queries, k, tasks), usable, k)


def scored_pairs(pos: np.ndarray, at: np.ndarray, r: int) -> Iterator[tuple[slice, slice]]:
    """(queries, candidates) to score at once, both in the order of their places: windows of queries close together."""
    begin = 0
    while begin < len(pos):
        end = max(begin + 1, int(np.searchsorted(pos, pos[begin] + r // 8, side="right")))
        end = min(end, begin + 512)
        yield slice(begin, end), slice(int(np.searchsorted(at, pos[begin] - r)), int(np.searchsorted(at, pos[end - 1] + r, side="right")))
        begin = end


def _near(candidates: DataFrame, queries: DataFrame, k: int, tasks: int) -> DataFrame:
    """(query_id, asked, id, row, low, high): of each block, what may be among a query's k best ids there, between bounds."""
    schema = "query_id long, asked long, id long, row long, low double, high double"

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c.split()[0]: pd.Series(dtype="float64" if c.endswith("double") else "int64") for c in schema.split(", ")})]
        if left.empty or right.empty:
            return out[0]
        left, right = left.sort_values(["pos", "row"]), right.sort_values(["pos", "row"])
        q = np.frombuffer(b"".join(right["v"]), "<f8").reshape(len(right), -1)
        x = np.frombuffer(b"".join(left["v"]), np.int8).reshape(len(left), -1).astype(np.float32).astype(float)
        x *= left["step"].to_numpy()[:, None]
        half = left["step"].to_numpy() * 0.5000001
        ids, rows, at = left["id"].to_numpy(), left["row"].to_numpy(), left["pos"].to_numpy()
        asked, number, pos, r = right["id"].to_numpy(), right["row"].to_numpy(), right["pos"].to_numpy(), int(right["r"].iloc[0])
        length = np.abs(q).sum(1)
        repeated = len(np.unique(ids)) < len(ids)
        for some, window in scored_pairs(pos, at, r):
            if window.start >= window.stop:
                continue
            products = q[some] @ x[window].T
            spare = length[some, None] * half[window] + 1e-12 * length[some, None]
            out_of = (np.abs(pos[some, None] - at[window]) > r) | (asked[some, None] == ids[window])
            low = np.where(out_of, -np.inf, products - spare)
            best = low
            if repeated:  # an id counts once, by its best row
                by_id = np.argsort(ids[window], kind="stable")
                heads = np.flatnonzero(np.diff(ids[window][by_id], prepend=ids[window][by_id[0]] - 1))
                best = np.maximum.reduceat(low[:, by_id], heads, axis=1)
            kth = np.partition(best, -k, axis=1)[:, -k] if best.shape[1] > k else np.full(len(best), -np.inf)
            i, j = np.nonzero((low + 2 * spare >= kth[:, None]) & ~out_of)
            names = ["query_id", "asked", "id", "row", "low", "high"]
            values = [asked[some][i], number[some][i], ids[window][j], rows[window][j], low[i, j], (low + 2 * spare)[i, j]]
            out.append(pd.DataFrame(dict(zip(names, values, strict=True))))
        return pd.concat(out)

    keys = ["dim", "curve", "block", "grp"]
    own = [F.col(c).alias(c) for c in queries.columns]  # columns of their own, apart from the candidates'
    candidates, queries = candidates.repartition(tasks, *keys), queries.select(*own).repartition(tasks, *keys)
    return candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(score, schema)


def _reranked(near: DataFrame, usable: DataFrame, k: int) -> DataFrame:
    """The k best of each query by its exact scores; a row found on several curves counts once."""
    once = staged(near.groupBy("query_id", "asked", "id", "row").agg(F.max("low").alias("low"), F.max("high").alias("high")), "near-rows")
    per_id = once.groupBy("query_id", "id").agg(F.max("low").alias("low"))
    order = Window.partitionBy("query_id").orderBy(F.desc("low"))
    kth = per_id.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", F.col("low").alias("least"))
    left = once.join(kth, "query_id", "left").where(F.col("least").isNull() | (F.col("high") >= F.col("least")))
    asked = usable.select(F.col("row").alias("asked"), F.col("v").alias("q"))
    both = left.select("query_id", "asked", "id", "row").join(asked, "asked").join(usable.select("row", "v"), "row")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    best = both.select("query_id", "id", score.alias("score")).groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
