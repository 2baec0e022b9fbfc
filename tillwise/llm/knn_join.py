"""Exact top-k search by largest inner product as a Voronoi kNN join.

Integer vectors x become points (x, sqrt(M - |x|^2)) with M the largest squared norm,
and queries points (q, 0). All points then lie at distances for which

    |q - x|^2 = |q|^2 + M - 2 q.x

so the largest inner products are the nearest points, and the triangle inequality holds.

1. Pivots: up to ``MAX_PIVOTS`` distinct vectors of smallest hash. They split data and
   queries into Voronoi cells. Only the pivots are broadcast.
2. Summaries per cell: number of rows, largest radius, and the k smallest distances to
   the pivot; for query cells the largest radius.
3. Bounds per group of query cells: theta is the k-th smallest of radius + pivot distance
   + point distance over the summaries, an upper bound on any k-th neighbour. A point s of
   cell j can matter only if |p_i p_j| - U_i - |p_j s| <= theta.
4. Replicate: a data row goes to the groups whose bound it meets, and to no other.
5. Solve: groups are cut into blocks of queries and of data; each pair of blocks returns
   its k best per query from an exact integer product, and the best k of these remain.

Distances prune, with a margin for rounding; scores are integers throughout. In many
dimensions without structure no bound prunes; the cost is then a blocked product of all
queries and all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.vectors import distinct, stack, usable
from tillwise.workspace import materialise

SCALE = 256
MAX_PIVOTS = 512
#: A cell holds about so many rows while the pivots allow it.
CELL_ROWS = 500
QUERY_BLOCK = 2048
DATA_BLOCK = 16_384
_MARGIN = 1e-6


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec``: components as floor(256 x), packed as 64-bit integers."""
    vector = F.col(vec_col).cast("array<double>")

    def pack(batches):
        for batch in batches:
            lists = batch.column(1)
            values = np.floor(SCALE * lists.values.to_numpy(zero_copy_only=False))
            # Values beyond a long end at its limits.
            values = np.clip(values, -(2.0**63), 2.0**63 - 1024).astype("<i8")
            ends = lists.offsets.to_numpy()
            rows = [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.binary())], ["id", "vec"]
            )

    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    return chosen.where(usable(F.col("v")) & F.col("id").isNotNull()).mapInArrow(
        pack, "id long, vec binary"
    )


def _norms(rows: np.ndarray) -> np.ndarray:
    wide = rows.astype(np.float64)
    return np.einsum("ij,ij->i", wide, wide)


def _pad(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


def _lift(rows: np.ndarray, largest: float, is_query: bool = False) -> np.ndarray:
    """Points in the space where the inner product is a distance."""
    last = np.zeros(len(rows)) if is_query else np.sqrt(np.maximum(largest - _norms(rows), 0))
    return np.column_stack([rows.astype(np.float64), last])


def _nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and distance to its pivot. Dimensions that one side lacks are zero there."""
    width = max(points.shape[1], pivots.shape[1]) - 1
    grow = lambda m: np.column_stack([_pad(m[:, :-1], width), m[:, -1]])
    points, pivots = grow(points), grow(pivots)
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * points @ pivots.T
    cell = square.argmin(axis=1)
    # Differences, not the expanded square: the bounds must not be off by cancellation.
    return cell, np.sqrt(((points - pivots[cell]) ** 2).sum(axis=1))


def _assign(rows: DataFrame, pivots, largest: float, is_query: bool) -> DataFrame:
    """``cell`` and ``dist`` of packed vectors; ``pivots`` is broadcast."""

    def run(batches):
        for batch in batches:
            points = _lift(stack(batch.column(0), "<i8"), largest, is_query)
            cell, dist = _nearest(points, pivots.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(dist)],
                ["vec", "ids", "first", "cell", "dist"],
            )

    return rows.select("vec", "ids", "first").mapInArrow(
        run, "vec binary, ids array<long>, first boolean, cell int, dist double"
    )


def _largest_norm(rows: DataFrame) -> tuple[float, int]:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                norm = _norms(stack(batch.column(0), "<i8")).max()
                yield pa.RecordBatch.from_pydict({"norm": [float(norm)], "n": [batch.num_rows]})

    found = rows.select("vec").mapInArrow(run, "norm double, n long").agg(
        F.max("norm"), F.sum("n")).first()
    return found[0] or 0.0, found[1] or 0


def plan_groups(queries: DataFrame, data: DataFrame, between: np.ndarray, k: int):
    """Groups of query cells and, for each (group, data cell), the least distance that matters.

    Reads only the cells' summaries, of which there are at most as many as pivots.
    """
    bounding = data.where("first") if "first" in data.columns else data
    nearest = bounding.withColumn("r", F.row_number().over(W.partitionBy("cell").orderBy("dist")))
    points = nearest.where(F.col("r") <= k).groupBy("cell").agg(
        F.array_sort(F.collect_list("dist")).alias("near"))
    cells = data.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("far"))
    summary = {r.cell: r for r in cells.join(points, "cell", "left").collect()}
    asked = {r.cell: r for r in queries.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("dist").alias("far")).collect()}
    homes = np.array(sorted(summary))
    far = np.array([summary[j].far for j in homes])
    rows = np.array([summary[j].n for j in homes])

    # Neighbouring cells share a group until it has a block of queries.
    group_of, left, g = {}, sorted(asked), 0
    while left:
        first = left[0]
        near = sorted(left, key=lambda i: between[first, i])
        size = 0
        for i in near:
            if size and size + asked[i].n > QUERY_BLOCK:
                break
            group_of[i] = g
            size += asked[i].n
        left = [i for i in left if i not in group_of]
        g += 1

    limits = []
    for group in range(g):
        lowest = np.full(len(homes), np.inf)
        for i in (c for c, at in group_of.items() if at == group):
            reach = asked[i].far
            bounds = np.sort(np.concatenate([
                reach + between[i, j] + np.array(summary[j].near or []) for j in homes]))
            theta = bounds[min(k, len(bounds)) - 1] if len(bounds) >= k else np.inf
            theta += _MARGIN * (1 + abs(theta)) if np.isfinite(theta) else 0
            lowest = np.minimum(lowest, between[i, homes] - reach - theta)
        open_cells = lowest <= far + _MARGIN * (1 + far)
        blocks = max(1, -(-int(rows[open_cells].sum()) // DATA_BLOCK))
        limits += [
            (int(j), group, float(low - _MARGIN * (1 + abs(low))) if np.isfinite(low) else -1.0,
             blocks)
            for j, low in zip(homes[open_cells], lowest[open_cells])
        ]
    sizes = {}
    for i, at in group_of.items():
        sizes[at] = sizes.get(at, 0) + asked[i].n
    many = {at: max(1, -(-n // QUERY_BLOCK)) for at, n in sizes.items()}
    blocks = {at: b for _, at, _, b in limits}
    groups = [(i, at, many[at], blocks.get(at, 1)) for i, at in group_of.items()]
    return groups, [(j, at, low, b, many[at]) for j, at, low, b in limits]


def _products(queries: np.ndarray, data: np.ndarray):
    """Exact integer inner products of all rows with all rows."""
    width = max(queries.shape[1], data.shape[1])
    a, b = _pad(queries, width), _pad(data, width)
    top = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if top * max(1, width) < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top * max(1, width) < 2.0**63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _solve(k: int):
    """Per query vector of a block, the k best ids of a block of data: (vec, vec_id, score)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            # Columns in order of id: equal scores rank by id, so a stable sort does.
            ids = right["ids"].combine_chunks()
            flat = ids.values.to_numpy()
            owner = np.repeat(np.arange(len(ids)), np.diff(ids.offsets.to_numpy()))
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            data = stack(right["vec"].combine_chunks(), "<i8")
            some = left["vec"].combine_chunks()
            asked = stack(some, "<i8")
            for a in range(0, len(asked), 256):
                # An id counts by the best of its vectors.
                scores = _products(asked[a : a + 256], data)[:, owner]
                if len(start) < len(flat):
                    scores = np.maximum.reduceat(scores, start, axis=1)
                for i, row in enumerate(scores):
                    if len(row) > k:
                        kth = np.partition(row, len(row) - k)[len(row) - k]
                        keep = np.flatnonzero(row >= kth)
                    else:
                        keep = np.arange(len(row))
                    keep = keep[np.argsort(~row[keep], kind="stable")][:k]
                    out[0].extend([some[a + i].as_py()] * len(keep))
                    out[1].append(flat[start[keep]])
                    out[2].append(row[keep])
        values = [np.concatenate(o) if o else np.empty(0, np.int64) for o in out[1:]]
        return pa.table({"vec": pa.array(out[0], pa.binary()), "vec_id": pa.array(values[0], pa.int64()),
                         "score": pa.array(values[1], pa.int64())})

    return run


def _marked(data: DataFrame, rows: DataFrame) -> DataFrame:
    """``data`` with ``first``: whether the vector is the smallest of one of its ids.

    Different vectors of that kind have different ids, so k of them bound k candidates.
    """
    twice = rows.groupBy("id").agg(F.count("*").alias("n"), F.min("vec").alias("first_vec"))
    if twice.where("n > 1").isEmpty():
        return data.withColumn("first", F.lit(True))
    some = twice.select(F.col("first_vec").alias("vec")).distinct().withColumn("first", F.lit(True))
    return data.join(some, "vec", "left").fillna({"first": False})


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product for each query.

    Components count as floor(256 x). ``queries`` are rows like ``vectors``; a candidate
    with the query's own id is passed over. Equal scores rank by smaller id. Vectors that
    are null or hold null or non-finite components, and null ids, take no part. Vectors of
    different lengths are compared over the shorter one's components; an empty vector
    scores 0. Queries with equal id and vector share one answer; queries that share an id
    only are ranked each on its own. A candidate is an id; of several vectors its best
    counts. Scores beyond a long end at its limits.
    """
    spark: SparkSession = vectors.sparkSession
    rows = materialise(quantised(vectors, id_col, vec_col).distinct(), "knn-rows")
    asked = materialise(quantised(queries, id_col, vec_col).distinct(), "knn-queries")
    data = materialise(_marked(distinct(rows, "vec", "id", k + 1), rows), "knn-data")
    shapes = "query_id long, rank int, vec_id long, score long"
    largest, count = _largest_norm(data)
    if not count:
        return spark.createDataFrame([], shapes)
    wanted = max(1, min(MAX_PIVOTS, count // CELL_ROWS))
    drawn = data.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(wanted).collect()
    pivots = [bytes(r.vec) for r in drawn]
    points = _lift(stack(pa.array(pivots, pa.binary()), "<i8"), largest)
    shared = spark.sparkContext.broadcast(points)
    between = np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in points])
    # Equal query vectors are solved once.
    different = asked.select("vec").distinct().select(
        "vec", F.array().cast("array<long>").alias("ids"), F.lit(True).alias("first"))
    query_cells = materialise(_assign(different, shared, largest, True), "knn-query-cells")
    data_cells = materialise(_assign(data, shared, largest, False), "knn-data-cells")
    groups, limits = plan_groups(query_cells, data_cells, between, k + 1)
    if not groups:
        return spark.createDataFrame([], shapes)
    # Both tables are bounded by the pivots: at most MAX_PIVOTS rows, and its square.
    of_group = spark.createDataFrame(groups, "cell int, grp int, q_blocks int, d_blocks int")
    of_limit = spark.createDataFrame(
        limits, "cell int, grp int, low double, d_blocks int, q_blocks int")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    left = query_cells.join(F.broadcast(of_group), "cell").select(
        "vec", "grp", F.expr("cast(pmod(xxhash64(vec), q_blocks) as int)").alias("qb"),
        F.explode(upto("d_blocks")).alias("db"),
    )
    right = data_cells.join(F.broadcast(of_limit), "cell").where("dist >= low").select(
        "vec", "ids", "grp", F.expr("cast(pmod(xxhash64(vec), d_blocks) as int)").alias("db"),
        F.explode(upto("q_blocks")).alias("qb"),
    )
    keys = ("grp", "qb", "db")
    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _solve(k + 1), "vec binary, vec_id long, score long"
    )
    # An id may have vectors in several blocks.
    merged = (
        part.groupBy("vec", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("at", F.row_number().over(W.partitionBy("vec").orderBy(F.desc("score"), "vec_id")))
        .where(F.col("at") <= k + 1)
    )
    best = W.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")
    return (
        asked.withColumnRenamed("id", "query_id").join(merged.drop("at"), "vec")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
