"""Approximate nearest neighbours by cosine: an NN-descent graph and a greedy search of it.

Building. Every distinct vector is a node with a list of its ``NEIGHBOURS`` nearest found
so far. Lists start from Voronoi cells around ``TREES`` sets of sampled pivots: cells of at
most ``LEAF`` nodes are compared within. Then rounds of NN-descent: an edge tells both ends
of each other, a node's pool is the neighbours it has or that have it, and members of a
pool meet if one is new to it. Improvements are joined back to the members' lists. A node
is in at most ``NEIGHBOURS + REVERSE`` pools, so a vector that is near to many is not hot.

Searching. All queries walk at once. Each keeps a beam of its best ``BEAM`` nodes; a hop
joins the best not yet expanded with the graph's rows, scores their neighbours where the
rows lie, and merges what beats the beam. A query that is a stored vector starts from its
node, others from the pivots. The walk ends when every beam is expanded. The best
``RESCORED`` of a beam are ranked by exact cosines of the original vectors.

The graph is fitted on all rows. Scores inside the graph use components of eight bits.
Node rows, pools and beams have fixed widths; groups solved in one task have at most
``GROUP_NODES`` of them. Rounds and hops are written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.tables import bucketed
from tillwise.llm.vectors import distinct, stack, usable
from tillwise.workspace import materialise

NEIGHBOURS = 24
REVERSE = 20
TREES = 4
LEAF = 2048
MAX_PIVOTS = 2048
ROUNDS = 4
OFFERS = 4
#: Rounds end early when fewer than this share of list entries are new.
SETTLED = 0.02
BEAM = 256
EXPANDED = 96
RESCORED = 32
GROUP_NODES = 2048

_LISTS = "node long, vec binary, ids array<long>, scores array<float>, fresh boolean"


def nodes_of(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """``node, exact, vec, ids`` of distinct usable vectors.

    ``exact``: components as doubles; ``vec``: of the unit vector, a scale and eight bits
    per component; ``ids``: the k smallest ids with this vector; ``node``: a number of the
    vector's own, as ids may have several vectors. Write the frame before its use.
    """

    def exact(batches):
        for batch in batches:
            lists = batch.column(1)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<f8")
            # Minus zero equals zero, so equal vectors have equal bytes.
            values = values + 0.0
            ends = lists.offsets.to_numpy()
            rows = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
            live = [bool(np.any(r)) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(live)),
                    pa.array([r.tobytes() for r, ok in zip(rows, live) if ok], pa.binary()),
                ],
                ["id", "exact"],
            )

    def pack(batches):
        for batch in batches:
            packed = [_packed(np.frombuffer(v.as_py(), "<f8")) for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), batch.column(1)],
                ["exact", "vec", "ids"],
            )

    vector = F.col(vec_col).cast("array<double>")
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    rows = chosen.where(usable(F.col("v")) & F.col("id").isNotNull()).mapInArrow(
        exact, "id long, exact binary"
    )
    packed = distinct(rows.distinct(), "exact", "id", k).select("exact", "ids").mapInArrow(
        pack, "exact binary, vec binary, ids array<long>"
    )
    return packed.select(F.monotonically_increasing_id().alias("node"), "exact", "vec", "ids")


def _packed(row: np.ndarray) -> bytes:
    row = row / np.abs(row).max()  # the square of a huge component stays finite
    row = row / np.sqrt((row * row).sum())
    scale = np.abs(row).max() / 127
    return np.float32(scale).tobytes() + np.rint(row / scale).astype(np.int8).tobytes()


def _unpacked(column: pa.Array) -> np.ndarray:
    raw = stack(column, np.uint8)
    if not raw.size:
        return np.empty((len(raw), 0), np.float32)
    scale = np.ascontiguousarray(raw[:, :4]).view("<f4")
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    k = min(k, scores.shape[1])
    if k == scores.shape[1]:
        return np.argsort(-scores, axis=1, kind="stable")
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _leaf(k: int):
    """The nearest of each node among the nodes of its leaf."""

    def run(table: pa.Table) -> pa.Table:
        node = _whole(table, "node").to_numpy()
        vecs = _unpacked(_whole(table, "vec"))
        counts, ids, scores = [], [], []
        for a in range(0, len(node), 512):
            found = vecs[a : a + 512] @ vecs.T
            found[np.arange(len(found)), np.arange(a, a + len(found))] = -9
            at = _top(found, k)
            best = np.take_along_axis(found, at, 1)
            real = best > -5
            counts.append(real.sum(axis=1))
            ids.append(node[at][real])
            scores.append(best[real])
        return _messages(node, np.concatenate(counts), np.concatenate(ids), np.concatenate(scores))

    return run


def _messages(node, counts, ids, scores) -> pa.Table:
    return pa.table({
        "node": pa.array(node, pa.int64()),
        "vec": pa.nulls(len(node), pa.binary()),
        "ids": _lists(counts, pa.array(ids, pa.int64())),
        "scores": _lists(counts, pa.array(scores.astype(np.float32))),
        "fresh": pa.nulls(len(node), pa.bool_()),
    })


def _merge(k: int):
    """Lists of nodes from their old lists (rows with a vector) and messages: the k best."""

    def run(table: pa.Table) -> pa.Table:
        node, vec = _whole(table, "node").to_numpy(), _whole(table, "vec")
        ids, scores = _whole(table, "ids"), _whole(table, "scores")
        counts = np.diff(ids.offsets.to_numpy())
        is_old = np.asarray(vec.is_valid())
        who = np.repeat(node, counts)
        new = np.repeat(~is_old, counts)
        # flatten() leaves out what lies before the first offset.
        nbr, score = ids.flatten().to_numpy(), scores.flatten().to_numpy()
        order = np.lexsort((new, nbr, who))
        who, nbr, score, new = who[order], nbr[order], score[order], new[order]
        keep = np.ones(len(who), bool)
        keep[1:] = (who[1:] != who[:-1]) | (nbr[1:] != nbr[:-1])
        who, nbr, score, new = who[keep], nbr[keep], score[keep], new[keep]
        order = np.lexsort((nbr, -score, who))
        who, nbr, score, new = who[order], nbr[order], score[order], new[order]
        own = np.flatnonzero(is_old)
        own = own[np.argsort(node[own])]
        starts = np.searchsorted(who, node[own])
        rank = np.arange(len(who)) - starts[np.searchsorted(node[own], who)]
        keep = rank < k
        counts = np.diff(np.append(np.searchsorted(who[keep], node[own]), keep.sum()))
        return pa.table({
            "node": pa.array(node[own], pa.int64()),
            "vec": vec.take(pa.array(own)),
            "ids": _lists(counts, pa.array(nbr[keep], pa.int64())),
            "scores": _lists(counts, pa.array(score[keep], pa.float32())),
            "news": _lists(counts, pa.array(new[keep])),
        })

    return run


_GRAPH = "node long, vec binary, ids array<long>, scores array<float>, news array<boolean>"


def _grouped(rows: DataFrame, key: str, groups: int):
    return rows.withColumn("_g", F.pmod(F.xxhash64(key), F.lit(groups))).groupBy("_g")


def _local_join(offers: int, width: int):
    """Members of a pool meet; each is told of the best it does not have yet."""

    def run(table: pa.Table) -> pa.Table:
        pool, member = _whole(table, "pool").to_numpy(), _whole(table, "member").to_numpy()
        fresh = _whole(table, "fresh").to_numpy(zero_copy_only=False).astype(bool)
        worst = _whole(table, "worst").to_numpy()
        vecs = _unpacked(_whole(table, "vec"))
        order = np.lexsort((~fresh, member, pool))
        keep = np.ones(len(order), bool)
        p, m = pool[order], member[order]
        keep[1:] = (p[1:] != p[:-1]) | (m[1:] != m[:-1])
        order, p = order[keep], p[keep]
        starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        sizes = np.diff(np.append(starts, len(p)))
        out = ([], [], [], [])
        for a in range(0, len(starts), 256):
            some, count = starts[a : a + 256], sizes[a : a + 256]
            wide = int(min(width, count.max()))
            slot = np.arange(wide)[None, :]
            real = slot < count[:, None]
            at = order[np.where(real, some[:, None] + slot, 0)]
            v = vecs[at]
            score = v @ v.transpose(0, 2, 1)
            news = fresh[at] & real
            meet = real[:, :, None] & real[:, None, :] & (news[:, :, None] | news[:, None, :])
            meet[:, np.arange(wide), np.arange(wide)] = False
            meet &= score > worst[at][:, :, None]
            score[~meet] = -9
            flat = score.reshape(-1, wide)
            best = _top(flat, offers)
            value = np.take_along_axis(flat, best, 1)
            good = value > -5
            who = member[at].reshape(-1)
            other = member[at][np.repeat(np.arange(len(some)), wide)[:, None], best]
            some_good = good.any(axis=1)
            out[0].append(who[some_good])
            out[1].append(good.sum(axis=1)[some_good])
            out[2].append(other[good])
            out[3].append(value[good])
        return _messages(*map(np.concatenate, out))

    return run


def _start(nodes: DataFrame, k: int, trees: int, leaf: int, total: int) -> DataFrame:
    """Messages from comparing the nodes of each leaf of each tree."""
    wanted = max(1, min(MAX_PIVOTS, -(-2 * total // leaf)))
    spark = nodes.sparkSession
    sets = []
    for tree in range(trees):
        drawn = nodes.select("vec").orderBy(F.xxhash64("vec", F.lit(tree)), "vec").limit(wanted)
        sets.append(_unpacked(pa.array([bytes(r.vec) for r in drawn.collect()], pa.binary())))
    pivots = spark.sparkContext.broadcast(sets)

    def assign(batches):
        for batch in batches:
            vecs = _unpacked(batch.column(1))
            for tree, some in enumerate(pivots.value):
                width = max(vecs.shape[1], some.shape[1])
                grow = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))  # noqa: B023, E731
                cell = (grow(vecs) @ grow(some).T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell * trees + tree)], ["node", "vec", "cell"]
                )

    cells = materialise(
        nodes.select("node", "vec").mapInArrow(assign, "node long, vec binary, cell long"), "ann-cells"
    )
    # Cells above the size of a leaf are cut by hash; the list is as short as the pivots.
    sizes = F.broadcast(
        cells.groupBy("cell").count().select("cell", F.ceil(F.col("count") / leaf).alias("cuts"))
    )
    return (
        cells.join(sizes, "cell")
        .withColumn("cut", F.pmod(F.xxhash64("node", "cell"), F.col("cuts")))
        .groupBy("cell", "cut").applyInArrow(_leaf(k), _LISTS)
    )


def build(
    nodes: DataFrame,
    k: int = NEIGHBOURS,
    reverse: int = REVERSE,
    rounds: int = ROUNDS,
    trees: int = TREES,
    leaf: int = LEAF,
) -> DataFrame:
    """The neighbour graph of ``nodes`` (node, vec): ``node, vec, ids, scores, news``."""
    total = nodes.count()
    groups = max(1, -(-total // GROUP_NODES))
    bare = nodes.select(
        "node", "vec", F.array().cast("array<long>").alias("ids"),
        F.array().cast("array<float>").alias("scores"), F.lit(None).cast("boolean").alias("fresh"),
    )
    messages = _start(nodes, k, trees, leaf, total)
    graph = materialise(
        _grouped(bare.unionByName(messages), "node", groups).applyInArrow(_merge(k), _GRAPH), "ann-graph"
    )
    for turn in range(rounds):
        pairs = graph.select(
            F.col("node").alias("a"), F.explode(F.arrays_zip("ids", "news")).alias("e")
        ).select("a", F.col("e.ids").alias("b"), F.col("e.news").alias("fresh"))
        heard = pairs.withColumn("r", F.row_number().over(
            W.partitionBy("b").orderBy(F.desc("fresh"), F.xxhash64("a", "b", F.lit(turn)))
        )).where(F.col("r") <= reverse)
        both = heard.select(F.explode(F.array(
            F.struct(F.col("a").alias("member"), F.col("b").alias("pool"), "fresh"),
            F.struct(F.col("b").alias("member"), F.col("a").alias("pool"), "fresh"),
        )).alias("e")).select("e.*")
        pools = both.groupBy("member").agg(
            F.collect_list(F.struct("pool", "fresh")).alias("pools"))
        kth = F.when(F.size("scores") >= k, F.array_min("scores")).otherwise(F.lit(-2.0))
        sent = graph.select("node", "vec", kth.cast("float").alias("worst")).join(
            pools, F.col("node") == F.col("member")
        ).select("member", "vec", "worst", F.explode("pools").alias("e")).select(
            F.col("e.pool").alias("pool"), "member", F.col("e.fresh").alias("fresh"), "vec", "worst"
        )
        offers = _grouped(sent, "pool", groups).applyInArrow(
            _local_join(OFFERS, k + reverse), _LISTS)
        old = graph.select("node", "vec", "ids", "scores", F.lit(None).cast("boolean").alias("fresh"))
        graph = materialise(
            _grouped(old.unionByName(offers), "node", groups).applyInArrow(_merge(k), _GRAPH), "ann-graph"
        )
        changed = graph.select(
            F.sum(F.size(F.filter("news", lambda x: x))), F.sum(F.size("news"))).first()
        if (changed[0] or 0) <= SETTLED * (changed[1] or 0):
            break
    return graph


def _links(graph: DataFrame, k: int) -> DataFrame:
    """Per node, its neighbours and up to k that have it, with their vectors; bucketed by node.

    Bucketing lets every hop join without moving the graph.
    """
    pairs = graph.select(F.col("node").alias("a"), F.explode("ids").alias("b"))
    back = pairs.withColumn(
        "r", F.row_number().over(W.partitionBy("b").orderBy(F.xxhash64("a", "b")))
    ).where(F.col("r") <= k)
    edges = pairs.union(back.select("b", "a")).distinct()
    rows = edges.join(
        graph.select(F.col("node").alias("b"), "vec"), "b"
    ).groupBy(F.col("a").alias("node")).agg(F.collect_list(F.struct("b", "vec")).alias("near"))
    return bucketed(rows, "node", "ann-links")


_STATE = "query long, vec binary, ids array<long>, scores array<float>, done array<boolean>"


def _score_links(batches):
    """Scores of a node's neighbours for a query; only what beats the query's beam is kept."""
    for batch in batches:
        if not batch.num_rows:
            continue
        near = batch.column(3)
        counts = np.diff(near.offsets.to_numpy())
        flat = near.flatten()
        asked = np.repeat(_unpacked(batch.column(1)), counts, axis=0)
        vecs = _unpacked(flat.field("vec"))
        width = max(asked.shape[1], vecs.shape[1])
        grow = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))  # noqa: B023, E731
        score = np.einsum("ij,ij->i", grow(asked), grow(vecs))
        keep = score > np.repeat(batch.column(2).to_numpy(), counts)
        row = np.repeat(np.arange(len(counts)), counts)[keep]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.nulls(batch.num_rows, pa.binary()),
                _lists(np.bincount(row, minlength=len(counts)),
                       flat.field("b").filter(pa.array(keep))),
                _lists(np.bincount(row, minlength=len(counts)), pa.array(score[keep], pa.float32())),
                pa.nulls(batch.num_rows, pa.list_(pa.bool_())),
            ],
            ["query", "vec", "ids", "scores", "done"],
        )


def _advance(beam: int):
    """Beams merged with what a hop has found."""

    def run(table: pa.Table) -> pa.Table:
        query, vec = _whole(table, "query").to_numpy(), _whole(table, "vec")
        ids, scores, done = (_whole(table, c) for c in ("ids", "scores", "done"))
        counts = np.diff(ids.offsets.to_numpy())
        is_state = np.asarray(vec.is_valid())
        who = np.repeat(query, counts)
        node, score = ids.flatten().to_numpy(), scores.flatten().to_numpy()
        seen = np.zeros(len(who), bool)
        seen[np.repeat(is_state, counts)] = done.flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((~seen, node, who))
        who, node, score, seen = who[order], node[order], score[order], seen[order]
        keep = np.ones(len(who), bool)
        keep[1:] = (who[1:] != who[:-1]) | (node[1:] != node[:-1])
        who, node, score, seen = who[keep], node[keep], score[keep], seen[keep]
        order = np.lexsort((node, -score, who))
        who, node, score, seen = who[order], node[order], score[order], seen[order]
        own = np.flatnonzero(is_state)
        own = own[np.argsort(query[own])]
        starts = np.searchsorted(who, query[own])
        rank = np.arange(len(who)) - starts[np.searchsorted(query[own], who)]
        keep = rank < beam
        counts = np.diff(np.append(np.searchsorted(who[keep], query[own]), keep.sum()))
        return pa.table({
            "query": pa.array(query[own], pa.int64()),
            "vec": vec.take(pa.array(own)),
            "ids": _lists(counts, pa.array(node[keep], pa.int64())),
            "scores": _lists(counts, pa.array(score[keep], pa.float32())),
            "done": _lists(counts, pa.array(seen[keep])),
        })

    return run


def _entries(batches, entry_ids, entry_vecs):
    """First beams: the entry nodes nearest to each query, and its own node if it has one."""
    for batch in batches:
        vecs = _unpacked(batch.column(1))
        width = max(vecs.shape[1], entry_vecs.shape[1])
        grow = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))  # noqa: B023, E731
        found = grow(vecs) @ grow(entry_vecs).T
        ids, scores, counts = [], [], []
        for row, own in zip(found, batch.column(2).to_pylist()):
            at = np.argsort(-row)[:8]
            pairs = {int(entry_ids[i]): float(row[i]) for i in at}
            if own is not None:
                pairs[own] = 1.0
            ids += pairs
            scores += pairs.values()
            counts.append(len(pairs))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                _lists(np.array(counts), pa.array(ids, pa.int64())),
                _lists(np.array(counts), pa.array(scores, pa.float32())),
                _lists(np.array(counts), pa.array([False] * len(ids))),
            ],
            ["query", "vec", "ids", "scores", "done"],
        )


def _open(count: int) -> Column:
    """The best nodes of a beam that are not expanded yet."""
    pairs = F.arrays_zip("ids", "done")
    return F.slice(F.transform(F.filter(pairs, lambda p: ~p["done"]), lambda p: p["ids"]), 1, count)


def search(
    graph: DataFrame, nodes: DataFrame, asked: DataFrame, beam: int = BEAM, expanded: int = EXPANDED,
) -> DataFrame:
    """Beams ``query, ids, scores`` of ``asked`` (query, vec, own) after the walk."""
    entries = nodes.select("node", "vec").orderBy(F.xxhash64("vec"), "node").limit(64).collect()
    entry_ids = np.array([r.node for r in entries])
    entry_vecs = _unpacked(pa.array([bytes(r.vec) for r in entries], pa.binary()))
    links = _links(graph, NEIGHBOURS)
    groups = max(1, -(-asked.count() // GROUP_NODES * 4))
    state = materialise(
        asked.select("query", "vec", "own").mapInArrow(
            lambda batches: _entries(batches, entry_ids, entry_vecs), _STATE), "ann-state"
    )
    while True:
        worst = F.when(F.size("ids") >= beam, F.array_min("scores")).otherwise(F.lit(-2.0))
        steps = state.select(
            "query", F.col("vec").alias("q"), worst.cast("float").alias("worst"),
            F.explode(_open(expanded)).alias("node"),
        )
        if steps.isEmpty():
            break
        found = steps.join(links, "node").select("query", "q", "worst", "near").mapInArrow(
            _score_links, _STATE)
        # What this hop expands is marked before the merge.
        opened = _open(expanded)
        marked = F.transform(
            F.arrays_zip("ids", "done"), lambda p: p["done"] | F.array_contains(opened, p["ids"]))
        base = state.withColumn("done", marked)
        state = materialise(
            _grouped(base.unionByName(found), "query", groups).applyInArrow(_advance(beam), _STATE),
            "ann-state",
        )
    return state.select("query", "ids", "scores")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
    vec_col: str = "embedding", beam: int = BEAM,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k found nearest by cosine for each query row.

    A candidate with the query's own id is passed over; ties rank by smaller id. Vectors
    that are null, zero or hold null or non-finite components, and null ids, take no part.
    Of vectors of different lengths the shorter counts as ending in zeros. Queries with
    equal id and vector share an answer; queries that share an id only are ranked each on
    its own. A candidate is an id; of several vectors the nearest found counts. ``score``
    is the cosine in double precision of the original vectors.
    """
    spark: SparkSession = vectors.sparkSession
    nodes = materialise(nodes_of(vectors, id_col, vec_col, k + 1), "ann-nodes")
    shapes = "query_id long, rank int, vec_id long, score double"
    if nodes.isEmpty():
        return spark.createDataFrame([], shapes)
    # Equal query vectors walk once; the walk is known by the vector's number.
    asked_nodes = nodes_of(queries, id_col, vec_col, 1).select(
        F.col("node").alias("query"), "exact", "vec")
    asked = materialise(
        asked_nodes.join(nodes.select(F.col("node").alias("own"), F.col("exact").alias("e")),
                         F.col("exact") == F.col("e"), "left").drop("e"),
        "ann-asked",
    )
    graph = build(nodes)
    beams = search(graph, nodes, asked, beam)

    def cosine(batches):
        for batch in batches:
            a, b = (stack(batch.column(i), "<f8") for i in (1, 2))
            width = max(a.shape[1], b.shape[1]) if batch.num_rows else 0
            a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
            # Scaled by the largest component first, so that no square overflows.
            a, b = (m / np.abs(m).max(axis=1, keepdims=True) for m in (a, b)) if batch.num_rows else (a, b)
            lengths = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array((a * b).sum(axis=1) / lengths)],
                ["query", "near_ids", "score"],
            )

    picked = beams.select("query", F.explode(F.slice("ids", 1, RESCORED + k)).alias("node"))
    scored = (
        picked.join(asked.select("query", F.col("exact").alias("qx")), "query")
        .join(nodes.select("node", F.col("exact").alias("nx"), "ids"), "node")
        .select("query", "qx", "nx", "ids")
        .mapInArrow(cosine, "query long, near_ids array<long>, score double")
        .select("query", "score", F.explode("near_ids").alias("vec_id"))
        .groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("at", F.row_number().over(
            W.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
        .where(F.col("at") <= k + 1)
    )
    # Every row that asks, by its own vector.
    rows = _askers(queries, id_col, vec_col, asked)
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        rows.join(scored.drop("at"), "query")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _askers(queries: DataFrame, id_col: str, vec_col: str, asked: DataFrame) -> DataFrame:
    """``query_id, query``: each asking row's id and the walk of its vector."""
    def pack(batches):
        for batch in batches:
            lists = batch.column(1)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            ends = lists.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])],
                                           pa.binary())],
                ["query_id", "exact"],
            )

    vector = F.col(vec_col).cast("array<double>")
    chosen = queries.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    rows = chosen.where(usable(F.col("v")) & F.col("id").isNotNull()).mapInArrow(
        pack, "query_id long, exact binary").distinct()
    return rows.join(asked.select("query", "exact"), "exact").select("query_id", "query")
