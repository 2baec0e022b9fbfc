"""Recommendations from matrix factors: the largest inner products of users and items.

Item factors are sorted by length and cut into blocks. A user's k-th score so far is a
bound: where the user's length times the longest item of a block falls below it, neither
that block nor any later one can change the list. Rounds read one block, what a task holds,
as much again, twice, four times as much and so on, for the users still open; in skewed
catalogues most users stop after the first. Open users are dealt anew each round, so few of
them mean few copies of the items, and lists of the others are not moved again. Within a task the same bound is taken block by block, and scores
are first taken in single precision: only those that can reach a user's k-th score are worked
out and compared in full. Lists are exact for the factors at hand, over all users and items.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.ordering import global_row_index
from tillwise.operators.collaborative import RANK_DIGITS, mean_ratings
from tillwise.workspace import materialise

ITEM_BLOCK = 4_096
USER_BLOCK = 32_768
#: Blocks of users that a smaller input is cut into, of this many users at least.
SPREAD, LEAST_USERS = 32, 2_048
#: Rows and columns of one product of matrices: in few columns few rows reach their limit.
TILE, ITEM_TILE = 4_096, 256
#: Item blocks that a task holds.
HELD_BLOCKS = 64
_MARGIN = 1e-6


def fold_in(item_factors: DataFrame, ratings: DataFrame, reg: float = 0.1) -> DataFrame:
    """Factors (``id, features``) of users the model has not seen, from their ratings.

    One least-squares step against the given item factors, the penalty scaled by the
    user's number of ratings as in training. Ratings of unknown items are passed over;
    a user without any known item has no factors.
    """
    known = mean_ratings(ratings).join(
        item_factors.select(F.col("id").alias("product_id"), "features"), "product_id"
    )
    # One row is one user's own ratings.
    per_user = known.groupBy("user_id").agg(F.collect_list(F.struct("features", "rating")).alias("r"))

    def solve(batches):
        for batch in batches:
            out = []
            for rows in batch.column(1):
                v = np.array(rows.values.field("features").to_pylist(), float)
                r = rows.values.field("rating").to_numpy()
                left = v.T @ v + reg * len(r) * np.eye(v.shape[1])
                out.append(np.linalg.solve(left, v.T @ r).astype(np.float32).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.float32()))], ["id", "features"]
            )

    return per_user.select("user_id", "r").mapInArrow(solve, "id long, features array<float>")


def _lengths(factors: DataFrame) -> DataFrame:
    square = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return factors.select(F.col("id").cast("long").alias("id"), "features", F.sqrt(square).alias("length"))


def factor_recommendations(
    user_factors: DataFrame, item_factors: DataFrame, rated: DataFrame, k: int = 8,
    item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK,
) -> DataFrame:
    """``user_id, product_id, score, rank``: each user's k items of largest inner product.

    ``rated`` (user_id, product_id): pairs left out, popular items and all; repeated ones
    count once. Scores rank at nine digits, then by smaller product id. A user with fewer
    than k items left has a shorter list.
    """
    items = _lengths(item_factors).withColumn("order", F.struct((-F.col("length")).alias("l"), "id"))
    placed, n_items = global_row_index(items, "order", out="place")
    blocks = materialise(
        placed.groupBy(F.floor(F.col("place") / item_block).cast("int").alias("ib")).agg(
            F.max("length").alias("longest"), F.collect_list(F.struct("id", "features")).alias("items")
        ),
        "als-items",
    )
    seen = rated.select("user_id", "product_id").distinct().groupBy("user_id").agg(
        F.collect_list("product_id").alias("rated")
    )
    users = materialise(
        _lengths(user_factors).join(seen, F.col("id") == F.col("user_id"), "left").select(
            "id", "features", "length",
            F.coalesce("rated", F.array().cast("array<long>")).alias("rated"),
            F.lit(None).cast("double").alias("kth"),
        ),
        "als-users",
    )
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("score", RANK_DIGITS)), "product_id")
    whole = Window.partitionBy("user_id")
    settled, carried, open_users, n_open = [], None, users, users.count()
    first, last = 0, math.ceil(n_items / item_block)
    while first < last and n_open:
        until = min(last, max(HELD_BLOCKS, 2 * first) if first else 1)
        n_blocks = _user_blocks(n_open, user_block)
        some = F.explode(F.sequence(F.lit(first), F.lit(until - 1))).alias("ib")
        held = F.floor((F.col("ib") - first) / HELD_BLOCKS).cast("int").alias("part")
        asked = open_users.select(
            "*", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("ub"),
            F.explode(F.sequence(F.lit(0), F.lit((until - 1 - first) // HELD_BLOCKS))).alias("part"),
        )
        dealt = users.sparkSession.range(n_blocks).select(F.col("id").cast("int").alias("ub"), some)
        offered = dealt.join(blocks, "ib").select("ub", held, "longest", "items")
        found = asked.groupBy("ub", "part").cogroup(offered.groupBy("ub", "part")).applyInArrow(
            lambda u, i: _products(u, i, k), "user_id long, length double, product_id long, score double"
        )
        every = found if carried is None else found.unionByName(carried)
        ranked = every.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
        kth = F.when(F.count(F.lit(1)).over(whole) >= k, F.min("score").over(whole))
        best = ranked.withColumn("kth", kth)
        longest = blocks.where(F.col("ib") == until).first()["longest"] if until < last else -math.inf
        reached = F.col("length") * F.lit(longest) + _MARGIN >= F.col("kth")
        best = materialise(
            best.withColumn("open", F.lit(until < last) & F.coalesce(reached, F.lit(True))), "als-best"
        )
        settled.append(best.where(~F.col("open")).select("user_id", "product_id", "score"))
        if until < last:
            carried = best.where("open").select(*found.columns)
            ends = best.where("at = 1").select(F.col("user_id").alias("id"), "kth", "open")
            # Without any item so far a user is open, too.
            open_users = materialise(
                open_users.drop("kth").join(ends, "id", "left").where(F.coalesce("open", F.lit(True)))
                .select(*users.columns),
                "als-open",
            )
            n_open = open_users.count()
        first = until
    if not settled:
        settled = [users.sparkSession.createDataFrame([], "user_id long, product_id long, score double")]
    return reduce(DataFrame.unionByName, settled).withColumn("rank", F.row_number().over(order))


def _user_blocks(n_users: int, user_block: int) -> int:
    return max(1, math.ceil(n_users / user_block), min(SPREAD, math.ceil(n_users / LEAST_USERS)))


def _matrix(column) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy().astype(float).reshape(len(whole), -1)


def _products(users: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """The k best items of these blocks for each user that reach ``kth``, rated ones left out."""
    out = []
    if users.num_rows and blocks.num_rows:
        rated = users["rated"].combine_chunks()
        mine = np.unique(rated.flatten().to_numpy())
        ids, left = users["id"].to_numpy(), _matrix(users["features"])
        length = users["length"].to_numpy()
        floor = users["kth"].fill_null(-math.inf).to_numpy()
        longest = blocks["longest"].to_numpy()
        held = []
        for b in np.argsort(-longest, kind="stable"):
            items = blocks["items"][int(b)]
            numbers = items.values.field("id").to_numpy()
            order = np.argsort(numbers)
            held.append((longest[b], numbers[order], _matrix(items.values.field("features"))[order]))
        for low in range(0, len(ids), TILE):
            some = slice(low, min(low + TILE, len(ids)))
            part = rated.slice(low, some.stop - low)
            owner = np.repeat(np.arange(some.stop - low), np.diff(part.offsets.to_numpy()))
            taken = np.sort(owner * max(1, len(mine)) + np.searchsorted(mine, part.flatten().to_numpy()))
            who, what, score = _best_of(left[some], length[some], floor[some], held, mine, taken, k)
            out.append((ids[some][who], length[some][who], what, score))
    none = [np.empty(0, np.int64), np.empty(0)] * 2
    columns = [np.concatenate(c) for c in zip(*out)] if out else none
    return pa.table(dict(zip(("user_id", "length", "product_id", "score"), map(pa.array, columns))))


def _best_of(left, length, floor, held, mine, taken, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and score of the k best of ``held`` blocks, which come by falling length.

    ``floor``: a score that another k items reach, per row. ``taken``: sorted numbers of the
    pairs to leave out, row times ``len(mine)`` plus the item's place in ``mine``.
    """
    small = left.astype(np.float32)
    slip = (left.shape[1] + 2) * 2.0**-23 * length
    item, best = np.zeros((len(left), k), np.int64), np.full((len(left), k), -math.inf)
    floor = floor.copy()
    for longest, numbers, right in held:
        # Whoever cannot reach the floor with the longest item here is done with all that follow.
        live = np.flatnonzero(length * longest + _MARGIN >= floor)
        if not len(live):
            break
        limit = (floor[live] - _MARGIN - slip[live] * longest).astype(np.float32)
        # Rounded down, as the comparison must let through whatever may pass.
        limit = np.nextafter(limit, np.float32(-np.inf))
        mine_live, narrow = small[live], right.astype(np.float32)
        for start in range(0, len(numbers), ITEM_TILE):
            rough = mine_live @ narrow[start : start + ITEM_TILE].T
            unknown = np.flatnonzero(np.isneginf(limit))
            if len(unknown) and rough.shape[1] > k:
                # A first floor: the k-th of the free items here, on the safe side.
                kth = _kth_free(rough[unknown], live[unknown], numbers[start : start + ITEM_TILE], mine, taken, k)
                limit[unknown] = (kth - _MARGIN - 2 * slip[live[unknown]] * longest).astype(np.float32)
                limit = np.nextafter(limit, np.float32(-np.inf))
            rows = np.flatnonzero(rough.max(axis=1) >= limit)
            if not len(rows):
                continue
            r, c = np.nonzero(rough[rows] >= limit[rows, None])
            r, c = live[rows[r]], c + start
            if len(mine):
                spot = np.minimum(np.searchsorted(mine, numbers[c]), len(mine) - 1)
                key = r * len(mine) + spot
                at = np.minimum(np.searchsorted(taken, key), max(0, len(taken) - 1))
                free = (mine[spot] != numbers[c]) | (taken[at] != key) if len(taken) else np.ones(len(r), bool)
                r, c = r[free], c[free]
            exact = np.einsum("ij,ij->i", left[r], right[c])
            # Only lists that a score has come to are sorted again.
            some = np.unique(r)
            who = np.concatenate([np.repeat(some, k), r])
            what = np.concatenate([item[some].ravel(), numbers[c]])
            score = np.concatenate([best[some].ravel(), exact])
            turn = np.lexsort((what, -np.round(score, RANK_DIGITS), who))
            turn = turn[np.arange(len(who)) - np.searchsorted(who[turn], who[turn]) < k]
            item[some], best[some] = what[turn].reshape(-1, k), score[turn].reshape(-1, k)
            floor[some] = np.maximum(floor[some], best[some, k - 1])
            at = np.searchsorted(live, some)
            reach = (floor[some] - _MARGIN - slip[some] * longest).astype(np.float32)
            limit[at] = np.maximum(limit[at], np.nextafter(reach, np.float32(-np.inf)))
    who, place = np.nonzero(best > -math.inf)
    return who, item[who, place], best[who, place]


def _kth_free(rough, rows, numbers, mine, taken, k) -> np.ndarray:
    """Per row the k-th largest score among the items (``numbers``, rising) not taken."""
    owner = taken // max(1, len(mine))
    at = np.minimum(np.searchsorted(rows, owner), len(rows) - 1)
    item = mine[taken % max(1, len(mine))]
    spot = np.minimum(np.searchsorted(numbers, item), len(numbers) - 1)
    hit = (rows[at] == owner) & (numbers[spot] == item)
    free = rough.astype(float)
    free[at[hit], spot[hit]] = -np.inf
    return np.partition(free, free.shape[1] - k, axis=1)[:, -k]
