"""Exact order statistics and row positions without a global sort.

Quantiles follow one idea: a bounded sketch (``percentile_approx``) tells where to look,
and a second pass counts exactly. Row positions come from ranges and a prefix scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scan import RANGE_ROWS, in_ranges, prefix_sums
from tillwise.functions.skew import hot_groups, join_on_group, split_hot

SKETCH_ACCURACY = 10_000
SLICE_ROWS = 100_000


def interpolate(lower: float, upper: float, fraction: float) -> float:
    return lower + (upper - lower) * fraction


# --- quantiles of whole columns -------------------------------------------------


@dataclass
class _Target:
    column: str
    rank: int  # zero-based rank of the lower neighbour
    fraction: float
    last: int
    low: float | None = None  # None = open end
    high: float | None = None
    below: int = 0
    inside: int = 0
    accuracy: int = SKETCH_ACCURACY
    settled: tuple[float, float] | None = None  # both neighbours, once known

    @property
    def following(self) -> int:
        return min(self.rank + 1, self.last)

    def condition(self) -> Column:
        value = F.col(self.column)
        cond = value.isNotNull()
        if self.low is not None:
            cond = cond & (value >= F.lit(self.low))
        if self.high is not None:
            cond = cond & (value <= F.lit(self.high))
        return cond


def exact_quantiles(
    df: DataFrame,
    probs: dict[str, Sequence[float]],
    accuracy: int = SKETCH_ACCURACY,
    slice_rows: int = SLICE_ROWS,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of numeric columns, nulls ignored.

    A sketch narrows each quantile to a value range; ranges are narrowed until
    they hold at most ``slice_rows`` rows (or a single value), and only the
    distinct values in them are brought back. What reaches the driver is bounded
    by ``slice_rows`` per quantile, however large the input.
    """
    columns = list(probs)
    work = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    wanted = [(c, p) for c in columns for p in probs[c]]
    margin = 2.0 / accuracy
    # First pass: row counts together with a sketch around every quantile.
    first = work.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(c, _around_prob(p, margin), accuracy).alias(f"t{i}")
            for i, (c, p) in enumerate(wanted)
        ],
    ).first()
    counts = {c: first[f"n_{i}"] for i, c in enumerate(columns)}

    targets, wide, ranges = [], [], []
    for i, (name, prob) in enumerate(wanted):
        n = counts[name]
        position = prob * (n - 1) if n else 0.0
        rank = math.floor(position)
        target = _Target(
            name, rank, position - rank, max(n - 1, 0), inside=n, accuracy=accuracy
        )
        targets.append(target)
        if n > slice_rows:
            wide.append(target)
            ranges.append(first[f"t{i}"])
    while wide:
        wide = _narrow(work, wide, ranges, slice_rows)
        ranges = _sketch(work, wide) if wide else []

    return _pick(work, targets, columns, counts)


def _around_prob(prob: float, margin: float) -> list[float]:
    return [max(0.0, prob - margin), min(1.0, prob + margin)]


def _sketch(work: DataFrame, targets: list[_Target]) -> list[list[float]]:
    """Values enclosing each target, from a sketch of its current range."""
    sketches = []
    for i, t in enumerate(targets):
        at = (t.rank - t.below + t.fraction) / t.inside
        inside = F.when(t.condition(), F.col(t.column))
        window = _around_prob(at, 2.0 / t.accuracy)
        sketches.append(F.percentile_approx(inside, window, t.accuracy).alias(f"t{i}"))
    found = work.agg(*sketches).first()
    return [found[f"t{i}"] for i in range(len(targets))]


def _narrow(
    work: DataFrame, targets: list[_Target], ranges: list[list[float]], slice_rows: int
) -> list[_Target]:
    """Set the new ranges after counting them; returns the targets that stay too wide."""
    narrowed = [replace(t, low=r[0], high=r[1]) for t, r in zip(targets, ranges)]
    sizes = []
    for i, t in enumerate(narrowed):
        value, low, high = F.col(t.column), F.lit(t.low), F.lit(t.high)
        sizes += [
            F.count_if(value < low).alias(f"below{i}"),
            F.count_if(t.condition()).alias(f"inside{i}"),
            F.count_if(value == low).alias(f"at_low{i}"),
            F.count_if(value == high).alias(f"at_high{i}"),
            F.min(F.when(value > low, value)).alias(f"above_low{i}"),
            F.max(F.when(value < high, value)).alias(f"below_high{i}"),
        ]
    found = work.agg(*sizes).first()
    again = []
    for i, (t, new) in enumerate(zip(targets, narrowed)):
        below, inside = found[f"below{i}"], found[f"inside{i}"]
        if below > t.rank or below + inside <= t.following:
            raise RuntimeError(f"value range of {t.column} misses rank {t.rank}")
        t.low, t.high, t.below, t.inside = new.low, new.high, below, inside
        if t.inside > slice_rows and t.low < t.high:
            ends = ("at_low", "at_high", "above_low", "below_high")
            _cut_ends(t, *[found[f"{name}{i}"] for name in ends])
            if t.settled is None and t.inside > slice_rows and t.low < t.high:
                again.append(t)
    return again


def _cut_ends(
    t: _Target, at_low: int, at_high: int, above_low: float, below_high: float
) -> None:
    """Settle a target that touches an end value of its range, else leave the ends out.

    A sketch leaves few rows strictly between its two end values; what keeps a range
    wide is rows equal to them. Without those, every round shrinks the range.
    """
    inner, outer = t.below + at_low, t.below + t.inside - at_high
    if t.rank < inner:
        t.settled = (t.low, t.low if t.following < inner else above_low)
    elif t.following >= outer:
        t.settled = (t.high if t.rank >= outer else below_high, t.high)
    else:
        t.low, t.high, t.below, t.inside = above_low, below_high, inner, outer - inner


def _pick(work, targets, columns, counts):
    slices: dict[tuple, int] = {}
    by_slice = {}
    for t in targets:
        if t.settled is None and counts[t.column]:
            tag = slices.setdefault((t.column, t.low, t.high), len(slices))
            by_slice.setdefault(tag, t)
    groups = _slice_values(work, by_slice) if by_slice else {}
    out: dict[str, list[float | None]] = {c: [] for c in columns}
    for t in targets:
        if counts[t.column] == 0:
            out[t.column].append(None)
            continue
        if t.settled is None:
            g = groups[slices[(t.column, t.low, t.high)]]
            ends = t.below + g["n"].to_numpy().cumsum()
            values = g["value"].to_numpy()
            top = len(values) - 1
            lower, upper = (
                values[min(np.searchsorted(ends, rank, side="right"), top)]
                for rank in (t.rank, t.following)
            )
        else:
            lower, upper = t.settled
        out[t.column].append(float(interpolate(lower, upper, t.fraction)))
    return out


def _slice_values(work: DataFrame, by_slice: dict[int, _Target]) -> dict:
    """Distinct values and their counts in each slice, in order."""
    tagged = F.array(
        *[
            F.when(
                t.condition(),
                F.struct(F.lit(tag).alias("tag"), F.col(t.column).alias("value")),
            )
            for tag, t in by_slice.items()
        ]
    )
    rows = (
        work.select(F.explode(F.filter(tagged, lambda x: x.isNotNull())).alias("x"))
        .groupBy("x.tag", "x.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .toPandas()
    )
    return {tag: g.sort_values("value") for tag, g in rows.groupby("tag")}


# --- order statistics per group -------------------------------------------------


def group_order_window(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    prob: float,
    hot_rows: int | None = None,
    hot: DataFrame | None = None,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """The values around rank ``floor(prob * n)`` of each group.

    Returns ``by``, ``n`` (non-null values), ``rank`` and ``prev``, ``here``,
    ``next``: the sorted values at rank-1, rank and rank+1, null outside the
    group. Ordinary groups are ranked in a window. Hot groups are never gathered:
    a per-group sketch gives a narrow value range, and only that range is ranked.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    if hot is None and hot_rows is not None:
        hot = hot_groups(rows, by, hot_rows)
    cold_rows, hot_part = split_hot(rows, by, hot)
    result = _windowed_order(cold_rows, by, prob)
    if hot_part is not None:
        result = result.unionByName(sketched_order_window(hot_part, by, prob, accuracy))
    return result


def _around(rank_matches, value: str):
    return [
        F.max(F.when(rank_matches(offset), F.col(value))).alias(name)
        for offset, name in ((-1, "prev"), (0, "here"), (1, "next"))
    ]


def _windowed_order(rows: DataFrame, by: Sequence[str], prob: float) -> DataFrame:
    group = Window.partitionBy(*by)
    ranked = rows.withColumn("n", F.count("v").over(group)).withColumn(
        "pos", F.row_number().over(group.orderBy("v")) - 1
    )
    ranked = ranked.withColumn("rank", F.floor(F.lit(prob) * F.col("n")))
    near = ranked.where(F.abs(F.col("pos") - F.col("rank")) <= 1)
    return near.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max("rank").alias("rank"),
        *_around(lambda o: F.col("pos") == F.col("rank") + o, "v"),
    )


def sketched_order_window(
    rows: DataFrame, by: Sequence[str], prob: float, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """:func:`group_order_window` for a bounded number of large groups, values in ``v``."""
    # The sketch misses a rank by at most n/accuracy, so two such steps on each
    # side, plus a floor for small groups, always enclose the wanted ranks.
    margin = 2.0 / accuracy
    window = [max(0.0, prob - margin), min(1.0, prob + margin)]
    ranges = rows.groupBy(*by).agg(
        F.count("v").alias("n"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
        F.percentile_approx("v", window, accuracy).alias("b"),
    )
    small = F.col("n") < 4 * accuracy
    ranges = ranges.select(
        *by,
        "n",
        F.floor(F.lit(prob) * F.col("n")).alias("rank"),
        F.when(small, F.col("lowest")).otherwise(F.col("b")[0]).alias("low"),
        F.when(small, F.col("highest")).otherwise(F.col("b")[1]).alias("high"),
    )
    # One row per hot group; Spark broadcasts them where their measured size allows it.
    scoped = join_on_group(rows, ranges, by, "inner")
    below = scoped.groupBy(*by).agg(F.count_if(F.col("v") < F.col("low")).alias("below"))
    counted = (
        scoped.where(F.col("v").between(F.col("low"), F.col("high")))
        .groupBy(*by, "v")
        .agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"), F.max("rank").alias("rank"))
    )
    ahead = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("ahead", F.coalesce(F.sum("c").over(ahead), F.lit(0)))
    placed = join_on_group(ranked, below, by, "inner")
    first = F.col("below") + F.col("ahead")
    return placed.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.max("rank").alias("rank"),
        *_around(
            lambda o: (first <= F.col("rank") + o) & (F.col("rank") + o < first + F.col("c")),
            "v",
        ),
    )


def group_quantile(window: DataFrame, by: Sequence[str], prob: float, name: str) -> DataFrame:
    """Linear-interpolation quantile from the output of :func:`group_order_window`."""
    position = F.lit(prob) * (F.col("n") - 1)
    shifted = F.floor(position) < F.col("rank")
    lower = F.when(shifted, F.col("prev")).otherwise(F.col("here"))
    upper = F.when(shifted, F.col("here")).otherwise(F.coalesce(F.col("next"), F.col("here")))
    fraction = position - F.floor(position)
    return window.select(*by, (lower + (upper - lower) * fraction).alias(name))


# --- value ranges and row positions ------------------------------------------------


def range_bounds(df: DataFrame, column: str, n_bins: int) -> list[float]:
    """At most ``n_bins - 1`` increasing cut values that balance the rows."""
    if n_bins <= 1:
        return []
    steps = [i / n_bins for i in range(1, n_bins)]
    value = F.col(column).cast("double")
    found = df.agg(F.percentile_approx(value, steps, 10 * n_bins).alias("b")).first()["b"]
    return sorted(set(found or []))


def with_range_bin(df: DataFrame, column: str, bounds: Sequence[float], out: str) -> DataFrame:
    """Add the index of the value range; a larger value never gets a smaller index."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    as_double = f"{out}_value"
    cut = Bucketizer(
        splits=[-math.inf, *bounds, math.inf],
        inputCol=as_double,
        outputCol=f"{out}_bucket",
    )
    ranged = cut.transform(df.withColumn(as_double, F.col(column).cast("double")))
    return ranged.withColumn(out, F.col(f"{out}_bucket").cast("int")).drop(
        as_double, f"{out}_bucket"
    )


def global_row_index(
    df: DataFrame, key: str, rows_per_bin: int = RANGE_ROWS, out: str = "row_index"
) -> tuple[DataFrame, int]:
    """Zero-based position of every row in the order of a unique key, and the row count.

    Rows are written in ranges of the key, each range is numbered on its own, and the
    rows of earlier ranges are added by a prefix scan over the ranges' sizes.
    """
    placed = in_ranges(df, [key], rows_per_bin, "range_bin")
    starts = prefix_sums(
        placed.groupBy("range_bin").agg(F.count(F.lit(1)).alias("n")), "range_bin", ["n"]
    )
    within = F.row_number().over(Window.partitionBy("range_bin").orderBy(key))
    indexed = (
        placed.withColumn("within", within)
        .join(starts.select("range_bin", "before_n"), "range_bin")
        .withColumn(out, F.col("before_n") + F.col("within") - 1)
    )
    return indexed.select(*df.columns, out), starts.agg(F.sum("n")).first()[0] or 0


def occurrence_index(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    id_column: str,
    hot_rows: int,
    rows_per_bin: int = RANGE_ROWS,
    out: str = "occurrence",
) -> DataFrame:
    """Zero-based running count of each row within its group.

    Hot groups are cut into ranges of the order columns and the unique id, so rows with
    one order value are split as well. Ranges are numbered on their own and shifted by
    the rows in earlier ranges of the same group, from a prefix scan over the sizes.
    """
    hot = hot_groups(df, by, hot_rows)
    cold, hot_part = split_hot(df, by, hot)
    numbered = F.row_number().over(Window.partitionBy(*by).orderBy(*order, id_column)) - 1
    result = cold.withColumn(out, numbered)
    if hot_part is None:
        return result
    ranged = in_ranges(hot_part, [*by, *order, id_column], rows_per_bin, "range_bin")
    sizes = ranged.groupBy(*by, "range_bin").agg(F.count(F.lit(1)).alias("n"))
    starts = prefix_sums(sizes, "range_bin", ["n"], by).select(*by, "range_bin", "before_n")
    within = F.row_number().over(
        Window.partitionBy(*by, "range_bin").orderBy(*order, id_column)
    )
    shifted = (
        ranged.withColumn("within", within)
        .transform(lambda d: join_on_group(d, starts, [*by, "range_bin"], "inner"))
        .withColumn(out, F.col("before_n") + F.col("within") - 1)
    )
    return result.unionByName(shifted.select(*result.columns))
