"""Order statistics of everything that came before, for every row of a group.

A wavelet matrix answers "the k-th smallest of the first m values" for all rows of many
groups at once: values are levelled to ranks, and one descent over the bits of the ranks
settles every question, in n log n steps. Ordinary groups are solved this way where their
sorted rows lie.

A hot group is cut twice, into time ranges and into value ranges of bounded size:

1. Counts per (time range, value range) give, for each time range, how many earlier rows
   lie in each value range.
2. A time range's rows descend over value ranges, adding their own range's earlier rows to
   those counts. That names the value range of each answer and the rank left within it.
3. Per (value range, time range) with such a question, the value range's earlier rows and
   the time range's own rows answer by another descent.

Nothing gathers a hot group. The counts are (n / range)^2 cells for n rows, fewer than the
rows as long as a group has less than range^2 of them. The answers within one time range
move by no more ranks than it has rows, so few value ranges are asked for each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scan import RANGE_ROWS, in_ranges
from tillwise.functions.skew import HOT_ROWS, hot_groups, join_on_group, split_hot
from tillwise.workspace import materialise

#: Sorted rows of ordinary groups solved side by side.
BATCH_ROWS = 200_000
#: Places a value range's rows are dealt to before they are copied to the time ranges asking.
SALTS = 32


def kth_smallest(
    ranks: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray, base: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The k-th smallest (from 0) of ``ranks[low:high]``, and what is left of k among its equals.

    ``ranks`` are small non-negative integers. ``base`` adds that many more elements of
    each rank to every question.
    """
    size = len(base) if base is not None else int(ranks.max(initial=0)) + 1
    upto = None if base is None else np.concatenate([[0], np.cumsum(base)])
    found, k = np.zeros(len(k), np.int64), k.copy()
    low, high = low.copy(), high.copy()
    for bit in reversed(range(max(1, (size - 1).bit_length()))):
        one = (ranks >> bit) & 1 > 0
        zeros = np.concatenate([[0], np.cumsum(~one)])
        low_left, high_left = zeros[low], zeros[high]
        left = high_left - low_left
        if upto is not None:
            end = np.minimum(found + (1 << bit), size)
            left = left + upto[end] - upto[np.minimum(found, size)]
        right = k >= left
        k -= np.where(right, left, 0)
        found += right.astype(np.int64) << bit
        low = np.where(right, zeros[-1] + low - low_left, low_left)
        high = np.where(right, zeros[-1] + high - high_left, high_left)
        ranks = np.concatenate([ranks[~one], ranks[one]])
    return found, k


def _places(earlier: np.ndarray, prob: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of both neighbours of the quantile of so many values, and the share of the upper."""
    position = prob * np.maximum(earlier - 1, 0)
    lower = np.floor(position).astype(np.int64)
    return lower, np.minimum(lower + 1, np.maximum(earlier - 1, 0)), position - lower


def running_limits(values: np.ndarray, starts: np.ndarray, prob: float) -> np.ndarray:
    """The quantile of the values before each in its group; NaN where there is none.

    ``values``: groups one after the other, each in order, NaN for missing; ``starts``:
    where each value's group begins.
    """
    known = ~np.isnan(values)
    counted = np.concatenate([[0], np.cumsum(known)])
    low, high = counted[starts], counted[np.arange(len(values))]
    levels, ranks = np.unique(values[known], return_inverse=True)
    lower, upper, share = _places(high - low, prob)
    out = np.full(len(values), np.nan)
    ask = high > low
    if ask.any():
        at, _ = kth_smallest(ranks, low[ask], high[ask], lower[ask])
        above, _ = kth_smallest(ranks, low[ask], high[ask], upper[ask])
        out[ask] = levels[at] + (levels[above] - levels[at]) * share[ask]
    return out


def _starts(batch: pa.RecordBatch, by: Sequence[str]) -> np.ndarray:
    """Positions where a group begins in rows sorted by ``by``."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for name in by:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(change)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _solved(
    batches: Iterator[pa.RecordBatch], by: list[str], value: str, prob: float, out: str
) -> Iterator[pa.RecordBatch]:
    def close(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = table.num_rows
        begins = np.repeat(starts, np.diff(np.append(starts, rows)))
        limits = running_limits(_numbers(table[value].combine_chunks()), begins, prob)
        made = pa.array(limits, mask=np.isnan(limits))
        yield from table.append_column(out, made).combine_chunks().to_batches()

    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size < BATCH_ROWS:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        starts = _starts(table.to_batches()[0], by)
        last = int(starts[-1])
        if last:
            # The last group may go on in the next batch.
            yield from close(table.slice(0, last), starts[:-1])
            table = table.slice(last)
        waiting, size = table.to_batches(), table.num_rows
    if size:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield from close(table, _starts(table.to_batches()[0], by))


def running_quantile(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    prob: float,
    out: str,
    hot_rows: int = HOT_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``df`` plus ``out``: the quantile of ``value`` over the earlier rows of the same group.

    Linear interpolation; null and NaN values do not count as earlier rows, and a row
    without an earlier value has null. ``order`` ends with a column that is unique,
    which also tells rows apart. Groups above ``hot_rows`` rows are cut into ranges of
    ``range_rows``.
    """
    by, order = list(by), list(order)
    ordinary, large = split_hot(df, by, hot_groups(df, by, hot_rows))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    result = (
        ordinary.repartition(*by)
        .sortWithinPartitions(*by, *order)
        .mapInArrow(lambda b: _solved(b, by, value, prob, out), f"{schema}, `{out}` double")
    )
    if large is None:
        return result
    limits = _hot_limits(large, by, order, value, prob, range_rows)
    key = order[-1]
    joined = large.join(limits.withColumnRenamed("limit", out), key, "left")
    return result.unionByName(joined.select(*df.columns, out))


def _hot_limits(
    rows: DataFrame, by: list[str], order: list[str], value: str, prob: float, range_rows: int
) -> DataFrame:
    """``order[-1], limit`` of the rows of large groups."""
    key = order[-1]
    number = F.col(value).cast("double")
    slim = rows.select(*by, *order, F.when(~F.isnan(number), number).alias("v"))
    # Missing values lie in value ranges too, which they leave unused.
    valued = in_ranges(slim, [*by, "v", key], range_rows, "vr")
    placed = in_ranges(valued, [*by, *order], range_rows, "tr")
    within = Window.partitionBy(*by, "tr").orderBy(*order)
    numbered = materialise(
        placed.select(*by, key, "v", "vr", "tr", (F.row_number().over(within) - 1).alias("at")),
        "running-rows",
    )
    base = materialise(_earlier_counts(numbered, by), "running-counts")
    asked = materialise(
        numbered.groupBy(*by, "tr").cogroup(base.groupBy(*by, "tr")).applyInArrow(
            lambda mine, before: _ask(mine, before, by, key, prob),
            _schema(numbered, [*by, key, "tr"]) + ", vr int, at long, k long, side int, share double",
        ),
        "running-asked",
    )
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    wanted = asked.select(*by, "vr", F.col("tr").alias("to")).distinct().withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    known = numbered.where("v is not null")
    copied = join_on_group(
        known.withColumn("salt", salt), wanted, [*by, "vr", "salt"], "inner"
    ).where("tr < to")
    none = F.lit(None)
    columns = [*by, "vr"]
    offers = copied.select(*columns, F.col("to").alias("tr"), F.lit(-1).cast("long").alias("at"), "v")
    own = known.select(*columns, "tr", F.col("at").cast("long").alias("at"), "v")
    events = offers.unionByName(own).withColumns(
        {"k": none.cast("long"), "side": none.cast("int"), "share": none.cast("double"),
         key: none.cast(numbered.schema[key].dataType)}
    ).unionByName(asked.withColumn("v", none.cast("double")))
    answers = events.groupBy(*by, "vr", "tr").applyInArrow(
        lambda t: _answer(t, key), _schema(numbered, [key]) + ", side int, share double, found double"
    )
    side = lambda n: F.max(F.when(F.col("side") == n, F.col("found")))
    return answers.groupBy(key).agg(side(0).alias("low"), side(1).alias("up"), F.max("share").alias("share")).select(
        key, (F.col("low") + (F.col("up") - F.col("low")) * F.col("share")).alias("limit")
    )


def _schema(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _earlier_counts(numbered: DataFrame, by: list[str]) -> DataFrame:
    """``by, tr, vr, n``: a group's known rows of a value range in earlier time ranges."""
    cells = numbered.where("v is not null").groupBy(*by, "vr", "tr").agg(F.count("*").alias("c"))
    last = numbered.groupBy(*by).agg(F.max("tr").alias("last"))
    along = Window.partitionBy(*by, "vr").orderBy("tr")
    upto = join_on_group(cells, last, by, "inner").withColumns(
        {"n": F.sum("c").over(along), "next": F.lead("tr").over(along)}
    )
    until = F.coalesce("next", "last")
    return upto.where(until > F.col("tr")).select(
        *by, "vr", "n", F.explode(F.sequence(F.col("tr") + 1, until)).alias("tr")
    )


def _ask(mine: pa.Table, before: pa.Table, by: list[str], key: str, prob: float) -> pa.Table:
    """For each row of a time range, the value ranges of its two neighbours and the ranks there."""
    order = np.argsort(mine["at"].to_numpy(), kind="stable")
    mine = mine.take(pa.array(order))
    known = mine["v"].is_valid().to_numpy()
    vr = mine["vr"].to_numpy()
    levels = np.unique(np.concatenate([vr[known], before["vr"].to_numpy()]))
    base = np.zeros(len(levels), np.int64)
    base[np.searchsorted(levels, before["vr"].to_numpy())] = before["n"].to_numpy()
    high = np.concatenate([[0], np.cumsum(known)])[:-1]
    lower, upper, share = _places(high + base.sum(), prob)
    ask = np.flatnonzero(high + base.sum() > 0)
    codes, low = np.searchsorted(levels, vr[known]), np.zeros(len(ask), np.int64)
    picked = mine.take(pa.array(ask)).select([*by, key, "tr", "at"])
    parts = []
    for side, place in enumerate((lower, upper)):
        at, left = (
            kth_smallest(codes, low, high[ask], place[ask], base) if len(ask) else (low, low))
        parts.append(pa.table({
            **{c: picked[c] for c in (*by, key, "tr")},
            "vr": pa.array(levels[at].astype(np.int32) if len(ask) else np.empty(0, np.int32)),
            "at": picked["at"].cast(pa.int64()),
            "k": pa.array(left), "side": pa.array(np.full(len(ask), side, np.int32)),
            "share": pa.array(share[ask]),
        }))
    return pa.concat_tables(parts)


def _answer(events: pa.Table, key: str) -> pa.Table:
    """Values of the asked ranks among the earlier rows of one value range."""
    is_question = events["side"].is_valid().to_numpy()
    asked = events.filter(pa.array(is_question))
    data = events.filter(pa.array(~is_question))
    at, values = data["at"].to_numpy(), data["v"].to_numpy()
    order = np.argsort(at, kind="stable")
    at, values = at[order], values[order]
    levels, ranks = np.unique(values, return_inverse=True)
    high = np.searchsorted(at, asked["at"].to_numpy())
    found, _ = kth_smallest(ranks, np.zeros(len(high), np.int64), high, asked["k"].to_numpy())
    return pa.table({
        key: asked[key], "side": asked["side"], "share": asked["share"],
        "found": pa.array(levels[found] if len(levels) else np.empty(0)),
    })
