"""Chat formatting in budgeted windows.

Prefix sums of turn tokens choose the windows of a conversation. Windows are ``step`` tokens
wide, what the budget leaves beside the system turn and the history. Turns that lie within
one of them share it; a turn across its end has a window of its own. A window shows

* the system turn (the first row, if its role is ``system``), masked where it is repeated,
* history: the turns before it, of together at most ``history`` tokens, and no more than the
  budget leaves; repeated and masked, in every window they reach,
* its own turns, of which assistant texts are under the loss mask.

So every turn is a target once, spans are turn-aligned, and a window has at most ``budget``
tokens, its system turn included, unless a single turn (or the system turn) is longer.

The template is ``<|role|>text<|end|>`` per turn. Control strings inside roles and
texts are escaped by one more backslash after their first character, which the reader
takes away, so any text reads back as it was.

Positions and prefix sums come from windows over blocks of ``BLOCK_TURNS`` turn numbers
and over the blocks' sums, so a very long conversation is spread over tasks. Formatting
is per window. Nothing holds a conversation as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.workspace import materialise

BUDGET = 2048
HISTORY = 512
BLOCK_TURNS = 128
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"

END = "<|end|>"
# What could be taken for a mark: "<", any backslashes, "|".
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_CLOSE, _CLOSED = re.compile(r"\|(\\*)>"), re.compile(r"\|\\(\\*)>")
_TURN = re.compile(r"<\|((?:[^|]|\|(?!>))*)\|>((?:[^<]|<(?!\|end\|>))*)<\|end\|>", re.S)


def escape(text: str) -> str:
    return _CLOSE.sub(r"|\\\1>", _ESCAPE.sub(r"<\\\1|", text))


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", _CLOSED.sub(r"|\1>", text))


def turn_tokens(text: Column) -> Column:
    """Tokens a turn is counted with: one for every four bytes, and four for its marks."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def positions(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) plus ``pos`` from 0, ``tokens`` and ``start``.

    ``start`` is the number of tokens before the turn, the system turn not counted;
    ``system`` that turn's tokens, 0 without one.
    Turns are ordered by number, nulls first; equal numbers by role, then text, so ties
    and repeated rows have a fixed order. Null roles and texts count as empty. Rows with
    a null conv_id are one conversation.
    """
    clean = rows.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)).withColumn(
        "tokens", turn_tokens(F.col("text"))
    )
    own = W.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    inside = clean.withColumn("at", F.row_number().over(own) - 1).withColumn(
        "sum", F.sum("tokens").over(own.rowsBetween(W.unboundedPreceding, -1))
    )
    blocks = clean.groupBy("conv_id", "block").agg(
        F.count("*").alias("turns"), F.sum("tokens").alias("all"),
        F.min(F.struct("turn", "role", "tokens")).alias("first"),
    )
    before = W.partitionBy("conv_id").orderBy("block")
    offsets = blocks.select(
        F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("turns").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("turns_before"),
        F.coalesce(F.sum("all").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("tokens_before"),
        F.first("first").over(before).alias("head"),
    )
    system = F.when(F.col("head.role") == SYSTEM_ROLE, F.col("head.tokens")).otherwise(0)
    raw = F.col("tokens_before") + F.coalesce("sum", F.lit(0)) - system
    return inside.join(
        offsets, F.expr("conv_id <=> b_conv and block <=> b_block")
    ).select(
        "conv_id", "turn", "role", "text", "tokens",
        (F.col("turns_before") + F.col("at")).alias("pos"),
        F.greatest(raw, F.lit(0)).alias("start"),
        system.cast("long").alias("system"),
    )


def windows(placed: DataFrame, budget: int, history: int) -> DataFrame:
    """``conv_id, pos, window, part`` for every turn of every window.

    ``part``: system, history or target. Windows are numbered in order, with gaps. A system
    turn that leaves less than an eighth of the budget leaves that eighth all the same.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be at least 0 and less than the budget")
    known = placed.select("conv_id", "pos", "role", "tokens", "start", "system")
    step = F.greatest(F.lit(max(1, budget // 8)), F.lit(budget - history) - F.col("system"))
    is_system = F.expr(f"pos = 0 and role = '{SYSTEM_ROLE}'")
    cell = lambda at: F.floor(at / F.col("step"))
    turns = known.where(~is_system).withColumn("step", step)
    # Even numbers: the turns within a cell. Odd ones: the turn across its end.
    across = cell(F.col("start") + F.col("tokens") - 1) > cell(F.col("start"))
    targets = turns.withColumn("window", 2 * cell(F.col("start")) + across.cast("int"))
    room = F.greatest(F.lit(0), F.lit(budget) - F.first("system") - F.sum("tokens"))
    spans = targets.groupBy(F.col("conv_id").alias("w_conv"), F.col("window").alias("w_window")).agg(
        F.min("start").alias("w_start"), F.least(F.lit(history), room).alias("reach"))
    shown = targets.select("conv_id", "pos", "window", F.lit("target").alias("part"))
    if history:
        first, last = cell(F.col("start") + 1), cell(F.col("start") + history)
        reached = turns.select(
            "conv_id", "pos", "start", F.explode(F.sequence(2 * first, 2 * last + 1)).alias("window"))
        near = "conv_id <=> w_conv and window = w_window and start < w_start and start >= w_start - reach"
        shown = shown.unionByName(reached.join(spans, F.expr(near)).select(
            "conv_id", "pos", "window", F.lit("history").alias("part")))
    begins = spans.groupBy(F.col("w_conv").alias("b_conv")).agg(F.min("w_window").alias("begin"))
    every = spans.join(begins, F.expr("w_conv <=> b_conv")).select("w_conv", "w_window", "begin")
    own = F.when(F.col("w_window") > F.col("begin"), "system").otherwise("target")
    heads = known.where(is_system).join(every, F.expr("conv_id <=> w_conv"), "left").select(
        "conv_id", "pos", F.coalesce("w_window", F.lit(0)).alias("window"), own.alias("part"))
    return shown.unionByName(heads)


FORMATTED = (
    "conv_id long, window long, formatted string, repeated int, turns int, "
    "loss array<struct<start:int,end:int>>"
)
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows from their turns, which come sorted by conversation, window and position."""
    names = ["conv_id", "window", "formatted", "repeated", "turns", "loss"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), _LOSS]
    done: list[tuple] = []
    current, pieces, size, repeated, loss = None, [], 0, 0, []

    def close():
        if current is not None:
            done.append((*current, "".join(pieces), repeated, len(pieces), loss))

    def batch_of() -> pa.RecordBatch:
        columns = zip(*done)
        made = [pa.array(list(c), t) for c, t in zip(columns, types)]
        done.clear()
        return pa.RecordBatch.from_arrays(made, names)

    for batch in batches:
        for conv, window, part, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, window) != current or current is None:
                close()
                current, pieces, size, repeated, loss = (conv, window), [], 0, 0, []
                if len(done) >= 1000:
                    yield batch_of()
            head, body = f"<|{escape(role)}|>", escape(text)
            if part != "target":
                repeated += 1
            elif role == TARGET_ROLE:
                loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
            pieces.append(head + body + END)
            size += len(pieces[-1])
    close()
    if done:
        yield batch_of()


def format_windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows of conversations: one row per conversation and window.

    ``formatted``: the text; ``turns`` in it, of which the first ``repeated`` are masked
    repeats (system and history); ``loss``: (start, end) of the assistant texts that
    count, in code points. Extra columns of ``rows`` are ignored.
    """
    placed = materialise(positions(rows), "chat-positions")
    # Windows are chosen on numbers alone; the texts join what was chosen once.
    texts = placed.select(F.col("conv_id").alias("t_conv"), F.col("pos").alias("t_pos"), "role", "text")
    shown = windows(placed, budget, history).join(texts, F.expr("conv_id <=> t_conv and pos = t_pos"))
    return (
        shown.repartition("conv_id", "window")
        .sortWithinPartitions("conv_id", "window", "pos")
        .select(F.col("conv_id").cast("long"), "window", "part", "role", "text")
        .mapInArrow(_format, FORMATTED)
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of one window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    done: list[tuple] = []
    key: object = _digest  # no conversation is called this
    state: list = []

    def close():
        if key is not _digest:
            turns, loss, n, chars, size, many = state
            done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), size, many))

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist(
            [dict(zip(names, d)) for d in done],
            pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
                       for c in DIGESTS.split(", ")]),
        )
        done.clear()
        return made

    for batch in batches:
        for conv, text, repeated, spans in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != key or key is _digest:
                close()
                key, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                if len(done) >= 5000:
                    yield batch_of()
            for role, said in parse(text)[repeated:]:
                state[0].update(f"{role}\n{said}\n".encode())
                state[2] += 1
            for span in spans:
                said = unescape(text[span["start"] : span["end"]])
                state[1].update(said.encode())
                state[3] += len(said)
            state[4] += len(text)
            state[5] += 1
    close()
    if done:
        yield batch_of()


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its windows hold once repeats are passed over.

    The digests run over a conversation's windows in order, one window at a time; a
    digest of one long conversation is sequential by its definition.
    """
    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
        .select("conv_id", "formatted", "repeated", "loss")
        .mapInArrow(_digest, DIGESTS)
    )
