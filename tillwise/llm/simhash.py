"""SimHash near-duplicates: fingerprints, pigeonring candidate search, components.

Fingerprints of 64 bits link when at most ``MAX_BITS`` = 4 bits differ. The bits form
a ring of five segments. If two fingerprints differ in at most 4 bits, some segment
starts a chain whose first l segments together differ in at most floor(4 l / 5) bits,
for every l: 0, 1, 2, 3, 4. So

* l = 1 and 2 are an equi-join key: a segment, and the next one up to one flipped bit.
  Every fingerprint offers 5 exact keys and asks for 64 keys with a flipped bit, whatever
  the data; rows grow in proportion to the fingerprints.
* l = 3 and 4 prune the candidates of a key before the full Hamming check.

Candidates of a key are not written as pairs. A task walks its keys in order and
returns a spanning forest of the links it finds: a key with g fingerprints gives at
most g - 1 rows, and once a group of near copies hangs together its members are not
compared again. Keys that more than ``KEY_LIMIT`` fingerprints offer are split into
blocks; each pair of blocks is solved in its own place, which keeps every link.

Equal texts and equal fingerprints are merged before the search, by an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillwise.llm.components import components
from tillwise.workspace import materialise

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
# Segments of the ring, lowest bits first.
WIDTHS = (13, 13, 13, 13, 12)
OFFSETS = (0, 13, 26, 39, 52)
KEY_LIMIT = 20_000

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SLICE = 1 << 16


def fingerprint(text: bytes) -> int:
    """SimHash of a whole text: majority of the bits of its word shingles' XXH64 values."""
    # bytes.split() splits at exactly the ASCII white space \x20 \x09-\x0D.
    words = text.translate(_UPPER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(SHINGLE_WORDS, len(words)) - 1
    first, last = starts[: len(words) - span].tolist(), ends[span:].tolist()
    digest = xxhash.xxh64_intdigest
    return majority(
        np.array(
            [digest(joined[a:b], SEED) for a, b in zip(first[k : k + _SLICE], last[k : k + _SLICE])],
            dtype="<u8",
        )
        for k in range(0, len(first), _SLICE)
    )


def majority(slices: Iterable[np.ndarray]) -> int:
    """The bits set in over half of all hashes (unsigned, 64 bits) of the slices."""
    votes, n = np.zeros(64, np.int64), 0
    for hashes in slices:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    found = [fingerprint(t.as_py() or b"") for t in texts]
    return pa.array(np.array(found, dtype=np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a long column ``fp``. Null and empty texts have fingerprint zero."""
    return docs.withColumn("fp", _fingerprints(F.col(text_col).cast("binary")))


def _segment(fp: Column, i: int) -> Column:
    i %= len(WIDTHS)
    return F.shiftrightunsigned(fp, OFFSETS[i]).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1).cast("long"))


def _key(i: int, first: Column, second: Column) -> Column:
    """Chain start, its segment and the next segment as one long."""
    head = F.lit(i).cast("long")
    return F.shiftleft(F.shiftleft(head, 13).bitwiseOR(first), 13).bitwiseOR(second)


def _offered(fps: DataFrame) -> DataFrame:
    fp = F.col("fp")
    own = [_key(i, _segment(fp, i), _segment(fp, i + 1)) for i in range(5)]
    return fps.select(F.explode(F.array(*own)).alias("key"), "fp")


def _asked(fps: DataFrame) -> DataFrame:
    fp = F.col("fp")
    flipped = [
        _key(i, _segment(fp, i), _segment(fp, i + 1).bitwiseXOR(F.lit(1 << bit).cast("long")))
        for i in range(5)
        for bit in range(WIDTHS[(i + 1) % 5])
    ]
    return fps.select(F.explode(F.array(*flipped)).alias("key"), "fp")


def _in_blocks(rows: DataFrame, fps: DataFrame, limit: int) -> DataFrame:
    """Rows with a column ``sub``: 0, or for crowded keys every pair of blocks the row is in."""
    crowded = (
        _offered(fps).groupBy("key").count().where(F.col("count") > limit)
        .withColumn("blocks", F.ceil(F.col("count") / limit).cast("long"))
    )
    # Whoever offers a crowded key asks for its neighbours, so these are crowded too.
    width = F.when(F.shiftright("key", 26) == 3, 12).otherwise(13)
    flips = F.transform(
        F.sequence(F.lit(0), width - 1), lambda b: F.pow(F.lit(2), b).cast("long")
    )
    near = crowded.select(F.explode(flips).alias("flip"), "key", "blocks").select(
        F.col("key").bitwiseXOR(F.col("flip")).alias("key"), "blocks"
    )
    split = materialise(
        crowded.select("key", "blocks").union(near).groupBy("key").agg(F.max("blocks").alias("blocks")),
        "simhash-crowded",
    )
    if split.isEmpty():
        return rows.withColumn("sub", F.lit(0).cast("long"))
    block = F.expr("pmod(xxhash64(fp), blocks)")
    both = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other),
    )
    subs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(both)
    return rows.join(split, "key", "left").select("key", "fp", F.explode(subs).alias("sub"))


def _chained(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Whether fingerprints ``b`` link to ``a``: chain budgets first, then all bits."""
    diff = a ^ b
    mask, live = 0, np.ones(len(diff), bool)
    for step in range(4):
        i = (start + step) % 5
        mask |= ((1 << WIDTHS[i]) - 1) << OFFSETS[i]
        budget = MAX_BITS * (step + 1) // 5
        live[live] = np.bitwise_count(diff[live] & np.uint64(mask)) <= budget
    live[live] = np.bitwise_count(diff[live]) <= MAX_BITS
    return live


def forest(fps: np.ndarray, offers: np.ndarray, start: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints of one key, offered or asked for.

    Grown breadth first: a reached fingerprint is compared only with those not yet
    reached, and askers only with offers.
    """
    waiting, wanted = fps, offers
    edges = []
    while len(waiting) > 1 and wanted.any():
        at = int(np.argmax(wanted))
        queue = [(waiting[at], True)]
        waiting, wanted = np.delete(waiting, at), np.delete(wanted, at)
        while queue and len(waiting):
            one, offered = queue.pop()
            hit = _chained(np.full(len(waiting), one), waiting, start)
            if not offered:
                hit &= wanted
            if hit.any():
                edges += [(int(one), int(x)) for x in waiting[hit]]
                queue += list(zip(waiting[hit], wanted[hit]))
                waiting, wanted = waiting[~hit], wanted[~hit]
    return edges


def _links_of(key: np.ndarray, fp: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Forest edges of all runs of equal key; ``bounds`` has the runs' starts and the end."""
    start = key >> 26
    first = np.zeros(len(key), np.int64)
    second = np.zeros(len(key), np.int64)
    for i in range(5):
        at = start == i
        j = (i + 1) % 5
        first[at] = (fp[at] >> np.uint64(OFFSETS[i])) & np.uint64((1 << WIDTHS[i]) - 1)
        second[at] = (fp[at] >> np.uint64(OFFSETS[j])) & np.uint64((1 << WIDTHS[j]) - 1)
    offers = (key & ((1 << 26) - 1)) == (first << 13 | second)
    offered = np.add.reduceat(offers, bounds[:-1], dtype=np.int64)
    sizes = np.diff(bounds)
    edges: list[tuple[int, int]] = []
    for r in np.flatnonzero((offered > 0) & (sizes > 1)):
        a, b = bounds[r], bounds[r + 1]
        edges += forest(fp[a:b], offers[a:b], int(start[a]))
    return edges


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solve sorted (key, sub, fp) rows run by run; a run that a batch cuts is carried on."""
    rest = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        new[2] = new[2].view(np.uint64)
        key, sub, fp = (np.concatenate(pair) for pair in zip(rest, new))
        if not len(key):
            continue
        change = np.flatnonzero((np.diff(key) != 0) | (np.diff(sub) != 0)) + 1
        last = int(change[-1]) if len(change) else 0
        rest = [key[last:], sub[last:], fp[last:]]
        if last:
            bounds = np.concatenate([[0], change])
            yield _edge_batch(_links_of(key[:last], fp[:last], bounds))
    if len(rest[0]):
        yield _edge_batch(_links_of(rest[0], rest[2], np.array([0, len(rest[0])])))


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def links(fps: DataFrame, key_limit: int = KEY_LIMIT) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints ``fp`` exactly as all links would."""
    rows = _in_blocks(_offered(fps).unionByName(_asked(fps)), fps, key_limit)
    return (
        rows.select("key", "sub", "fp")
        .repartition("key", "sub")
        .sortWithinPartitions("key", "sub")
        .mapInArrow(_walk, "a long, b long")
    )


def _roots(marked: DataFrame, key: Column) -> DataFrame:
    """Per distinct ``fp``: ``root``, the same for linked ones, and ``least``, its smallest key."""
    distinct = materialise(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    groups = components(links(distinct.select("fp")))
    return materialise(
        distinct.join(groups, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("root")
        ),
        "simhash-roots",
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp, fingerprint, component_id`` of every row of ``docs``.

    ``fingerprint`` is ``fp`` as 16 hex digits. ``component_id`` is the smallest id
    among the rows reachable by links, its own included; null ids are never smallest
    unless a component has no other. Texts without words have fingerprint zero and
    link like any other. Repeated rows are repeated. Other columns are not read.
    """
    chosen = docs.select(F.col(id_col), F.col(text_col))
    marked = materialise(fingerprints(chosen, text_col).select(id_col, "fp"), "simhash-fp")
    root = _roots(marked, F.col(id_col))
    smallest = root.groupBy("root").agg(F.min("least").alias("component_id"))
    found = root.join(smallest, "root").select("fp", "component_id")
    return marked.join(found, "fp").select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked texts: that of the smallest id.

    Null ids come last; of rows that share id and fingerprint, the smallest text stays.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
    )
    marked = materialise(fingerprints(packed).select("row", "id", "text", "fp"), "simhash-docs")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    winners = _roots(marked, order).groupBy("root").agg(
        F.min(F.struct("least", "fp")).alias("w")
    ).select(F.col("w.least.id").alias("w_id"), F.col("w.fp").alias("w_fp"))
    # Joined and ranked by one key that is never null, so the texts are moved once.
    keyed = marked.withColumn("h", F.xxhash64("id", "fp"))
    chosen = winners.withColumn("w_h", F.xxhash64("w_id", "w_fp"))
    same = "h = w_h and (fp ^ w_fp) = 0 and coalesce(id = w_id, id is null and w_id is null)"
    kept = keyed.join(chosen, F.expr(same), "left_semi")
    first = W.partitionBy("h", "id", "fp").orderBy("text")
    return (
        kept.withColumn("n", F.row_number().over(first)).where(F.col("n") == 1).select("row.*")
    )
