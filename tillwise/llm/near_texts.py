"""Near copies by SimHash, confirmed by the Jaccard similarity of word shingles.

Two texts link when the sets of their five-word shingles have a Jaccard similarity of
at least 0.8 (texts of fewer words are one shingle). Each text has a SimHash fingerprint
of its set, and ``simhash.links`` proposes the texts whose fingerprints differ in few
bits. At a similarity of 0.8 about 10 of 64 bits differ, more than any search by chains
of bits can ask for, so such texts are proposed by MinHash as well: 24 bands of four
minima, of which they share none with a probability of (1 - 0.8^4)^24 = 3e-6. Both kinds
of candidates are joined into families, and within a family every pair is judged by its
shingles: no text is dropped on the word of a sketch, and a pair of a family links
whether or not it was a candidate itself.

A family is solved in one task, which counts common shingles through an inverted index
and returns a spanning forest of the links. Families above a bound on memory and work
are split into blocks; each pair of blocks is solved in its own place, which keeps
every link. That is quadratic in the blocks of a family, the price of exact links.

Texts of equal words are merged first, by an aggregate on their digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from tillwise.llm.components import components
from tillwise.llm.memory import returning_memory
from tillwise.llm.simhash import SEED, _UPPER, links, majority
from tillwise.workspace import materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 4
#: A block holds so many shingles, and comparing all its texts takes so many steps, at most.
BLOCK_SHINGLES, BLOCK_STEPS = 4e6, 5e9

_SLICE = 1 << 12
_random = np.random.default_rng(SEED)
_TIMES = _random.integers(0, 1 << 63, (BANDS * BAND_ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _random.integers(0, 1 << 63, (BANDS * BAND_ROWS, 1), dtype=np.uint64) * np.uint64(2)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, ASCII letters lowered."""
    return text.translate(_UPPER).split()


def shingles(words: list[bytes]) -> np.ndarray:
    """The distinct shingles' XXH64 values, sorted. No words: none."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(SHINGLE_WORDS, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - span].tolist(), ends[span:].tolist())
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))


def band_keys(found: np.ndarray) -> list[int]:
    """One key for each band of minima; none without shingles."""
    if not len(found):
        return []
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), _SLICE):
        least = np.minimum(least, ((found[k : k + _SLICE] ^ _FLIPS) * _TIMES).min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


@F.arrow_udf(BinaryType())
def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([_digest(words_of(t.as_py() or b"")) for t in texts], pa.binary())


_SIGNED = pa.struct(
    [("digest", pa.binary()), ("size", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))]
)


def simhash_of(found: np.ndarray) -> int | None:
    """The SimHash fingerprint of a set of shingles as a signed long; none without shingles."""
    if not len(found):
        return None
    one = majority(found[k : k + _SLICE] for k in range(0, len(found), _SLICE))
    return one - (1 << 64) if one >> 63 else one


@F.arrow_udf(
    StructType().add("digest", BinaryType()).add("size", LongType()).add("fp", LongType())
    .add("keys", ArrayType(LongType()))
)
def _signed(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts:
        words = words_of(t.as_py() or b"")
        found = shingles(words)
        out.append({
            "digest": _digest(words), "size": len(found),
            "fp": simhash_of(found), "keys": band_keys(found),
        })
    return pa.array(out, _SIGNED)


def _linked(distinct: DataFrame) -> DataFrame:
    """Edges that connect the texts whose SimHash fingerprints are equal or link."""
    prints = materialise(
        distinct.where("fp is not null").groupBy("fp").agg(F.min("digest").alias("first")), "near-prints"
    )
    near = links(prints.select("fp"))
    firsts = [prints.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_first")) for c in ("a", "b")]
    far = near.join(firsts[0], "a").join(firsts[1], "b").select(
        F.col("a_first").alias("a"), F.col("b_first").alias("b")
    )
    equal = distinct.join(prints, "fp").where("digest <> first").select(
        F.col("first").alias("a"), F.col("digest").alias("b")
    )
    return far.unionByName(equal)


def _shared(distinct: DataFrame) -> DataFrame:
    """Edges from every text of a band's key to the smallest digest of that key."""
    offered = distinct.select(F.explode("keys").alias("key"), "digest")
    least = offered.groupBy("key").agg(F.min("digest").alias("a"), F.max("digest").alias("z"))
    return offered.join(least.where("a <> z").select("key", "a"), "key").where("digest <> a").select(
        "a", F.col("digest").alias("b")
    )


def forest(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest, by position, of the links between sets of shingles.

    Grown breadth first: a reached set is compared only with those not yet reached.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(number, kind="stable")
    posts = owner[order]
    bounds = np.searchsorted(number[order], np.arange(len(values) + 1))
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    waiting = np.ones(len(sets), bool)
    edges = []
    for root in range(len(sets)):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            one = queue.pop()
            own = number[cuts[one] : cuts[one + 1]]
            lists = [posts[a:b] for a, b in zip(bounds[own].tolist(), bounds[own + 1].tolist())]
            common = np.bincount(np.concatenate(lists), minlength=len(sets)) if lists else 0 * sizes
            union = np.maximum(sizes + sizes[one] - common, 1)
            hit = np.flatnonzero(waiting & (common / union >= similarity))
            waiting[hit] = False
            edges += [(one, int(x)) for x in hit]
            queue += hit.tolist()
    return edges


def _solved(digests: list[bytes], sets: list[np.ndarray]) -> pa.RecordBatch:
    edges = forest(sets) if len(sets) > 1 else []
    return pa.RecordBatch.from_arrays(
        [pa.array([digests[e[k]] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"]
    )


@returning_memory
def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solve sorted (family, sub, digest, text) rows run by run."""
    at, digests, sets = None, [], []
    for batch in batches:
        for family, sub, digest, text in zip(*batch.columns):
            here = family.as_py(), sub.as_py()
            if here != at:
                if digests:
                    yield _solved(digests, sets)
                at, digests, sets = here, [], []
            digests.append(digest.as_py())
            sets.append(shingles(words_of(text.as_py() or b"")))
    if digests:
        yield _solved(digests, sets)


def _links(members: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect the digests of ``members`` exactly as all links would."""
    block = F.expr("pmod(xxhash64(digest), blocks)")
    both = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other),
    )
    return (
        members.select("family", "digest", "text", F.explode(both).alias("sub"))
        .select("family", "sub", "digest", "text")
        .repartition("family", "sub")
        .sortWithinPartitions("family", "sub", "digest")
        .mapInArrow(_walk, "a binary, b binary")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked texts: that of the smallest id.

    A group holds all that is reachable by links. Null ids come last; of rows that share
    id and words, the smallest text stays. Texts without words (null ones too) are equal.
    """
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"))
    text = F.col(f"`{text_col}`").cast("binary")
    distinct = materialise(
        docs.select(order.alias("at"), _signed(text).alias("s"))
        .groupBy(F.col("s.digest").alias("digest"))
        .agg(F.min("at").alias("least"), F.first("s.size").alias("size"),
             F.first("s.fp").alias("fp"), F.first("s.keys").alias("keys")),
        "near-distinct",
    )
    candidates = _linked(distinct).unionByName(_shared(distinct))
    families = components(candidates).withColumnRenamed("component", "family")
    info = distinct.join(families, F.col("digest") == F.col("node"), "left")
    info = materialise(info.select("digest", "least", "size", "family"), "near-info")
    work = F.greatest(F.sqrt(F.col("size") / BLOCK_STEPS), F.col("size") / BLOCK_SHINGLES)
    blocks = info.where("family is not null").groupBy("family").agg(
        F.greatest(F.ceil(F.sum(work)), F.lit(1)).cast("long").alias("blocks")
    )

    # Joined and ranked by two keys that are never null, so the texts are moved once.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        order.alias("at"), _digests(text).alias("digest"),
    ).withColumn("h", F.xxhash64("at.id", "digest"))
    chosen = info.select(
        F.xxhash64("least.id", "digest").alias("c_h"), F.col("digest").alias("c_digest"),
        F.col("least").alias("c_least"), "family",
    )
    first = W.partitionBy("h", "digest", "at").orderBy(F.col("row").getField(text_col))
    firsts = materialise(
        rows.join(chosen, F.expr(
            "h = c_h and digest = c_digest"
            " and coalesce(at.id = c_least.id, at.id is null and c_least.id is null)"
        ))
        .withColumn("n", F.row_number().over(first)).where("n = 1").select("row", "digest", "family"),
        "near-firsts",
    )
    members = firsts.where("family is not null")
    compared = members.select("family", "digest", F.col("row").getField(text_col).cast("binary").alias("text"))
    roots = components(_links(compared.join(blocks, "family")))
    placed = roots.select(F.col("node").alias("digest"), F.col("component").alias("root")).join(
        info.select("digest", "least"), "digest"
    )
    winners = placed.groupBy("root").agg(F.min(F.struct("least", "digest")).alias("w"))
    losers = placed.join(winners, "root").where("digest <> w.digest").select("digest")
    kept = members.join(materialise(losers, "near-losers"), "digest", "left_anti")
    return firsts.where("family is null").select("row.*").unionByName(kept.select("row.*"))
