"""Ranked lexical search by Block-Max MaxScore over sharded inverted lists.

``build`` reads whole texts into shards of about ``SHARD_BYTES`` of text. A shard holds its
documents' ids and lengths, and for every term a list of postings (document number, count)
cut into blocks. A block row carries what bounds its scores, the largest count and the
shortest document, beside its compressed postings.

``search`` takes only the lists of the terms asked for to the items:

1. A term's weight comes from its document count over all shards.
2. In a shard, an item's lists are ordered by the highest score any of their postings can
   give. The lists whose bounds together stay below the item's k-th score are non-essential:
   a document found in them alone cannot enter. Documents come from the essential lists.
3. A candidate is looked up in a non-essential list only while its score, the maximum of the
   block it would be in and the bounds of the lists still to come reach the k-th score;
   blocks without such a candidate are never decompressed.
4. A task goes through many shards and keeps the items' heaps, so the k-th scores it has
   reached prune the next shard. The tasks' heaps are merged at the end.

Items are dealt out in blocks of about ``ITEM_TERMS`` terms, and every group of shards meets
every block of items, as each item is ranked over all documents. Nothing is broadcast; a
task holds one block of items, their heaps and one shard's lists.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.workspace import materialise

SHARD_BYTES = 16 << 20
#: Document numbers of a shard fit in two bytes.
SHARD_DOCS = 1 << 16
BLOCK = 128
ITEM_TERMS = 200_000
TOP = 20
#: Documents scored side by side; the k-th score rises from window to window.
WINDOW = 4096
#: Copies of the asked terms, so that a term of most documents is joined in many places.
SALTS = 32

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATORS = [i for i in range(128) if not chr(i).isalnum()]
_LEVEL = bytes.maketrans(
    bytes(range(65, 91)) + bytes(_SEPARATORS), bytes(range(97, 123)) + b" " * len(_SEPARATORS)
)
_PRESSED = 32  # postings from which a block is worth compressing
_ROWS = 20_000

_INDEX = (
    "shard long, term string, block int, n int, last int, max_tf int, least_len int, "
    "data binary, ids array<long>, tokens long"
)
_ARROW = pa.schema([
    ("shard", pa.int64()), ("term", pa.string()), ("block", pa.int32()), ("n", pa.int32()),
    ("last", pa.int32()), ("max_tf", pa.int32()), ("least_len", pa.int32()),
    ("data", pa.binary()), ("ids", pa.list_(pa.int64())), ("tokens", pa.int64()),
])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: A-Z lower-cased, runs of letters, digits and non-ASCII."""
    return text.translate(_LEVEL).split()


def _shard_rows(shard: int, keys: list, numbers: list, terms: list[bytes]) -> Iterator[pa.RecordBatch]:
    lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
    head = pa.RecordBatch.from_pylist(
        [{"shard": shard, "block": -1, "n": int((lengths > 0).sum()), "ids": keys,
          "data": lengths.astype("<u4").tobytes(), "tokens": int(lengths.sum())}], _ARROW)
    yield head
    if not terms:
        return
    many = len(keys)
    both, tf = np.unique(
        np.concatenate(numbers).astype(np.int64) * many + np.repeat(np.arange(many), lengths),
        return_counts=True,
    )
    term, doc = both // many, both % many
    del both
    first = np.flatnonzero(np.diff(term, prepend=-1))
    within = np.arange(len(term)) - np.repeat(first, np.diff(first, append=len(term)))
    start = np.flatnonzero(within % BLOCK == 0)
    end = np.append(start[1:], len(term))
    # Documents as steps from the one before, absolute where a block begins.
    steps = np.diff(doc, prepend=0)
    steps[start] = doc[start]
    low, high = (steps & 255).astype(np.uint8).tobytes(), (steps >> 8).astype(np.uint8).tobytes()
    small, wide = np.minimum(tf, 255).astype(np.uint8).tobytes(), tf.astype("<u4").tobytes()
    max_tf = np.maximum.reduceat(tf, start)
    press = zstandard.ZstdCompressor(level=3).compress
    data = []
    for a, b, top in zip(start.tolist(), end.tolist(), max_tf.tolist()):
        raw = low[a:b] + high[a:b] + (small[a:b] if top < 256 else wide[4 * a : 4 * b])
        data.append(raw if b - a < _PRESSED else press(raw))
    names = pa.array(terms, pa.binary()).cast(pa.string())
    columns = {
        "term": names.take(pa.array(term[start])),
        "block": pa.array((within[start] // BLOCK).astype(np.int32)),
        "n": pa.array((end - start).astype(np.int32)),
        "last": pa.array(doc[end - 1].astype(np.int32)),
        "max_tf": pa.array(max_tf.astype(np.int32)),
        "least_len": pa.array(np.minimum.reduceat(lengths[doc], start).astype(np.int32)),
        "data": pa.array(data, pa.binary()),
    }
    rows = len(start)
    columns |= {
        "shard": pa.array(np.full(rows, shard)),
        "ids": pa.nulls(rows, pa.list_(pa.int64())), "tokens": pa.nulls(rows, pa.int64()),
    }
    whole = pa.RecordBatch.from_arrays([columns[n] for n in _ARROW.names], schema=_ARROW)
    for at in range(0, rows, _ROWS):
        yield whole.slice(at, _ROWS)


def _index(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0

    def fresh():
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        return [], [], known, 0

    keys, numbers, known, size = fresh()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or b""
            if keys and (size + len(text) > limit or len(keys) == SHARD_DOCS):
                yield from _shard_rows(part << 32 | made, keys, numbers, list(known))
                made += 1
                keys, numbers, known, size = fresh()
            words = terms_of(text)
            keys.append(key)
            numbers.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
            size += len(text)
    if keys:
        yield from _shard_rows(part << 32 | made, keys, numbers, list(known))


def build(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The index of all rows of ``docs``, written to the shared folder.

    A null or empty text is a document without terms. Repeated rows are documents of their
    own. Other columns are not read. An empty table gives an empty index.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return materialise(rows.mapInArrow(lambda b: _index(b, shard_bytes), _INDEX), "lexical-index")


def item_terms(text: Column) -> Column:
    """The terms of an item, repeats included, by built-in functions."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(TERM), F.lit(0))


def _impact(tf, scaled_length):
    """Score of a posting before its term's weight, in whole numbers; grows with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * scaled_length)


class _Shard:
    """One shard's lists of the asked terms, with the bounds of its blocks and lists."""

    def __init__(self, table: pa.Table, total: int, tokens: int):
        head = table.slice(0, 1)
        ids = head["ids"].combine_chunks().values
        self.ids = ids.to_pylist()
        lengths = np.frombuffer(head["data"][0].as_py(), "<u4").astype(np.int64)

        def scaled(n):
            return 75 + (25 * n * total) // tokens

        self.scaled = scaled(lengths)
        rows = table.slice(1)
        self.n, self.last, self.max_tf, least = (
            rows[c].to_numpy().astype(np.int64) for c in ("n", "last", "max_tf", "least_len")
        )
        self.data = rows["data"].combine_chunks()
        self.bound = _impact(self.max_tf, scaled(least))
        names = rows["term"].combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        code = names.indices.to_numpy()
        start = np.flatnonzero(np.diff(code, prepend=-1)) if len(code) else np.empty(0, np.int64)
        end = np.append(start[1:], len(code))
        highest = np.maximum.reduceat(self.bound, start) if len(start) else start
        words = names.dictionary.to_pylist()
        self.lists = {
            words[code[a]]: (a, b, top)
            for a, b, top in zip(start.tolist(), end.tolist(), highest.tolist())
        }
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._press = zstandard.ZstdDecompressor()

    def block(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block; decompressed when first asked for."""
        found = self._blocks.get(x)
        if found is None:
            n, raw = int(self.n[x]), self.data[x].as_py()
            if n >= _PRESSED:
                raw = self._press.decompress(raw)
            steps = np.frombuffer(raw, np.uint8, n).astype(np.int64)
            steps += np.frombuffer(raw, np.uint8, n, n).astype(np.int64) << 8
            wide = self.max_tf[x] > 255
            tf = np.frombuffer(raw, "<u4" if wide else np.uint8, n, 2 * n).astype(np.int64)
            docs = np.cumsum(steps)
            found = self._blocks[x] = docs, _impact(tf, self.scaled[docs])
        return found

    def whole(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """All postings of an essential list."""
        found = self._whole.get(a)
        if found is None:
            parts = [self.block(x) for x in range(a, b)]
            found = self._whole[a] = tuple(map(np.concatenate, zip(*parts)))
            for x in range(a, b):
                self._blocks[x] = parts[x - a]
        return found

    def _more(self, at: tuple, weight: int, cand, score, rest: int, least: int):
        """Scores of candidates with a non-essential list's share added; hopeless ones go."""
        a, b, _ = at
        x = a + np.searchsorted(self.last[a:b], cand)
        bound = np.where(x < b, weight * self.bound[np.minimum(x, b - 1)], 0)
        alive = score + bound + rest >= least
        cand, score, x = cand[alive], score[alive], x[alive]
        here = x < b
        if here.any():
            opened = [self.block(i) for i in np.unique(x[here]).tolist()]
            docs, impact = map(np.concatenate, zip(*opened))
            spot = np.minimum(np.searchsorted(docs, cand), len(docs) - 1)
            score = score + np.where(docs[spot] == cand, weight * impact[spot], 0)
        return cand, score

    def rank(self, terms: list[str], weights: list[int], heap: list, k: int) -> list:
        """``heap`` (best first: score negated, id unknown, id) after this shard."""
        found = [(self.lists[t], w) for t, w in zip(terms, weights) if w > 0 and t in self.lists]
        found.sort(key=lambda f: f[0][2] * f[1])
        if not found:
            return heap
        upto = np.cumsum([f[0][2] * f[1] for f in found])
        for low in range(0, len(self.ids), WINDOW):
            least = max(1, -heap[-1][0]) if len(heap) == k else 1
            first = int(np.searchsorted(upto, least))
            if first == len(found):
                break  # all lists together stay below the k-th score
            high = min(low + WINDOW, len(self.ids))
            sums = np.zeros(high - low, np.int64)
            for (a, b, _), weight in found[first:]:
                docs, impact = self.whole(a, b)
                i, j = np.searchsorted(docs, (low, high))
                sums[docs[i:j] - low] += weight * impact[i:j]
            cand = np.flatnonzero(sums)
            score = sums[cand]
            cand = cand + low
            for j in range(first - 1, -1, -1):
                alive = score + upto[j] >= least
                cand, score = cand[alive], score[alive]
                if not len(cand):
                    break
                rest = int(upto[j - 1]) if j else 0
                cand, score = self._more(*found[j], cand, score, rest, least)
            alive = score >= least
            cand, score = cand[alive], score[alive]
            if len(cand) > k:
                alive = score >= np.partition(score, len(score) - k)[len(score) - k]
                cand, score = cand[alive], score[alive]
            if len(cand):
                new = [(-s, self.ids[c] is None, self.ids[c] or 0) for c, s in zip(cand.tolist(), score.tolist())]
                heap = heapq.nsmallest(k, heap + new)
        return heap


def _search(batches: Iterator[pa.RecordBatch], total: int, tokens: int, k: int):
    """Rows sorted by (part, blk, shard, term, block): a block of items, then shard by shard."""
    at, items, heaps, waiting, shard = None, [], [], [], None

    def close_shard():
        nonlocal heaps
        if waiting and items:
            here = _Shard(pa.Table.from_batches(waiting), total, tokens)
            heaps = [here.rank(i[2], i[3], h, k) for i, h in zip(items, heaps)]
        waiting.clear()

    def results():
        rows = [(i[0], i[1], None if h[1] else h[2], -h[0]) for i, hs in zip(items, heaps) for h in hs]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["item_id", "digest", "doc_id", "score"],
            )

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("part", "blk", "shard")])
        cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if a == b:
                continue
            *group, this = keys[:, a].tolist()
            if (group, this) != (at, shard):
                close_shard()
                shard = this
            if group != at:
                yield from results()
                at, items, heaps = group, [], []
            some = batch.slice(a, b - a)
            if this == -1:
                new = [tuple(r.values()) for r in some.select(
                    ["item_id", "digest", "terms", "weights"]).to_pylist()]
                items += new
                heaps += [[] for _ in new]
            else:
                waiting.append(some)
    close_shard()
    yield from results()


def search(
    index: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, rank, doc_id, score``: each item's ``k`` documents of highest score above 0.

    Rows of equal id and text are one item; rows that share an id with different texts are
    ranked on their own. Equal scores rank by ascending document id, null ids last; repeated
    documents rank one after another. Items without terms, null texts and items without a
    match have no rows. Other columns are not read.
    """
    spark = index.sparkSession
    heads = index.where("block = -1")
    total, tokens, shards = heads.agg(
        F.sum("n"), F.sum("tokens"), F.count("*")).first()
    if not tokens:
        return spark.createDataFrame(
            [], f"`{id_col}` long, rank int, doc_id long, score long")
    asked = materialise(
        items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("t"))
        .select("item_id", F.sha2(F.coalesce("t", F.lit("")), 256).alias("digest"),
                item_terms(F.col("t")).alias("terms"))
        .distinct()
        .select("item_id", "digest", F.explode("terms").alias("term"))
        .groupBy("item_id", "digest", "term").agg(F.count("*").alias("times")),
        "lexical-items",
    )
    blocks = max(1, -(-asked.count() // ITEM_TERMS))
    blk = F.expr(f"cast(pmod(xxhash64(item_id, digest), {blocks}) as int)")
    wanted = asked.select("term").distinct().withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = F.expr(f"cast(pmod(xxhash64(shard, block), {SALTS}) as int)")
    lists = materialise(
        index.where("block >= 0").withColumn("salt", spread).join(wanted, ["term", "salt"])
        .drop("salt", "ids", "tokens"),
        "lexical-lists",
    )
    held = lists.groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000.0 * F.log(F.lit(2.0 * total + 2) / (2.0 * F.col("df") + 1))).cast("long")
    pair = F.struct("term", (weight * F.col("times")).alias("w"))
    queries = asked.join(held, "term").withColumn("blk", blk).groupBy(
        "blk", "item_id", "digest").agg(F.collect_list(pair).alias("p"))
    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk")
    part = F.expr(f"cast(pmod(xxhash64(shard), {parts}) as int)")
    if blocks > 1:
        where = asked.select("term", blk.alias("blk")).distinct()
        placed = lists.join(where, "term")
    else:
        placed = lists.withColumn("blk", F.lit(0))
    stream = (
        queries.select(
            all_parts, "blk", F.lit(-1).cast("long").alias("shard"), "item_id", "digest",
            F.col("p.term").alias("terms"), F.col("p.w").alias("weights"))
        .unionByName(heads.withColumn("part", part).select("*", all_blocks), allowMissingColumns=True)
        .unionByName(placed.withColumn("part", part), allowMissingColumns=True)
    )
    found = (
        stream.repartition(parts * blocks, "part", "blk")
        .sortWithinPartitions("part", "blk", "shard", "term", "block")
        .mapInArrow(
            lambda b: _search(b, total, tokens, k), "item_id long, digest string, doc_id long, score long")
    )
    best = W.partitionBy("item_id", "digest").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item_id").alias(id_col), "rank", "doc_id", "score")
