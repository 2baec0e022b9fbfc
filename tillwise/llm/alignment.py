"""Cross-tokenizer alignment with external spill counting of token pairs.

A byte-level tokenizer (side A) reads a space and the text, a piece tokenizer (side B) the
text. Offsets where tokens of both sides end cut them into groups; all A-B pairs within a
group are linked. How many documents hold a pair linked is counted like an external sort:

1. *Spill.* A task reads documents into chunks. A chunk counts its documents by distinct
   pair, sorts the pairs by A id, then B id, and leaves one run for each radix of the A id,
   cut into compressed frames. Runs, and what the chunk's documents hold, are written.
2. *Merge.* Runs of one radix are merged by a heap, ``FAN_IN`` at a time, of each run one
   frame open; first side by side in slots of about ``FAN_IN`` chunks, then the slots' runs.
   Pairs come out A id by A id, so an A id's highest count is known when the next begins.
3. *Contribute.* The counts of a radix lie before its runs in one sorted stream; each run is
   answered as it passes, and the answers meet their chunk's documents.

A pair moves once for each chunk that has it, however many documents do. Counts of a radix
are bounded by the vocabularies, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, groupby, islice
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.workspace import materialise

CHUNK_BYTES = 8 << 20
FAN_IN = 64
#: Texts encoded and aligned side by side.
BATCH_BYTES = 1 << 20
#: What a document counts for besides its text.
_EACH = 64
_FRAME = 8192
_LINKS = 1 << 21
#: Groups of more links go by distinct ids and their counts.
_LARGE = 4096
#: Fixed value: the published pattern by which byte-level tokenizers split a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and digits beyond these may be classed by another Unicode version.
_BEYOND = re.compile("[^\x00-\u024f]")
_BITS = 21
_LOW = (1 << _BITS) - 1

_SPILLED = "chunk long, part int, keys array<long>, digests array<string>, frames array<binary>"
_ARROW = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int32()), ("keys", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.string())), ("frames", pa.list_(pa.binary())),
])


def _pack(values: np.ndarray) -> bytes:
    """64-bit integers with their byte planes apart, compressed."""
    planes = np.ascontiguousarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view("<i8")


class Sides:
    """Both tokenizers, the bytes of their tokens and the words of the groups' notation."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        # The byte-level alphabet: visible Latin-1 characters stand for themselves, the
        # other bytes in order for the characters from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [i for i in range(256) if i not in plain]
        byte_of = {chr(i): i for i in plain} | {chr(256 + n): i for n, i in enumerate(rest)}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes([byte_of[c] for c in token]) if known else token.encode()
        size = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(size))
        ]
        if max(len(self.a_bytes), size) > _LOW:
            raise ValueError("vocabularies of more than two million entries")
        self.quick = self._by_ranks(byte_level)
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # Each id twice: within its side of a group, and as the last there.
        self.notes = [b"%d%c" % (i, c) for i in range(len(self.a_bytes)) for c in b",|"]
        self.notes += [b"%d%c" % (i, c) for i in range(size) for c in b",;"]

    def _by_ranks(self, byte_level: str):
        """Side A as merge ranks, which gives the same ids several times faster.

        None where the file is more than byte-level merges numbered in their order.
        """
        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        rule, model = spec.get("pre_tokenizer") or {}, spec["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        vocabulary = model["vocab"]
        first = len(vocabulary) - len(pairs)
        if (
            rule.get("type") != "ByteLevel" or not rule.get("use_regex") or rule.get("add_prefix_space")
            or spec.get("normalizer") or not all(t["special"] for t in spec.get("added_tokens", []))
            or first != 256 or any(vocabulary["".join(m)] != first + i for i, m in enumerate(pairs))
        ):
            return None
        import tiktoken

        ranks = {self.a_bytes[i]: i for i in vocabulary.values()}
        return tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _first(self, texts: list[str]) -> list[list[int]]:
        """Ids on side A, of a space and the text."""
        quick = [self.quick is not None and not _BEYOND.search(t) for t in texts]
        rest = [" " + t for t, q in zip(texts, quick) if not q]
        fast = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        slow = iter(fast(rest, add_special_tokens=False)) if rest else iter(())
        return [self.quick.encode_ordinary(" " + t) if q else next(slow).ids for t, q in zip(texts, quick)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids on both sides; none where either side's bytes are not a space and the text."""
        out = []
        for text, first, second in zip(texts, self._first(texts), self.b.encode(texts, num_threads=1)):
            raw = b" " + text.encode("utf-8")
            same = (
                text
                and b"".join(map(self.a_bytes.__getitem__, first)) == raw
                and b"".join(map(self.b_bytes.__getitem__, second)) == raw
            )
            out.append((first, second) if same else ([], []))
        return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum())), lengths


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[start], np.add.reduceat(times[order], start) if len(start) else times[:0]


def _pairs(ids_a, ids_b, group_a, n_a, n_b, doc):
    """Distinct (document, pair) keys and how often each is linked.

    ``doc``: the document of a group; a key is the document above A id above B id.
    """
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    large = n_a * n_b > _LARGE
    keys, times = [], []

    def add(k, t):
        k, t = _counted(k, t)
        keys.append(k)
        times.append(t)

    own = np.flatnonzero(~large[group_a])
    width = n_b[group_a[own]]
    upto = np.cumsum(width)
    for low in range(0, int(upto[-1]) if len(upto) else 0, _LINKS):
        i, j = np.searchsorted(upto, (low, low + _LINKS), side="right")
        some, many = own[i:j], width[i:j]
        if not len(some):
            continue
        group = group_a[some]
        first = np.cumsum(many) - many
        at = np.repeat(start_b[group] - first, many) + np.arange(int(many.sum()))
        key = (doc[group] << 2 * _BITS) + (ids_a[some] << _BITS)
        add(np.repeat(key, many) + ids_b[at], np.ones(len(at), np.int64))
    for g in np.flatnonzero(large).tolist():
        left, lots = np.unique(ids_a[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
        right, more = np.unique(ids_b[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
        step = max(1, _LINKS // len(right))
        for k in range(0, len(left), step):
            key = (doc[g] << 2 * _BITS) + (left[k : k + step, None] << _BITS) + right[None]
            add(key.reshape(-1), (lots[k : k + step, None] * more[None]).reshape(-1))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _counted(np.concatenate(keys), np.concatenate(times))


def align_texts(sides: Sides, texts: list[str]):
    """For texts side by side: counts (n_a, n_b, n_groups, n_links) and digest of each, and
    the distinct (document, pair) keys with their numbers of links."""
    encoded = sides.encode(texts)
    ids_a, len_a = _flat([e[0] for e in encoded])
    ids_b, len_b = _flat([e[1] for e in encoded])
    ends_a, ends_b = np.cumsum(sides.a_length[ids_a]), np.cumsum(sides.b_length[ids_b])
    # Both sides spell the same bytes, so the texts' ends are common ends as well.
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
    upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
    docs = np.arange(len(texts))
    last = np.zeros(len(common), np.int64)
    last[group_a] = np.repeat(docs, len_a)
    n_groups = np.bincount(last, minlength=len(texts))
    edge = np.concatenate([[0], np.cumsum(n_a * n_b)])[np.concatenate([[0], np.cumsum(n_groups)])]
    counts = np.stack([len_a, len_b, n_groups, np.diff(edge)])

    note = np.empty(len(ids_a) + len(ids_b), np.int64)
    at_a = np.arange(len(ids_a)) + (upto_b - n_b)[group_a]
    at_b = np.arange(len(ids_b)) + upto_a[group_b]
    note[at_a] = 2 * ids_a + (np.arange(1, len(ids_a) + 1) == upto_a[group_a])
    note[at_b] = 2 * (len(sides.a_bytes) + ids_b) + (np.arange(1, len(ids_b) + 1) == upto_b[group_b])
    ends = np.cumsum(len_a + len_b).tolist()
    digests, low = [], 0
    for high in ends:
        spelt = b"".join(map(sides.notes.__getitem__, note[low:high].tolist()))
        digests.append(hashlib.sha256(spelt[:-1]).hexdigest() if spelt else "")
        low = high
    return counts, digests, *_pairs(ids_a, ids_b, group_a, n_a, n_b, last)


def _frames(*columns: np.ndarray) -> list[bytes]:
    """Equally long columns in compressed frames of ``_FRAME`` records."""
    return [
        _pack(np.concatenate([c[k : k + _FRAME] for c in columns]))
        for k in range(0, len(columns[0]), _FRAME)
    ]


def _row(chunk, part, keys, digests, frames) -> pa.RecordBatch:
    values = ([chunk], [part], [keys], [digests], [frames])
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)


def _spill(batches: Iterator[pa.RecordBatch], paths, parts: int, limit: int) -> Iterator[pa.RecordBatch]:
    sides, task, made = Sides(*paths), TaskContext.get().partitionId(), 0

    def rows(keys, found):
        chunk = task << 32 | made
        counts = np.concatenate([f[0] for f in found], axis=1)
        digests = list(chain.from_iterable(f[1] for f in found))
        held = np.concatenate([f[2] & ((1 << 2 * _BITS) - 1) for f in found])
        times = np.concatenate([f[3] for f in found])
        widths = np.concatenate([
            np.bincount(f[2] >> 2 * _BITS, minlength=f[0].shape[1]) for f in found])
        pairs, place, n_docs = np.unique(held, return_inverse=True, return_counts=True)
        part = (pairs >> _BITS) % parts
        order = np.lexsort((pairs, part))
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        packed = [_pack(counts.reshape(-1)), _pack(widths), _pack(turn[place]), _pack(times)]
        yield _row(chunk, -1, keys, digests, packed)
        pairs, n_docs, part = pairs[order], n_docs[order], part[order]
        start = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(start.tolist(), np.append(start[1:], len(part)).tolist()):
            yield _row(chunk, int(part[a]), None, None, _frames(pairs[a:b], n_docs[a:b]))

    keys, found, size, texts, waiting = [], [], 0, [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if texts and waiting + len(text) > BATCH_BYTES:
                found.append(align_texts(sides, texts))
                texts, waiting = [], 0
            if keys and size + len(text) > limit:
                if texts:
                    found.append(align_texts(sides, texts))
                yield from rows(keys, found)
                made += 1
                keys, found, size, texts, waiting = [], [], 0, [], 0
            keys.append(key)
            texts.append(text)
            size += len(text) + _EACH
            waiting += len(text) + _EACH
    if keys:
        found.append(align_texts(sides, texts))
        yield from rows(keys, found)


def _records(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    for frame in frames:
        keys, counts = _unpack(frame).reshape(2, -1)
        yield from zip(keys.tolist(), counts.tolist())


def merge(runs: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Pairs in order with their counts over all runs; one frame of a run is open at a time."""
    for pair, some in groupby(heapq.merge(*map(_records, runs)), key=itemgetter(0)):
        yield pair, sum(count for _, count in some)


def _written(records: Iterator[tuple[int, ...]], width: int) -> list[bytes]:
    frames = []
    while some := list(islice(records, _FRAME)):
        frames.append(_pack(np.fromiter(chain.from_iterable(some), np.int64, width * len(some))
                            .reshape(-1, width).T.reshape(-1)))
    return frames


def with_maxima(records: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """Pair, count and whether it is the highest of its A id; an A id's pairs are held at a time."""
    for _, some in groupby(records, key=lambda r: r[0] >> _BITS):
        held = list(some)
        top = max(count for _, count in held)
        yield from ((pair, count, int(count == top)) for pair, count in held)


def _merge_runs(batches: Iterator[pa.RecordBatch], final: bool) -> Iterator[pa.RecordBatch]:
    """One run for each (part, slot); rows come sorted by these."""
    group, runs = None, []

    def closed():
        merged = merge(runs)
        frames = _written(with_maxima(merged), 3) if final else _written(merged, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array([group[0]], pa.int32()), pa.array([frames], pa.list_(pa.binary()))],
            ["part", "frames"],
        )

    for batch in batches:
        for part, slot, frames in zip(*(batch.column(c) for c in ("part", "slot", "frames"))):
            at = (part.as_py(), slot.as_py())
            if at != group:
                if runs:
                    yield closed()
                group, runs = at, []
            if len(runs) == FAN_IN:
                runs = [_written(merge(runs), 2)]
            runs.append(frames.as_py())
    if runs:
        yield closed()


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to runs, from the counts that come before them in each part."""
    held = None
    for batch in batches:
        for chunk, part, frames in zip(*(batch.column(c) for c in ("chunk", "part", "frames"))):
            frames = frames.as_py()
            if chunk.as_py() is None:
                held = np.concatenate([_unpack(f).reshape(3, -1) for f in frames], axis=1)
                continue
            pairs = np.concatenate([_unpack(f).reshape(2, -1)[0] for f in frames])
            at = np.searchsorted(held[0], pairs)
            yield _row(chunk.as_py(), part.as_py(), None, None, [_pack(held[1][at]), _pack(held[2][at])])


_RESULT = pa.schema([
    *((c, pa.int64()) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    ("groups_sha256", pa.string()),
])


def _settle(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums of their pairs' counts."""
    out = []
    for keys, digests, frames in zip(*(texts[c].to_pylist() for c in ("keys", "digests", "frames"))):
        counts, widths, place, times = map(_unpack, frames)
        order = np.argsort(answers["part"].to_numpy())
        got = [answers["frames"][int(i)].as_py() for i in order]
        count, best = (
            np.concatenate([np.empty(0, np.int64), *(_unpack(g[k]) for g in got)]) for k in (0, 1))
        ends = np.cumsum(widths)

        def total(values):
            upto = np.concatenate([[0], np.cumsum(values)])
            return upto[ends] - upto[ends - widths]

        columns = [
            pa.array(keys, pa.int64()), *map(pa.array, counts.reshape(4, -1)),
            pa.array(total(times * best[place])), pa.array(total(times * count[place])),
            pa.array(digests, pa.string()),
        ]
        out.append(pa.Table.from_arrays(columns, schema=_RESULT))
    return pa.concat_tables(out) if out else _RESULT.empty_table()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for frames in batch.column(0):
            for frame in frames.as_py():
                pair, count, best = _unpack(frame).reshape(3, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair >> _BITS), pa.array(pair & _LOW), pa.array(count), pa.array(best > 0)],
                    ["a_id", "b_id", "n_docs", "best"],
                )


class Alignment(NamedTuple):
    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> Alignment:
    """``documents``: ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row of ``docs``; ``pairs``: ``a_id, b_id, n_docs, best`` of
    every linked id pair.

    ``byte_level`` is the file of a byte-level tokenizer, ``pieces`` that of a piece model.
    Texts that are null or empty, or that either side does not spell as a space and the
    text, have no tokens: zeros and an empty digest. Repeated rows count as documents of
    their own; null ids stay null. Other columns are not read.
    """
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(16, min(shuffles, 1 << 15))
    paths = (byte_level, pieces)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    spilled = materialise(
        rows.mapInArrow(lambda b: _spill(b, paths, parts, chunk_bytes), _SPILLED), "align-spill")
    texts, runs = spilled.where("part = -1"), spilled.where("part >= 0").select("chunk", "part", "frames")
    slots = max(1, -(-texts.count() // FAN_IN))

    def merged(of: DataFrame, slot, final: bool) -> DataFrame:
        return (
            of.select("part", slot.alias("slot"), "frames")
            .repartition(parts, "part", "slot").sortWithinPartitions("part", "slot")
            .mapInArrow(lambda b: _merge_runs(b, final), "part int, frames array<binary>")
        )

    some = F.expr(f"cast(pmod(xxhash64(chunk), {slots}) as int)")
    counts = materialise(merged(merged(runs, some, False), F.lit(0), True), "align-counts")
    answers = (
        runs.unionByName(counts, allowMissingColumns=True)
        .repartition(parts, "part").sortWithinPartitions("part", F.col("chunk").asc_nulls_first())
        .mapInArrow(_contribute, _SPILLED)
    )
    found = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _settle,
        "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string",
    )
    listed = counts.select("frames").mapInArrow(_listed, "a_id long, b_id long, n_docs long, best boolean")
    return Alignment(found.withColumnRenamed("id", id_col), listed)
