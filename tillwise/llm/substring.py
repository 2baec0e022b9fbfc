"""Substring deduplication by fixed-block anchors.

A repeat of ``window`` or more words covers a whole block of ``(window + 1) // 2`` words,
wherever it starts, if a reference document is cut into such blocks end to end. So

1. *Chunk.* Texts become word numbers and a vocabulary, about ``chunk_bytes`` of text a row,
   written once. Everything after reads these rows.
2. *Index and probe.* Each document offers its non-overlapping blocks and asks with every
   rolling window of block length. Hashes are dealt by range to parts; a part answers each
   chunk with one bit a hash: whether some document's block meets another document.
3. *Extend.* Around the hits, positions are extended to all windows of ``window`` words that
   hold one. The windows' digests meet again, by range, with the smallest id that has each,
   and every chunk learns where a smaller id exists. Neighbouring windows of that kind merge
   into maximal repeats. A passage of many documents is extended against all holders at
   once: one digest a chunk and part, never a pair of documents.

Block hashes have 48 bits and only propose; windows are told apart by 96 bits of digest.
A part holds about ``PART_WINDOWS`` hashes, so their number grows with the corpus. A chunk
sends a hash once, whatever the number of its documents that have it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.workspace import materialise

WINDOW_WORDS = 13
CHUNK_BYTES = 8 << 20
PART_WINDOWS = 2_000_000
#: What a document counts for besides its text.
_EACH = 64
#: Ids that are null count as the largest.
_LAST = np.iinfo(np.int64).max
# Odd multipliers of the rolling sums, fixed so that all tasks agree.
_TIMES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_CHUNKS = "chunk long, keys array<long>, counts binary, vocabulary binary, numbers binary, words long"
_SENT = "chunk long, part int, low binary, high binary, marks binary"
_ANSWER = "chunk long, part int, stage int, bits binary"


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _open(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack(values: np.ndarray) -> bytes:
    """Integers with their byte planes apart, compressed."""
    width = values.dtype.itemsize
    return _press(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(_open(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _split(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0

    def fresh():
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        return [], [], known, 0

    def row():
        flat = np.concatenate(numbers)
        # Numbered by falling frequency, most numbers are small.
        often = np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")
        number = np.empty(len(known), np.uint32)
        number[often] = np.arange(len(known), dtype=np.uint32)
        words = list(known)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part << 32 | made]), pa.array([keys], pa.list_(pa.int64())),
                pa.array([_pack(np.array([len(n) for n in numbers], "<u4"))]),
                pa.array([_press(b" ".join([words[i] for i in often]))]),
                pa.array([_pack(number[flat])]), pa.array([len(flat)]),
            ],
            ["chunk", "keys", "counts", "vocabulary", "numbers", "words"],
        )

    keys, numbers, known, size = fresh()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or b""
            if keys and size + len(text) > limit:
                yield row()
                made += 1
                keys, numbers, known, size = fresh()
            # bytes.split() splits at exactly the ASCII white space \x20 \x09-\x0D.
            words = text.split()
            keys.append(key)
            numbers.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            size += len(text) + _EACH
    if keys:
        yield row()


def _edges(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, start, end) of the runs of a sorted array."""
    start = np.flatnonzero(np.diff(part, prepend=-1))
    return zip(part[start].tolist(), start.tolist(), np.append(start[1:], len(part)).tolist())


class _Chunk:
    """A chunk's words, its block hashes and the digests of its windows.

    Every order in here follows from the written row, so a chunk that is taken up again
    reads its answers in the order in which it asked.
    """

    def __init__(self, keys, counts: bytes, vocabulary: bytes, numbers: bytes, window: int):
        self.window, self.block = window, (window + 1) // 2
        self.keys = [k for k in keys]
        self.counts = _unpack(counts, "<u4").astype(np.int64)
        joined = _open(vocabulary)
        self.vocabulary = joined.split(b" ") if joined else []
        self.numbers = _unpack(numbers, "<u4")
        digests = [xxhash.xxh3_128_intdigest(w) for w in self.vocabulary]
        mask = (1 << 64) - 1
        self.low = np.array([d & mask for d in digests], np.uint64)
        self.high = np.array([d >> 64 for d in digests], np.uint64)
        self.doc = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        self.start = np.cumsum(self.counts) - self.counts
        self.ids = np.array([_LAST if k is None else k for k in self.keys], np.int64)

    def _starts(self, width: int) -> np.ndarray:
        """Positions at which ``width`` words of one document begin."""
        many = max(0, len(self.doc) - width + 1)
        return np.flatnonzero(self.doc[:many] == self.doc[width - 1 : width - 1 + many])

    def _rolled(self, digests: np.ndarray, starts: np.ndarray, width: int, times: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for j in range(width):
            out *= np.uint64(times)
            out += digests[self.numbers[starts + j]]
        return out

    def anchors(self, parts: int):
        """Distinct hashes in order, their part and flags; positions and their hash's place."""
        starts = self._starts(self.block)
        hashes = self._rolled(self.low, starts, self.block, _TIMES[0]) >> np.uint64(16)
        distinct, place = np.unique(hashes, return_inverse=True)
        del hashes
        doc = self.doc[starts]
        offered = (starts - self.start[doc]) % self.block == 0
        flags = np.zeros(len(distinct), np.uint8)
        flags[place[offered]] = 1
        # Of several documents, some differs from the one written last.
        last = np.empty(len(distinct), np.int32)
        last[place] = doc
        flags[place[last[place] != doc]] |= 2
        part = ((distinct >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(32)
        return distinct, part.astype(np.int64), flags, starts, place

    def windows(self, hits: np.ndarray, starts: np.ndarray, place: np.ndarray, parts: int):
        """Windows that hold a hit: their starts, distinct digests, places, smallest ids, parts."""
        inside = np.zeros(len(self.doc) + 1, np.int64)
        inside[starts + 1] = hits[place]
        inside = np.cumsum(inside)
        begin = self._starts(self.window)
        reach = self.window - self.block + 1
        begin = begin[inside[begin + reach] > inside[begin]]
        low = self._rolled(self.low, begin, self.window, _TIMES[0])
        high = (self._rolled(self.high, begin, self.window, _TIMES[1]) >> np.uint64(32)).astype("<u4")
        order = np.lexsort((high, low))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        low, high = low[order][new], high[order][new]
        least = np.full(len(low), _LAST)
        np.minimum.at(least, at, self.ids[self.doc[begin]])
        part = ((low >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        return begin, at, low, high, least, part.astype(np.int64)


def _chunks(table: pa.Table | pa.RecordBatch, window: int) -> Iterator[tuple[int, _Chunk]]:
    for i in range(table.num_rows):
        row = [table.column(c)[i].as_py() for c in range(5)]
        yield row[0], _Chunk(*row[1:], window)


def _ask(batches: Iterator[pa.RecordBatch], window: int, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, chunk in _chunks(batch, window):
            distinct, part, flags, _, _ = chunk.anchors(parts)
            for p, a, b in _edges(part):
                yield _sent(name, p, _pack(np.diff(distinct[a:b], prepend=np.uint64(0))), None, _press(flags[a:b].tobytes()))


def _sent(chunk, part, low, high, marks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()),
         *(pa.array([x], pa.binary()) for x in (low, high, marks))],
        ["chunk", "part", "low", "high", "marks"],
    )


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one part after the other, from batches sorted by part."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        for part, a, b in _edges(batch.column("part").to_numpy().astype(np.int64)):
            if waiting and waiting[-1].column("part")[0].as_py() != part:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _answers(table: pa.Table, stage: int, bits: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    cut = [_press(np.packbits(x).tobytes()) for x in np.split(bits, ends[:-1])]
    return pa.RecordBatch.from_arrays(
        [table["chunk"].combine_chunks(), table["part"].combine_chunks(),
         pa.array(np.full(table.num_rows, stage, np.int32)), pa.array(cut, pa.binary())],
        ["chunk", "part", "stage", "bits"],
    )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a hash is a block of some document and occurs in another one as well."""
    for table in _by_part(batches):
        hashes = [np.cumsum(_unpack(x, "<u8"), dtype=np.uint64) for x in table["low"].to_pylist()]
        flags = np.frombuffer(b"".join(map(_open, table["marks"].to_pylist())), np.uint8)
        ends = np.cumsum([len(x) for x in hashes])
        _, place, many = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        offered = np.zeros(len(many), bool)
        offered[place[flags & 1 > 0]] = True
        several = many > 1
        several[place[flags & 2 > 0]] = True
        yield _answers(table, 1, (offered & several)[place], ends)


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether an id smaller than the chunk's smallest has a window."""
    for table in _by_part(batches):
        low = [np.cumsum(_unpack(x, "<u8"), dtype=np.uint64) for x in table["low"].to_pylist()]
        ends = np.cumsum([len(x) for x in low])
        low = np.concatenate(low)
        high = np.concatenate([_unpack(x, "<u4") for x in table["high"].to_pylist()])
        ids = np.concatenate([_unpack(x, "<i8") for x in table["marks"].to_pylist()])
        order = np.lexsort((high, low))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        first = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        bits = np.empty(len(order), bool)
        bits[order] = first[np.cumsum(new) - 1] < ids[order]
        yield _answers(table, 2, bits, ends)


def _read(answers: pa.Table, stage: int, part: np.ndarray) -> np.ndarray:
    """The bits of a stage in the order of the chunk's sorted hashes."""
    got = {
        p: bits for p, s, bits in zip(*(answers[c].to_pylist() for c in ("part", "stage", "bits")))
        if s == stage
    }
    out = np.zeros(len(part), bool)
    for p, a, b in _edges(part):
        out[a:b] = np.unpackbits(np.frombuffer(_open(got[p]), np.uint8), count=b - a)
    return out


def _extend(texts: pa.Table, answers: pa.Table, window: int, parts: int) -> pa.Table:
    """The digests of a chunk's windows that hold a hit."""
    out = []
    for name, chunk in _chunks(texts, window):
        _, part, _, starts, place = chunk.anchors(parts)
        hits = _read(answers, 1, part)
        _, _, low, high, least, part = chunk.windows(hits, starts, place, parts)
        out += [
            _sent(name, p, _pack(np.diff(low[a:b], prepend=np.uint64(0))), _pack(high[a:b]), _pack(least[a:b]))
            for p, a, b in _edges(part)
        ]
    return pa.Table.from_batches(out or [_sent(0, 0, None, None, None).slice(0, 0)])


_FOUND = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("repeats", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.string()),
])


def _remove(texts: pa.Table, answers: pa.Table, window: int, parts: int) -> pa.Table:
    out = []
    for _, chunk in _chunks(texts, window):
        _, part, _, starts, place = chunk.anchors(parts)
        hits = _read(answers, 1, part)
        begin, at, _, _, least, part = chunk.windows(hits, starts, place, parts)
        del starts, place, hits
        repeated = _read(answers, 2, part)[at] | (least[at] < chunk.ids[chunk.doc[begin]])
        steps = np.zeros(len(chunk.doc) + 1, np.int64)
        begin = begin[repeated]
        steps[begin] += 1
        # No two windows begin at one word, so none end there either.
        steps[begin + window] -= 1
        gone = np.cumsum(steps[:-1]) > 0
        words = chunk.vocabulary
        for key, a, n in zip(chunk.keys, chunk.start.tolist(), chunk.counts.tolist()):
            mine = gone[a : a + n]
            turn = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            kept = chunk.numbers[a : a + n][~mine].tolist()
            out.append({
                "id": key, "n_words": n, "n_removed": n - len(kept),
                "repeats": [{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()],
                "kept": b" ".join([words[i] for i in kept]),
            })
    columns = [pa.array([r[f.name] for r in out], pa.binary() if f.name == "kept" else f.type) for f in _FOUND]
    columns[-1] = columns[-1].cast(pa.string())
    return pa.Table.from_arrays(columns, schema=_FOUND)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES, part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """``id_col, n_words, n_removed, repeats, kept`` of every row of ``docs``.

    Words are runs of other characters than ASCII white space, unchanged. A word goes if a
    window of ``window`` words that covers it also begins in a row of smaller id; windows are
    judged on the input. ``repeats`` are the maximal runs of such words, as word numbers
    [start, end); ``kept`` are the other words, joined by one space.

    Null ids count as the largest, rows of one id (or without id) do not repeat one another.
    Repeats within one document stay. A null or empty text has no words. Repeated rows give
    repeated results. Other columns are not read.
    """
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    chunks = materialise(rows.mapInArrow(lambda b: _split(b, chunk_bytes), _CHUNKS), "substring-chunks")
    words = chunks.agg(F.sum("words")).first()[0] or 0
    parts = max(shuffles, -(-words // part_windows))

    def dealt(sent: DataFrame, solve) -> DataFrame:
        return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(solve, _ANSWER)

    asked = chunks.mapInArrow(lambda b: _ask(b, window, parts), _SENT)
    hits = materialise(dealt(asked, _meet), "substring-hits")
    near = chunks.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(
        lambda t, a: _extend(t, a, window, parts), _SENT)
    smaller = dealt(near, _least)
    found = chunks.groupBy("chunk").cogroup(hits.unionByName(smaller).groupBy("chunk")).applyInArrow(
        lambda t, a: _remove(t, a, window, parts),
        "id long, n_words long, n_removed long, repeats array<struct<start:long,end:long>>, kept string",
    )
    return found.withColumnRenamed("id", id_col)
