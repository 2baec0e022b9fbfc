"""BPE encoding and decoding over a distinct-word table.

A text is split into words at ASCII white space. Each distinct word is encoded
once, and its ids return to every position it came from:

1. *Split.* Each task reads its documents into chunks of about ``chunk_bytes``
   of text. A chunk keeps its distinct words (numbered by frequency) and,
   for every document, the numbers of its words in order. Both are written, so
   the numbering is fixed whatever is recomputed later.
2. *Encode.* The distinct words of all chunks are dealt by hash of the word, so
   a word meets the tokenizer in one task only, which answers every chunk.
3. *Join by position.* The ids of a chunk's words meet the chunk's word numbers.

Splitting at ASCII white space is exact for tokenizers that drop white space
between words: neither the normaliser nor the merges reach across it, and a
special token holds none. ``encode`` refuses tokenizers it would be wrong for.

Memory: one chunk (its largest document, if that is longer) and at most
``CACHED_WORDS`` encoded words per task. No row holds all uses of a word, so a
word that every document repeats costs one entry per chunk.

Decoding is a join of ids with the id-to-piece table. That table has one row per
vocabulary entry, a size fixed by the tokenizer file, so it is broadcast and the
join takes place where the ids are.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.memory import give_back, returning_memory
from tillwise.llm.tables import bucketed

CHUNK_BYTES = 16 << 20
CACHED_WORDS = 100_000
MAX_PARTS = 4096
_SLICE = 1 << 20
_DECODED_ROWS = 256

# What the chunks write and shuffle is mostly word numbers; they are worth the time to press.
_LEVEL = 9

_CHUNKS = "chunk string, part int, keys array<bigint>, meta binary, body binary"


def _pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=_LEVEL).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")


def _chunk_rows(keys, numbers, counts, known, parts) -> pa.RecordBatch:
    chunk = uuid.uuid4().hex
    # Numbered by falling frequency, most numbers are small.
    flat = np.concatenate(numbers) if numbers else np.empty(0, np.uint32)
    often = np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")
    number = np.empty(len(known), np.uint32)
    number[often] = np.arange(len(known), dtype=np.uint32)
    first = list(known)
    words = [first[i] for i in often]
    del first, often
    known.clear()
    part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    press = zstandard.ZstdCompressor(level=_LEVEL)
    columns = [[chunk], [-1], [keys], [_pack(np.array(counts))], [_pack(number[flat])]]
    del flat
    for p in range(parts):
        at = order[ends[p] : ends[p + 1]]
        if len(at):
            for column, value in zip(columns, (
                chunk, p, None, _pack(np.diff(at, prepend=0)),
                press.compress(b" ".join([words[i] for i in at])),
            )):
                column.append(value)
    types = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        ["chunk", "part", "keys", "meta", "body"],
    )


@returning_memory
def _split(batches: Iterator[pa.RecordBatch], parts: int, limit: int) -> Iterator[pa.RecordBatch]:
    def fresh():
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        return [], [], [], known, 0

    keys, numbers, counts, known, size = fresh()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or b""
            if keys and size + len(text) > limit:
                yield _chunk_rows(keys, numbers, counts, known, parts)
                keys, numbers, counts, known, size = fresh()
            words = text.split()
            keys.append(key)
            counts.append(len(words))
            numbers.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
            size += len(text)
    if keys:
        yield _chunk_rows(keys, numbers, counts, known, parts)


def load_tokenizer(path: str):
    """The tokenizer without its truncation and padding; one thread, as Spark runs the tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _check(path: str) -> None:
    """Raise unless words between white space can be encoded one by one."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = [
        s for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]
    ]
    spaces = [t["content"] for t in spec["added_tokens"]
              if t["lstrip"] or t["rstrip"] or t["single_word"] or not t["content"].strip()]
    if not split or spaces:
        raise ValueError(f"{path} does not drop white space between words")


@returning_memory
def _encode_words(batches, path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = load_tokenizer(path)
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    known: dict[bytes, bytes] = {}
    part = None
    for batch in batches:
        for i in range(batch.num_rows):
            if part != batch.column(1)[i].as_py():
                # No word is in two parts.
                part = batch.column(1)[i].as_py()
                known.clear()
            words = zstandard.ZstdDecompressor().decompress(batch.column(4)[i].as_py()).split(b" ")
            new = [w for w in words if w not in known]
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
                new = words
            for start in range(0, len(new), 5000):
                some = new[start : start + 5000]
                found = encode([w.decode("utf-8") for w in some], add_special_tokens=False)
                for word, encoding in zip(some, found):
                    known[word] = np.array(encoding.ids, "<u4").tobytes()
            ids = [known[w] for w in words]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            at = np.cumsum(_unpack(batch.column(3)[i].as_py()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column(0)[i].as_py()], pa.string()),
                    pa.array([batch.column(1)[i].as_py()], pa.int32()),
                    pa.array([None], pa.list_(pa.int64())),
                    pa.array([_pack(np.stack([at, lengths]).reshape(-1))], pa.binary()),
                    pa.array([_pack(np.frombuffer(b"".join(ids), "<u4"))], pa.binary()),
                ],
                ["chunk", "part", "keys", "meta", "body"],
            )


def _assemble(texts: pa.Table, words: pa.Table, packed: bool) -> pa.Table:
    """The ids of a chunk's documents from word numbers and the words' ids."""
    keys = texts["keys"][0].as_py()
    counts = _unpack(texts["meta"][0].as_py()).astype(np.int64)
    numbers = _unpack(texts["body"][0].as_py())
    at, lengths, ids = [], [], []
    for i in range(words.num_rows):
        both = _unpack(words["meta"][i].as_py()).astype(np.int64).reshape(2, -1)
        at.append(both[0])
        lengths.append(both[1])
        ids.append(_unpack(words["body"][i].as_py()))
    if at:
        order, many, flat = map(np.concatenate, (at, lengths, ids))
        starts = np.empty(len(order), np.int64)
        width = np.empty(len(order), np.int64)
        starts[order] = np.cumsum(many) - many
        width[order] = many
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(width[numbers])])
        edges = ends[bounds]
        values = np.empty(edges[-1], np.int32)
        for a in range(0, len(numbers), _SLICE):
            some = numbers[a : a + _SLICE]
            each, low, high = width[some], ends[a], ends[a + len(some)]
            # Position k lies in some word; walk on from that word's first id.
            take = np.arange(low, high) + np.repeat(starts[some] - ends[a : a + len(some)], each)
            values[low:high] = flat[take]
    else:
        values, edges = np.empty(0, np.int32), np.zeros(len(counts) + 1, np.int64)
    counted = {"key": pa.array(keys, pa.int64()), "n_tokens": pa.array(np.diff(edges))}
    if packed:
        at, data = pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(values)
        ids = pa.Array.from_buffers(pa.binary(), len(keys), [None, at, data])
    else:
        ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values))
    return pa.table({**counted, "ids": ids})


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    packed: bool = False,
) -> DataFrame:
    """``id_col, n_tokens, ids`` of every row, as the tokenizer encodes the whole text.

    ``ids`` is an array, or with ``packed`` binary: little-endian 32-bit integers.

    One row out for each row in: repeated rows are repeated, null ids stay null, a
    null or empty text has no ids. Other columns of ``docs`` are not read.
    """
    _check(tokenizer)

    def assembled(texts: pa.Table, words: pa.Table) -> pa.Table:
        try:
            return _assemble(texts, words, packed)
        finally:
            give_back()

    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MAX_PARTS, max(16, 2 * shuffles))
    # In buckets, so that the word numbers are not moved again to meet the ids.
    chunks = bucketed(
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(
            lambda batches: _split(batches, parts, chunk_bytes), _CHUNKS
        ),
        "chunk",
        "bpe-chunks",
    )
    words = (
        chunks.where("part >= 0")
        .repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(lambda batches: _encode_words(batches, tokenizer), _CHUNKS)
    )
    return (
        chunks.where("part = -1")
        .groupBy("chunk")
        .cogroup(words.groupBy("chunk"))
        .applyInArrow(
            assembled,
            f"key long, n_tokens long, ids {'binary' if packed else 'array<int>'}",
        )
        .withColumnRenamed("key", id_col)
    )


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the pieces of ``ids_col`` (array or packed) in order.

    Equal to the tokenizer's decode with special tokens kept, for tokenizers without
    a decoder of their own (pieces are joined by a space). Null ids decode to the
    empty string; ids outside the vocabulary are passed over, as there.
    """
    loaded = load_tokenizer(tokenizer)
    if loaded.decoder is not None:
        raise ValueError(f"{tokenizer} has a decoder; pieces joined by spaces would be wrong")
    size = max(loaded.get_vocab(with_added_tokens=True).values()) + 1
    pieces = encoded.sparkSession.sparkContext.broadcast(
        [loaded.id_to_token(i) for i in range(size)]
    )

    at = encoded.columns.index(ids_col)
    types = [f.dataType.simpleString() for f in encoded.schema]
    names = [*encoded.columns, "decoded"]
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, [*types, "string"]))

    def numbers(ids: pa.Scalar) -> list:
        if not ids.is_valid:
            return []
        if isinstance(ids, pa.BinaryScalar):
            return np.frombuffer(ids.as_py(), "<u4").tolist()
        return ids.values.to_pylist()

    @returning_memory
    def join(batches):
        table = pieces.value
        for batch in batches:
            for start in range(0, batch.num_rows, _DECODED_ROWS):
                some = batch.slice(start, _DECODED_ROWS)
                texts = [
                    " ".join([
                        table[i] for i in numbers(ids)
                        if i is not None and 0 <= i < size and table[i] is not None
                    ])
                    for ids in some.column(at)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(texts, pa.string())], names
                )

    return encoded.mapInArrow(join, schema)
