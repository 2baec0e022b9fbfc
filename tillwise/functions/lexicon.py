"""Polarity from a lexicon table with phrases, negations and intensifiers.

A lexicon is a table (``LEXICON``): a phrase of one or more words; its role; a value, which
is the score of a ``score`` phrase and the factor of the others; the scope of a negation or
intensifier, in words after it; and where the entry comes from and under which licence.

Texts are cut into runs of letters of any script. From left to right the longest phrase of
the lexicon is taken, found by a trie that each task builds once. A score phrase is scaled
by the last intensifier and the last negation before it, back to the score phrase before,
whose scopes reach it. A text's polarity is the mean of its phrases' scaled scores, each
kept within [-1, 1]; 0 without any.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.text import INTENSIFIERS, NEGATION_FACTOR, NEGATIONS, POLARITY

LEXICON = T.StructType([
    T.StructField("phrase", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("scope", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("licence", T.StringType()),
])
SCORE, NEGATION, INTENSIFIER = "score", "negation", "intensifier"
WORD = r"\p{L}[\p{L}\p{M}'’]*"
#: A lexicon is sent to every task; larger tables are refused.
MAX_PHRASES = 200_000
NEGATION_SCOPE, INTENSIFIER_SCOPE = 3, 1

# Phrases of the default lexicon beside the single words.
PHRASES = {
    "always excellent": 1.0,
    "great quality": 0.9,
    "is okay": 0.05,
    "not bad": 0.3,
    "waste of money": -0.9,
}
_OWN = ("written for this package", "the package's own")


def default_entries() -> list[tuple]:
    """The default lexicon as rows of ``LEXICON``."""
    scored = [(p, SCORE, v, 0, *_OWN) for p, v in {**POLARITY, **PHRASES}.items()]
    turned = [(p, NEGATION, NEGATION_FACTOR, NEGATION_SCOPE, *_OWN) for p in NEGATIONS]
    scaled = [(p, INTENSIFIER, v, INTENSIFIER_SCOPE, *_OWN) for p, v in INTENSIFIERS.items()]
    return scored + turned + scaled


def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(default_entries(), LEXICON)


def build_trie(entries: list[tuple]) -> dict:
    """Nested maps from word to the rest; the key None holds (words, role, value, scope).

    Of entries with one phrase the last one counts.
    """
    root: dict = {}
    for phrase, role, value, scope in entries:
        words = phrase.lower().split()
        node = root
        for word in words:
            node = node.setdefault(word, {})
        if words:
            node[None] = (len(words), role, value, scope or 0)
    return root


def polarity_of(words: list[str], trie: dict) -> tuple[float, int]:
    """Mean scaled score of the phrases in ``words``, and their number."""
    total, hits, at = 0.0, 0, 0
    factor = {NEGATION: (1.0, -1), INTENSIFIER: (1.0, -1)}  # and the last place it reaches
    while at < len(words):
        node, found = trie.get(words[at]), None
        ahead = at
        while node is not None:
            found = node.get(None, found)
            ahead += 1
            node = node.get(words[ahead]) if ahead < len(words) else None
        if found is None:
            at += 1
            continue
        length, role, value, scope = found
        if role == SCORE:
            for scale, last in factor.values():
                value *= scale if at <= last else 1.0
            total += max(-1.0, min(1.0, value))
            hits += 1
            factor = {NEGATION: (1.0, -1), INTENSIFIER: (1.0, -1)}
        else:
            factor[role] = (value, at + length - 1 + scope)
        at += length
    return (total / hits if hits else 0.0), hits


def with_polarity(
    texts: DataFrame, lexicon: DataFrame, text_col: str = "text", out: str = "polarity"
) -> DataFrame:
    """``texts`` plus ``out`` and ``<out>_phrases``, the number of score phrases found.

    Null and empty texts have polarity 0. Entries with a null phrase, role or value, or of
    an unknown role, are passed over. Other columns pass as they are.
    """
    entries = lexicon.where(
        F.col("phrase").isNotNull() & F.col("value").isNotNull()
        & F.col("role").isin(SCORE, NEGATION, INTENSIFIER)
    ).select("phrase", "role", F.col("value").cast("double"), "scope")
    rows = entries.orderBy("phrase", "role", "value").limit(MAX_PHRASES + 1).collect()
    if len(rows) > MAX_PHRASES:
        raise ValueError(f"a lexicon has at most {MAX_PHRASES} phrases")
    shared = texts.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    names = [c for c in texts.columns if c not in (out, f"{out}_phrases")]
    types = {f.name: f.dataType.simpleString() for f in texts.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = build_trie(shared.value)
        for batch in batches:
            found = [polarity_of(w.as_py(), trie) for w in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array([f[0] for f in found], pa.float64()),
                    pa.array([f[1] for f in found], pa.int32()),
                ],
                [*names, out, f"{out}_phrases"],
            )

    return texts.select(*[F.col(f"`{c}`") for c in names], words.alias("lexicon_words")).mapInArrow(
        run, f"{schema}, `{out}` double, `{out}_phrases` int"
    )
