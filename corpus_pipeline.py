"""The corpus pipeline: documents through five stages, each written and read by the next.

    run(spark, "/data/sf")

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``.
Extra columns are carried along, whatever they are called. Every stage asks the session
for small batches first, as its rows hold whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import bpe, mixing, near_texts, pii, toxicity
from tillwise.llm.memory import small_batches
from tillwise.llm.queries import PII_KEY, TOKENIZER, table, toxicity_model
from tillwise.workspace import materialise

# Text held at a time by a task of the BPE stage, which shares its executors with the heap
# that the stages before it have grown.
CHUNK_BYTES = 8 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not reject. Empty ones are scored like others."""
    small_batches(spark)
    model = toxicity_model(spark, docs, sf_dir)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    scored = toxicity.score(packed, model, keep=["row"])
    return scored.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Near copies have a Jaccard similarity of 0.8 or more in shingles of five words. SimHash
    links propose them, MinHash bands propose those too many bits apart, and the shingles
    decide. The contract of op4_simhash (four words, four bits) binds that query only.
    """
    small_batches(spark)
    return near_texts.deduplicate(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows where there is such a column."""
    small_batches(spark)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    out = pii.pseudonymise(packed, PII_KEY, count_col="n_pii")
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        made["n_chars"] = F.when(F.col("n_pii") > 0, length).otherwise(F.col("row.n_chars"))
    return out.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the probabilities that meet the target marginals."""
    small_batches(spark)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id", "source", "lang", "text",
    )
    cells = mixing.weights(mixing.features(docs))
    drawn = mixing.mix(mixing.features(packed, "row", "doc_id"), cells)
    return drawn.where("selected").select("row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of the text they decode to."""
    small_batches(spark)
    # Written first, so that a task runs either the encoder or the decoder.
    encoded = bpe.encode(docs, TOKENIZER, chunk_bytes=CHUNK_BYTES)
    encoded = materialise(encoded, "pipeline-ids")
    decoded = bpe.decode(encoded, TOKENIZER)
    return decoded.select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Scores, fingerprints and pseudonyms have no counterpart in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
