"""Stages of the pipeline hold bounded bytes of text in a batch, whatever the texts' length."""

import pyarrow as pa
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

ARROW, READER = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


@pytest.fixture
def settings(spark):
    old = {k: spark.conf.get(k) for k in (ARROW, READER)}
    for key in old:
        spark.conf.unset(key)
    yield spark.conf
    for key, value in old.items():
        spark.conf.set(key, value)


def staged(spark, rows):
    frame = rows([(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.drop_near_duplicates(spark, frame, "").count() == 1


def test_texts_reach_workers_in_small_batches(spark, rows, settings):
    staged(spark, rows)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id as string), 1500) as text")
    found = texts.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["bytes"] for r in found) < 2 << 20
    assert int(settings.get(READER)) <= 512


def test_a_session_keeps_sizes_of_its_own(spark, rows, settings):
    settings.set(ARROW, "2m")
    settings.set(READER, "100")
    staged(spark, rows)
    assert (settings.get(ARROW), settings.get(READER)) == ("2m", "100")
