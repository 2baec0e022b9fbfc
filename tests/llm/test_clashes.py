"""Columns called like those the operators use on the way pass untouched."""

import pytest

from tillwise.llm import mixing, pii

corpus_pipeline = pytest.importorskip("corpus_pipeline")

NAMES = ["_pii", "_n_pii", "pii", "n_pii", "row", "_ratio", "_probability", "_cell_source", "_at_source", "number"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
TEXTS = ["call me, 123-45-6789", "nothing", None, "", "born 2001-02-03, card 4111111111111111"]


def table(rows):
    extra = [f"kept {n}" for n in NAMES]
    return rows([(i, t, "en", "web", len(t or ""), *extra) for i, t in enumerate(TEXTS)], SCHEMA)


def kept(frame):
    return all(r[n] == f"kept {n}" for r in frame.collect() for n in NAMES)


def test_pseudonyms_keep_other_columns(spark, rows):
    got = pii.pseudonymise(table(rows), "key", count_col="found")
    assert got.columns == [*table(rows).columns, "found"] and kept(got)
    assert {r.doc_id: r.found for r in got.collect()} == {0: 1, 1: 0, 2: 0, 3: 0, 4: 2}


def test_personal_data_stage_keeps_other_columns(spark, rows):
    docs = table(rows)
    got = corpus_pipeline.hide_personal_data(spark, docs, "")
    assert got.schema == docs.schema or got.columns == docs.columns
    assert kept(got)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].text != TEXTS[0] and by_id[0].n_chars == len(by_id[0].text)
    assert [by_id[i].text for i in (1, 2, 3)] == TEXTS[1:4]


def test_mixing_keeps_other_columns(spark, rows):
    docs = table(rows)
    cells = mixing.weights(mixing.features(docs))
    counted = mixing.features(docs, "doc_id", *NAMES)
    got = mixing.mix(counted, cells)
    assert got.count() == len(TEXTS) and kept(got)
    stage = corpus_pipeline.mix_sources(spark, docs, "")
    assert stage.columns == docs.columns and kept(stage)
