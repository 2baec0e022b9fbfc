"""Training on whole texts: passages beyond a text's beginning count."""

import random

from pyspark.sql import Row

from tillwise.llm import toxicity


def test_toxicity_reads_whole_training_texts(spark, rows):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    texts, marks = [], [i % 3 == 0 for i in range(120)]
    for toxic in marks:
        text = [rng.choice(words) for _ in range(rng.randint(900, 1300))]
        if toxic:
            # Far from the start, across the end of a window.
            text[799:802] = ["vequaux", "scum", "vequi"]
        texts.append(" ".join(text))
    frame = rows(list(enumerate(texts)), "doc_id long, text string")
    labels = rows([(i, int(y)) for i, y in enumerate(marks) if i % 5], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, toxicity.train(frame, labels)).collect()}
    assert [got[i].predicted for i in range(0, 120, 5)] == [int(marks[i]) for i in range(0, 120, 5)]
    assert all(len(got[i].spans) == 3 * marks[i] for i in range(0, 120, 5))


def test_toxicity_sample_leaves_out_whole_texts_only():
    costs = [("a", 1, 6), ("b", 0, 9), ("c", 1, 5), ("d", 1, 4), ("e", 0, 2)]
    found = [Row(_id=i, y=y, cost=c) for i, y, c in costs]
    assert toxicity._affordable(found, 10) == ["a", "b", "d"]
