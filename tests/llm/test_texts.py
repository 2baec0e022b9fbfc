"""BPE, licences, near-duplicates, pseudonyms, toxicity: literal cases and brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import bpe, components, license_scan, mixing, pii, simhash, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, score string, fp string, row string"
TEXTS = [
    "Hello, World's éü <|endoftext|> a1 ﬁ İ", "", None, "  \t\n ", "x" * 5000, "the " * 300,
    "é    wide\x1cgap", "'s 't'll can't", "<|startoftext|><|endoftext|>",
    "日本語 текст 🙂🙂", "Σίσυφος ΟΔΟΣ", "the " * 300,
]


def docs(rows, texts):
    return rows([(i, t, "en", "s", "a", "b", "c") for i, t in enumerate(texts)], SCHEMA)


def test_bpe_equals_the_library(spark, rows):
    frame = docs(rows, TEXTS).union(docs(rows, TEXTS[:1])).union(
        rows([(None, "a b", None, None, None, None, None)], SCHEMA))
    tokenizer = bpe.load_tokenizer(TOKENIZER)
    for packed in (False, True):
        got = bpe.decode(bpe.encode(frame, TOKENIZER, chunk_bytes=600, packed=packed), TOKENIZER).collect()
        assert len(got) == len(TEXTS) + 2
        for r in got:
            text = "a b" if r.doc_id is None else TEXTS[r.doc_id] or ""
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            found = np.frombuffer(r.ids, "<u4").tolist() if packed else r.ids
            assert (found, r.n_tokens) == (ids, len(ids))
            assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs(rows, []), TOKENIZER).count() == 0


def test_decode_passes_over_what_it_does_not_know(spark, rows):
    frame = rows([(1, [320, 10**6, None, 49407]), (2, None), (3, [])], "k long, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(frame, TOKENIZER).collect()}
    assert got == {1: "a</w> <|endoftext|>", 2: "", 3: ""}


def test_encode_refuses_other_tokenizers():
    with pytest.raises(ValueError):
        bpe._check(public_tokenizers.path("byte_bpe_50k.json"))


def test_license_of_texts_and_lines(spark, rows):
    mit = "The MIT Licence (MIT)\n\nCopyright (c) 2019-2021 Some One <a@b.c>\n\n" + (
        license_scan.MIT_BODY.upper().replace('"', "``"))
    frame = docs(rows, [mit, "Prose.\nReleased under the MIT license!", None, "", "MIT",
                        "Some prose. Released under the MIT License. More.",
                        "x\nLicensed under CC-BY-NC 4.0\nLicensed under the Apache Licence, version 2.0"])
    got = {r.doc_id: (r.license, r.notices) for r in license_scan.scan(frame).collect()}
    assert got == {0: ("MIT", []), 1: (None, ["MIT"]), 2: (None, []), 3: (None, []), 4: (None, []),
                   5: (None, []), 6: (None, ["Apache-2.0", "CC-BY-NC-4.0"])}
    assert license_scan.scan(docs(rows, [])).count() == 0
    plan = license_scan.scan(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_copyright_lines_and_runs(spark, rows):
    mit = license_scan.MIT_BODY
    flat = mit.replace("\n\n", "#").replace("\n", " ").replace("#", "\n\n")
    heads = ["Copyright (c) Microsoft Corporation.", "Copyright (c) The Foo Authors\nAll rights reserved.",
             "Copyright Jane Doe 2020", "Copyright (c) <year> <holder>", "(c) 2020 Jane", "© Jane 1999", "// © 2020",
             "Copyright © Jane.\nCOPYRIGHT 2001, 2002 Others"]
    texts = [f"{h}\n\n{mit}" for h in heads]
    texts += [f"def f():\n    pass\n\n{mit}", f"Before.\n{flat}\nAfter.", f"{mit}\n{mit}\nx",
              license_scan.BSD_CONDITIONS + license_scan.BSD_NAMES + license_scan.BSD_DISCLAIMER,
              "int x;\n" + license_scan.MPL_NOTICE.replace("\n", " "), "# spdx-license-identifier: lgpl-3.0-only",
              "a) first\nb) second\nc) third", mit.replace("sublicense", "sell"), "(c) You must keep " + mit]
    got = [(r.license, r.notices) for r in license_scan.scan(docs(rows, texts)).orderBy("doc_id").collect()]
    assert got[:8] == [("MIT", [])] * 8
    assert got[8:] == [(None, ["MIT"]), (None, ["MIT"]), (None, ["MIT"]), ("BSD-3-Clause", []),
                       (None, ["MPL-2.0"]), ("LGPL-3.0-only", ["LGPL-3.0-only"]), (None, []), (None, []), (None, [])]


def brute_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(count, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(count // 10):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        for _ in range(10):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


def brute_groups(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("limit", [20_000, 3])
def test_near_duplicates_equal_brute_force(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(simhash, "KEY_LIMIT", limit)
    monkeypatch.setattr(simhash.links, "__defaults__", (limit,))
    texts = near_copies(300, 4) + ["", None, " \n", "One Two", "one two", "one two three four"]
    frame = docs(rows, texts)
    prints = [brute_fingerprint(t) for t in texts]
    groups = brute_groups(prints)
    got = {r.doc_id: r for r in simhash.near_duplicates(frame).collect()}
    for i in range(len(texts)):
        assert got[i].fingerprint == f"{prints[i]:016x}"
        assert got[i].component_id == groups[i]
    kept = simhash.deduplicate(frame.union(frame.limit(20)))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups))


def test_deduplicate_ties_nulls_and_nothing(spark, rows):
    frame = rows([(5, "a b c d e"), (5, "q r s t u v"), (None, "a b c d e"), (5, "a b c d e")],
                 "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.deduplicate(frame).collect()) == [
        (5, "a b c d e"), (5, "q r s t u v")]
    assert simhash.deduplicate(docs(rows, [])).count() == 0
    assert simhash.near_duplicates(docs(rows, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.randoms())
def test_every_link_has_a_chain(bases, rng):
    """The ring's chain condition holds for every pair within the limit, at some start."""
    for a in bases:
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        pair = np.array([a], np.uint64), np.array([b], np.uint64)
        assert any(simhash._chained(*pair, start)[0] for start in range(5))


def test_components_of_a_path_and_a_star(spark, rows):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)] + [(300, 300), (7, 6)]
    got = components.components(rows(path + star, "a long, b long")).collect()
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark, rows):
    texts = [
        "card 4111 1111 1111 1111, again 4111111111111111; not 4111111111111112.",
        "mail Jane.Doe7@mail.example.com or jane.doe7@mail.example.com, ip 10.0.255.1.",
        "call +1 (743) 555-3824 or +1 743.555.3824; born 1984-02-29, 29.02.1984, 31.02.1984",
        "ssn 123-45-6789 not 000-45-6789", None, "", "nothing here 12345",
        "4111111111111111", "4785380592391139 4111111111111111",
    ]
    frame = docs(rows, texts)
    out = pii.pseudonymise(frame, "k1")
    assert "Python" not in out._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].n_pii for i in range(7)] == [2, 3, 4, 1, 0, 0, 0]
    assert got[4].text is None and got[5].text == "" and got[6].text == texts[6]
    first = got[0].text
    spaced, plain = first[5:24], first[32:48]
    assert spaced.replace(" ", "") == plain == got[7].text and luhn(plain)
    assert plain != "4111111111111111" and "4111111111111112" in first
    assert got[8].text.endswith(" " + plain)
    assert len(got[1].text.split()[1]) == len("Jane.Doe7@mail.example.com")
    one, two = got[1].text.split()[1], got[1].text.split()[3].rstrip(",")
    assert one.lower() == two and one[0].isupper() and two.endswith("@mail.example.com")
    call = got[2].text
    assert call.split("+1 (")[1][:3] == call.split("+1 ")[2][:3]
    iso, german = call.split("born ")[1].split(", ")[:2]
    assert iso.split("-") == german.split(".")[::-1] and iso != "1984-02-29" and "31.02.1984" in call
    assert "000-45-6789" in got[3].text and "123-45-6789" not in got[3].text
    other = {r.doc_id: r.text for r in pii.pseudonymise(frame, "k2").collect()}
    assert other[7] != got[7].text
    assert pii.pseudonymise(docs(rows, []), "k").count() == 0


def test_pseudonyms_are_permutations(spark, rows):
    from pyspark.sql import functions as F

    three = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, F.lit("0")).alias("d"))
    got = [r[0] for r in three.select(pii.permute_digits("k", "t", F.col("d"))).collect()]
    assert sorted(got) == [f"{i:03d}" for i in range(1000)]
    days = spark.range(365 * 201).select(
        F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")),
                      "yyyy-MM-dd").alias("d"))
    shown = days.select(pii.pseudonym("k", F.col("d")).alias("p"))
    assert shown.distinct().count() == 365 * 201 and shown.where("p is null").isEmpty()


def test_raking_meets_the_targets(spark, rows):
    rng = random.Random(2)
    table = [(i, rng.choice("abc"), rng.choice(["en", "de", None]), rng.choice("xy"), rng.randint(1, 50))
             for i in range(600)] + [(600, "d", "en", "x", 0)]
    frame = rows(table, "doc_id long, source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": 0.5, "topic": {"x": 0.4, "y": 0.6}}
    raked = mixing.rake(mixing.cells_of(frame), targets)
    for name, wanted in (("source", targets["source"]), ("topic", targets["topic"])):
        sums = {r[0][1:]: r[1] for r in raked.groupBy(name).agg({"weight": "sum"}).collect()}
        assert sums == pytest.approx(wanted, abs=1e-5)
    # The same by hand.
    cells = {}
    for _, s, l, t, n in table[:600]:
        cells[s, l, t] = cells.get((s, l, t), 0) + n
    total = sum(cells.values())
    w = {c: n / total for c, n in cells.items()}
    natural = {}
    for (s, l, t), n in cells.items():
        natural[l] = natural.get(l, 0) + n
    share = {l: n**0.5 for l, n in natural.items()}
    wants = [targets["source"], {l: v / sum(share.values()) for l, v in share.items()}, targets["topic"]]
    for _ in range(60):
        for d in range(3):
            had = {}
            for c, v in w.items():
                had[c[d]] = had.get(c[d], 0) + v
            w = {c: v * wants[d][c[d]] / had[c[d]] for c, v in w.items()}
    key = lambda v: "" if v is None else "=" + v
    got = {(r.source, r.lang, r.topic): r.weight for r in raked.collect()}
    assert got == pytest.approx({tuple(map(key, c)): v for c, v in w.items()}, abs=1e-5)
    rated = mixing.calibrate(raked, 0.4)
    kept = rated.selectExpr("sum(tokens * probability) / sum(tokens)").first()[0]
    assert kept == pytest.approx(0.4, abs=2e-3) and rated.where("probability > 1").isEmpty()
    mixed = mixing.mix(frame, rated)
    assert mixed.count() == 601 and not mixed.where("doc_id = 600").first().selected
    share = mixed.where("selected").selectExpr("sum(tokens)").first()[0] / total
    assert abs(share - 0.4) < 0.08
    empty = frame.limit(0)
    assert mixing.mix(empty, mixing.weights(empty)).count() == 0


def toxic_corpus(count):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    out, labels = [], []
    for i in range(count):
        text = [rng.choice(words) for _ in range(rng.randint(3, 60))]
        labels.append(int(rng.random() < 0.3))
        if labels[-1]:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["Idiot", "scum!", "vequaux", "vequi"]))
        out.append(" ".join(text))
    return out, labels


def test_toxicity_learns_and_points(spark, rows):
    texts, marks = toxic_corpus(500)
    frame = docs(rows, texts + [None, "", "idiot", "İİ Vequaux İ"])
    labels = rows([(i, y) for i, y in enumerate(marks) if i % 5] + [(3, None), (None, 1), (9999, 1)],
                  "doc_id long, toxic int")
    model = toxicity.train(frame, labels)
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    right = sum(got[i].predicted == marks[i] for i in range(0, 500, 5))
    assert right >= 97 and all(0 <= r.score <= 1 for r in got.values())
    assert got[500].predicted == got[501].predicted == 0 and got[500].score == got[501].score
    assert [(s.start, s.end) for s in got[502].spans] == [(0, 5)]
    assert [(s.start, s.end) for s in got[503].spans] == [(3, 10)]
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_toxicity_without_labels(spark, rows):
    frame = docs(rows, ["a b", None])
    none = rows([], "doc_id long, toxic int")
    scored = toxicity.score(frame, toxicity.train(frame, none)).collect()
    assert [r.predicted for r in scored] == [0, 0]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(size=5), rng.normal(size=(2, 2))
    weight = {}
    for path in np.ndindex(*[2] * 5):
        s = sum(scores[t] * y for t, y in enumerate(path))
        weight[path] = np.exp(s + sum(trans[a, b] for a, b in zip(path, path[1:])))
    want = [sum(v for p, v in weight.items() if p[t]) / sum(weight.values()) for t in range(5)]
    grid = np.column_stack([scores, np.append(scores[:2], [0, 0, 0])])
    got = toxicity.marginals(grid, np.array([5, 2]), trans)
    assert got[:, 0] == pytest.approx(want, abs=1e-5)


def test_digest_of_ids_is_little_endian(spark, rows):
    from pyspark.sql import functions as F

    frame = bpe.encode(docs(rows, ["a"]), TOKENIZER, packed=True)
    assert frame.select(F.sha2("ids", 256)).first()[0] == hashlib.sha256(
        np.array([320], "<u4").tobytes()).hexdigest()
