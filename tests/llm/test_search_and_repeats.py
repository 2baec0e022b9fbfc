"""Lexical search, substring deduplication and token alignment against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillwise.llm import alignment, lexical, substring
from tillwise.llm.queries import BYTE_LEVEL, PIECES

ODD = [None, "", " \t\n", "...", "İ é 你好 ß", "a", "x" * 70_000, "Ab aB AB-ab_ab"]


def corpus(rng, many, words=60):
    known = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 3))) for _ in range(words)]
    return [" ".join(rng.choices(known, k=int(rng.paretovariate(0.7)) + 1)[:900]) for _ in range(many)]


# Lexical search


def brute_search(docs, items, k):
    terms = lambda t: [
        "".join(c.lower() if "A" <= c <= "Z" else c for c in m) for m in re.findall(lexical.TERM, t or "")]
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, tokens = len(held), sum(n for _, _, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * total) // tokens
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1)))
                * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w in terms(text) if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_bytes,per_block", [(1 << 24, 200_000), (2000, 200_000), (2000, 15)])
def test_search_equals_brute_force(spark, rows, monkeypatch, shard_bytes, per_block):
    rng = random.Random(shard_bytes + per_block)
    monkeypatch.setattr(lexical, "ITEM_TERMS", per_block)
    texts = corpus(rng, 500)
    texts += texts[:40] + ODD + ["common " * 400, "common"]
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (None, texts[4])]
    items = [(i, " ".join(rng.choices(texts[i].split(), k=6))) for i in range(12)]
    items += [(1, items[1][1]), (2, "common " + texts[0][:40]), (50, None), (51, ""), (52, "zzz-unknown"),
              (53, "COMMON common"), (None, texts[7][:50])]
    frame = rows([(*d, 1, "x") for d in docs], "doc_id long, text string, term int, shard string")
    index = lexical.build(frame.repartition(3), shard_bytes=shard_bytes)
    asked = rows([(*i, 0) for i in items], "item_id long, text string, blk int")
    got = sorted(map(tuple, lexical.search(index, asked, k=7).collect()), key=repr)
    assert got == brute_search(docs, items, 7)


def test_search_of_nothing(spark, rows):
    empty = rows([], "doc_id long, text string")
    items = rows([(1, "a b")], "item_id long, text string")
    assert lexical.search(lexical.build(empty), items).count() == 0
    blank = rows([(1, None), (2, "--")], "doc_id long, text string")
    assert lexical.search(lexical.build(blank), items).count() == 0
    assert lexical.search(lexical.build(rows([(1, "a")], "doc_id long, text string")), items.limit(0)).count() == 0


def test_blocks_below_the_kth_score_stay_compressed(monkeypatch):
    """A list that cannot matter is opened only where a candidate needs it."""
    import pyarrow as pa

    many = 4000
    texts = [b"common filler"] * many
    for i in range(0, 40):
        texts[i] = b"common rare rare rare"
    keys, numbers, known = [], [], {}
    for i, t in enumerate(texts):
        words = lexical.terms_of(t)
        keys.append(i)
        numbers.append(np.array([known.setdefault(w, len(known)) for w in words], np.int32))
    made = pa.Table.from_batches(list(lexical._shard_rows(0, keys, numbers, list(known))))
    shard = lexical._Shard(made, many, sum(map(len, numbers)))
    heap = shard.rank(["common", "rare"], [10, 8000], [(-10**9, False, 9)] * 5, 5)
    assert all(h[0] < -(10**9) for h in heap)
    a, b, _ = shard.lists["common"]
    opened = [x for x in shard._blocks if a <= x < b]
    assert b - a > 20 and len(opened) == 1


# Substring deduplication


def brute_repeats(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    ids = [math.inf if i is None else i for i, _ in docs]
    first = defaultdict(lambda: math.inf)
    for i, ws in zip(ids, words):
        for k in range(len(ws) - window + 1):
            g = tuple(ws[k : k + window])
            first[g] = min(first[g], i)
    out = []
    for (key, _), i, ws in zip(docs, ids, words):
        gone = set()
        for k in range(len(ws) - window + 1):
            if first[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        spans, kept = [], [w for k, w in enumerate(ws) if k not in gone]
        for k in sorted(gone):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((key, len(ws), len(gone), tuple(map(tuple, spans)), " ".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,chunk,part", [(13, 1 << 23, 2_000_000), (13, 3000, 500), (4, 900, 64)])
def test_repeats_equal_brute_force(spark, rows, window, chunk, part):
    rng = random.Random(window + chunk)
    passages = [" ".join(rng.choices("abcdefgh", k=rng.randint(5, 40))) for _ in range(12)]
    docs = []
    for i in range(250):
        filler = [" ".join(rng.choices("ijklmnopqrstuvw", k=rng.randint(0, 30))) for _ in range(3)]
        docs.append((i * 7 % 251, "\n".join(filler[:1] + rng.choices(passages, k=rng.randint(0, 2)) + filler[1:])))
    docs += [(1000 + i, docs[5][1]) for i in range(60)]
    docs += [(None, docs[6][1]), (None, docs[6][1]), (None, "only here " * 20), (docs[7][0], docs[7][1])]
    docs += [(2000 + i, t) for i, t in enumerate(ODD)] + [(-5, " ".join("abcd" * 400)), (3000, " ".join("abcd" * 9))]
    frame = rows([(*d, 1, 2) for d in docs], "doc_id long, text string, chunk int, part int").repartition(5)
    found = substring.remove_repeats(frame, window, chunk_bytes=chunk, part_windows=part).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, tuple((s.start, s.end) for s in r.repeats), r.kept) for r in found]
    assert sorted(got, key=repr) == brute_repeats(docs, window)


def test_repeats_of_nothing(spark, rows):
    assert substring.remove_repeats(rows([], "doc_id long, text string")).count() == 0
    one = substring.remove_repeats(rows([(None, None)], "doc_id long, text string")).first()
    assert tuple(one) == (None, 0, 0, [], "")


# Alignment


def brute_align(docs):
    sides = alignment.Sides(BYTE_LEVEL, PIECES)
    per, held = [], Counter()
    for key, text in docs:
        a, b = sides.encode([text or ""])[0]
        ends_a = np.cumsum([len(sides.a_bytes[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(sides.b_bytes[i]) for i in b]).tolist()
        common, groups = set(ends_a) & set(ends_b), []
        mine, at = [], 0
        for i, e in zip(a, ends_a):
            mine.append(i)
            if e in common:
                theirs = []
                while True:
                    theirs.append(b[at])
                    at += 1
                    if ends_b[at - 1] == e:
                        break
                groups.append((mine, theirs))
                mine = []
        links = Counter((x, y) for m, t in groups for x in m for y in t)
        held.update(links.keys())
        note = ";".join(",".join(map(str, m)) + "|" + ",".join(map(str, t)) for m, t in groups)
        digest = hashlib.sha256(note.encode()).hexdigest() if a else ""
        per.append((key, len(a), len(b), len(groups), links, digest))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = [
        (key, na, nb, g, sum(links.values()), sum(t for p, t in links.items() if held[p] == top[p[0]]),
         sum(t * held[p] for p, t in links.items()), digest)
        for key, na, nb, g, links, digest in per
    ]
    pairs = sorted((x, y, n, n == top[x]) for (x, y), n in held.items())
    return sorted(out, key=repr), pairs


@pytest.mark.parametrize("chunk,fan,links", [(1 << 23, 64, 1 << 21), (1500, 2, 50)])
def test_alignment_equals_brute_force(spark, rows, monkeypatch, chunk, fan, links):
    monkeypatch.setattr(alignment, "FAN_IN", fan)
    monkeypatch.setattr(alignment, "_LINKS", links)
    rng = random.Random(5)
    texts = corpus(rng, 60) + ["The cat's <|endoftext|> <0x41> sat\n\ton  it. 2,500 €", "<s> a </s>", "▁x", "\x00"]
    texts += ["  two  spaces ", "好" * 300, "ab" * 900, "naïve café — “quoted”", "Ünïcödé " * 20]
    docs = list(enumerate(texts + ODD[:6])) + [(3, texts[3]), (None, texts[1]), (None, None)]
    frame = rows([(*d, 0, "z") for d in docs], "doc_id long, text string, chunk int, frames string")
    got = alignment.align(frame.repartition(4), BYTE_LEVEL, PIECES, chunk_bytes=chunk)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, pairs = brute_align(docs)
    assert sorted(map(tuple, got.documents.select(columns).collect()), key=repr) == want
    assert sorted(map(tuple, got.pairs.collect())) == pairs


def test_ranks_give_the_ids_of_the_tokenizer():
    sides = alignment.Sides(BYTE_LEVEL, PIECES)
    rng = random.Random(11)
    letters = "aAbz'\x00\x1c\x85\xa0 \t\n\r.,;<|>09²½ªßéÿĀŐɏ\u0300"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|> 's 'S don't  we'll\n\n x\t y ", "ab" * 5000, " " * 900 + "x"]
    texts += ["日本 ＡＢ٣ " + t for t in texts[:200]]
    whole = [e.ids for e in sides.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert sides.quick is not None and sides._first(texts) == whole


def test_large_groups_go_by_counts(monkeypatch):
    rng = np.random.default_rng(2)
    ids_a, ids_b = rng.integers(0, 9, 400), rng.integers(0, 7, 300)
    n_a, n_b = np.array([150, 5, 245]), np.array([100, 180, 20])
    group, doc = np.repeat(np.arange(3), n_a), np.array([0, 0, 2])
    small = alignment._pairs(ids_a, ids_b, group, n_a, n_b, doc)
    monkeypatch.setattr(alignment, "_LARGE", 1 << 40)
    monkeypatch.setattr(alignment, "_LINKS", 1000)
    whole = alignment._pairs(ids_a, ids_b, group, n_a, n_b, doc)
    assert small[1].sum() == (n_a * n_b).sum()
    assert all((x == y).all() for x, y in zip(small, whole))


def test_alignment_of_nothing(spark, rows):
    got = alignment.align(rows([], "doc_id long, text string"), BYTE_LEVEL, PIECES)
    assert got.documents.count() == 0 and got.pairs.count() == 0
