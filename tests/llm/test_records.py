"""Chat windows and WARC archives: round trips, and damaged input."""

import base64
import gzip
import hashlib
import io
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import chat, warc

TURNS = "conv_id long, turn long, role string, text string, window string, part string"


def turns(rows, data):
    return rows([(*d, "w", "p") for d in data], TURNS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("<|>\\end ab/", max_size=12), st.text("<|>\\end ab/", max_size=20)),
                max_size=4))
def test_template_reads_back(said):
    whole = "".join(f"<|{chat.escape(r)}|>{chat.escape(t)}{chat.END}" for r, t in said)
    assert chat.parse(whole) == said


def test_windows_hold_every_turn_once(spark, rows):
    data = [(1, 0, "system", "Be brief.")]
    data += [(1, i, ("user", "assistant")[i % 2], f"turn {i} " + "x" * (i * 37 % 200)) for i in range(1, 400)]
    data += [(2, 0, "user", None), (2, 1, "assistant", "</s>[INST] ok <|end|>"), (2, 1, "assistant", "tie")]
    data += [(None, None, None, None), (None, 5, "assistant", "a"), (3, 0, "system", "only")]
    data += [(4, 0, "assistant", "y" * 5000), (4, 0, "assistant", "y" * 5000)]
    windows = chat.format_windows(turns(rows, data), budget=256, history=64).collect()
    back = {r.conv_id: r for r in chat.read_back(
        chat.format_windows(turns(rows, data), budget=256, history=64)).collect()}
    clean = sorted(((c, t, r or "", x or "") for c, t, r, x in data),
                   key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or 0, d[2], d[3]))
    for conv, group in itertools.groupby(clean, key=lambda d: d[0]):
        group = list(group)
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in group)
        said = "".join(x for _, _, r, x in group if r == "assistant")
        got = back[conv]
        assert got.n_turns == len(group)
        assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got.loss_chars, got.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got.formatted_chars == sum(len(w.formatted) for w in windows if w.conv_id == conv)
    first = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.window)
    assert len(first) > 20
    assert all(chat.parse(w.formatted)[0] == ("system", "Be brief.") for w in first)
    # Later windows repeat some history, which is masked: loss spans lie behind it.
    assert any(w.repeated > 1 for w in first[1:])
    for w in first:
        assert len(chat.parse(w.formatted)) == w.turns
        assert sum(len(x) // 4 + 4 for _, x in chat.parse(w.formatted)) < 256 + 64 + 20
        for span in w.loss:
            assert w.formatted[: span.start].endswith("<|assistant|>")
    assert chat.format_windows(turns(rows, []), 256, 64).count() == 0


def counted(text):
    return -(-len(text.encode()) // 4) + 4


@pytest.mark.parametrize("budget,history,system", [(100, 80, 0), (100, 80, 9), (120, 30, 20), (64, 0, 5), (90, 89, 70)])
def test_windows_keep_to_the_budget(spark, rows, budget, history, system):
    rng = random.Random(budget + system)
    said = [("user", "assistant")[i % 2] for i in range(300)]
    data = [(1, i + 1, r, f"{i} " + "x" * rng.randint(0, 60)) for i, r in enumerate(said)]
    data += [(1, 150, "user", "long " * 100)]
    head = [("system", "s" * 4 * (system - 4))] if system else []
    data = [(1, 0, *h) for h in head] + data
    made = chat.format_windows(turns(rows, data), budget=budget, history=history).collect()
    order = [(r, x) for _, r, x in sorted(d[1:] for d in data)]
    seen = []
    for w in sorted(made, key=lambda w: w.window):
        shown = chat.parse(w.formatted)
        own = shown[w.repeated :]
        lead = 1 if head and own[0] != head[0] else 0
        assert shown[:lead] == head[:lead]
        past = shown[lead : w.repeated]
        begin = len(seen) + (own[0] in head)
        assert past == order[begin - len(past) : begin]
        targets = [t for t in own if t not in head]
        fixed = sum(counted(x) for _, x in targets + head)
        size = fixed + sum(counted(x) for _, x in past)
        single = len(targets) == 1
        assert size <= budget or (single and not past) or system > budget // 2
        # As much history as fits: one turn more would be too long.
        allowed = min(history, max(0, budget - fixed))
        assert sum(counted(x) for _, x in past) <= allowed
        if begin - len(past) > len(head):
            assert sum(counted(x) for _, x in [order[begin - len(past) - 1], *past]) > allowed
        seen += own
    assert seen == order


PAGES = "page_id long, url string, html string, digest string, size long, refers_to long"


def test_archives_read_back(spark, rows):
    data = [(1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nX: y", None), (4, "u", ""),
            (5, "u", "unique " * 5000), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (7, "u", "<p>é</p>"),
            (None, "u", "<p>é</p>"), (None, "u", "alone"), (7, "u", "<p>é</p>")]
    pages = rows([(*d, "d", 1, 9) for d in data], PAGES)
    got = warc.read_archives(warc.archive_pages(pages)).collect()
    assert len(got) == len(data) and all(r.problem is None for r in got)
    for page_id, _, html in data:
        body = (html or "").encode()
        mine = [r for r in got if r.record_id == f"urn:page:{'none' if page_id is None else page_id}"]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert any((r.payload_digest, r.payload_bytes) == (digest, len(body)) for r in mine)
    kind = {r.record_id: (r.record_type, r.refers_to) for r in got if "none" not in r.record_id}
    assert kind["urn:page:1"] == kind["urn:page:2"] == ("revisit", "urn:page:7")
    assert kind["urn:page:7"] == ("response", None) and kind["urn:page:3"] == ("revisit", "urn:page:4")
    none = sorted(r.record_type for r in got if "none" in r.record_id)
    assert none == ["response", "revisit"]
    assert bytes(next(r for r in got if r.record_id == "urn:page:6").payload) == data[5][2].encode()
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).count() == 0


def test_reader_names_damage():
    good = warc.record_bytes("urn:page:1", "http://a", b"body" * 100, None)
    inner = gzip.decompress(good)
    bad = gzip.compress(inner.replace(b"bodybody", b"bodyBODY", 1))
    short = gzip.compress(inner[:-4])
    read = lambda data: [
        warc.parse_record(*m)["problem"] for m in warc.members(io.BytesIO(data))]
    assert read(good + bad + short + good) == [
        None, "block digest mismatch", "length mismatch", None]
    assert read(good + good[:-20]) == [None, "truncated member"]
    assert read(good + b"\x00" * 50) == [None, "damaged member"]
    assert read(b"") == []


def test_members_are_single_records():
    both = warc.record_bytes("a", None, b"", None) + warc.record_bytes("b", None, b"", "a")
    found = [warc.parse_record(*m) for m in warc.members(io.BytesIO(both))]
    assert [(f["record_type"], f["record_id"], f["refers_to"], f["payload_bytes"]) for f in found] == [
        ("response", "a", None, 0), ("revisit", "b", "a", 0)]
