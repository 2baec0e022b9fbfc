"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters and digits, lower-cased. A token's emission score adds the
weights of its word and of its first three to five letters, and of the word before
and after; transitions link neighbouring tags. Forward-backward gives each token's
marginal of the toxic tag. A document's score is a logistic function of the
marginals' expected count, their share and their maximum; its offending offsets are
the tokens above one half.

Labels are given per document, so tokens are labelled from them: a token of a toxic
document is tagged when its word or a beginning of it occurs in toxic documents far
more often than in clean ones.

Training uses a bounded sample of whole texts: of each class the ``TRAIN_DOCS``
documents of smallest id hash, fewer where they average more than ``TRAIN_TOKENS``
tokens or ``TRAIN_CHARS`` characters. For the chain's gradient a text is cut into
windows that together cover it; the document's weights are fitted on marginals of whole
texts, as scoring computes them. Scoring reads whole texts of all documents and keeps a
batch of rows in memory. The model has at most ``MAX_WEIGHTS`` weights, whatever the
corpus; it is broadcast.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.memory import returning_memory
from tillwise.workspace import materialise

TRAIN_DOCS = 1600
#: What a sampled text may have on average; no text is shortened.
TRAIN_TOKENS = 400
TRAIN_CHARS = 12_000
#: Longest chain of the gradient.
WINDOW = 400
MAX_WEIGHTS = 20_000
MIN_DOCS = 3
#: A token feature is taken as toxic where the odds of its documents are this much higher.
LOG_ODDS = 3.0
#: ... and is certain on its own where this many standard errors below is still above the next.
ERRORS, CERTAIN = 2.0, 1.5
STEPS = 40
THRESHOLD = 0.5
_CACHED_WORDS = 200_000
_BATCH_TOKENS = 150_000
_BATCH_ROWS = 500

TOKEN = re.compile(r"[^\W_]+")


def tokenise(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def features_of(word: str) -> list[str]:
    """The word itself and the beginnings it shares with others."""
    return ["w" + word, *("p" + word[:n] for n in (3, 4, 5) if len(word) > n)]


def _chain(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray):
    """Odds of tag 1 from the left, from the token itself and from the right.

    ``scores``: tokens x sequences, the score of tag 1 over tag 0, longest sequence
    first. Odds of the two tags are all that needs to be carried; the transitions
    bound them, so they neither vanish nor overflow.
    """
    own = np.exp(np.clip(scores, -30, 30), dtype=np.float32)
    left, right = np.ones_like(own), np.ones_like(own)
    (e00, e01), (e10, e11) = np.exp(np.clip(trans, -15, 15)).astype(np.float32)
    live = np.searchsorted(-lengths, -np.arange(len(scores)), side="left")
    for t in range(1, len(scores)):
        n = live[t]
        odds = left[t - 1, :n] * own[t - 1, :n]
        left[t, :n] = (e01 + odds * e11) / (e00 + odds * e10)
    for t in range(len(scores) - 2, -1, -1):
        n = live[t + 1]
        odds = right[t + 1, :n] * own[t + 1, :n]
        right[t, :n] = (e10 + odds * e11) / (e00 + odds * e01)
    return left, own, right


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(tag 1) of every token of many sequences side by side; see ``_chain``."""
    left, own, right = _chain(scores, lengths, trans)
    odds = left * own * right
    return odds / (1 + odds)


def _expected(scores, lengths, trans, inside) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of the four transitions, and the marginals: for the gradient."""
    left, own, right = _chain(scores, lengths, trans)
    odds = left * own * right
    both = inside[1:]
    before, after = (left * own)[:-1][both], (own * right)[1:][both]
    four = np.stack([np.ones_like(before), after, before, before * after])
    four *= np.exp(np.clip(trans, -15, 15)).astype(np.float32).reshape(4, 1)
    return (four / four.sum(axis=0)).sum(axis=1).reshape(2, 2), odds / (1 + odds)


def _summary(p: np.ndarray) -> list[float]:
    """What a document's score is made from: expected count, share and maximum of the tag."""
    if not len(p):
        return [0.0, 0.0, 0.0]
    total = float(p.sum())
    return [math.log1p(total), math.sqrt(total / len(p)), float(p.max())]


def _marks(candidates: list[str], odds, seen, toxic_docs: list[set[str]]) -> set[str]:
    """Features that stand for toxicity, best evidence first.

    A feature that is not certain counts only if it explains toxic documents that no
    better one does: words that merely occur along with a toxic one are left out.
    """
    def bound(f: str) -> float:
        return odds(f) - ERRORS * math.sqrt(1 / (seen[1][f] + 0.5) + 1 / (seen[0][f] + 0.5))

    where: dict[str, list[int]] = {f: [] for f in candidates}
    for i, found in enumerate(toxic_docs):
        for f in found & where.keys():
            where[f].append(i)
    taken, open_docs = set(), set(range(len(toxic_docs)))
    for f in sorted(candidates, key=lambda f: (-bound(f), f)):
        if bound(f) >= CERTAIN or len(open_docs.intersection(where[f])) >= MIN_DOCS:
            taken.add(f)
            open_docs.difference_update(where[f])
    return taken


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for k in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return x


def fit(texts: list[str], labels: list[int], share: float | None = None) -> dict:
    """Train on labelled texts; returns a model of plain numbers and strings.

    ``share``: the toxic documents' share outside the sample, for the scores; the
    sample's own where it is not given.

    Without both classes there is nothing to learn: the model then scores every
    document by the share of toxic ones (0 without any label).
    """
    labels = np.array(labels, dtype=float)
    base = float(labels.mean()) if len(labels) else 0.0
    model = {"weights": {}, "near": {}, "trans": [[0.0, 0.0], [0.0, 0.0]], "bias": -4.0,
             "doc": [0.0, 0.0, 0.0], "offset": math.log((base + 1e-3) / (1 - base + 1e-3))}
    if base in (0.0, 1.0):
        return model
    # Texts as numbers of their distinct words: the only thing kept for every token.
    numbers = _Numbers()
    docs = [np.fromiter(map(numbers.__getitem__, tokenise(t)), np.int32) for t in texts]
    named = [features_of(w) for w in numbers]
    seen = (Counter(), Counter())
    for words, y in zip(docs, labels):
        seen[int(y)].update({f for w in np.unique(words) for f in named[w]})
    toxic, clean = labels.sum(), len(labels) - labels.sum()

    def odds(f: str) -> float:
        return math.log((seen[1][f] + 0.5) / (toxic + 1)) - math.log((seen[0][f] + 0.5) / (clean + 1))

    # In order of evidence, so that the bound leaves out what matters least.
    common = [f for f, c in (seen[0] + seen[1]).items() if c >= MIN_DOCS]
    common.sort(key=lambda f: (-abs(odds(f)) * math.sqrt(seen[0][f] + seen[1][f]), f))
    at = {f: i for i, f in enumerate(common[: MAX_WEIGHTS // 2])}
    likely = {f for f in at if seen[1][f] >= MIN_DOCS and odds(f) >= LOG_ODDS}
    marks = _marks(sorted(likely), odds, seen, [
        {f for w in np.unique(d) for f in named[w] if f in likely} for d, y in zip(docs, labels) if y
    ])
    size, many = len(at), len(named)
    # Word and feature of every feature that a distinct word has.
    has = [(w, at[f]) for w, fs in enumerate(named) for f in fs if f in at]
    has_word, has_feat = np.array(has, np.int32).reshape(-1, 2).T
    marked = np.array([any(f in marks for f in fs) for fs in named], bool)
    del named, has, common, seen, numbers

    # Tokens are numbered through all texts; windows are put side by side, longest first.
    ends = np.cumsum([len(d) for d in docs])
    cuts = [(a, min(a + WINDOW, e)) for e, d in zip(ends.tolist(), docs) for a in range(e - len(d), e, WINDOW)]
    cuts.sort(key=lambda c: c[0] - c[1])
    lengths = np.array([b - a for a, b in cuts], np.int64)
    steps = max(1, int(lengths.max(initial=0)))
    inside = np.arange(steps)[:, None] < lengths[None, :]
    word = np.concatenate(docs)
    place = np.empty(len(word), np.int32)  # of a token in the grid of steps x windows
    for s, (a, b) in enumerate(cuts):
        place[a:b] = np.arange(b - a) * len(cuts) + s
    tags = np.zeros((steps, len(cuts)), np.float32)
    tags.flat[place] = marked[word] & np.repeat(labels > 0, [len(d) for d in docs])
    del docs
    edge = np.zeros(len(word) + 1, bool)
    edge[ends] = edge[0] = True
    linked = ~edge[1:-1]  # a token and the next belong to one text

    def of_words(weights):
        return np.bincount(has_word, weights[has_feat], many).astype(np.float32)

    def of_features(sums):
        return np.bincount(has_feat, sums[has_word], size)

    def spread(x):
        own, near = of_words(x[:size]), of_words(x[size : 2 * size])
        scores = own[word] + np.float32(x[2 * size])
        around = near[word]
        scores[1:] += around[:-1] * linked
        scores[:-1] += around[1:] * linked
        grid = np.zeros_like(tags)
        grid.flat[place] = scores
        return grid

    both = inside[1:]
    had = np.array([
        [((1 - tags[:-1]) * (1 - tags[1:]) * both).sum(), ((1 - tags[:-1]) * tags[1:] * both).sum()],
        [(tags[:-1] * (1 - tags[1:]) * both).sum(), (tags[:-1] * tags[1:] * both).sum()],
    ])

    def gradient(x):
        trans = x[2 * size + 1 :].reshape(2, 2)
        expected, node = _expected(spread(x), lengths, trans, inside)
        miss = (node - tags).flat[place]
        g = np.zeros_like(x)
        g[:size] = of_features(np.bincount(word, miss, many))
        beside = np.bincount(word[:-1], miss[1:] * linked, many)
        beside += np.bincount(word[1:], miss[:-1] * linked, many)
        g[size : 2 * size] = of_features(beside)
        g[2 * size] = miss.sum()
        g[2 * size + 1 :] = (expected - had).reshape(-1)
        return g + 0.05 * x

    x = _adam(gradient, 2 * size + 5, STEPS, 0.3)
    trans = x[2 * size + 1 :].reshape(2, 2)
    model |= {
        "weights": {f: float(x[i]) for f, i in at.items()},
        "near": {f: float(x[size + i]) for f, i in at.items()},
        "trans": trans.tolist(), "bias": float(x[2 * size]),
    }
    tagger = Tagger(model)
    sums = np.array([
        _summary(p) for k in range(0, len(texts), _BATCH_ROWS) for p in tagger.tag(texts[k : k + _BATCH_ROWS])
    ])

    share = base if share is None else min(max(share, 1e-3), 1 - 1e-3)
    weight = np.where(labels == 1, share / base, (1 - share) / (1 - base))

    def doc_gradient(z):
        y = 1 / (1 + np.exp(-np.clip(sums @ z[:3] + z[3], -500, 500)))
        miss = weight * (y - labels)
        return np.append(sums.T @ miss, miss.sum()) / len(labels) + 1e-4 * z

    z = _adam(doc_gradient, 4, 800, 0.1)
    return model | {"doc": z[:3].tolist(), "offset": float(z[3])}


class _Numbers(dict):
    """Words numbered as they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        return found


class Tagger:
    """Scores texts with a model; keeps the emissions of words it has met."""

    def __init__(self, model: dict):
        self.model = model
        self.trans = np.array(model["trans"])
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.own, self.near = np.empty(0), np.empty(0)

    def _learn(self) -> None:
        """Emissions of the words numbered since the last call."""
        new = list(islice(self.numbers, len(self.own), None))
        found = [features_of(w) for w in new]
        for name, of in (("own", "weights"), ("near", "near")):
            get = self.model[of].get
            values = [sum([get(f, 0.0) for f in fs]) for fs in found]
            setattr(self, name, np.concatenate([getattr(self, name), values]))

    def _scores(self, numbers: np.ndarray) -> np.ndarray:
        out = self.own[numbers] + self.model["bias"]
        near = self.near[numbers]
        out[1:] += near[:-1]
        out[:-1] += near[1:]
        return out

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """The toxic marginals of each text's tokens."""
        if len(self.numbers) > _CACHED_WORDS:
            self.forget()
        number = self.numbers.__getitem__
        words = [tokenise(t) for t in texts]
        numbers = [np.fromiter(map(number, ws), np.int64, len(ws)) for ws in words]
        self._learn()
        scores = [self._scores(n) for n in numbers]
        found: list[np.ndarray] = [np.empty(0)] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: -len(scores[i]))
        k = 0
        while k < len(order) and len(scores[order[k]]):
            # Of falling length, so that padding stays under the bound.
            longest = len(scores[order[k]])
            some = order[k : k + max(1, _BATCH_TOKENS // longest)]
            lengths = np.array([len(scores[i]) for i in some])
            grid = np.zeros((longest, len(some)))
            for s, i in enumerate(some):
                grid[: lengths[s], s] = scores[i]
            p = marginals(grid, lengths, self.trans)
            for s, i in enumerate(some):
                found[i] = p[: lengths[s], s]
            k += len(some)
        return found

    def score(self, p: np.ndarray) -> float:
        z = float(np.dot(_summary(p), self.model["doc"])) + self.model["offset"]
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


@returning_memory
def _fit_rows(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    texts, marks = [r[1] for r in rows], [r[2] for r in rows]
    del rows
    model = fit(texts, marks, share)
    yield pa.RecordBatch.from_pydict({"model": [json.dumps(model)]})


def _affordable(found: list, room: float) -> list[str]:
    """Ids (id, class, cost, in order) that together cost no more than ``room`` a class."""
    spent, taken = Counter(), []
    for row in found:
        if spent[row.y] + row.cost <= room:
            spent[row.y] += row.cost
            taken.append(row._id)
    return taken


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = TRAIN_DOCS,
) -> dict:
    """Fit on at most ``sample`` labelled documents of each class, in one task.

    Texts are read whole; where they would exceed ``sample`` texts of ``TRAIN_TOKENS``
    tokens (or ``TRAIN_CHARS`` characters), those that no longer fit are left out and
    shorter ones after them taken, so the end of a full sample favours short texts.
    Labels other than 0 and 1 (null too) and ids without a document are passed over;
    a null text counts as empty; an id labelled both ways counts as toxic.
    """
    marked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    )
    share = marked.agg(F.avg("_toxic")).first()[0] or 0.0
    chosen = [
        marked.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        for y in (0, 1)
    ]
    picked = materialise(chosen[0].union(chosen[1]), "tox-sample")
    # Rows that share an id give one training text, so the bound holds.
    rows = materialise(
        docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(picked, F.col("_doc") == F.col("_id"))
        .groupBy("_id", F.col("_toxic").cast("int").alias("y"))
        .agg(F.min("text").alias("text"))
        .select(F.col("_id").cast("string").alias("_id"), "text", "y", F.xxhash64("_id").alias("_at")),
        "tox-texts",
    )
    cost = F.greatest(
        F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")),
        F.length("text") * F.lit(TRAIN_TOKENS / TRAIN_CHARS),
    )
    # A row for each sampled document, so their number is bounded.
    found = rows.select("_id", "y", cost.alias("cost"), "_at").orderBy("_at", "_id").collect()
    fitting = rows.where(F.col("_id").isin(_affordable(found, sample * TRAIN_TOKENS)))
    written = materialise(
        fitting.select("_id", "text", "y").coalesce(1)
        .mapInArrow(lambda batches: _fit_rows(batches, share), "model string"),
        "tox-model",
    )
    first = written.first()
    return json.loads(first[0]) if first else fit([], [])


def score(
    docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default: the id) plus ``score``, ``predicted`` and ``spans``.

    ``spans`` are (start, end, p) of tokens whose toxic marginal is at least one half,
    in characters of the text. Null and empty texts score like texts without a token.
    Only the text enters the score.
    """
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)
    schema += ", score double, predicted int, spans array<struct<start:int,end:int,p:double>>"

    @returning_memory
    def run(batches):
        tagger = Tagger(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH_ROWS):
                some = batch.slice(start, _BATCH_ROWS)
                texts = [t or "" for t in some.column(len(keep)).to_pylist()]
                tags = tagger.tag(texts)
                scores = [tagger.score(p) for p in tags]
                spans = []
                for text, p in zip(texts, tags):
                    hits = np.flatnonzero(p >= 0.5)
                    spans.append(_places(text, hits, p) if len(hits) else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        *some.columns[: len(keep)],
                        pa.array(scores, pa.float64()),
                        pa.array([int(x >= THRESHOLD) for x in scores], pa.int32()),
                        pa.array(spans, pa.list_(span)),
                    ],
                    [*keep, "score", "predicted", "spans"],
                )

    columns = [F.col(f"`{c}`") for c in keep]
    return docs.select(*columns, F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema)


def _places(text: str, hits: np.ndarray, p: np.ndarray) -> list[dict]:
    """Offsets of the tokens numbered ``hits``.

    Tokens are found in the lowered text; the few letters that change length when
    lowered are stepped over by lowering character by character.
    """
    low = text.lower()
    places = [m.span() for m in TOKEN.finditer(low)]
    if len(low) != len(text):
        back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
        places = [(back[a], back[b - 1] + 1) for a, b in places]
    return [{"start": places[h][0], "end": places[h][1], "p": float(p[h])} for h in hits]


def held_out(id_col: str = "doc_id"):
    """The fifth of the ids that training may not see: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
