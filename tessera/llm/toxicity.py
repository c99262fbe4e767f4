"""Toxic spans by a linear-chain conditional random field.

Tokens of labelled documents are labelled first: a word or word beginning that toxic
documents hold far more often than others is an indicator, and its occurrences in toxic
documents are toxic tokens.  A two-state chain is fitted to these sequences by gradient
ascent on the conditional likelihood; its features are the word, its beginnings, and the
words on both sides.  Forward-backward marginals give each token's probability.  A
document's score is a logistic function, fitted on the same sample, of its tokens' largest
and joint marginals, and runs of likely tokens are its spans.

Sequences are cut into chunks of equal length.  A chunk's steps multiply to a 2 x 2 matrix,
so messages pass over whole chunks first and inside all chunks at once afterwards; the
marginals are those of the uncut sequence.

TOXIC_DOCS and OTHER_DOCS bound the fitting sample, which leaves out texts beyond
SAMPLE_CHARS; every document is scored on its whole text.

Edge cases: a null or wordless text scores 0; without toxic training rows every score is 0;
repeated rows get equal scores, and a repeated id counts once in the sample; empty tables
give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common, sampling
from tessera.llm.decontamination import words_of
from tessera.llm.quality import training_fold

TOXIC_DOCS = 600
OTHER_DOCS = 900
SAMPLE_CHARS = 100_000
#: Words and word beginnings with a feature of their own.
VOCABULARY = 60_000
BEGINNINGS = (4, 5, 6)
CHUNK = 128
THRESHOLD = 0.3
SPAN_THRESHOLD = 0.5
REMEMBERED = 250_000


def units(word: bytes) -> list[bytes | None]:
    """The word, and its beginnings (marked by a bar that no word has)."""
    return [word, *(word[:k] + b"|" if len(word) > k else None for k in BEGINNINGS)]


class Tokens(dict):
    """Word -> row of feature ids: the word's and its beginnings'; 0 is unknown."""

    def __init__(self, features: dict[bytes, int]):
        super().__init__()
        self.features, self.ids = features, []

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self)
        self.ids += [self.features.get(u, 0) for u in units(word)]
        return row

    def of(self, words: list[bytes]) -> np.ndarray:
        """Feature ids, a row for each token."""
        if len(self) > REMEMBERED:
            self.clear()
            self.ids = []
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.array(self.ids, np.int32).reshape(-1, 1 + len(BEGINNINGS))[at]


class Layout:
    """Sequences laid out as chunks: places of tokens and neighbours of chunks."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        n = -(-sizes // CHUNK)
        self.chunks = int(n.sum())
        self.first = np.cumsum(n) - n  # first chunk of each sequence
        self.count = n
        token_first = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum())) - np.repeat(token_first, sizes)
        self.row = np.repeat(self.first, sizes) + within // CHUNK
        self.step = within % CHUNK

    def spread(self, values: np.ndarray, fill: float) -> np.ndarray:
        out = np.full((CHUNK, self.chunks), fill)
        out[self.step, self.row] = values
        return out


def marginals(layout: Layout, emission: np.ndarray, start: np.ndarray, transition: np.ndarray, pairs: bool = False):
    """Probabilities of state 1 of every token, and if wanted the expected numbers of
    transitions.  ``emission``: score of state 1 over 0 for each token; ``start`` and
    ``transition`` are scores."""
    if not layout.chunks:
        return np.zeros(0), np.zeros((2, 2)), np.zeros(2)
    real = layout.spread(np.ones(len(emission)), 0.0) > 0
    weight = np.exp(np.clip(layout.spread(emission, 0.0), -30, 30))
    move, begin = np.exp(transition), np.exp(start)
    is_first = np.zeros(layout.chunks, bool)
    is_first[layout.first[layout.count > 0]] = True
    n = layout.chunks
    # Products of the steps of each chunk, from the state before it.
    product = np.broadcast_to(np.eye(2), (n, 2, 2)).copy()
    for t in range(CHUNK):
        step = product @ move
        if t == 0:
            step[is_first] = np.broadcast_to(begin, (2, 2))
        step[:, :, 1] *= weight[t][:, None]
        product = np.where(real[t][:, None, None], step / step.sum((1, 2), keepdims=True), product)
    enter, leave = np.full((n, 2), 0.5), np.full((n, 2), 0.5)
    most = int(layout.count.max())
    for k in range(1, most):
        rows = layout.first[layout.count > k] + k
        v = np.einsum("ri,rij->rj", enter[rows - 1], product[rows - 1])
        enter[rows] = v / v.sum(1, keepdims=True)
    for k in range(most - 2, -1, -1):
        rows = layout.first[layout.count > k + 1] + k
        v = np.einsum("rij,rj->ri", product[rows + 1], leave[rows + 1])
        leave[rows] = v / v.sum(1, keepdims=True)
    alpha = np.empty((CHUNK, n, 2))
    a = enter
    for t in range(CHUNK):
        step = a @ move
        if t == 0:
            step[is_first] = begin
        step = step * np.stack([np.ones(n), weight[t]], axis=1)
        a = np.where(real[t][:, None], step / step.sum(1, keepdims=True), a)
        alpha[t] = a
    out = np.empty((CHUNK, n))
    expected, expected_start = np.zeros((2, 2)), np.zeros(2)
    b = leave
    for t in range(CHUNK - 1, -1, -1):
        p = alpha[t] * b
        p /= p.sum(1, keepdims=True)
        out[t] = p[:, 1]
        message = b * np.stack([np.ones(n), weight[t]], axis=1)
        if pairs:
            before = alpha[t - 1] if t else enter
            joint = before[:, :, None] * move * message[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            use = real[t] & ~is_first if t == 0 else real[t]
            expected += joint[use].sum(0)
            if t == 0:
                expected_start += p[is_first].sum(0)
        back = message @ move.T
        b = np.where(real[t][:, None], back / back.sum(1, keepdims=True), b)
    return out[layout.step, layout.row], expected, expected_start


class Chain:
    """Weights of the two-state chain, and of the score made of its marginals."""

    def __init__(self, features: dict[bytes, int]):
        self.features = features
        n = max(features.values(), default=0) + 1
        self.w = {"unit": np.zeros(n), "before": np.zeros(n), "after": np.zeros(n), "bias": np.zeros(1), "start": np.zeros(2), "move": np.zeros((2, 2))}
        self.scale = np.zeros(3)

    def neighbours(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word ids before and after each token; outside a sequence the unknown word."""
        before, after = np.r_[0, words[:-1]], np.r_[words[1:], 0]
        ends = np.cumsum(sizes[sizes > 0])
        before[np.r_[0, ends[:-1]].astype(np.int64)] = 0
        after[ends - 1] = 0
        return before, after

    def emission(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(ids):
            return np.zeros(0)
        before, after = self.neighbours(ids[:, 0], sizes)
        return self.w["bias"][0] + self.w["unit"][ids].sum(1) + self.w["before"][before] + self.w["after"][after]

    def probabilities(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return marginals(Layout(sizes), self.emission(ids, sizes), self.w["start"], self.w["move"])[0]

    def fit(self, ids, sizes, states, steps: int = 80, rate: float = 0.25, decay: float = 3e-4) -> None:
        """Adam on the regularised conditional log-likelihood."""
        layout = Layout(sizes)
        before, after = self.neighbours(ids[:, 0], sizes)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        inner = np.ones(len(ids), bool)
        inner[starts] = False
        seen_move = np.zeros((2, 2))
        np.add.at(seen_move, (states[:-1][inner[1:]], states[1:][inner[1:]]), 1)
        seen_start = np.bincount(states[starts], minlength=2).astype(float)
        self.w["bias"][0] = -6.0
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        scale = 1 / max(1, int(states.sum()))
        size = len(self.w["unit"])
        for t in range(1, steps + 1):
            p, moves, first = marginals(layout, self.emission(ids, sizes), self.w["start"], self.w["move"], True)
            gap = states - p
            g = {
                "unit": sum(np.bincount(column, gap, size) for column in ids.T), "before": np.bincount(before, gap, size), "after": np.bincount(after, gap, size),
                "bias": np.array([gap.sum()]), "start": seen_start - first, "move": seen_move - moves,
            }
            for k, x in g.items():
                if k in ("unit", "before", "after"):
                    x[0] = 0  # an unknown word says nothing
                x = scale * x - decay * self.w[k] * (k != "bias")
                m[k] = 0.9 * m[k] + 0.1 * x
                v2[k] = 0.99 * v2[k] + 0.01 * x * x
                self.w[k] = self.w[k] + rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.99**t)) + 1e-6)

    def evidence(self, p: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(each sequence's constant, largest and joint log odds; its largest marginal)."""
        x, most = np.zeros((len(sizes), 3)), np.zeros(len(sizes))
        x[:, 0], x[:, 1:] = 1, -12
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            most[some] = np.maximum.reduceat(p, starts)
            none = np.add.reduceat(np.log1p(-np.clip(p, 1e-9, 1 - 1e-9)), starts)
            top = np.clip(most[some], 1e-6, 1 - 1e-6)
            x[some, 1] = np.log(top / (1 - top))
            x[some, 2] = np.clip(np.log(-np.expm1(none)) - none, -12, 12)
        return x, most

    def fit_scale(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression of documents' labels on their evidence, by Newton steps."""
        w = np.zeros(3)
        for _ in range(30):
            s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            ridge = np.diag([1e-3, 1.0, 1.0])
            w = w + np.linalg.solve((x * (s * (1 - s))[:, None]).T @ x + ridge, x.T @ (y - s) - ridge @ w)
        self.scale = w


def indicators(toxic: list[list[bytes]], other: list[list[bytes]]) -> set[bytes]:
    """Words and word beginnings that are toxic documents' own, but for a few slips."""
    from collections import Counter

    kinds = lambda words: {u for w in set(words) for u in units(w) if u}
    a = Counter(u for words in toxic for u in kinds(words))
    b = Counter(u for words in other for u in kinds(words))
    n, m = max(1, len(toxic)), max(1, len(other))
    least = max(3, n // 100)
    return {u for u, k in a.items() if k >= least and b[u] <= 0.05 * k and (k + 0.5) / (n + 1) > 12 * (b[u] + 0.5) / (m + 1)}


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, other_docs: int = OTHER_DOCS) -> Chain | None:
    """The chain fitted on a bounded sample of the training fold, or None without toxic rows."""
    from collections import Counter

    short = docs.filter(F.length(F.coalesce("text", F.lit(""))) <= SAMPLE_CHARS)
    gather = lambda value, n, salt: [words_of(t) for t in sorted((r.text or "").encode() for r in sampling.labelled(short, labels, "toxic", value, n, salt).select("text").collect())]
    toxic, other = gather(1, toxic_docs, 5), gather(0, other_docs, 6)
    marked = indicators(toxic, other)
    if not marked:
        return None
    seen = Counter(u for words in toxic + other for w in set(words) for u in units(w) if u)
    most = sorted((u for u, k in seen.items() if k >= 3), key=lambda u: (-seen[u], u))[:VOCABULARY]
    chain = Chain({u: i for i, u in enumerate(sorted(marked | set(most)), 1)})
    sequences = toxic + other
    ids = Tokens(chain.features).of([w for words in sequences for w in words])
    sizes = np.array([len(words) for words in sequences])
    is_marked = {w: not marked.isdisjoint(units(w)) for words in toxic for w in words}
    states = np.array([is_marked[w] for words in toxic for w in words] + [False] * sum(map(len, other)), dtype=np.int64)
    chain.fit(ids, sizes, states)
    x, _ = chain.evidence(chain.probabilities(ids, sizes), sizes)
    chain.fit_scale(x, np.r_[np.ones(len(toxic)), np.zeros(len(other))])
    # The sample holds more toxic documents than the labels do.
    n = {r.toxic: r["count"] for r in labels.filter("toxic is not null").groupBy("toxic").count().collect()}
    chain.scale[0] += np.log(max(1, n.get(1, 0)) / max(1, n.get(0, 0))) - np.log(len(toxic) / max(1, len(other)))
    return chain


PLACES = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


def span_places(text: str, p: np.ndarray, threshold: float = SPAN_THRESHOLD) -> list[dict]:
    """Character offsets of runs of likely tokens with their largest probability."""
    spans: list[dict] = []
    previous = -2
    for i, m in enumerate(PLACES.finditer(text)):
        if p[i] < threshold:
            continue
        if i == previous + 1:
            spans[-1]["stop"] = m.end()
            spans[-1]["probability"] = max(spans[-1]["probability"], float(p[i]))
        else:
            spans.append({"start": m.start(), "stop": m.end(), "probability": float(p[i])})
        previous = i
    return spans


def score_rows(chain: Chain | None, carried: list[str], places: bool):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())]))

    def run(batches):
        tokens = Tokens(chain.features) if chain else None
        for batch in batches:
            raws = common.binary_texts(batch)
            scores, most, spans = np.zeros(len(raws)), np.zeros(len(raws)), [[] for _ in raws]
            if chain and raws:
                split = [words_of(raw) for raw in raws]
                sizes = np.array([len(w) for w in split])
                p = chain.probabilities(tokens.of([w for words in split for w in words]), sizes)
                starts = np.cumsum(sizes) - sizes
                x, most = chain.evidence(p, sizes)
                scores = 1 / (1 + np.exp(-np.clip(x @ chain.scale, -30, 30)))
                if places:
                    for i in np.flatnonzero(most >= SPAN_THRESHOLD).tolist():
                        spans[i] = span_places(raws[i].decode(), p[starts[i] : starts[i] + sizes[i]])
            arrays = [*common.keep(batch, *carried), pa.array(scores), pa.array(most)]
            names = [*carried, "score", "most"]
            if places:
                arrays.append(pa.array(spans, kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def tagged(docs: DataFrame, chain: Chain | None, places: bool = True) -> DataFrame:
    """Documents' id and fold with score, largest token probability and toxic spans."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", spans array<struct<start:int,stop:int,probability:double>>" if places else ""
    return docs.select("doc_id", "held_out", "text").mapInArrow(score_rows(chain, ["doc_id", "held_out"], places), f"doc_id {kind}, held_out boolean, score double, most double{more}")


def op8_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, train, labels = training_fold(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"), 4, 2)
    out = tagged(docs, fit(train, labels))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["stop"])).alias("offsets"))
