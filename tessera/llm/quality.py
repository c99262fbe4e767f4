"""Quality classifier by positive-unlabelled learning.

A document is described by how its bytes and words are built (shares and neighbourhoods of
byte classes, word shapes, repetition).  A small network is fitted on trusted positives and
on unlabelled web text by the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

with the class prior estimated from the fit of a plain positive-against-unlabelled model:
the prior is the least ratio, over thresholds, of the unlabelled share above the threshold
to the positive share above it.  Labelled negatives are never used.

POSITIVES and UNLABELLED bound the fitting samples; every document is scored on its whole
text.

Edge cases: a null or empty text has a defined description (all zero but for its length)
and gets a score; without positives or without unlabelled text there is nothing to fit and
every score is 0.5; with fewer than two of either the prior is taken to be 0.5; repeated
rows get equal scores, and a repeated id counts once in a sample; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import common, sampling

POSITIVES = 3000
UNLABELLED = 6000
HIDDEN = 16
BATCH = 256
THRESHOLD = 0.3

#: Classes of bytes, in order: other control, lower, upper, digit, space, line break, full
#: stop and comma, other sentence marks, brackets and quotes, bars and slashes, symbols,
#: beyond ASCII.
N_CLASSES = 12


def byte_classes() -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".,", "!?:;", "()[]{}<>\"'`", "|/\\-_", "#$%&*+=@^~"]
    for i, group in enumerate(groups, 1):
        out[[ord(c) for c in group]] = i
    out[128:] = N_CLASSES - 1
    return out


def describe(raw: bytes, classes: np.ndarray) -> np.ndarray:
    """Fixed-size description of a text."""
    kinds = classes[np.frombuffer(raw, np.uint8)]
    n = max(1, len(kinds))
    single = np.bincount(kinds, minlength=N_CLASSES) / n
    pairs = np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=N_CLASSES**2) / n if len(kinds) > 1 else np.zeros(N_CLASSES**2)
    words = raw.split()
    lines = raw.split(b"\n")
    m = max(1, len(words))
    shape = [
        np.log1p(len(words)) / 10,
        len(set(words)) / m,
        sum(map(bytes.__eq__, words, words[1:])) / m,
        sum(map(bytes.isupper, words)) / m,
        len(raw) / m / 20,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    return np.concatenate([np.sqrt(single), np.sqrt(pairs), shape]).astype(np.float32)


N_FEATURES = N_CLASSES + N_CLASSES**2 + 6


def description_rows(batches):
    classes = byte_classes()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([describe(raw, classes).tobytes() for raw in common.binary_texts(batch)], pa.binary())], names=["x"])


def descriptions(docs: DataFrame) -> np.ndarray:
    """Descriptions of a bounded sample, gathered on the driver in a fixed order."""
    rows = sorted(r.x for r in docs.select("text").mapInArrow(description_rows, "x binary").collect())
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Network:
    """One hidden layer of rectified units on standardised descriptions."""

    def __init__(self, mean, scale, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = [rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)]
        self.m = [np.zeros_like(w) for w in self.p]
        self.v = [np.zeros_like(w) for w in self.p]
        self.t = 0

    def hidden(self, x):
        return np.maximum(np.clip((x - self.mean) / self.scale, -5, 5) @ self.p[0] + self.p[1], 0)

    def score(self, x):
        return self.hidden(x) @ self.p[2] + self.p[3][0]

    def gradient(self, x, slope):
        """Gradient of a loss whose slope at each row's score is given."""
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        h = np.maximum(z @ self.p[0] + self.p[1], 0)
        back = slope[:, None] * self.p[2] * (h > 0)
        return [z.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]

    def step(self, gradient, rate=0.005, decay=1e-4):
        self.t += 1
        for i, g in enumerate(gradient):
            g = g + decay * self.p[i]
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.p[i] -= rate * (self.m[i] / (1 - 0.9**self.t)) / (np.sqrt(self.v[i] / (1 - 0.999**self.t)) + 1e-8)


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, seed: int = 7) -> Network:
    """Minimise the non-negative unbiased risk with the logistic loss, on batches."""
    both = np.vstack([positive, unlabelled])
    net = Network(both.mean(0), both.std(0) + 1e-3, seed)
    rng = np.random.default_rng(seed)
    for _ in range(steps):
        p = positive[rng.integers(0, len(positive), min(BATCH, len(positive)))]
        u = unlabelled[rng.integers(0, len(unlabelled), min(2 * BATCH, len(unlabelled)))]
        s_p, s_u = sigmoid(net.score(p)), sigmoid(net.score(u))
        loss_u = -np.log(np.maximum(1 - s_u, 1e-12)).mean()
        loss_p = -np.log(np.maximum(1 - s_p, 1e-12)).mean()
        g_plus = net.gradient(p, prior * (s_p - 1) / len(p))
        g_u = net.gradient(u, s_u / len(u))
        g_minus = net.gradient(p, -prior * s_p / len(p))
        if loss_u - prior * loss_p >= 0:
            net.step([a + b + c for a, b, c in zip(g_plus, g_u, g_minus)])
        else:  # the negative risk overfits: walk its gradient back
            net.step([-(b + c) for b, c in zip(g_u, g_minus)], rate=0.002)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled data, from held-out halves of both."""
    if min(len(positive), len(unlabelled)) < 2:
        return 0.5
    p_fit, p_held, u_fit, u_held = positive[::2], positive[1::2], unlabelled[::2], unlabelled[1::2]
    both = np.vstack([p_fit, u_fit])
    net = Network(both.mean(0), both.std(0) + 1e-3, 11)
    for _ in range(200):  # plain positive against unlabelled, both sides weighing the same
        net.step([a + b for a, b in zip(net.gradient(p_fit, 0.5 * (sigmoid(net.score(p_fit)) - 1) / len(p_fit)), net.gradient(u_fit, 0.5 * sigmoid(net.score(u_fit)) / len(u_fit)))])
    s_p, s_u = np.sort(net.score(p_held)), np.sort(net.score(u_held))
    cuts = np.quantile(s_p, np.linspace(0.01, 0.9, 90))
    above_p = 1 - np.searchsorted(s_p, cuts) / len(s_p)
    above_u = 1 - np.searchsorted(s_u, cuts) / len(s_u)
    slack = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(s_p)) + 1 / np.sqrt(len(s_u)))
    best = int(np.argmin((above_u + slack) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.05, 0.95))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED):
    """(network, prior), or None without positives or unlabelled text.  ``docs`` and
    ``labels`` are the training fold."""
    p = descriptions(sampling.labelled(docs, labels, "quality", 1, positives, 1))
    bound = sampling.share(unlabelled * 3 // 2, docs.count())
    known = labels.select("doc_id").filter(sampling.place(2) < bound).distinct()
    u = descriptions(sampling.one_an_id(docs.filter(sampling.place(2) < bound).join(F.broadcast(known), "doc_id", "left_anti")))
    if not len(p) or not len(u):
        return None
    prior = lowered(estimate_prior(p, u), len(p), len(u))
    return fit_pu(p, u, prior), prior


def lowered(prior: float, n: int, m: int) -> float:
    """Two standard errors below the estimate, since too high a prior hides the rarer
    negatives, but at least half of it and within (0, 1)."""
    error = float(np.sqrt(prior * (1 - prior) * (2 / n + 2 / m)))
    return float(np.clip(max(prior - 2 * error, prior / 2), 0.02, 0.98))


def score_rows(model, carried: list[str]):
    def run(batches):
        classes = byte_classes()
        for batch in batches:
            texts = common.binary_texts(batch)
            if not texts:
                continue
            x = np.stack([describe(raw, classes) for raw in texts]).astype(np.float64)
            s = sigmoid(model[0].score(x)) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*common.keep(batch, *carried), pa.array(s)], names=[*carried, "score"])

    return common.released(run)


def scored(docs: DataFrame, model) -> DataFrame:
    """Documents' id and fold with their score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(score_rows(model, ["doc_id", "held_out"]), f"doc_id {kind}, held_out boolean, score double")


def training_fold(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0):
    """Documents with held_out, and both tables' training rows."""
    docs = docs.withColumn("held_out", common.fold("doc_id", modulus) == held)
    return docs, docs.filter("not held_out"), labels.filter(common.fold("doc_id", modulus) != held)


def op2_pu_quality(spark, sf_dir: str) -> DataFrame:
    docs, train, labels = training_fold(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return scored(docs, fit(train, labels)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
