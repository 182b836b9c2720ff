"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are labelled rows of good quality; unlabelled web text is a sample of all documents, whose
labels are not looked at. The class prior (share of good text among the unlabelled) is estimated by the best bin
method: a first classifier tells positives from unlabelled text, and the prior is the least ratio of the share
of unlabelled rows above a threshold to the share of held-back positives above it. Then a small
network minimises

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the sigmoid loss; where the second term is negative, its gradient is followed backwards. Negative
labels are never used.

Features are counts over the whole text (shape of words and lines, repetition, character classes); ids,
language, source and labels are no features. Training reads at most ``MAX_ROWS`` rows of each kind, those
with the least hash of their id, and fits on the driver; scoring is one scan.

Defined cases: null and empty texts have zero features and get a score like any other; conflicting labels of
one id are averaged and only sure positives are used; without positives every score is the neutral 0.5; a repeated
row gives a repeated result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import fold, map_rows, text_column
from .rules import base_columns, char_histogram

MAX_ROWS = 20_000
HIDDEN = 32
STEPS = 1500
BATCH = 512
N_FEATURES = 28
_SPACE = K.is_word_byte("space")


def _upper() -> np.ndarray:
    out = np.zeros(256, bool)
    out[65:91] = True
    return out


_UPPER = _upper()
_LETTER = _upper() | np.roll(_upper(), 32) | (np.arange(256) >= 0xC0)


def features(chunk: K.Chunk) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per document of the chunk."""
    n = chunk.n
    base, docs, h = base_columns(chunk)
    words = base["n_words"].astype(float)
    per_word = 1 / np.maximum(words, 1)
    chars = char_histogram(chunk).astype(float)
    per_char = 1 / np.maximum(chars.sum(1), 1)
    starts, ends, _ = K.spans(chunk, _SPACE)
    count = lambda mask: np.bincount(docs[mask], minlength=n) * per_word
    length = ends - starts
    newline = np.ones(256, bool)
    newline[10] = False
    lines = np.bincount(K.spans(chunk, newline)[2], minlength=n).astype(float)
    if len(h):
        key = h ^ K.mix64(docs.astype(K.U64) + K.U64(1))
        uniques, first, counts = np.unique(key, return_index=True, return_counts=True)
        distinct = np.bincount(docs[first], minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, docs[first], counts)
        again = np.concatenate([[False], (h[1:] == h[:-1]) & (docs[1:] == docs[:-1])])
        head, tail = chunk.data[starts], chunk.data[ends - 1]
    else:
        distinct = most = np.zeros(n)
        again = np.zeros(0, bool)
        head = tail = np.zeros(0, np.uint8)
    letters = chars[:, 0] + chars[:, 1] + chars[:, 8]
    columns = [
        np.log1p(words),
        np.log1p(lines),
        words / np.maximum(lines, 1) / 100,
        base["word_chars"] * per_word / 5,
        *(chars[:, i] * per_char * 10 for i in range(10)),
        chars[:, 1] / np.maximum(letters, 1) * 4,
        letters * per_char * 4,
        base["n_symbols"] * per_word * 4,
        base["n_dup_lines"] / np.maximum(lines, 1) * 4,
        base["n_repeat_words"] * per_word * 4,
        distinct * per_word * 4,
        most * per_word * 4,
        count(again) * 4,
        count(length <= 3) * 4,
        count(length >= 12) * 4,
        count(_UPPER[head]) * 4,
        count((tail == 46) | (tail == 44)) * 4,
        count((length == 1) & ~_LETTER[head]) * 4,
        count(~_LETTER[tail] & (tail != 46) & (tail != 44)) * 4,
    ]
    return np.stack(columns, 1).astype(np.float32)


class Network:
    """Features to one number through a layer of rectifiers."""

    def __init__(self, positives: np.ndarray, unlabelled: np.ndarray, seed: int = 7):
        both = np.concatenate([positives, unlabelled]).astype(float)
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-3
        rng = np.random.default_rng(seed)
        d = both.shape[1]
        self.parameters = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def margin(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parameters
        return np.maximum(self.inputs(x) @ w + b, 0) @ v + c[0]

    def gradient(self, x: np.ndarray, of_margin: np.ndarray) -> list[np.ndarray]:
        w, b, v, _ = self.parameters
        x = self.inputs(x)
        hidden = np.maximum(x @ w + b, 0)
        back = np.outer(of_margin, v) * (hidden > 0)
        return [x.T @ back, back.sum(0), hidden.T @ of_margin, of_margin.sum(keepdims=True)]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(network: Network, positives, unlabelled, step_gradient, steps: int, seed: int, rate: float = 3e-3) -> Network:
    """Adam over random batches of both kinds, with decay of weights and of the rate."""
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in network.parameters]
    second = [np.zeros_like(p) for p in network.parameters]
    for t in range(1, steps + 1):
        p = positives[rng.integers(0, len(positives), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        now = rate * 0.5 * (1 + np.cos(np.pi * t / steps))
        for i, g in enumerate(step_gradient(network, p, u)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            network.parameters[i] -= now * (first[i] / (1 - 0.9**t) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8) + 1e-4 * network.parameters[i])
    return network


def _tell_apart(network: Network, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
    """Logistic loss of positives against unlabelled rows."""
    parts = [network.gradient(p, (sigmoid(network.margin(p)) - 1) / len(p)), network.gradient(u, sigmoid(network.margin(u)) / len(u))]
    return [a + b for a, b in zip(*parts, strict=True)]


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Best bin estimation of the share of positives among the unlabelled rows."""
    half = len(positives) // 2
    u_half = len(unlabelled) // 2
    network = _descend(Network(positives[:half], unlabelled[:u_half]), positives[:half], unlabelled[:u_half], _tell_apart, STEPS // 3, 11)
    p, u = np.sort(network.margin(positives[half:])), np.sort(network.margin(unlabelled[u_half:]))
    at = np.unique(np.concatenate([p, u]))
    share = lambda x: 1 - np.searchsorted(x, at, "left") / max(len(x), 1)
    qp, qu = share(p), share(u)
    slack = np.sqrt(np.log(4 / delta) / 2 / max(len(u), 1)) + np.sqrt(np.log(4 / delta) / 2 / max(len(p), 1))
    usable = qp > 0.05
    best = ((qu + slack) / np.maximum(qp, 1e-9))[usable].argmin()
    return float(np.clip(qu[usable][best] / qp[usable][best], 0.01, 0.99))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> tuple[Network, float]:
    prior = estimate_prior(positives, unlabelled) if prior is None else prior

    def risk(network: Network, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
        sp, su = sigmoid(network.margin(p)), sigmoid(network.margin(u))
        slope_p, slope_u = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        negative = su.mean() - prior * sp.mean()  # the unlabelled rows' risk as negatives without the positives among them
        if negative < 0:
            parts = [network.gradient(u, -slope_u), network.gradient(p, prior * slope_p)]
        else:
            parts = [network.gradient(u, slope_u), network.gradient(p, -2 * prior * slope_p)]
        return [a + b for a, b in zip(*parts, strict=True)]

    return _descend(Network(positives, unlabelled), positives, unlabelled, risk, STEPS, 13), prior


def _sample(docs: DataFrame, ids: DataFrame, max_rows: int) -> np.ndarray:
    """Features of the rows of at most ``max_rows`` ids, in the order of the ids' hashes."""
    some = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def each(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                x = features(chunk)
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    rows = docs.join(F.broadcast(some), "doc_id", "left_semi").mapInArrow(each, "doc_id long, x binary")
    rows = rows.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # at most max_rows rows of N_FEATURES numbers
    return np.array([np.frombuffer(x.as_buffer(), np.float32) for x in rows.column("x")], np.float32).reshape(-1, N_FEATURES)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, max_rows: int = MAX_ROWS) -> tuple[Network, float] | None:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(fold("doc_id", modulus) != held_out)
    sure = labels.where(fold("doc_id", modulus) != held_out).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("q")).where("q = 1").select("doc_id")
    positives = _sample(docs, sure.join(docs.select("doc_id"), "doc_id", "left_semi"), max_rows)
    unlabelled = _sample(docs, docs.select("doc_id"), max_rows)
    if len(positives) < 2 or len(unlabelled) < 2:
        return None
    return fit(positives, unlabelled)


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    model = train(docs, labels, modulus, held_out, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model[0] if model else None)

    def each(batches):
        network = shared.value
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                z = network.margin(features(chunk)) if network else np.zeros(chunk.n)
                score = sigmoid(z)
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = slim.mapInArrow(each, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "score", "predicted")


def keep_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5."""
    model = train(docs, labels, modulus, held_out, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model[0] if model else None)
    at = text_column(docs)

    def judge(batch):
        network = shared.value
        for chunk in K.chunks(batch.column(at).cast(pa.string())):
            rows = batch.slice(chunk.first, chunk.n)
            yield rows.filter(pa.array(sigmoid(network.margin(features(chunk))) >= 0.5)) if network else rows

    return map_rows(docs, judge).toDF(*docs.columns)
