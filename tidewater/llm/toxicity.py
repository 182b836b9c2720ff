"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words and their beginnings of 4, 5 and 6 bytes, hashed into ``BUCKETS``. The score of a text is

    bias + sum of weights + sum over pairs of <factor_i, factor_j>

through the logistic function, so that two terms can mean more together (an insult with a
mention of a group) than their weights add up to. Every bucket met in the training rows has a weight and
factors, also where it says nothing alone; that is at most ``BUCKETS`` rows of ``FACTORS`` + 1 numbers (36 MB).

At most ``MAX_ROWS`` labelled rows, those with the least hash of their id, are used for training; the buckets of
their texts, four bytes each, are fitted on the driver by AdaGrad, a step touching only the buckets of its rows. Rare
buckets move less, and so do weights (not factors) of those as frequent in toxic as in other rows; none is left out.
Scoring is one scan of all texts; a bucket that no training row has adds nothing.

Defined cases: null and empty texts get the score of a text without terms; labels of one id are averaged and rows
without a majority are left out; with one class only, every score is that class's smoothed share; a repeated row
gives a repeated result; ids, language, source and labels are no inputs; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import fold

BUCKETS = 1 << 20
FACTORS = 8
RATE = 0.5
PAIRS = 0.02  # rate of factors, relative to that of weights
SPREAD = 0.002  # of the first factors
PATIENCE = 1e-2  # squared gradient that weights and factors are taken to have had
SHRINK = 50  # documents: a term in as many moves at half the rate
DOUBT = 400.0  # squared standard errors: a term that is as far from the share of all rows has its weight moved at half the rate
LEAST = 0.005  # of the rate, for the weight of a term that says nothing alone; its factors are not slowed
EPOCHS = 12
MIN_STEPS = 600  # small inputs are gone through more often
BATCH = 256
FLUSH = 1 << 20
MAX_ROWS = 50_000
BEGINNINGS = (4, 5, 6)
_TABLE = K.is_word_byte("alnum")
_CODES = K.byte_codes(lower=True)


def term_buckets(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word and beginning, with repeats."""
    starts, ends, docs = K.spans(chunk, _TABLE)
    if not len(starts):
        return docs, docs
    sums = K.prefix_sums(chunk.data, _CODES)
    parts = [(docs, K.span_hash(sums, starts, ends))]
    for n in BEGINNINGS:
        longer = ends - starts > n
        parts.append((docs[longer], K.mix64(K.span_hash(sums, starts[longer], starts[longer] + n) + K.U64(n))))
    return np.concatenate([p[0] for p in parts]), (np.concatenate([p[1] for p in parts]) % K.U64(BUCKETS)).astype(np.int64)


def _present(docs: np.ndarray, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique(docs * width + terms)
    return code // width, code % width


class FactorizationMachine:
    def __init__(self, buckets: np.ndarray, factors: int = FACTORS, seed: int = 5):
        self.lookup = np.full(BUCKETS, -1, np.int32)
        self.lookup[buckets] = np.arange(len(buckets))
        self.terms = len(buckets)
        rng = np.random.default_rng(seed)
        self.bias, self.weights = 0.0, np.zeros(self.terms, np.float32)
        self.factors = rng.normal(0, SPREAD, (self.terms, factors)).astype(np.float32)

    def margin(self, docs: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` texts given their distinct terms, documents ascending."""
        edges = np.searchsorted(docs, np.arange(n + 1))
        return self._margin(edges, self.weights[terms], self.factors[terms])[0]

    def _margin(self, edges: np.ndarray, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins of texts whose terms lie between ``edges``, and their sums of factors."""
        some = edges[1:] > edges[:-1]
        part = lambda x, like: _sums(x, edges[:-1][some], some, like)
        total = part(v, np.zeros((len(some), v.shape[1])))
        linear, square = part(w, np.zeros(len(some))), part(np.einsum("ij,ij->i", v, v), np.zeros(len(some)))
        return self.bias + linear + 0.5 * ((total**2).sum(1) - square), total

    def fit(self, edges: np.ndarray, terms: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, decay: float = 1e-5, seed: int = 3) -> None:
        """``terms`` of row i are those from ``edges[i]`` up to ``edges[i + 1]``."""
        n = len(y)
        share = (y.sum() + 0.5) / (n + 1)
        self.bias = float(np.log(share / (1 - share)))
        if y.min() == y.max():
            return
        rng = np.random.default_rng(seed)
        hb, hw, hv = 1e-6, np.full(self.terms, PATIENCE, np.float32), np.full(self.factors.shape, PATIENCE, np.float32)
        place = np.zeros(self.terms, np.int32)
        count, toxic = np.zeros(self.terms), np.zeros(self.terms)
        for at in range(0, n, BATCH):
            own = edges[at : at + BATCH + 1]
            part = terms[own[0] : own[-1]]
            count += np.bincount(part, minlength=self.terms)
            toxic += np.bincount(part, np.repeat(y[at : at + BATCH], np.diff(own)), self.terms)
        trust = count / (count + SHRINK)
        apart = (toxic - count * share) ** 2 / (count * share * (1 - share) + 1e-9)  # squared standard errors from the share of all rows
        alone = trust * np.maximum(apart / (apart + DOUBT), LEAST)
        for _ in range(max(epochs, -(-MIN_STEPS * BATCH // n))):
            order = rng.permutation(n)
            for at in range(0, n, BATCH):
                rows = order[at : at + BATCH]
                counts = edges[rows + 1] - edges[rows]
                t = terms[K.expand(edges[rows], counts)]
                d = np.repeat(np.arange(len(rows)), counts)
                met = np.flatnonzero(np.bincount(t, minlength=self.terms))
                place[met] = np.arange(len(met))
                own = place[t]
                v = self.factors[t]
                z, total = self._margin(np.concatenate([[0], np.cumsum(counts)]), self.weights[t], v)
                slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
                each = slope[d]
                gw = np.bincount(own, each, len(met)) + decay * self.weights[met]
                # sum of slope * (total - factor) over the rows with the term
                gv = np.stack([np.bincount(own, (slope * column)[d], len(met)) for column in total.T], 1)
                gv -= np.bincount(own, each, len(met))[:, None] * self.factors[met]
                gv += decay * self.factors[met]
                gb = float(slope.sum())
                hb += gb * gb
                hw[met] += gw * gw
                hv[met] += gv * gv
                self.bias -= rate * gb / np.sqrt(hb)
                self.weights[met] -= rate * alone[met] * gw / np.sqrt(hw[met])
                self.factors[met] -= PAIRS * rate * trust[met, None] * gv / np.sqrt(hv[met])


def _sums(x: np.ndarray, starts: np.ndarray, some: np.ndarray, out: np.ndarray) -> np.ndarray:
    if len(starts):
        out[some] = np.add.reduceat(x, starts, axis=0, dtype=float)
    return out


def _rows_of(batches):
    """The distinct buckets of every row, ascending, four bytes each."""
    for batch in batches:
        for chunk in K.chunks(batch.column(1)):
            docs, terms = _present(*term_buckets(chunk), BUCKETS)
            edges = np.searchsorted(docs, np.arange(chunk.n + 1)).tolist()
            terms = terms.astype(np.uint32)
            rows = [terms[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), batch.column(2).slice(chunk.first, chunk.n), pa.array(rows, pa.binary())], names=["doc_id", "y", "terms"])


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, max_rows: int = MAX_ROWS) -> FactorizationMachine:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(fold("doc_id", modulus) != held_out)
    sure = labels.where(fold("doc_id", modulus) != held_out).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("toxic").alias("t")).where("t <> 0.5")
    some = sure.select("doc_id", F.when(F.col("t") > 0.5, 1).otherwise(0).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.join(F.broadcast(some), "doc_id").select("doc_id", "text", "y")  # at most max_rows ids and labels
    matrix = rows.mapInArrow(_rows_of, "doc_id long, y int, terms binary").select("y", "terms", F.xxhash64("doc_id").alias("h"), "doc_id").toArrow()  # max_rows rows of some hundred buckets
    y, terms = matrix.column("y").to_numpy().astype(float), [x.as_buffer() for x in matrix.column("terms")]
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        model = FactorizationMachine(np.zeros(0, np.int64))
        model.bias = float(np.log((n1 + 0.5) / (n0 + 0.5)))
        return model
    h, ids = matrix.column("h").to_pylist(), matrix.column("doc_id").to_pylist()
    order = sorted(range(len(y)), key=lambda i: (h[i], ids[i], bytes(terms[i])))
    edges = np.concatenate([[0], np.cumsum([terms[i].size // 4 for i in order])])
    sets = np.empty(edges[-1], np.int32)
    for a, i in zip(edges.tolist(), order, strict=False):
        sets[a : a + terms[i].size // 4] = np.frombuffer(terms[i], np.int32)
    del matrix, terms
    met = np.zeros(BUCKETS, bool)
    for a in range(0, len(sets), FLUSH):  # in blocks: the driver holds the buckets once
        met[sets[a : a + FLUSH]] = True
    model = FactorizationMachine(np.flatnonzero(met))
    for a in range(0, len(sets), FLUSH):
        sets[a : a + FLUSH] = model.lookup[sets[a : a + FLUSH]]
    model.fit(edges, sets, y[order])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, modulus, held_out, max_rows))

    def each(batches):
        model = shared.value
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                docs_of, terms = term_buckets(chunk)
                known = model.lookup[terms] >= 0
                docs_of, terms = _present(docs_of[known], model.lookup[terms[known]].astype(np.int64), BUCKETS)
                score = 1 / (1 + np.exp(-np.clip(model.margin(docs_of, terms, chunk.n), -30, 30)))
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = slim.mapInArrow(each, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "score", "predicted")
