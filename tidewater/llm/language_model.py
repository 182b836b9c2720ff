"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

    P(word | history) = P(class of word | history) * P(word | class, history)

The class comes from the word alone: the ``TOP_CLASSES`` most frequent words are classes of their own, other
words are classed by their last two bytes. P(class | history) is a softmax over hashed features: the previous
word, the two previous classes, and the word before the previous one (a skip). P(word | class, history) is a
product of softmaxes over the two halves of a Huffman tree of the words of the class (classes of classes), each a
maximum-entropy model of its node with, hashed, the previous word and the two previous classes; it starts from the counts, where each word
and one unknown word of the class have half a count more. A class of one word has no second factor.

Word counts are summed over all training texts. The weights start from the counts and are
trained by distributed gradient updates: in each of ``ROUNDS`` rounds every task goes through every position of its
training texts with AdaGrad, and the changes of all tasks are averaged in a shuffle whose tasks hold one slice of
the weights: those of classes weighted by positions, those of words by squared gradients, as few tasks meet most of them.

At most ``FREQUENT`` words and the most frequent ones are broadcast and are leaves of their own. The other words of a class
share one leaf, below which the bits of their hashes lead on, by the same model, to groups of ``GROUP`` words or
fewer on the average; within a group the counts decide. Whether a word is one of these or unknown is not known
where a text is read: both ways are scored, and the words of a text travel with them to the counts in buckets of the hash space, once per content
and task, and come back as sums.

Defined cases: null and empty texts consist of the end token; texts of the held-out fold are scored, never
learnt from; with no training text every token is unknown; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import Workspace, fold, shuffle_slices

TOP_CLASSES = 32
SHAPES = 32
CLASSES = TOP_CLASSES + SHAPES
HASHED = 2048  # rows of weights for each kind of feature, a power of two
FEATURES = 3
SLICES = 16
ROUNDS = 2
STEP = 1024
RATE = 0.5
PATIENCE = 1.0  # squared gradient that a row of weights is taken to have had: rare rows move little
FREQUENT = 1 << 18
FLUSH = 1 << 19
END = 0x5EED5EED5EED5EED
START = 0x0DDBA11
WORD_FEATURES = 2  # kinds of history in the second factor: the previous word, the two previous classes
WORD_BITS = 18  # 2**18 weights for each of them
WORD_STEP = 1 << 16  # a chunk of usual texts at once
WORD_RATE = 0.1  # most histories of a node are rare
WORD_PATIENCE = 10.0
GROUP = 4

_ONES = np.ones(max(CLASSES, FEATURES * STEP), np.float32)
_ORDER = np.tile(np.arange(STEP), FEATURES)
_ROW = np.dtype((np.void, 4 * CLASSES))  # a row of weights as one element: rows are stored faster so
_TABLE = K.is_word_byte("space")
_CODES = K.byte_codes(lower=True)
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.int64)
_SHAPE = (K.mix64((_LOWER[:, None] * 256 + _LOWER).ravel().astype(K.U64)) % K.U64(SHAPES)).astype(np.int64)  # by the last byte and the one before


class Tokens:
    """Words and ends of the documents of a chunk: hash, shape, document; ``edges`` are the documents' first tokens."""

    def __init__(self, chunk: K.Chunk):
        starts, ends, docs = K.spans(chunk, _TABLE)
        m = len(starts)
        self.sums = K.prefix_sums(chunk.data, _CODES)
        at = np.arange(m) + docs
        self.n = chunk.n
        self.hash = np.full(m + chunk.n, END, K.U64)
        self.shape = np.zeros(m + chunk.n, np.int64)
        if m:
            self.hash[at] = K.span_hash(self.sums, starts, ends)
            last = chunk.data[ends - 1].astype(np.int64)
            other = np.where(ends - starts > 1, chunk.data[np.maximum(ends - 2, 0)], 0)
            self.shape[at] = _SHAPE[last * 256 + other]
        counts = np.bincount(docs, minlength=chunk.n) + 1
        self.counts = counts
        self.edges = np.cumsum(counts) - counts
        self.doc = np.repeat(np.arange(chunk.n), counts)


def keep_memory() -> None:
    """A large array that is freed at once, after which malloc keeps what a chunk frees for the next one."""
    np.empty(31 << 20, np.uint8)


def find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``x`` in the sorted ``keys`` and whether they are there."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def _huffman(up: np.ndarray, start: np.ndarray, leaves: np.ndarray, mass: np.ndarray, node: int) -> int:
    """Joins ``leaves`` by nodes from ``node`` on, the two lightest first; returns the number after the last node.

    ``up`` gets twice the parent plus the side, ``start`` the log odds of side 1 by mass.
    """
    order = np.argsort(mass, kind="stable")
    leaves, mass = leaves[order].tolist(), mass[order].tolist()
    first = node
    joined: list[float] = []  # masses of the nodes, ascending
    i = j = 0
    for node in range(first, first + len(leaves) - 1):
        pair = []
        for side in (0, 1):
            if j == len(joined) or (i < len(leaves) and mass[i] <= joined[j]):
                up[leaves[i]] = 2 * node + side
                pair.append(mass[i])
                i += 1
            else:
                up[first + j] = 2 * node + side
                pair.append(joined[j])
                j += 1
        start[node] = np.log(pair[1] / pair[0])
        joined.append(pair[0] + pair[1])
    return first + max(len(leaves) - 1, 0)


@dataclass
class Decisions:
    """Sides taken at nodes: by the first ``sizes[i]`` tokens in ``order`` on their i-th step, then by those of ``tail``."""

    order: np.ndarray
    sizes: list[int]
    tail: np.ndarray
    mixed: np.ndarray  # hash of the node
    start: np.ndarray  # log odds of side 1 at the start
    sign: np.ndarray  # 1 for side 1

    def spread(self, x: np.ndarray) -> np.ndarray:
        """The value of ``x`` for the token of each decision."""
        own = x[self.order]
        return np.concatenate([*(own[:size] for size in self.sizes), x[self.tail]])

    def sums(self, y: np.ndarray) -> np.ndarray:
        """For each token the sum over its decisions."""
        own, a = np.zeros(len(self.order)), 0
        for size in self.sizes:
            own[:size] += y[a : a + size]
            a += size
        out = np.bincount(self.tail, y[a:], minlength=len(own)).astype(float)
        out[self.order] += own
        return out


class Vocabulary:
    """What the scoring needs to know of the counts; of bounded size.

    Leaf i is that of ``words[i]``; then come those of the unknown word of each shape, then those of the other words
    of each shape, then the nodes. ``bits`` of the hash lead on from the latter leaves.
    """

    def __init__(self, top: np.ndarray, words: np.ndarray, counts: np.ndarray, shapes: np.ndarray, class_words: np.ndarray, class_count: np.ndarray):
        order = np.argsort(words)
        self.words, counts, shapes = words[order], counts[order], shapes[order].astype(np.int64)
        self.logs = np.log10(counts + 0.5)
        self.total, self.distinct = int(class_count.sum()), int(class_words.sum())
        self.start = np.log((class_count + 1) / (class_count.sum() + CLASSES)).astype(np.float32)
        self.slot = K.U64(64 - max(1, len(words).bit_length()))
        self.first = np.searchsorted(self.words, np.arange(1 << (64 - int(self.slot)), dtype=K.U64) << self.slot).astype(np.int32)
        self.word_class = TOP_CLASSES + shapes
        at, there = find(self.words, top)
        self.word_class[at[there]] = np.flatnonzero(there)
        n = len(words)
        self.unknown, self.other, nodes = n, n + SHAPES, n + 2 * SHAPES
        self.up = np.full(2 * nodes, -1, np.int32)
        self.node_start = np.zeros(2 * nodes, np.float32)
        self.bits = np.zeros(SHAPES, np.int64)
        for shape in range(SHAPES):
            own = np.flatnonzero(self.word_class == TOP_CLASSES + shape)
            leaves, mass = np.append(own, self.unknown + shape), np.append(counts[own] + 0.5, 0.5)
            others = int(class_words[TOP_CLASSES + shape]) - len(own)
            if others > 0:
                left = class_count[TOP_CLASSES + shape] - counts[own].sum()
                leaves, mass = np.append(leaves, self.other + shape), np.append(mass, left + 0.5 * others)
                self.bits[shape] = max(0, -(-others // GROUP) - 1).bit_length()
            nodes = _huffman(self.up, self.node_start, leaves, mass, nodes)
        self.depth = np.zeros(len(self.up), np.uint8)
        at, up = np.arange(len(self.up)), self.up
        while len(at):
            at, up = at[up >= 0], up[up >= 0]
            self.depth[at] += 1
            up = self.up[up >> 1]

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``find`` in the words, from the first one with the same leading bits on."""
        if not len(self.words):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        last = len(self.words) - 1
        at = np.minimum(self.first[(x >> self.slot).astype(np.int64)], last)
        key = self.words[at]
        known = key == x
        left = np.flatnonzero(key < x)
        while len(left):
            left = left[at[left] < last]
            at[left] += 1
            key = self.words[at[left]]
            known[left] = key == x[left]
            left = left[key < x[left]]
        return at, known

    def places(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf (that of the other words if a word is not in ``words``), whether it is in ``words``, and class."""
        at, known = self.find(tokens.hash)
        if not len(self.words):
            return self.other + tokens.shape, known, TOP_CLASSES + tokens.shape
        return np.where(known, at, self.other + tokens.shape), known, np.where(known, self.word_class[at], TOP_CLASSES + tokens.shape)

    def classes(self, tokens: Tokens) -> np.ndarray:
        return self.places(tokens)[2]

    def group(self, word: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """Number of the group of other words."""
        lead = (K.mix64(word) >> (K.U64(63) - self.bits[shape].astype(K.U64))) >> K.U64(1)
        return (lead.astype(np.int64) << 6) + shape

    def decisions(self, leaf: np.ndarray, word: np.ndarray) -> Decisions:
        """Of the way from each leaf to the root and, for other words, on to their group."""
        depth = self.depth[leaf]
        order = np.argsort(depth, kind="stable")[::-1]  # short keys are sorted by radix
        sizes = len(leaf) - np.cumsum(np.bincount(depth, minlength=1))[:-1]
        up, ups = self.up[leaf[order]], []
        for size in sizes.tolist():
            ups.append(up[:size])
            up = self.up[ups[-1] >> 1]
        up = np.concatenate([*ups, np.zeros(0, np.int32)])
        node = up >> 1
        mixed, start, sign = node.astype(np.uint32) * np.uint32(0x9E3779B1), self.node_start.take(node), (2 * (up & 1) - 1).astype(np.float32)
        at = np.flatnonzero((leaf >= self.other) & (leaf < self.other + SHAPES))
        tail = [np.zeros(0, np.int64)]
        if len(at):
            shape = leaf[at] - self.other
            hash, bits = K.mix64(word[at]), self.bits[shape]
            for depth in range(int(bits.max())):
                go = bits > depth
                at, shape, hash, bits = at[go], shape[go], hash[go], bits[go]
                lead = (hash >> K.U64(63 - depth)) >> K.U64(1)
                node = K.mix64((lead << K.U64(12)) + K.U64(64 * depth) + shape.astype(K.U64))
                side = ((hash >> K.U64(63 - depth)) & K.U64(1)).astype(np.float32)
                tail.append(at)
                mixed, start, sign = np.append(mixed, (node >> K.U64(32)).astype(np.uint32)), np.append(start, np.zeros(len(at), np.float32)), np.append(sign, 2 * side - 1)
        return Decisions(order, sizes.tolist(), np.concatenate(tail), mixed, start, sign)


def histories(tokens: Tokens, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of what precedes each token: the previous word, the two previous classes, the word before the previous one."""
    n = len(classes)
    before, before2 = np.full(n, START, K.U64), np.full(n, START, K.U64)
    c1, c2 = np.full(n, CLASSES), np.full(n, CLASSES)
    before[1:], c1[1:] = tokens.hash[:-1], classes[:-1]
    before2[2:], c2[2:] = tokens.hash[:-2], classes[:-2]
    first, second = tokens.edges, (tokens.edges + 1)[tokens.counts > 1]
    before[first], c1[first] = START, CLASSES
    for at in (first, second):
        before2[at], c2[at] = START, CLASSES
    return K.mix64(before), K.mix64((c1 * (CLASSES + 1) + c2 + 1).astype(K.U64)), K.mix64(before2 + K.U64(0xABCD))


def history(tokens: Tokens, classes: np.ndarray) -> np.ndarray:
    """Rows of the weights that are active at each token."""
    return history_rows(histories(tokens, classes))


def history_rows(hashes: tuple[np.ndarray, ...]) -> np.ndarray:
    return np.stack([(h & K.U64(HASHED - 1)).astype(np.int64) + k * HASHED for k, h in enumerate(hashes)], 1)


class WordModel:
    """P(word | class, history): a weight for each node of the trees and history, hashed."""

    def __init__(self):
        self.weights = np.zeros((WORD_FEATURES, 1 << WORD_BITS), np.float32)

    def _odds(self, hashes: tuple[np.ndarray, ...], decisions: Decisions) -> tuple[np.ndarray, list]:
        """Log odds of the sides taken, and the weights' places."""
        z, keys = decisions.start.copy(), []
        for k in range(WORD_FEATURES):
            key = decisions.spread((hashes[k] >> K.U64(32)).astype(np.uint32))
            key ^= decisions.mixed
            key >>= np.uint32(32 - WORD_BITS)
            keys.append(key.astype(np.int64))
            z += self.weights[k].take(keys[-1])
        z *= decisions.sign
        return z, keys

    def log10(self, hashes: tuple[np.ndarray, ...], vocabulary: Vocabulary, leaf: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 P(word | class, history) of each token, down to its leaf or group."""
        out = np.empty(len(leaf))
        for a in range(0, len(leaf), WORD_STEP):
            b = min(a + WORD_STEP, len(leaf))
            decisions = vocabulary.decisions(leaf[a:b], word[a:b])
            z, _ = self._odds([h[a:b] for h in hashes], decisions)
            np.exp(np.negative(np.maximum(z, -80, out=z), out=z), out=z)
            z += 1
            out[a:b] = decisions.sums(np.log(z, out=z))
        return out / -np.log(10)

    def learn(self, hashes: tuple[np.ndarray, ...], vocabulary: Vocabulary, leaf: np.ndarray, word: np.ndarray, seen: np.ndarray) -> None:
        """One AdaGrad step; ``seen`` is the sum of squared gradients of each weight."""
        decisions = vocabulary.decisions(leaf, word)
        z, keys = self._odds(hashes, decisions)
        np.exp(np.minimum(z, 80, out=z), out=z)
        z += 1
        g = np.divide(decisions.sign, z, out=z)  # upwards
        for k, key in enumerate(keys):
            total = np.zeros(1 << WORD_BITS, np.float32)
            np.add.at(total, key, g)
            by = total * total
            seen[k] += by
            np.sqrt(np.add(seen[k], np.float32(WORD_PATIENCE), out=by), out=by)
            total *= np.float32(WORD_RATE)
            total /= by
            self.weights[k] += total


class MaxEnt:
    def __init__(self, bias: np.ndarray):
        self.bias = bias.astype(np.float32)
        self.weights = np.zeros((FEATURES * HASHED, CLASSES), np.float32)
        self.words = WordModel()

    def logits(self, rows: np.ndarray) -> np.ndarray:
        """Of each class, the largest of a row being 0 if some are too large or small for ``exp``."""
        z = self.weights.take(rows[:, 0], 0)
        for k in range(1, FEATURES):
            z += self.weights.take(rows[:, k], 0)
        z += self.bias
        if not len(z) or (z.max() < 40 and z.min() > -40):
            return z
        top = z
        while top.shape[1] > 1:  # CLASSES is a power of two; halves are faster than a maximum along short rows
            half = top.shape[1] // 2
            top = np.maximum(top[:, :half], top[:, half:])
        z -= top
        return z

    def log_softmax(self, rows: np.ndarray) -> np.ndarray:
        z = self.logits(rows)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z

    def log10(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 P(class | history) of each token, a cache-sized batch at a time."""
        out = np.empty(len(rows))
        for a in range(0, len(rows), STEP):
            b = min(a + STEP, len(rows))
            z = self.logits(rows[a:b])
            own = z[np.arange(b - a), classes[a:b]]
            out[a:b] = own - np.log(np.exp(z, out=z) @ _ONES[:CLASSES])
        return out / np.log(10)

    def learn(self, rows: np.ndarray, classes: np.ndarray, seen: np.ndarray) -> None:
        """One AdaGrad step; ``seen`` is the sum of squared gradients of each row."""
        g = self.logits(rows)
        n = len(g)
        np.exp(g, out=g)
        g *= (1 / (g @ _ONES[:CLASSES]))[:, None]
        g.reshape(-1)[np.arange(0, n * CLASSES, CLASSES) + classes] -= 1
        keys = rows.T.astype(np.uint16).ravel()  # short keys are sorted by radix
        order = np.argsort(keys, kind="stable")
        at = keys[order]
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        total, by = _run_sums(g, (_ORDER if n == STEP else np.tile(np.arange(n), FEATURES))[order], edge)
        at = at[edge[by]].astype(np.int64)
        squares = seen[at] + (total * total) @ _ONES[:CLASSES] / CLASSES
        seen[at] = squares
        total *= (RATE / np.sqrt(squares + PATIENCE)).astype(np.float32)[:, None]
        changed = self.weights.take(at, 0)
        changed -= total
        self.weights.view(_ROW).reshape(-1)[at] = changed.view(_ROW).reshape(-1)


def _run_sums(g: np.ndarray, row: np.ndarray, edge: np.ndarray, levels: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Sums of g[row] over the runs that begin at ``edge``, the longest run first, and the runs in this order.

    The second members of all runs are added at once, then the third ones, and so on; what a run has beyond
    ``levels`` members is summed by itself. ``reduceat`` along the first axis takes twice as long.
    """
    size = np.diff(edge, append=len(row))
    by = np.argsort((-size).astype(np.int16), kind="stable")  # short keys are sorted by radix; a step has FEATURES * STEP rows
    size, start = size[by], edge[by]
    total = g.take(row[start], 0)
    more = len(by) - np.searchsorted(size[::-1], np.arange(1, levels + 1), side="right")  # runs of more than 1, 2, .. members
    for r, k in enumerate(more[: levels - 1].tolist(), 1):
        if k:
            total[:k] += g.take(row[start[:k] + r], 0)
    k = int(more[-1])
    for i, a, z in zip(range(k), (start[:k] + levels).tolist(), (start[:k] + size[:k]).tolist()):
        total[i] += _ONES[: z - a] @ g.take(row[a:z], 0)
    return total, by


def _sum_counts(batches):
    """(word, shape, count) summed within the task."""
    keep_memory()
    held, size = [], 0

    def flush():
        words = np.concatenate([h[0] for h in held])
        uniques, first, at = np.unique(words, return_index=True, return_inverse=True)
        n = np.bincount(at, np.concatenate([h[2] for h in held])).astype(np.int64)
        return pa.record_batch([pa.array(K.as_long(uniques)), pa.array(np.concatenate([h[1] for h in held])[first].astype(np.int32)), pa.array(n)], names=["word", "shape", "n"])

    for batch in batches:
        for chunk in K.chunks(batch.column(0)):
            t = Tokens(chunk)
            uniques, first, n = np.unique(t.hash, return_index=True, return_counts=True)
            held.append((uniques, t.shape[first], n))
            size += len(uniques)
            if size > 2 * FLUSH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    counted = texts.select("text").mapInArrow(_sum_counts, "word long, shape int, n long")
    return counted.groupBy("word").agg(F.max("shape").alias("shape"), F.sum("n").alias("n"))


def _vocabulary(counts: DataFrame, frequent: int) -> Vocabulary:
    top = counts.orderBy(F.desc("n"), "word").limit(TOP_CLASSES).toArrow()
    is_top = F.col("word").isin(*top.column("word").to_pylist()) if len(top) else F.lit(False)
    totals = counts.where(~is_top).groupBy("shape").agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()  # one row per shape
    words, n = np.zeros(CLASSES), np.zeros(CLASSES)
    words[: len(top)], n[: len(top)] = 1, top.column("n").to_numpy()
    for r in totals:
        words[TOP_CLASSES + r.shape], n[TOP_CLASSES + r.shape] = r.words, r.n
    # the least count such that at most ``frequent`` words have it or more, from a histogram of some 500 steps
    step = F.floor(F.log2(F.col("n").cast("double")) * 8 + 1e-9).cast("int")
    steps = sorted(((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, sum_ = None, 0
    for at, some in steps:
        if sum_ + some > frequent:
            break
        least, sum_ = at, sum_ + some
    known = counts.where((step >= (least if least is not None else 1 << 20)) | is_top).select("word", "n", "shape").toArrow()
    return Vocabulary(top.column("word").to_numpy().view(K.U64), known.column("word").to_numpy().view(K.U64), known.column("n").to_numpy(), known.column("shape").to_numpy(), words, n)


def _train(texts: DataFrame, vocabulary: Vocabulary, rounds: int) -> MaxEnt:
    model = MaxEnt(vocabulary.start)
    context = texts.sparkSession.sparkContext
    size, word_size = FEATURES * HASHED // SLICES, (WORD_FEATURES << WORD_BITS) // SLICES
    names = ["slice", "positions", "change", "words", "squares"]
    kind = "slice long, positions long, change binary, words binary, squares binary"
    for _ in range(rounds):
        shared = context.broadcast((vocabulary, model))

        def each(batches, shared=shared):
            keep_memory()
            vocabulary, model = shared.value
            own = MaxEnt(model.bias)
            own.weights, own.words.weights = model.weights.copy(), model.words.weights.copy()
            seen, positions = np.zeros(FEATURES * HASHED, np.float32), 0
            word_seen = np.zeros_like(own.words.weights)
            for batch in batches:
                for chunk in K.chunks(batch.column(0)):
                    t = Tokens(chunk)
                    leaf, _, classes = vocabulary.places(t)
                    hashes = histories(t, classes)
                    rows = history_rows(hashes)
                    for a in range(0, len(rows), STEP):
                        own.learn(rows[a : a + STEP], classes[a : a + STEP], seen)
                    for a in range(0, len(rows), WORD_STEP):
                        part = slice(a, a + WORD_STEP)
                        own.words.learn([h[part] for h in hashes], vocabulary, leaf[part], t.hash[part], word_seen)
                    positions += len(rows)
            if positions:
                change = (own.weights - model.weights).astype(np.float16).reshape(SLICES, -1)
                words = (own.words.weights - model.words.weights).astype(np.float16).reshape(SLICES, -1)
                squares = np.sqrt(word_seen).astype(np.float16).reshape(SLICES, -1)
                blobs = (pa.array([c.tobytes() for c in x], pa.binary()) for x in (change, words, squares))
                yield pa.record_batch([pa.array(np.arange(SLICES)), pa.array(np.full(SLICES, positions)), *blobs], names=names)

        def average(batches):
            total: dict[int, list] = {}
            for batch in batches:
                for s, n, change, words, squares in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    got = total.setdefault(s, [0, np.zeros(size * CLASSES), np.zeros(word_size), np.zeros(word_size)])
                    got[0] += n
                    got[1] += n * np.frombuffer(change, np.float16).astype(float)
                    weight = np.frombuffer(squares, np.float16).astype(float) ** 2
                    got[2] += weight * np.frombuffer(words, np.float16).astype(float)
                    got[3] += weight
            for s, (n, change, words, squares) in total.items():
                blobs = (pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (change / n, words / np.maximum(squares, 1e-30), np.zeros(0)))
                yield pa.record_batch([pa.array([s]), pa.array([n]), *blobs], names=names)

        changes = texts.select("text").mapInArrow(each, kind)
        flat = model.words.weights.reshape(-1)
        for r in changes.repartition(SLICES, "slice").mapInArrow(average, kind).collect():  # the weights once
            model.weights[r.slice * size : (r.slice + 1) * size] += np.frombuffer(r.change, np.float32).reshape(size, CLASSES)
            flat[r.slice * word_size : (r.slice + 1) * word_size] += np.frombuffer(r.words, np.float32)
    return model


_SCORED = "kind int, doc_id long, content long, n_tokens long, known long, words double, history double, bucket long, entries binary"


def _blob(content: np.ndarray, word: np.ndarray, n: np.ndarray, other: np.ndarray, unknown: np.ndarray) -> bytes:
    start = np.flatnonzero(np.concatenate([[True], content[1:] != content[:-1]]))
    runs = np.diff(np.append(start, len(content))).astype(np.uint32)
    return b"".join(x.tobytes() for x in (np.array([len(start), len(content)], np.uint32), content[start], runs, word, n.astype(np.uint32), other.astype(np.float32), unknown.astype(np.float32)))


def _unblob(blob: bytes):
    runs, entries = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
    content = np.frombuffer(blob, np.uint64, runs, 8)
    run = np.frombuffer(blob, np.uint32, runs, 8 + 8 * runs)
    word = np.frombuffer(blob, np.uint64, entries, 8 + 12 * runs)
    n = np.frombuffer(blob, np.uint32, entries, 8 + 12 * runs + 8 * entries)
    other, unknown = (np.frombuffer(blob, np.float32, entries, 8 + 12 * runs + at * entries) for at in (12, 16))
    return np.repeat(content, run), word, n, other, unknown


def _score_scan(docs: DataFrame, vocabulary: Vocabulary, model: MaxEnt, buckets: int) -> DataFrame:
    """Kind 0: a document's sums over frequent words and histories. Kind 1: other words of contents, by bucket, with
    their sums of log10 P(word | class, history) as trained words, down to their group, and as unknown ones."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))

    def flush(held):
        content, word, n, other, unknown = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = ((K.mix64(word) >> K.U64(33)) % K.U64(buckets)).astype(np.int64)
        order = np.lexsort((word, content, bucket))
        content, word = content[order], word[order]
        new = np.ones(len(word), bool)  # copies within the task
        new[1:] = (word[1:] != word[:-1]) | (content[1:] != content[:-1])
        content, word = content[new], word[new]
        n, bucket, other, unknown = (x[order][new] for x in (n, bucket, other, unknown))
        start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(start[1:], len(bucket))
        blobs = [_blob(content[s:e], word[s:e], n[s:e], other[s:e], unknown[s:e]) for s, e in zip(start.tolist(), ends.tolist(), strict=True)]
        k = len(blobs)
        none = pa.nulls(k, pa.int64())
        return pa.record_batch([pa.array([1] * k, pa.int32()), none, none, none, none, pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.array(bucket[start]), pa.array(blobs, pa.binary())], names=_names)

    def each(batches):
        keep_memory()
        vocabulary, model = shared.value
        held, size = [], 0
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                t = Tokens(chunk)
                leaf, known, classes = vocabulary.places(t)
                hashes = histories(t, classes)
                context = model.log10(history_rows(hashes), classes)
                own = np.flatnonzero(known)
                context[own] += model.words.log10([h[own] for h in hashes], vocabulary, leaf[own], t.hash[own])
                logs = np.zeros(len(leaf))
                logs[own] = vocabulary.logs[leaf[own]]
                content = K.span_hash(t.sums, chunk.offsets[:-1], chunk.offsets[1:])
                sums = lambda x, t=t, n=chunk.n: np.bincount(t.doc, x, minlength=n)
                k = chunk.n
                yield pa.record_batch([pa.array(np.zeros(k, np.int32)), batch.column(0).slice(chunk.first, k), pa.array(K.as_long(content)), pa.array(t.counts.astype(np.int64)), pa.array(sums(known).astype(np.int64)), pa.array(sums(logs)), pa.array(sums(context)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], names=_names)
                rare = np.flatnonzero(~known)
                if len(rare):
                    # a content's words once with their number: copies in the chunk count once
                    first_doc = np.unique(content, return_index=True)[1]
                    rare = rare[np.isin(t.doc[rare], first_doc)]
                    rare = rare[np.lexsort((t.hash[rare], t.doc[rare]))]
                    doc, word, shape = t.doc[rare], t.hash[rare], t.shape[rare]
                    start = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])]))
                    sides = (np.add.reduceat(model.words.log10([h[rare] for h in hashes], vocabulary, side + shape, word), start) for side in (vocabulary.other, vocabulary.unknown))
                    held.append((content[doc[start]], word[start], np.diff(np.append(start, len(word))), *sides))
                    size += len(start)
                if size > FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    _names = ["kind", "doc_id", "content", "n_tokens", "known", "words", "history", "bucket", "entries"]
    return docs.mapInArrow(each, _SCORED)


def _rare_sums(scan: DataFrame, counts: DataFrame, vocabulary: Vocabulary, buckets: int, slices: int) -> DataFrame:
    """(content, rare_words, rare_score, rare_known): sums over the words that the broadcast counts lack."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)

    def grouped(batches):
        for batch in batches:
            word, n, shape = batch.column(0).to_numpy().view(K.U64), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
            left = ~shared.value.find(word)[1]
            word, n, shape = word[left], n[left], shape[left]
            yield pa.record_batch([pa.array(K.as_long(word)), pa.array(n), pa.array(shared.value.group(word, shape))], names=["word", "n", "part"])

    def pack(batches):
        for batch in batches:
            word, n, mass = batch.column(0).to_numpy().view(K.U64), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            bucket = ((K.mix64(word) >> K.U64(33)) % K.U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            word, n, mass, bucket = word[order], n[order], mass[order], bucket[order]
            if not len(word):
                continue
            start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(start[1:], len(bucket))
            blobs = [word[s:e].tobytes() + n[s:e].astype(np.int64).tobytes() + mass[s:e].astype(float).tobytes() for s, e in zip(start.tolist(), ends.tolist(), strict=True)]
            yield pa.record_batch([pa.array(np.zeros(len(blobs), np.int32)), pa.array(bucket[start]), pa.array(blobs, pa.binary())], names=["kind", "bucket", "entries"])

    def meet(held, out):
        words, n, mass = [], [], []
        for kind, blob in held:
            if kind == 0:
                three = np.frombuffer(blob, np.uint64).reshape(3, -1)
                words.append(three[0])
                n.append(three[1].view(np.int64))
                mass.append(three[2].view(float))
        asked = [_unblob(blob) for kind, blob in held if kind == 1]
        if not asked:
            return
        words, n, mass = (np.concatenate([*x, np.zeros(0, kind)]) for x, kind in ((words, np.uint64), (n, np.int64), (mass, float)))
        order = np.argsort(words)
        words, n, mass = words[order], n[order], mass[order]
        content, word, times, other, unknown = (np.concatenate(x) for x in zip(*asked, strict=True))
        order = np.lexsort((word, content))  # copies in other tasks
        content, word = content[order], word[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (content[1:] != content[:-1])
        content, word = content[new], word[new]
        times, other, unknown = (x[order][new].astype(float) for x in (times, other, unknown))
        at, known = find(words, word)
        logs = np.full(len(word), np.log10(0.5))
        score = unknown
        if len(n):
            logs[known] = np.log10(n[at[known]] + 0.5)
            score[known] = (other + times * (logs - np.log10(mass[at])))[known]
        out.append((content, times * logs, score, times * known))

    def sums(out):
        content, words, score, known = (np.concatenate(x) for x in zip(*out, strict=True))
        uniques, at = np.unique(content, return_inverse=True)
        return uniques, np.bincount(at, words), np.bincount(at, score), np.bincount(at, known).astype(np.int64)

    def each(batches):
        bucket, held, out, size = None, [], [], 0
        for batch in batches:
            for kind, b, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if b != bucket and held:
                    meet(held, out)
                    held = []
                    if sum(len(o[0]) for o in out) > 2 * FLUSH:
                        out = [sums(out)]
                bucket = b
                held.append((kind, blob))
        if held:
            meet(held, out)
        if out:
            content, words, score, known = sums(out)
            yield pa.record_batch([pa.array(K.as_long(content)), pa.array(words), pa.array(score), pa.array(known)], names=["content", "words", "score", "known"])

    others = counts.select("word", "n", "shape").mapInArrow(grouped, "word long, n long, part long")
    others = others.withColumn("mass", F.sum(F.col("n") + 0.5).over(Window.partitionBy("part")))
    packed = others.select("word", "n", "mass").mapInArrow(pack, "kind int, bucket long, entries binary").unionByName(scan.where("kind = 1").select("kind", "bucket", "entries"))
    met = packed.repartition(slices, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(each, "content long, words double, score double, known long")
    return met.groupBy("content").agg(F.sum("words").alias("rare_words"), F.sum("score").alias("rare_score"), F.sum("known").alias("rare_known"))


def score_texts(docs: DataFrame, work: Workspace | None = None, modulus: int = 5, held_out: int = 1, frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """One row per document with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    spark = docs.sparkSession
    work = work or Workspace(spark, "lm")
    slices = shuffle_slices(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.where(fold("doc_id", modulus) != held_out)
    counts = work.write(word_counts(training), "counts")
    vocabulary = _vocabulary(counts, frequent)
    model = _train(training, vocabulary, rounds)
    buckets = 4 * slices
    scan = work.write(_score_scan(docs, vocabulary, model, buckets), "scan")
    rare = _rare_sums(scan, counts, vocabulary, buckets, slices)
    rows = scan.where("kind = 0").join(rare, "content", "left")
    words = F.col("words") + F.coalesce("rare_words", F.lit(0.0))
    log_total = float(np.log10(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    return rows.select(
        "doc_id",
        (fold("doc_id", modulus) == held_out).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("history") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
