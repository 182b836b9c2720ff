"""A training step of the language model against a plain one, position by position."""

import zlib

import numpy as np
import pytest

from tidewater.llm import common
from tidewater.llm import language_model as L


@pytest.mark.parametrize("n, hot", [(1, 0.0), (40, 0.0), (700, 0.3), (1024, 0.9)])
def test_step_equals_a_plain_one(n, hot):
    r = np.random.default_rng(n)
    rows = np.stack([np.where(r.random(n) < hot, 7, r.integers(0, L.HASHED, n)) + k * L.HASHED for k in range(L.FEATURES)], 1)
    classes = r.integers(0, L.CLASSES, n)
    model = L.MaxEnt(r.normal(size=L.CLASSES))
    model.weights = r.normal(size=model.weights.shape).astype(np.float32) * 0.3
    weights, bias = model.weights.astype(float), model.bias.astype(float)
    seen = r.random(len(weights)).astype(np.float32)
    squares, gradient = seen.astype(float), {}
    for row, c in zip(rows, classes):
        z = bias + sum(weights[k] for k in row)
        p = np.exp(z - z.max())
        p /= p.sum()
        p[c] -= 1
        for k in row:
            gradient[k] = gradient.get(k, 0) + p
    for k, g in gradient.items():
        squares[k] += (g * g).sum() / L.CLASSES
        weights[k] -= L.RATE / np.sqrt(squares[k] + L.PATIENCE) * g
    model.learn(rows, classes, seen)
    assert np.allclose(model.weights, weights, atol=2e-4) and np.allclose(seen, squares, rtol=1e-3)


def test_log10_is_a_distribution():
    r = np.random.default_rng(1)
    model = L.MaxEnt(r.normal(size=L.CLASSES))
    model.weights = r.normal(size=model.weights.shape).astype(np.float32)
    row = np.array([[5, L.HASHED + 5, 2 * L.HASHED + 5]])
    total = sum(10 ** model.log10(row, np.array([c]))[0] for c in range(L.CLASSES))
    assert total == pytest.approx(1, abs=1e-4)


def _vocabulary(words, counts, shapes, broadcast):
    """As counted from a text: no classes of one word, the first ``broadcast`` words known everywhere."""
    class_words, class_count = np.zeros(L.CLASSES), np.zeros(L.CLASSES)
    np.add.at(class_words, L.TOP_CLASSES + shapes, 1)
    np.add.at(class_count, L.TOP_CLASSES + shapes, counts)
    return L.Vocabulary(np.zeros(0, np.uint64), words[:broadcast], counts[:broadcast], shapes[:broadcast], class_words, class_count)


@pytest.mark.parametrize("broadcast", [0, 30, 400])
def test_words_of_a_class_are_a_distribution(broadcast):
    r = np.random.default_rng(2)
    words, counts, shapes = L.K.mix64(np.arange(1, 401).astype(np.uint64)), np.sort(r.zipf(1.3, 400).clip(max=10**6))[::-1], r.integers(0, 3, 400)
    v = _vocabulary(words, counts, shapes, broadcast)
    at, known = v.find(words)
    assert known.sum() == broadcast and (v.words[at[known]] == words[known]).all()
    model = L.WordModel()
    for start in (True, False):
        for shape in range(4):
            some = L.K.mix64(np.arange(10**6, 10**6 + 5000).astype(np.uint64))
            groups = some[np.unique(v.group(some, np.full(5000, shape)), return_index=True)[1]] if (shapes[broadcast:] == shape).any() else some[:0]
            own = np.flatnonzero(v.word_class == L.TOP_CLASSES + shape)
            leaf = np.concatenate([own, [v.unknown + shape], np.full(len(groups), v.other + shape)])
            word = np.concatenate([v.words[own], some[:1], groups])
            assert len(groups) in (0, 1 << v.bits[shape])
            hashes = [np.full(len(leaf), h, np.uint64) for h in (11 << 40, 22 << 40, 33 << 40)]
            got = 10 ** model.log10(hashes, v, leaf, word)
            assert got.sum() == pytest.approx(1, abs=1e-4)
            if start and len(own):  # without weights the counts decide
                mass = (counts + 0.5)[shapes == shape].sum() + 0.5
                assert got[: len(own)] * mass == pytest.approx([counts[words == x][0] + 0.5 for x in v.words[own]], rel=1e-3)
        model.weights[:] = r.normal(size=model.weights.shape)


def test_word_step_equals_a_plain_one():
    r = np.random.default_rng(3)
    words, counts, shapes = L.K.mix64(np.arange(1, 201).astype(np.uint64)), r.integers(1, 50, 200), r.integers(0, 3, 200)
    v = _vocabulary(words, counts, shapes, 120)
    pick = r.integers(0, 200, 300)
    at, known = v.find(words[pick])
    leaf = np.where(known, at, v.other + shapes[pick])
    hashes = [L.K.mix64(r.integers(0, 9, 300).astype(np.uint64) + np.uint64(100 * k)) for k in range(L.WORD_FEATURES)]
    model, seen = L.WordModel(), np.zeros((L.WORD_FEATURES, 1 << L.WORD_BITS), np.float32)
    model.weights[:] = 0.3 * r.normal(size=model.weights.shape)
    before = model.weights.astype(float)
    gradient = {}
    for i in range(300):
        d = v.decisions(leaf[i : i + 1], words[pick[i : i + 1]])
        for node, start, sign in zip(d.mixed, d.start, d.sign):
            places = [(k, int((np.uint32(int(hashes[k][i]) >> 32) ^ node) >> np.uint32(32 - L.WORD_BITS))) for k in range(L.WORD_FEATURES)]
            z = sign * (start + sum(before[p] for p in places))
            for p in places:
                gradient[p] = gradient.get(p, 0) + sign / (1 + np.exp(z))
    model.learn(hashes, v, leaf, words[pick], seen)
    want = before.copy()
    for p, g in gradient.items():
        want[p] += L.WORD_RATE / np.sqrt(g * g + L.WORD_PATIENCE) * g
    assert np.allclose(model.weights, want, atol=1e-5)


@pytest.mark.parametrize("frequent", [10_000, 40])
def test_word_within_its_class_depends_on_history(spark, frequent):
    """Every first word has one second word; all second words have the same ending, so one class, and the same count."""
    common.ship_package(spark)
    fill = " ".join(f"f{i:02d}" for i in range(40))  # the classes of one word
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    learnt, asked = [i for i in range(900) if not held(i)][:600], [i for i in range(900, 2000) if held(i)][:60]
    pair = lambda a, b: f"{a}first {b}second"
    rows = [(i, " ".join([fill, *(pair(k % 30, k % 30) for k in (i, 7 * i + 1))])) for i in learnt]
    rows += [(i, pair(k % 30, (k + 11 * (k >= 30)) % 30)) for k, i in enumerate(asked)]
    got = {r.doc_id: r for r in L.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent).collect()}
    right, wrong = [got[i] for i in asked[:30]], [got[i] for i in asked[30:]]
    assert all(r.held_out and r.n_known == 3 for r in right + wrong)
    assert sum(r.base_score for r in right) == pytest.approx(sum(r.base_score for r in wrong))
    gain = np.mean([r.score for r in right]) - np.mean([r.score for r in wrong])
    assert gain > 0.04, gain
