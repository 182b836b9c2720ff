"""Quality rules by distribution divergence.

Every document's character-class histogram and common-word histogram are compared with language
references by the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1). The
references are grouped counts over all documents that pass the base rules: character classes per
language, and the ``COMMON_WORDS`` most frequent words per language with all other words as one class.
A document is held against the language whose common words are nearest.

Defined cases: null and empty texts have no words, fail the base rules and have null distances; texts
under ``MIN_WORDS`` words are never judged by divergence (the base rules decide); languages whose
reference has under ``MIN_REFERENCE_WORDS`` words are left out, and without any reference only the base
rules decide; a null language is a group of its own; repeated rows give repeated results; ties
between languages go to the first by name. The references of all other languages, some 2 KB each, are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K

COMMON_WORDS = 100
MIN_WORDS = 50
MIN_REFERENCE_WORDS = 1000
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.455

_SPACE = K.is_word_byte("space")
_CODES = K.byte_codes()
_LOWER_CODES = K.byte_codes(lower=True)
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LEAD = np.arange(256) & 0xC0 != 0x80


def _char_classes() -> np.ndarray:
    """Class of each byte; continuation bytes belong to their lead byte and get the class that is never counted."""
    out = np.full(256, 9)  # other ASCII
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[32]], out[10] = 3, 4
    out[[46, 44]] = 5  # . ,
    out[[33, 63, 58, 59, 39, 34, 45, 40, 41]] = 6  # ! ? : ; ' " - ( )
    out[_SYMBOLS] = 7
    out[0xC0:] = 8  # beyond ASCII
    out[0x80:0xC0] = 10
    return out


_CLASSES = _char_classes()
N_CLASSES = 10


def base_columns(chunk: K.Chunk):
    """Counts of the base rules for each document of a chunk, and the word hashes they came from."""
    n, data = chunk.n, chunk.data
    starts, ends, docs = K.spans(chunk, _SPACE)
    n_words, _ = K.run_lengths(docs, n)
    if not len(data):
        zero = np.zeros(n, np.int64)
        return {"n_words": n_words, "word_chars": zero, "n_symbols": zero, "n_dup_lines": zero, "n_repeat_words": zero}, docs, np.zeros(0, K.U64)
    sizes = np.diff(chunk.offsets)
    per_doc = lambda mask: K.segment_sums(mask.astype(np.int64), chunk.offsets[:-1], sizes)
    sums = K.prefix_sums(data, _CODES)
    h = K.span_hash(sums, starts, ends)
    # words inside three-word windows that the text has at least twice
    at, g = K.windows(h, docs, 3)
    key = g ^ K.mix64(docs[at].astype(K.U64) + K.U64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    mark = np.zeros(len(h) + 3, np.int64)
    np.add.at(mark, at[repeated], 1)
    np.add.at(mark, at[repeated] + 3, -1)
    inside = np.cumsum(mark)[: len(h)] > 0
    # lines with a word that equal an earlier line of the same text
    newline = np.ones(256, bool)
    newline[10] = False
    line_start, line_end, line_doc = K.spans(chunk, newline)
    word_at = np.searchsorted(starts, line_start)
    has_word = (word_at < len(starts)) & (np.append(starts, 0)[word_at] < line_end)
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    line = K.span_hash(sums, line_start, line_end) ^ K.mix64(line_doc.astype(K.U64) + K.U64(1))
    earlier = np.ones(len(line), bool)
    earlier[np.unique(line, return_index=True)[1]] = False
    return {
        "n_words": n_words,
        "word_chars": per_doc(_SPACE[data] & _LEAD[data]),
        "n_symbols": per_doc(_SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_doc[earlier], minlength=n),
        "n_repeat_words": np.bincount(docs[inside], minlength=n),
    }, docs, h


def base_failed(base: dict) -> np.ndarray:
    return (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])


def char_histogram(chunk: K.Chunk) -> np.ndarray:
    doc = np.repeat(np.arange(chunk.n), np.diff(chunk.offsets))
    width = N_CLASSES + 1
    return np.bincount(doc * width + _CLASSES[chunk.data], minlength=chunk.n * width).reshape(chunk.n, width)[:, :N_CLASSES]


def folded_hashes(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes for the common-word histogram: A-Z as a-z, without punctuation at the edges being cut off."""
    starts, ends, docs = K.spans(chunk, _SPACE)
    if not len(starts):
        return docs, np.zeros(0, K.U64)
    return docs, K.span_hash(K.prefix_sums(chunk.data, _LOWER_CODES), starts, ends)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows of ``p`` against ``q``; both are made to sum to one. In [0, 1]."""
    p = p / np.maximum(p.sum(-1, keepdims=True), 1e-300)
    q = q / np.maximum(q.sum(-1, keepdims=True), 1e-300)
    m = (p + q) / 2

    def part(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(-1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


class References:
    """Per language: character classes, and counts of its common words (last: all other words)."""

    def __init__(self, chars: dict[str, np.ndarray], words: dict[str, dict[int, int]], totals: dict[str, int]):
        self.languages = sorted(chars)
        self.chars = np.array([chars[x] for x in self.languages], float).reshape(len(self.languages), N_CLASSES)
        self.keys, self.words = [], []
        for x in self.languages:
            ordered = sorted(words.get(x, {}).items())
            self.keys.append(np.array([k for k, _ in ordered], K.U64))
            counts = np.array([n for _, n in ordered], float)
            self.words.append(np.append(counts, max(0.0, totals[x] - counts.sum())))

    def distances(self, chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language by common words, and both distances from it."""
        n = chunk.n
        docs, h = folded_hashes(chunk)
        by_words = np.ones((len(self.languages), n))
        for i, (keys, reference) in enumerate(zip(self.keys, self.words, strict=True)):
            at = np.searchsorted(keys, h)
            known = at < len(keys)
            known[known] = keys[at[known]] == h[known]
            at = np.where(known, at, len(keys))
            width = len(keys) + 1
            histogram = np.bincount(docs * width + at, minlength=n * width).reshape(n, width)
            by_words[i] = js_distance(histogram.astype(float), reference)
        nearest = by_words.argmin(0)
        by_chars = js_distance(char_histogram(chunk).astype(float), self.chars[nearest])
        return nearest, by_words[nearest, np.arange(n)], by_chars


def _gather(batches):
    """Character classes (key = class) and words (key = hash) by language, summed within the task."""
    chars: dict[str, np.ndarray] = {}
    words: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush():
        for lang, parts in words.items():
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.record_batch([pa.array([lang] * len(keys), pa.string()), pa.array(np.ones(len(keys), np.int32)), pa.array(K.as_long(keys)), pa.array(counts)], names=["lang", "kind", "key", "n"])
        words.clear()

    held = 0
    for batch in batches:
        langs = np.array([x or "" for x in batch.column(1).to_pylist()], object)
        for chunk in K.chunks(batch.column(0)):
            good = ~base_failed(base_columns(chunk)[0])
            docs, h = folded_hashes(chunk)
            histogram = char_histogram(chunk)
            own = langs[chunk.first : chunk.first + chunk.n]
            for lang in set(own[good]):
                mine = good & (own == lang)
                chars[lang] = chars.get(lang, 0) + histogram[mine].sum(0)
                keys, counts = np.unique(h[mine[docs]], return_counts=True)
                words.setdefault(lang, []).append((keys, counts))
                held += len(keys)
        if held > 1_500_000:
            yield from flush()
            held = 0
    yield from flush()
    for lang, histogram in chars.items():
        yield pa.record_batch([pa.array([lang] * N_CLASSES, pa.string()), pa.array(np.zeros(N_CLASSES, np.int32)), pa.array(np.arange(N_CLASSES)), pa.array(histogram.astype(np.int64))], names=["lang", "kind", "key", "n"])


def language_references(docs: DataFrame, common_words: int = COMMON_WORDS) -> References:
    counts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(_gather, "lang string, kind int, key long, n long")
    counts = counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    # the largest words of each salt first, then those of the language: no task sorts a language's whole vocabulary
    salted = counts.withColumn("salt", F.when(F.col("kind") == 1, F.pmod("key", F.lit(64))).otherwise(F.lit(-1)))
    total = F.sum("n").over(Window.partitionBy("lang", "kind", "salt"))
    first = salted.withColumn("total", total).withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind", "salt").orderBy(F.desc("n"), "key"))).where(F.col("r") <= common_words)
    # at most 65 * common_words rows per language
    per_language = first.groupBy("lang").agg(
        F.sum(F.when((F.col("kind") == 1) & (F.col("r") == 1), F.col("total"))).alias("words"),
        F.slice(F.sort_array(F.collect_list(F.when(F.col("kind") == 1, F.struct("n", "key"))), asc=False), 1, common_words).alias("top"),
        F.collect_list(F.when(F.col("kind") == 0, F.struct("key", "n"))).alias("classes"),
    )
    rows = per_language.where(F.col("words") >= MIN_REFERENCE_WORDS).collect()  # one row of some 2 KB per language
    chars, words, totals = {}, {}, {}
    for r in rows:
        histogram = np.zeros(N_CLASSES, np.int64)
        for x in r.classes:
            histogram[x.key] = x.n
        chars[r.lang], totals[r.lang] = histogram, r.words
        words[r.lang] = {x.key % (1 << 64): x.n for x in r.top}
    return References(chars, words, totals)


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, language string, js_words double, js_chars double"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, max_word_distance: float = MAX_WORD_DISTANCE, max_char_distance: float = MAX_CHAR_DISTANCE, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: counts of the base rules, both distances and the verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(language_references(docs))

    def judge(batches):
        known = shared.value
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                base, _, _ = base_columns(chunk)
                failed = base_failed(base)
                judged = base["n_words"] >= (min_words if known.languages else np.iinfo(np.int64).max)
                if known.languages:
                    nearest, by_words, by_chars = known.distances(chunk)
                    kept = ~failed & ~(judged & ((by_words > max_word_distance) | (by_chars > max_char_distance)))
                    language = pa.array([known.languages[i] for i in nearest], pa.string(), mask=~judged)
                else:
                    by_words = by_chars = np.zeros(chunk.n)
                    kept, language = ~failed, pa.nulls(chunk.n, pa.string())
                yield pa.record_batch(
                    [batch.column(0).slice(chunk.first, chunk.n), *(pa.array(base[c].astype(np.int64)) for c in _COUNTS), pa.array(failed), pa.array(kept), language, pa.array(by_words, mask=~judged), pa.array(by_chars, mask=~judged)],
                    names=["doc_id", *_COUNTS, "base_failed", "kept", "language", "js_words", "js_chars"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(judge, RESULT)
