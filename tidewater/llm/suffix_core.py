"""Sampled suffixes of byte strings: which suffixes an index holds, and which windows each one stands for.

A window is a string of ``length`` bytes. Of the ``length - gram + 1`` suffixes that begin in it with
``gram`` bytes left, the one whose gram has the least hash (the first of equal ones) is its
sample. The choice depends on the window's bytes alone, so equal windows, wherever they are, have equal samples
at equal offsets. Consecutive windows mostly share their sample, so about 2 of
``length - gram + 2`` positions are sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from . import textkernel as K

_CODES = K.byte_codes()


@dataclass
class Samples:
    """One row per sampled suffix: its document, the first and last window it stands for, and hashes."""

    doc: np.ndarray
    first: np.ndarray  # byte of the chunk at which the first window begins
    last: np.ndarray
    key: np.ndarray  # hash of the suffix's first ``gram`` bytes
    span: np.ndarray  # hash of all bytes of its windows, [first, last + length), and of the sample's place in them
    sums: np.ndarray  # prefix sums of the chunk, for window hashes


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i that has so many."""
    have, out = 1, x
    while 2 * have <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def samples(chunk: K.Chunk, length: int, gram: int) -> Samples | None:
    n = len(chunk.data)
    if n < length:
        return None
    sums = K.prefix_sums(chunk.data, _CODES)
    at = np.arange(n - gram + 1)
    grams = K.span_hash(sums, at, at + gram)
    # windows that lie in one document
    begin, size = chunk.offsets[:-1], np.diff(chunk.offsets)
    windows = np.maximum(size - length + 1, 0)
    start = K.expand(begin, windows)
    if not len(start):
        return None
    ordered = (grams & K.U64(0xFFFFFFFF00000000)) | at.astype(K.U64)  # 32 bits of the hash, then the place
    sample = (sliding_min(ordered, length - gram + 1)[start] & K.U64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(chunk.n), windows)
    new = np.ones(len(start), bool)
    new[1:] = (sample[1:] != sample[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    first = start[at]
    last = start[np.append(at[1:], len(start)) - 1]
    sample = sample[at]
    span = K.span_hash(sums, first, last + length) ^ K.mix64((sample - first + 1).astype(K.U64))
    return Samples(doc[at], first, last, grams[sample], span, sums)


def window_hashes(sums: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    return K.span_hash(sums, start, start + length)
