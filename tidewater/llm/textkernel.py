"""Vectorised text work on Arrow batches: words, lines and rolling hashes of many documents at once.

An Arrow string column is one byte buffer with offsets. Everything here works on that
buffer, so no Python object is made per word. Batches are cut into chunks of about
``CHUNK_BYTES`` (a longer document is a chunk of its own), which bounds the memory of a task.

Hashes are 64-bit polynomials modulo 2**64 over random byte codes, finished by a mixing
step; equal byte strings always give equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_codes(lower: bool = False) -> np.ndarray:
    """A random odd code per byte value; with ``lower`` A-Z share the codes of a-z."""
    values = np.arange(256)
    if lower:
        values = np.where((values >= 65) & (values <= 90), values + 32, values)
    return mix64((values + 1).astype(U64) * U64(0xD1342543DE82EF95)) | U64(1)


def is_word_byte(pattern: str) -> np.ndarray:
    """Byte table of the word classes used by the operators.

    ``space``: words are runs without ``[\\x20\\x09-\\x0D]``.
    ``alnum``: words are runs without ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z.
    """
    table = np.ones(256, bool)
    if pattern == "space":
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif pattern == "alnum":
        table[:128] = False
        table[48:58] = table[65:91] = table[97:123] = True
    else:
        raise ValueError(f"unknown word pattern {pattern!r}")
    return table


class _Powers:
    """Powers of the base and of its inverse, grown to the longest chunk seen by this process."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, 1 << 16)
            up, down = np.full(size, _BASE, U64), np.full(size, _BASE_INV, U64)
            up[0] = down[0] = U64(1)
            self.up, self.down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        return self.up, self.down


_POWERS = _Powers()


def prefix_sums(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``P`` with hash(data[a:b]) = (P[b] - P[a]) * base**-a, all modulo 2**64."""
    up, _ = _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, U64)
    each = sums[1:]
    np.take(codes, data, out=each, mode="clip")  # nothing to clip: a byte has a code; other modes need a copy
    each *= up[: len(data)]
    np.cumsum(each, out=each)
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each byte span [start, end)."""
    _, down = _POWERS.upto(len(sums) - 1)
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0x2545F4914F6CDD1D))


@dataclass
class Chunk:
    """Some documents of a batch: their rows, one byte buffer and offsets into it."""

    first: int  # row of the first document in the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cuts a string or binary column into chunks. Null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may cover bytes; give it none
        valid = np.asarray(column.is_valid())
        if np.any((np.diff(offsets) > 0) & ~valid):
            column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
            yield from chunks(column, limit)
            return
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield Chunk(start, raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
        start = end


def text_of(chunk: Chunk, i: int) -> bytes:
    return chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes()


def spans(chunk: Chunk, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``table``, and the document of each.

    Runs never cross documents.
    """
    data, offsets = chunk.data, chunk.offsets
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = table[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
    starts_mask = inside & ~before
    starts_mask[edges] = inside[edges]
    ends_mask = before & ~inside
    ends_mask[edges] = before[edges]
    starts = np.flatnonzero(starts_mask)
    ends = np.flatnonzero(ends_mask)
    if inside[-1]:
        ends = np.append(ends, len(data))
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return starts, ends, docs


def run_lengths(docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: how many items it has, and where its first is (``docs`` ascends)."""
    counts = np.bincount(docs, minlength=n)
    return counts, np.cumsum(counts) - counts


def windows(hashes: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where ``width`` items of one document begin, and the hash of each such window."""
    m = len(hashes) - width + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    first = np.flatnonzero(docs[:m] == docs[width - 1 :])
    total = np.zeros(len(first), U64)
    for j in range(width):
        total += hashes[first + j] * U64(pow(_BASE, j + 1, 1 << 64))
    return first, mix64(total + U64(width))


def whole_hash(hashes: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """For each document the hash of all its items in order; equals ``windows`` of that width."""
    counts, first = run_lengths(docs, n)
    up, _ = _POWERS.upto(int(counts.max(initial=0)) + 1)
    rank = np.arange(len(docs)) - first[docs]
    total = np.zeros(n, U64)
    np.add.at(total, docs, hashes * up[rank + 1])
    return mix64(total + counts.astype(U64))


def segment_sums(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each segment values[first : first + counts]; empty segments give 0."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[first + counts] - sums[first]


def expand(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All indexes first[i] .. first[i] + counts[i] - 1, one segment after the other."""
    total = int(counts.sum())
    steps = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first, counts) + steps


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed bigint, bit for bit."""
    return x.astype(U64, copy=False).view(np.int64)
