"""Vector code compression: product codes learnt and assigned over lexicographic tries of distinct parts.

Each component x becomes the integer floor(256 * x); a vector is cut into ``parts`` equal consecutive parts and each part
is replaced by the number of the nearest entry of its position's codebook (squared Euclidean distance, ties to the
lower number). A codebook starts as that part of the ``entries`` vectors of least id; in each round every entry becomes
floor(sum / count) of the parts assigned to it, and stays if it has none.

* A task takes vectors in chunks of ``CHUNK``. Per position the distinct parts of a chunk, in lexicographic order, are the
  leaves of a trie over their components, each with the number of vectors that hold it.
* The trie is walked depth first, in blocks of ``BLOCK`` leaves. A node is a prefix of components; its vector of
  distances to all entries, accumulated over the prefix, is made once from its parent's and one more component, and
  all parts below it share it. The path to the last leaf of a block stays on the stack, so that a prefix
  that goes on in the next block is not computed again.
* A leaf takes the argmin of its vector, and adds its components, weighted by its count, to the sums of that entry.

Sums leave a task as one row per entry and component; Spark adds them up, and the codebooks (64 x dimension integers) are
all that reaches the driver. Nothing is shuffled by part, so a part or vector that fills a third of the table is no hot key.
The error of a label is a grouped sum, joined back with the labels that hold many rows broadcast (``join_unique``).

Defined cases: a vector that is null or holds a null or non-finite component is dropped; the others are filled up with zeros
to the longest one's length, rounded up to a multiple of ``parts`` (an empty vector is all zeros); components beyond
+-2**28 count as that bound, so that an error of up to 32 components fits a long; equal ids are ordered by their components, null ids come last; repeated rows are
each coded and each count; fewer than ``entries`` vectors give as many entries; an empty table gives no rows; an error of a label
beyond a long is null; columns other than the three named are not read, and of clashing names the first column counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, first_columns, join_unique

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BOUND = 1 << 28
CHUNK = 1 << 14
BLOCK = 1 << 12


@dataclass
class Codebooks:
    """Integer entries by part, entry and position within the part."""

    entries: np.ndarray  # (parts, entries, width)

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def text(self) -> str:
        """All components as decimal integers, by part, entry and position, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that rows of codes stand for."""
        return np.concatenate([self.entries[p][codes[:, p]] for p in range(self.parts)], axis=1)


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector is kept, the lengths of these vectors, and their integer components end to end."""
    if not pa.types.is_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    column = pc.fill_null(column, pa.scalar([None], column.type)) if column.null_count else column
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    values = column.flatten()
    whole = pc.fill_null(values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    finite = np.isfinite(whole)
    row = np.repeat(np.arange(len(lengths)), lengths)
    kept = np.bincount(row[~finite], minlength=len(lengths)) == 0
    with np.errstate(over="ignore"):  # what lies beyond the doubles lies beyond the bound
        scaled = np.floor(np.clip(whole[kept[row]] * SCALE, -BOUND, BOUND))
    return np.flatnonzero(kept), lengths[kept], scaled.astype(np.int64)


def _matrix(lengths: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` components, shorter ones filled up with zeros."""
    if np.all(lengths == width):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    column = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), column] = values
    return out


@dataclass
class Leaves:
    """Distinct parts of a chunk in lexicographic order."""

    parts: np.ndarray  # (leaves, width)
    counts: np.ndarray
    leaf_of: np.ndarray  # the leaf of each row of the chunk
    shared: np.ndarray  # components a leaf has in common with the one before it; -1 for the first


def leaves_of(rows: np.ndarray) -> Leaves:
    """The trie's leaves for parts ``rows`` (n, width)."""
    n, width = rows.shape
    if width == 0:
        return Leaves(rows[:1], np.array([n]), np.zeros(n, np.int64), np.full(min(n, 1), -1))
    small = rows.astype(np.int16) if np.abs(rows).max(initial=0) < 1 << 15 else rows
    order = np.lexsort(small.T[::-1])
    ordered = rows[order]
    equal = np.logical_and.accumulate(ordered[1:] == ordered[:-1], axis=1).sum(axis=1)
    shared = np.concatenate([[-1], equal])
    fresh = shared < width
    leaf_of = np.empty(n, np.int64)
    leaf_of[order] = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    return Leaves(ordered[first], np.diff(np.append(first, n)), leaf_of, shared[first])


def nearest(leaves: Leaves, entries: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its distance for every leaf, by a depth-first walk in blocks of leaves."""
    n, width = leaves.parts.shape
    reach = int(max(np.abs(leaves.parts).max(initial=0), np.abs(entries).max(initial=0)))
    kind = np.int32 if width * (2 * reach) ** 2 < 1 << 31 else np.int64
    parts, table = leaves.parts.astype(kind), entries.astype(kind)
    best, error = np.empty(n, np.int64), np.empty(n, np.int64)
    stack = [np.zeros(len(entries), kind)] + [None] * width  # distances of the last leaf's prefixes
    for at in range(0, n, block):
        part, shared = parts[at : at + block], leaves.shared[at : at + block]
        above, parent = stack[0][None, :], np.zeros(len(part), np.int64)
        for depth in range(width):
            # a node begins where the prefix of depth + 1 components changes; the block's first one may go on from before
            fresh = shared <= depth
            carried = not fresh[0]
            fresh[0] = True
            node = np.flatnonzero(fresh)
            step = part[node, depth, None] - table[None, :, depth]
            step *= step
            step += above[parent[node]]
            if carried:
                step[0] = stack[depth + 1]
            above, parent = step, np.cumsum(fresh) - 1
            stack[depth + 1] = step[-1].copy()
        choice = above.argmin(axis=1)
        best[at : at + block] = choice[parent]
        error[at : at + block] = above[np.arange(len(choice)), choice][parent]
    return best, error


def _chunks(batches, width: int, chunk: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Kept rows of the batches and their integer matrices, gathered to about ``chunk`` vectors."""
    held, rows = [], 0

    def gathered():
        kept = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        _, lengths, values = _integers(kept.column(kept.num_columns - 1))
        return kept, _matrix(lengths, values, width)

    for batch in batches:
        at, _, _ = _integers(batch.column(batch.num_columns - 1))
        if len(at):
            held.append(batch.take(pa.array(at)))
            rows += len(at)
        if rows >= chunk:
            yield gathered()
            held, rows = [], 0
    if held:
        yield gathered()


def _key(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """Integer vectors as bytes that sort as the vectors do."""
    raw = (values + (1 << 31)).astype(">u4").tobytes()
    ends = 4 * np.cumsum(lengths)
    return pa.array([raw[a:z] for a, z in zip((ends - 4 * lengths).tolist(), ends.tolist())], pa.binary())


def first_codebooks(vectors: DataFrame, work: Workspace, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of the ``entries`` vectors of least id; none if no vector is kept. ``vectors``: (vec_id, .., embedding)."""
    def least(batches):
        for batch in batches:
            at, lengths, values = _integers(batch.column(1))
            found = pa.table({"vec_id": batch.column(0).take(pa.array(at)), "key": _key(lengths, values)})
            order = pc.sort_indices(found, sort_keys=[("vec_id", "ascending"), ("key", "ascending")], null_placement="at_end")
            longest = pa.array(np.full(min(entries, len(at)), lengths.max(initial=0)), pa.int64())
            for out in found.take(order[:entries]).append_column("longest", longest).to_batches():
                yield out

    slim = vectors.select("vec_id", "embedding")
    kind = slim.schema["vec_id"].dataType.simpleString()
    found = work.write(slim.mapInArrow(least, f"vec_id {kind}, key binary, longest long"), "least")
    longest = found.agg(F.max("longest")).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    rows = found.orderBy(F.col("vec_id").asc_nulls_last(), "key").limit(entries).select("key").collect()
    keys = [np.frombuffer(bytes(r.key), ">u4").astype(np.int64) - (1 << 31) for r in rows]
    matrix = _matrix(np.array([len(k) for k in keys]), np.concatenate(keys), parts * width)
    return Codebooks(matrix.reshape(len(keys), parts, width).transpose(1, 0, 2).copy())


def refine(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes floor(sum / count) of the parts nearest to it."""
    parts, count, width = books.entries.shape

    def sums(batches):
        total, members = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for _, matrix in _chunks(batches, parts * width, CHUNK):
            for p in range(parts):
                leaves = leaves_of(matrix[:, p * width : (p + 1) * width])
                entry, _ = nearest(leaves, books.entries[p])
                np.add.at(members[p], entry, leaves.counts)
                np.add.at(total[p], entry, leaves.parts * leaves.counts[:, None])
        part, entry = np.nonzero(members)
        if len(part):
            flat = total[part, entry]
            yield pa.RecordBatch.from_arrays([pa.array(part * count + entry), pa.array(members[part, entry]), pa.array(list(flat), pa.list_(pa.int64()))], names=["slot", "members", "total"])

    found = vectors.select("embedding").mapInArrow(sums, "slot long, members long, total array<long>")
    added = (found.groupBy("slot")
             .agg(F.sum("members").alias("members"), *(F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(width))).collect())
    entries = books.entries.copy().reshape(parts * count, width)
    for row in added:
        entries[row.slot] = np.array(row[2:], np.int64) // row.members
    return Codebooks(entries.reshape(parts, count, width))


def learn(vectors: DataFrame, work: Workspace, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    books = first_codebooks(vectors, work, parts, entries)
    for _ in range(rounds if books else 0):
        books = refine(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, codes, error): the codes as bytes (two for each if a codebook has over 256 entries), kept vectors only."""
    width, wide = books.width, books.entries.shape[1] > 256

    def each(batches):
        for kept, matrix in _chunks(batches, books.parts * width, CHUNK):
            codes, error = np.empty((len(matrix), books.parts), ">u2" if wide else np.uint8), np.zeros(len(matrix), np.int64)
            for p in range(books.parts):
                leaves = leaves_of(matrix[:, p * width : (p + 1) * width])
                entry, distance = nearest(leaves, books.entries[p])
                codes[:, p] = entry[leaves.leaf_of]
                error += distance[leaves.leaf_of]
            raw = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), raw, pa.array(error)], names=["vec_id", "label", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return vectors.mapInArrow(each, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes binary, error long")


def compress_vectors(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Every kept vector's codes with its error and its label's error, and the codebooks they refer to."""
    work = Workspace(embeddings.sparkSession, "codes")
    vectors = first_columns(embeddings, "vec_id", "label", "embedding")
    books = learn(vectors, work, parts, entries, rounds)
    if books is None:
        none = vectors.where(F.lit(False)).select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return none.withColumn("label_error", F.col("error")), None
    coded = work.write(encode(vectors, books).withColumn("of", F.struct("label")), "coded")
    labels = work.write(coded.groupBy("of").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error")), "labels")
    return join_unique(coded, labels, "of", "n").select("vec_id", "label", "codes", "error", "label_error"), books
