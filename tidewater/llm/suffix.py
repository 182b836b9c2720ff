"""Repeated passages by a logarithmic family of suffix arrays.

Every batch of documents gets a sparse suffix array: its sampled suffixes (see ``suffix_core``) in the
order of a fingerprint of their first ``GRAM`` bytes. Any fixed order that puts equal beginnings side by
side serves a merge scan, and fingerprints are short. The array is cut into buckets of the fingerprint
space; a bucket is one sorted row. A new batch is merge-scanned against itself and against every level
of the index; suffixes met twice are the beginnings of possible long matches. Then levels
of equal size are merged geometrically, as a binary counter carries, so an entry is rewritten
log2(batches) times.

A window of ``LENGTH`` bytes belongs to its sampled suffix. For suffixes met twice, runs of windows that
occur as a whole elsewhere are settled by one hash. Only runs that occur once, and those sharing their
suffix with such a run, are compared window by window. Bytes of windows found twice or more, in any
document, the same one included, are removed; windows are judged on the input.

No group is gathered: occurrences are combined within a task before each shuffle, and all
shuffles are by hashes of 200-byte contents or of document contents. The lists that prefilter the later scans are
broadcast only up to ``FILTER_IDS`` entries; beyond that the same joins work without the prefilter.
Hashes have 64 bits.

Defined cases: null texts are empty; texts under ``LENGTH`` bytes are kept whole; copies of a document are
repeats of each other and go completely, as asked (a caller that wants one to stay removes copies first); a repeated row
counts as another occurrence and gets its own result row; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import Workspace, map_rows, shuffle_slices, text_column
from .suffix_core import samples, window_hashes

LENGTH = 200
GRAM = 100
BATCHES = 4
FILTER_IDS = 4_000_000
FLUSH = 1 << 19
_CODES = K.byte_codes()


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((K.mix64(x) >> K.U64(33)) % K.U64(buckets)).astype(np.int64)


def _cut(order_by: np.ndarray) -> list[tuple[int, int]]:
    start = np.flatnonzero(np.concatenate([[True], order_by[1:] != order_by[:-1]])) if len(order_by) else np.zeros(0, int)
    return list(zip(start.tolist(), np.append(start[1:], len(order_by)).tolist(), strict=True))


def _read(blob: bytes | None, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(blob or b"", kind)


class SuffixIndex:
    """Levels of sorted suffix fingerprints, the level of rank r holding 2**r batches."""

    def __init__(self, work: Workspace, buckets: int, slices: int, length: int = LENGTH, gram: int = GRAM):
        self.work, self.buckets, self.slices, self.length, self.gram = work, buckets, slices, length, gram
        self.levels: list[tuple[int, DataFrame]] = []

    def _runs(self, texts: DataFrame) -> DataFrame:
        """Sorted fingerprints of a batch by bucket and task; those met twice in the task are listed again."""
        buckets, length, gram = self.buckets, self.length, self.gram

        def flush(held):
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = _bucket(keys, buckets)
            order = np.lexsort((keys, bucket))
            keys, counts, bucket = keys[order], counts[order], bucket[order]
            cuts = _cut(bucket)
            return pa.record_batch([pa.array([int(bucket[s]) for s, _ in cuts], pa.int64()), pa.array([-1] * len(cuts), pa.int32()), pa.array([keys[s:e].tobytes() for s, e in cuts], pa.binary()), pa.array([keys[s:e][counts[s:e] > 1].tobytes() for s, e in cuts], pa.binary())], names=["bucket", "rank", "keys", "twice"])

        def each(batches):
            held, size = [], 0
            for batch in batches:
                for chunk in K.chunks(batch.column(0)):
                    found = samples(chunk, length, gram)
                    if found is not None:
                        held.append(found.key)
                        size += len(found.key)
                    if size > FLUSH:
                        yield flush(held)
                        held, size = [], 0
            if size:
                yield flush(held)

        return texts.select("text").mapInArrow(each, "bucket long, rank int, keys binary, twice binary")

    def add(self, texts: DataFrame) -> DataFrame:
        """Indexes a batch; returns (bucket, keys) of fingerprints met twice, in the batch or against a level."""
        rows = self._runs(texts)
        ranks = [r for r, _ in self.levels]
        carried = 0  # levels of rank 0, 1, .. carried - 1 are all there: they merge with the batch
        while carried in ranks:
            carried += 1
        for rank, level in self.levels:
            rows = rows.unionByName(level.select("bucket", F.lit(rank).cast("int").alias("rank"), "keys", F.lit(None).cast("binary").alias("twice")))

        def scan(bucket, held):
            mine = [_read(k) for rank, k, _ in held if rank < 0]
            twice = [_read(t) for rank, _, t in held if rank < 0]
            if mine:
                run, counts = np.unique(np.concatenate(mine), return_counts=True)
                twice.append(run[counts > 1])
            else:
                run = np.zeros(0, np.uint64)
            merged = [run]
            for rank, keys, _ in held:
                if rank >= 0:
                    level = _read(keys)
                    twice.append(run[np.isin(run, level, assume_unique=True)])
                    if rank < carried:
                        merged.append(level)
            met = np.unique(np.concatenate(twice)) if twice else run[:0]
            level = np.unique(np.concatenate(merged))
            yield pa.record_batch([pa.array([bucket] * 2, pa.int64()), pa.array([True, False]), pa.array([level.tobytes(), met.tobytes()], pa.binary())], names=["bucket", "kept", "keys"])

        def each(batches):
            bucket, held = None, []
            for batch in batches:
                for b, rank, keys, twice in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    if b != bucket and held:
                        yield from scan(bucket, held)
                        held = []
                    bucket = b
                    held.append((rank, keys, twice))
            if held:
                yield from scan(bucket, held)

        done = self.work.write(rows.repartition(self.slices, "bucket").sortWithinPartitions("bucket").mapInArrow(each, "bucket long, kept boolean, keys binary"), "level")
        for rank, level in self.levels:
            if rank < carried:
                self.work.drop(level._table)
        level = done.where("kept").select("bucket", "keys")
        level._table = done
        met = self.work.write(done.where("NOT kept").select("bucket", "keys"), "met")
        self.levels = [x for x in self.levels if x[0] >= carried] + [(carried, level)]
        return met


def _content_ids(chunk: K.Chunk) -> np.ndarray:
    """Hash of each document's whole bytes: XXH3, as sums modulo 2**64 have texts of 1,024 bytes and more that clash whatever the codes."""
    return np.fromiter((xxhash.xxh3_64_intdigest(K.text_of(chunk, i)) for i in range(chunk.n)), np.uint64, chunk.n)


def _prefilter(rows: DataFrame, limit: int) -> np.ndarray | None:
    """The ids as a sorted array, or None if there are more than ``limit``."""
    some = rows.limit(limit + 1).toArrow().column(0).to_numpy()
    return np.sort(some.view(np.uint64)) if len(some) <= limit else None


def _in(known: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    if known is None:
        return np.ones(len(x), bool)
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def repeated_suffixes(texts: DataFrame, work: Workspace, batches: int, slices: int, length: int, gram: int) -> DataFrame:
    """Runs the batches through the index; (key) of every suffix fingerprint met twice."""
    index = SuffixIndex(work, 4 * slices, slices, length, gram)
    met = None
    part = F.pmod(F.xxhash64("doc_id", F.lit("batch")), F.lit(batches))
    for i in range(batches):
        found = index.add(texts.where(part == i))
        met = found if met is None else met.unionByName(found)

    def each(rows):
        for batch in rows:
            keys = np.concatenate([_read(k) for k in batch.column(0).to_pylist()] or [np.zeros(0, np.uint64)])
            yield pa.record_batch([pa.array(K.as_long(keys))], names=["key"])

    return work.write(met.select("keys").mapInArrow(each, "key long").distinct(), "keys")


_RUN = "kind int, content long, key long, span long, n long, first long, last long"


def _runs_of(texts: DataFrame, keys: DataFrame, limit: int, length: int, gram: int) -> DataFrame:
    """Runs of windows whose suffix was met twice.

    Kind 0: removal [first, last) of a content, from runs found twice within the task.
    Kind 1: a run, once per task, with how often the task has it (1, or 2 for more).
    """
    known = _prefilter(keys, limit)
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def flush(held):
        content, key, span, first, last = (np.concatenate(x) for x in zip(*held, strict=True))
        uniques, at, counts = np.unique(span, return_inverse=True, return_counts=True)
        many = counts[at] > 1
        lone = np.flatnonzero(~many)
        _, some = np.unique(span, return_index=True)  # one of each
        some = some[counts > 1]
        pick = np.concatenate([lone, some])
        n = np.concatenate([np.ones(len(lone), np.int64), np.full(len(some), 2)])
        zero = np.zeros(int(many.sum()), np.int64)
        # removals are joined where they touch, so that a copied document is one row
        c, f, e = _union(content[many], first[many], last[many] + length)
        zero = np.zeros(len(c), np.int64)
        yield pa.record_batch([pa.array(zero.astype(np.int32)), pa.array(K.as_long(c)), pa.array(zero), pa.array(zero), pa.array(zero), pa.array(f), pa.array(e)], names=_names)
        yield pa.record_batch([pa.array(np.ones(len(pick), np.int32)), pa.array(K.as_long(content[pick])), pa.array(K.as_long(key[pick])), pa.array(K.as_long(span[pick])), pa.array(n), pa.array(first[pick]), pa.array(last[pick])], names=_names)

    def each(batches):
        held, size = [], 0
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                found = samples(chunk, length, gram)
                if found is None:
                    continue
                mine = np.flatnonzero(_in(shared.value, found.key))
                if not len(mine):
                    continue
                begin = chunk.offsets[found.doc[mine]]
                held.append((_content_ids(chunk)[found.doc[mine]], found.key[mine], found.span[mine], found.first[mine] - begin, found.last[mine] - begin))
                size += len(mine)
                if size > FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    _names = ["kind", "content", "key", "span", "n", "first", "last"]
    rows = texts.select("text").mapInArrow(each, _RUN)
    if known is None:
        met = rows.where("kind = 1").join(keys, "key", "left_semi").select(*_names)
        rows = rows.where("kind = 0").unionByName(met)
    return rows


def _union(content: np.ndarray, first: np.ndarray, end: np.ndarray):
    """Union of the intervals [first, end) of each content."""
    if not len(content):
        return content, first, end
    order = np.lexsort((first, content))
    content, first, end = content[order], first[order], end[order]
    new_doc = np.ones(len(content), bool)
    new_doc[1:] = content[1:] != content[:-1]
    group = np.cumsum(new_doc) - 1
    step = np.int64(int(end.max()) + 1)
    reach = np.maximum.accumulate(end + group * step) - group * step  # furthest end so far in the content
    new = new_doc.copy()
    new[1:] |= first[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return content[at], first[at], reach[np.append(at[1:], len(content)) - 1]


def _windows(texts: DataFrame, runs: DataFrame, work: Workspace, limit: int, slices: int, length: int) -> DataFrame:
    """Compares the open runs window by window; (content, first, last) of the removed windows of lone runs."""
    per_text = work.write(runs.groupBy("content").agg(F.collect_list(F.struct("span", "n", "first", "last")).alias("runs")), "open")
    known = _prefilter(per_text.select("content"), limit)
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def pick(batches):
        seen: set[int] = set()
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                ids = _content_ids(chunk)
                rows = [i for i in np.flatnonzero(_in(shared.value, ids) & (np.diff(chunk.offsets) >= length)).tolist() if int(ids[i]) not in seen]
                if len(seen) > 1 << 18:
                    seen.clear()
                rows = [i for i in rows if int(ids[i]) not in seen and not seen.add(int(ids[i]))]
                if rows:
                    yield pa.record_batch([pa.array(K.as_long(ids[rows])), pa.array([K.text_of(chunk, i) for i in rows], pa.binary())], names=["content", "bytes"])

    chosen = texts.select("text").mapInArrow(pick, "content long, bytes binary").join(per_text, "content")
    buckets = 4 * slices

    def flush(held):
        window, run, n, content, start = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = _bucket(window, buckets)
        order = np.lexsort((run, window, bucket))
        window, run, n, content, start, bucket = (x[order] for x in (window, run, n, content, start, bucket))
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1]) | (run[1:] != run[:-1])
        window, n, content, start, bucket = (x[new] for x in (window, n, content, start, bucket))
        cuts = _cut(bucket)
        blob = lambda x: pa.array([x[s:e].tobytes() for s, e in cuts], pa.binary())
        return pa.record_batch([pa.array([int(bucket[s]) for s, _ in cuts], pa.int64()), blob(window), blob(n.astype(np.uint8)), blob(content), blob(start.astype(np.uint32))], names=["bucket", "window", "n", "content", "start"])

    def open_up(batches):
        held, size = [], 0
        for batch in batches:
            runs_of = batch.column("runs")
            for chunk in K.chunks(batch.column("bytes")):
                sums = K.prefix_sums(chunk.data, _CODES)
                for i in range(chunk.n):
                    rows = runs_of[chunk.first + i].values
                    span, n, first, last = (rows.field(c).to_numpy() for c in ("span", "n", "first", "last"))
                    count = last - first + 1
                    start = K.expand(first, count)
                    hashes = window_hashes(sums, start + chunk.offsets[i], length)
                    content = np.full(len(start), batch.column("content")[chunk.first + i].as_py(), np.int64)
                    held.append((hashes, np.repeat(span, count), np.repeat(n, count), content, start))
                    size += len(start)
                    if size > FLUSH:
                        yield flush(held)
                        held, size = [], 0
        if size:
            yield flush(held)

    def meet(held):
        window, n, content, start = (np.concatenate([_read(row[i], kind) for row in held]) for i, kind in enumerate((np.uint64, np.uint8, np.int64, np.uint32)))
        _, at = np.unique(window, return_inverse=True)
        total = np.bincount(at, n)
        mine = (n == 1) & (total[at] > 1)
        content, start = content[mine], start[mine].astype(np.int64)
        c, f, e = _union(content, start, start + 1)  # starts of windows; neighbours become one row
        yield pa.record_batch([pa.array(c), pa.array(f), pa.array(e - 1)], names=["content", "first", "last"])

    def each(batches):
        bucket, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != bucket and held:
                    yield from meet(held)
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield from meet(held)

    packed = chosen.select("content", "bytes", "runs").mapInArrow(open_up, "bucket long, window binary, n binary, content binary, start binary")
    return packed.repartition(slices, "bucket").sortWithinPartitions("bucket").mapInArrow(each, "content long, first long, last long")


def removals(texts: DataFrame, work: Workspace, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM, limit: int = FILTER_IDS) -> DataFrame:
    """(content, spans): for each document content, the byte intervals to remove, not yet joined."""
    slices = shuffle_slices(texts.sparkSession)
    keys = repeated_suffixes(texts, work, batches, slices, length, gram)
    work.tidy()
    rows = work.write(_runs_of(texts, keys, limit, length, gram), "runs")
    runs = rows.where("kind = 1")
    spans = runs.groupBy("span").agg(F.sum("n").alias("n"), F.min(F.struct("content", "first", "last", "key")).alias("at"))
    spans = work.write(spans.select("span", F.least("n", F.lit(2)).alias("n"), "at.*"), "spans")
    # a run whose span others have too is removed as a whole; each task has reported one of its occurrences,
    # the others are in the removals of kind 0
    whole = runs.join(spans.where("n > 1").select("span"), "span", "left_semi").select("content", "first", (F.col("last") + length).alias("end"))
    open_keys = spans.where("n = 1").select("key").distinct()
    open_runs = spans.join(open_keys, "key", "left_semi")
    lone = _windows(texts, open_runs, work, limit, slices, length).select("content", "first", (F.col("last") + length).alias("end"))
    local = rows.where("kind = 0").select("content", "first", F.col("last").alias("end"))
    every = work.write(whole.unionByName(local).unionByName(lone), "removals")
    work.tidy()
    return every.groupBy("content").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def _cut_batch(batch: pa.RecordBatch, at: int):
    """Byte count, removed bytes, removed runs and remaining bytes of each row; the last column has the intervals."""
    text, found = batch.column(at).cast(pa.string()), batch.column(batch.num_columns - 1)
    kept, figures = [], np.zeros((len(batch), 3), np.int64)
    for chunk in K.chunks(text):
        for i in range(chunk.n):
            whole = K.text_of(chunk, i)
            row = chunk.first + i
            figures[row, 0] = len(whole)
            value = found[row]
            if not value.is_valid:
                kept.append(whole)
                continue
            first, end = (value.values.field(c).to_numpy() for c in ("first", "end"))
            _, first, end = _union(np.zeros(len(first), np.int64), first, end)
            figures[row, 1:] = (end - first).sum(), len(first)
            cuts = [0, *np.stack([first, end], 1).ravel().tolist(), len(whole)]
            kept.append(b"".join(whole[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
    return figures, kept


def _tagged(docs: DataFrame) -> DataFrame:
    """Numbered columns of ``docs`` with the hash of each row's text."""
    at = text_column(docs)

    def tag(batch):
        for chunk in K.chunks(batch.column(at).cast(pa.string())):
            rows = batch.slice(chunk.first, chunk.n)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(K.as_long(_content_ids(chunk)))], names=[*rows.schema.names, "content"])

    return map_rows(docs, tag, ("content", T.LongType()))


def remove_repeats(docs: DataFrame, work: Workspace | None = None, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM, limit: int = FILTER_IDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes."""
    work = work or Workspace(docs.sparkSession, "suffix")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = removals(docs, work, batches, length, gram, limit)

    def cut(rows):
        for batch in rows:
            figures, kept = _cut_batch(batch, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(figures[:, i]) for i in range(3)), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = _tagged(docs).join(spans, "content", "left").drop("content")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, work: Workspace | None = None, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM, limit: int = FILTER_IDS) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; rows of which nothing is left go.

    Where a cut splits a character, its remaining bytes go too. A column ``n_chars`` follows the text.
    """
    work = work or Workspace(docs.sparkSession, "suffix")
    spans = removals(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")), work, batches, length, gram, limit)
    at, counted = text_column(docs), docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    joined = _tagged(docs).join(spans, "content", "left").drop("content")
    own = joined.columns[:-1]
    schema = T.StructType(joined.schema.fields[:-1])

    def cut(rows):
        for batch in rows:
            figures, kept = _cut_batch(batch, at)
            changed = figures[:, 1] > 0
            columns = batch.columns[:-1]
            old = columns[at]
            texts = [k.decode("utf-8", "ignore") if c else t for k, c, t in zip(kept, changed.tolist(), old.to_pylist(), strict=True)]
            columns[at] = pa.array(texts, old.type)
            if counted is not None:
                chars = columns[counted].to_pylist()
                columns[counted] = pa.array([len(t) if c else n for t, c, n in zip(texts, changed.tolist(), chars, strict=True)], columns[counted].type)
            left = [not c or bool(k) for k, c in zip(kept, changed.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=own).filter(pa.array(left, pa.bool_()))

    return joined.mapInArrow(cut, schema).toDF(*docs.columns)
