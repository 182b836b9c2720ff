"""N-gram Jaccard join in the metric space of shingle sets (distance 1 - Jaccard, threshold 0.25).

Almost all pairs of documents are at distance 1, where a pivot tells nothing. So regions are first
seeded by shingles: with one global order of shingles (rarest first, then by hash), two sets within the
threshold share a shingle of their first n - ceil(3n/4) + 1 ones, so every set is replicated to the
regions of these shingles and to no other. Equal sets are one class from the start.

* A small region reports its pairs that pass the length bound 4 * min >= 3 * max and the positional bound.
* In a large region the member with the least id is the pivot and is compared with every member.
  Members within the threshold are linked to it and thereby to each other. What is left joins
  recursively: the regions of a pivot are one cell, a set being replicated to the cells of all pivots whose
  regions it is in; a cell is split by set size, a set being replicated to the neighbouring size its partners can
  have, and into blocks. Pairs whose distances to the pivot differ by more than the threshold (triangle
  inequality) or that are already connected are skipped, all others are tested inside the cell.

Candidate pairs are tested by parity bitmaps, whose Hamming distance never exceeds the symmetric
difference, then exactly on the whole shingle sets. Links become components without pairs of copies.

The order of shingles is only a matter of speed. It is by how often the shingles of a hash slot occur in all documents
(``ORDER_SLOTS`` slots, a table of 2 MB at every size of the input): what a frequent shingle shares its slot with does not hide it.

Defined cases: null, empty and word-less texts have no shingles and are their own component; under five
words the whole sequence is one shingle; repeated rows are each returned; ids may repeat (the component
is the least id reachable from any row of that id's set); a null id takes part and is returned, and is
its own (null) component only if nothing it reaches has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import Workspace, map_rows, shuffle_slices, text_column
from .graph import components

WORDS = 5
ORDER_SLOTS = 1 << 18
SMALL_REGION = 16  # members up to which a region reports pairs at once
BLOCK = 512  # members of a block of a large cell
NO_ID = -(1 << 63)  # stands for a null id where rows are named
FILTER_IDS = 1 << 20  # classes up to which the second scan is filtered by a broadcast list
FLUSH_ENTRIES = 1 << 19
_TABLE = K.is_word_byte("space")
_CODES = K.byte_codes(lower=True)


def shingle_sets(chunk: K.Chunk, words: int = WORDS):
    """Distinct shingle hashes, ascending within each document, their documents, set sizes and set fingerprints."""
    starts, ends, docs = K.spans(chunk, _TABLE)
    h = K.span_hash(K.prefix_sums(chunk.data, _CODES), starts, ends) if len(starts) else np.zeros(0, K.U64)
    at, g = K.windows(h, docs, words)
    doc = docs[at]
    counts, _ = K.run_lengths(docs, chunk.n)
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        doc = np.concatenate([doc, short])
        g = np.concatenate([g, K.whole_hash(h, docs, chunk.n)[short]])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[keep], doc[keep]
    sizes, _ = K.run_lengths(doc, chunk.n)
    return g, doc, sizes, K.whole_hash(g, doc, chunk.n)


def needed_overlap(n):
    """Least intersection of a set of ``n`` with any partner."""
    return (3 * n + 3) // 4


def pair_fits(na, nb, pa_, pb):
    """Length bound, and overlap still possible if the sets' first common shingle is at these positions."""
    return (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)) & (7 * np.minimum(na - pa_, nb - pb) >= 3 * (na + nb))


def linked(inter, na, nb):
    return 4 * inter >= 3 * (na + nb - inter)


def parity_bitmap(sizes: np.ndarray, doc: np.ndarray, g: np.ndarray) -> list[bytes]:
    """Per set, 2 to 4 bits per shingle; every shingle flips one bit. Halves can be folded onto each other."""
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    at = base[doc] + (K.mix64(g ^ K.U64(0xA5A5)) % bits[doc].astype(K.U64)).astype(np.int64)
    flipped = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    packed = np.packbits(flipped, bitorder="little").tobytes()
    return [packed[b // 8 : (b + n) // 8] for b, n in zip(base.tolist(), bits.tolist(), strict=True)]


def _differs_too_much(a: bytes, b: bytes, na: int, nb: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return 7 * int(np.bitwise_count(x ^ y).sum()) > na + nb


def _frequencies(docs: DataFrame) -> np.ndarray:
    """In how many documents the shingles of each slot are, over all documents. Only for the order."""

    def each(batches):
        total = np.zeros(ORDER_SLOTS, np.int64)
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                total += np.bincount(_slot(shingle_sets(chunk)[0]), minlength=ORDER_SLOTS)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["slot", "n"])

    counted = docs.select("text").mapInArrow(each, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # a row per slot at most
    out = np.zeros(ORDER_SLOTS, np.int64)
    out[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    return out


def _slot(g: np.ndarray) -> np.ndarray:
    return (K.mix64(g ^ K.U64(0x51)) % K.U64(ORDER_SLOTS)).astype(np.int64)


def _prefixes(g, doc, sizes, frequency):
    """The first n - ceil(3n/4) + 1 shingles of each set in the global order: hash, document, position."""
    order = np.lexsort((g, frequency[_slot(g)], doc))
    first = np.cumsum(sizes) - sizes
    length = np.where(sizes > 0, sizes - needed_overlap(sizes) + 1, 0)
    at = K.expand(first, length)
    position = at - np.repeat(first, length)
    return g[order[at]], doc[order[at]], position


def _pack(key, cls, n, pos) -> bytes:
    """Entries of one bucket, sorted by class: a class is stored once for its run of entries."""
    start = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
    runs = np.diff(np.append(start, len(cls))).astype(np.uint32)
    head = np.array([len(start), len(cls)], np.uint32)
    return b"".join(x.tobytes() for x in (head, cls[start], n[start].astype(np.uint32), runs, key, pos))


def _unpack(blob: bytes):
    runs, entries = np.frombuffer(blob, np.uint32, 2)
    at = 8
    out = []
    for kind, count in ((np.uint64, runs), (np.uint32, runs), (np.uint32, runs), (np.uint32, entries), (np.uint16, entries)):
        out.append(np.frombuffer(blob, kind, int(count), at))
        at += int(count) * np.dtype(kind).itemsize
    cls, n, run, key, pos = out
    return key, np.repeat(cls, run), np.repeat(n, run).astype(np.int64), pos.astype(np.int64)


def _entries(docs: DataFrame, frequency: np.ndarray, buckets: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def flush(held):
        keys, cls, n, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        mixed = K.mix64(keys)
        bucket = ((mixed >> K.U64(32)) % K.U64(buckets)).astype(np.int64)
        short = mixed.astype(np.uint32)  # equal shingles stay equal; chance meetings fail the exact test
        order = np.lexsort((short, cls, bucket))
        bucket, short, cls, n, pos = bucket[order], short[order], cls[order], n[order], pos[order]
        new = np.ones(len(bucket), bool)  # copies within the task
        new[1:] = (bucket[1:] != bucket[:-1]) | (short[1:] != short[:-1]) | (cls[1:] != cls[:-1])
        bucket, short, cls, n, pos = bucket[new], short[new], cls[new], n[new], pos[new]
        start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(start[1:], len(bucket))
        blobs = [_pack(short[s:e], cls[s:e], n[s:e], np.minimum(pos[s:e], 65535).astype(np.uint16)) for s, e in zip(start.tolist(), ends.tolist(), strict=True)]
        return pa.record_batch([pa.array(bucket[start]), pa.array(blobs, pa.binary())], names=["bucket", "entries"])

    def each(batches):
        held, size = [], 0
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                g, doc, sizes, prints = shingle_sets(chunk)
                first_of = np.zeros(chunk.n, bool)
                first_of[np.unique(prints, return_index=True)[1]] = True
                key, at, pos = _prefixes(g, doc, sizes, shared.value)
                mine = first_of[at]
                held.append((key[mine], prints[at[mine]], sizes[at[mine]], pos[mine]))
                size += int(mine.sum())
                if size > FLUSH_ENTRIES:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return docs.select("text").mapInArrow(each, "bucket long, entries binary")


_CANDIDATES = "kind int, region long, a long, b long, na long, nb long, pos long"


def _rows(kind, region, a, b, na, nb, pos):
    n = len(a)
    return pa.record_batch([pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(region, n).astype(np.int64)), pa.array(K.as_long(a)), pa.array(K.as_long(b)), pa.array(na.astype(np.int64)), pa.array(nb.astype(np.int64)), pa.array(pos.astype(np.int64))], names=["kind", "region", "a", "b", "na", "nb", "pos"])


def _meet(bucket: int, blobs: list[bytes]):
    """Regions of one bucket. Kind 0: candidate pair. Kind 1: member ``a`` of a large region with pivot ``b``."""
    key, cls, n, pos = (np.concatenate(x) for x in zip(*map(_unpack, blobs), strict=True))
    order = np.lexsort((cls, key))
    key, cls, n, pos = key[order], cls[order], n[order], pos[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls, n, pos = key[new], cls[new], n[new], pos[new]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    members = np.diff(np.append(start, len(key)))
    pairs = []
    for m in range(2, SMALL_REGION + 1):
        i, j = np.triu_indices(m, 1)
        for some in np.array_split(start[members == m], max(1, int((members == m).sum()) * len(i) >> 20)):
            x, y = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
            ok = pair_fits(n[x], n[y], pos[x], pos[y])
            pairs.append(np.stack([x[ok], y[ok]]))
    if pairs:
        x, y = np.concatenate(pairs, 1)
        code = np.lexsort((cls[y], cls[x]))
        x, y = x[code], y[code]
        new = np.ones(len(x), bool)
        new[1:] = (cls[x][1:] != cls[x][:-1]) | (cls[y][1:] != cls[y][:-1])
        x, y = x[new], y[new]
        yield _rows(0, 0, cls[x], cls[y], n[x], n[y], np.zeros(len(x)))
    for s, m in zip(start[members > SMALL_REGION].tolist(), members[members > SMALL_REGION].tolist(), strict=True):
        mine = slice(s, s + m)
        region = (bucket << 32) | int(key[s])
        yield _rows(1, region, cls[mine], np.full(m, cls[s]), n[mine], np.full(m, n[s]), pos[mine])


def _regions(entries: DataFrame, slices: int) -> DataFrame:
    def each(batches):
        bucket, blobs = None, []
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != bucket and blobs:
                    yield from _meet(bucket, blobs)
                    blobs = []
                bucket = k
                blobs.append(blob)
        if blobs:
            yield from _meet(bucket, blobs)

    return entries.repartition(slices, "bucket").sortWithinPartitions("bucket").mapInArrow(each, _CANDIDATES)


def _sets_of(docs: DataFrame, classes: DataFrame, work: Workspace) -> DataFrame:
    """Whole shingle set of each class in ``classes`` (cls, rep), read from the text of its representative row."""
    some = classes.limit(FILTER_IDS + 1).toArrow()
    known = None  # more than FILTER_IDS: every set goes to the join below
    if some.num_rows <= FILTER_IDS:
        cls, rep = some.column("cls").to_numpy().view(K.U64), some.column("rep").to_numpy()
        order = np.argsort(cls)
        known = cls[order], rep[order]
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def each(batches):
        known = shared.value
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for chunk in K.chunks(batch.column(1)):
                g, doc, sizes, prints = shingle_sets(chunk)
                own = ids[chunk.first : chunk.first + chunk.n]
                wanted = sizes > 0
                if known is not None:
                    cls, rep = known
                    at = np.minimum(np.searchsorted(cls, prints), max(len(cls) - 1, 0))
                    wanted &= (cls[at] == prints) & (rep[at] == own) if len(cls) else False
                rows = np.flatnonzero(wanted)
                if not len(rows):
                    continue
                first = np.cumsum(sizes) - sizes
                sets = [g[first[i] : first[i] + sizes[i]].tobytes() for i in rows.tolist()]
                yield pa.record_batch([pa.array(K.as_long(prints[rows])), pa.array(own[rows]), pa.array(sets, pa.binary())], names=["cls", "rep", "items"])

    rows = docs.mapInArrow(each, "cls long, rep long, items binary")
    rows = rows.join(classes, ["cls", "rep"], "left_semi") if known is None else rows
    return work.write(rows.select("cls", "items"), "sets")


def _verify(docs: DataFrame, pairs: DataFrame, reps: DataFrame, work: Workspace) -> DataFrame:
    """Pairs (a, b, na, nb) to those that bitmaps leave, with the exact intersection size."""

    def by_bitmap(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "xa", "xb")), strict=True)
            keep = pa.array([not _differs_too_much(xa, xb, na, nb) for na, nb, xa, xb in rows], pa.bool_())
            yield batch.select(["a", "b", "na", "nb"]).filter(keep)

    def exact(batches):
        for batch in batches:
            common = []
            for xa, xb in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = np.frombuffer(xa.as_buffer(), K.U64), np.frombuffer(xb.as_buffer(), K.U64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common.append(int((y[at] == x).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(common, pa.int64())], names=["a", "b", "na", "nb", "common"])

    bitmaps = lambda name, to: reps.select(F.col("cls").alias(name), F.col("bitmap").alias(to))
    near = work.write(pairs.join(bitmaps("a", "xa"), "a").join(bitmaps("b", "xb"), "b").mapInArrow(by_bitmap, "a long, b long, na long, nb long"), "near")
    needed = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls"))).distinct()
    sets = _sets_of(docs, work.write(reps.select("cls", "rep").join(needed, "cls", "left_semi"), "needed"), work)
    items = lambda name, to: sets.select(F.col("cls").alias(name), F.col("items").alias(to))
    return near.join(items("a", "xa"), "a").join(items("b", "xb"), "b").mapInArrow(exact, "a long, b long, na long, nb long, common long").distinct()


def _is_link():
    return F.col("common") * 4 >= (F.col("na") + F.col("nb") - F.col("common")) * 3


def _rest_of_regions(docs: DataFrame, members: DataFrame, labels: DataFrame, distances: DataFrame, reps: DataFrame, slices: int, work: Workspace) -> DataFrame:
    """Links (a, b) between members of large regions that are not yet connected.

    Regions with the same pivot are one cell of the pivot. Bitmaps first tell which members have a possible partner left; only
    their sets are read, and pairs are tested inside the cell, so that only links leave it.
    """
    named = members.join(labels.select(F.col("node").alias("a"), "component"), "a", "left").withColumn("label", F.coalesce("component", "a"))
    own = named.groupBy("b", "a").agg(F.min("label").alias("label"), F.min("na").alias("na"), F.min("pos").alias("pos"))
    open_ = own.groupBy("b").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    rest = own.join(open_.select("b", "m"), "b").join(distances.select("a", "b", "distance"), ["a", "b"], "left")
    rest = rest.withColumn("distance", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.col("distance")))
    # size cells: partners are in the same cell or in the next; blocks: every two blocks of a region meet once
    cell = F.floor(F.log(F.col("na").cast("double")) / F.log(F.lit(4 / 3)) + F.lit(1e-9)).cast("int")
    rest = rest.withColumn("cell", cell).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    rest = rest.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    # copy (cell, role 0) is the lower cell of a pair of cells, (cell - 1, role 1) the upper one
    roles = F.array(F.struct(F.col("cell").alias("low"), F.lit(0).alias("role")), F.struct((F.col("cell") - 1).alias("low"), F.lit(1).alias("role")))
    rest = rest.join(reps.select(F.col("cls").alias("a"), "bitmap"), "a")
    rest = rest.withColumn("r", F.explode(roles)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("b", "r.low", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "r.role", "block", "a", "label", "na", "pos", "distance", "bitmap")
    keys = ["b", "low", "one", "two"]

    def by_cell(function):
        def each(batches):
            key, held = None, []
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                    if row[:4] != key:
                        if held:
                            yield from function(held)
                        key, held = row[:4], []
                    held.append(row)
            if held:
                yield from function(held)

        return each

    fields = "b long, low int, one int, two int, role int, block int, a long, label long, na long, pos long, distance double, bitmap binary"
    names = [f.split()[0] for f in fields.split(", ")]

    def possible(rows):
        i, j, _ = _cell_pairs(rows)
        some = [rows[k] for k in np.union1d(i, j).tolist()]
        kinds = [pa.int64(), *[pa.int32()] * 5, *[pa.int64()] * 4, pa.float64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in some], kind) for k, kind in enumerate(kinds)], names=names)

    def exact(rows):
        i, j, apart = _cell_pairs(rows)
        order = np.argsort(apart, kind="stable")  # likely links first: what they connect needs no further test
        sets = [np.frombuffer(r[12], K.U64) for r in rows]
        parent: dict[int, int] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        links = []
        for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
            p, q = root(rows[x][7]), root(rows[y][7])
            if p == q:
                continue
            u, v = sets[x], sets[y]
            if len(u) > len(v):
                u, v = v, u
            common = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
            if linked(common, len(u), len(v)):
                parent[max(p, q)] = min(p, q)
                links.append((rows[x][6], rows[y][6]))
        yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    dealt = rest.repartition(slices, *keys).sortWithinPartitions(*keys)
    left = work.write(dealt.mapInArrow(by_cell(possible), fields), "possible")
    needed = reps.select("cls", "rep").join(left.select(F.col("a").alias("cls")).distinct(), "cls", "left_semi")
    sets = _sets_of(docs, work.write(needed, "needed"), work)
    full = left.join(sets.select(F.col("cls").alias("a"), "items"), "a").select(*names, "items")
    return full.repartition(slices, *keys).sortWithinPartitions(*keys).mapInArrow(by_cell(exact), "a long, b long").distinct()


def _cell_pairs(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a cell that no bound excludes, and how many bits their bitmaps differ in, by size."""
    one, two = rows[0][2], rows[0][3]
    role, block, cls, label, n, pos = (np.array([r[i] for r in rows], np.int64) for i in (4, 5, 6, 7, 8, 9))
    distance = np.array([np.nan if r[10] is None else r[10] for r in rows])
    width = min(len(r[11]) for r in rows) // 8
    bits = np.empty((len(rows), width), np.uint64)
    for k, r in enumerate(rows):
        x = np.frombuffer(r[11], np.uint64)
        while len(x) > width:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        bits[k] = x
    low = np.flatnonzero(role == 0)
    found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
    for some in np.array_split(low, max(1, len(low) * len(rows) >> 19)):
        i, j = (x.ravel() for x in np.meshgrid(some, np.arange(len(rows)), indexing="ij"))
        ok = label[i] != label[j]
        # within the lower cell each pair once; the upper cell only against the lower
        ok &= (role[j] == 1) | (cls[i] < cls[j])
        ok &= (np.minimum(block[i], block[j]) == one) & (np.maximum(block[i], block[j]) == two)
        i, j = i[ok], j[ok]
        apart = np.abs(distance[i] - distance[j]) > 0.25 + 1e-9  # triangle inequality; unknown distances exclude nothing
        ok = pair_fits(n[i], n[j], pos[i], pos[j]) & ~apart
        i, j = i[ok], j[ok]
        for part in np.array_split(np.arange(len(i)), max(1, len(i) * width >> 20)):
            x, y = i[part], j[part]
            differ = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
            ok = 7 * differ <= n[x] + n[y]
            found.append((x[ok], y[ok], differ[ok] / (n[x] + n[y])[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _components(docs: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, cls, component) of every row, and (component, least) with the least id of each component."""
    spark = docs.sparkSession
    slices = shuffle_slices(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def classes(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                g, doc, sizes, prints = shingle_sets(chunk)
                bitmaps = parity_bitmap(sizes, doc, g)
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), pa.array(sizes.astype(np.int64)), pa.array(K.as_long(prints), mask=sizes == 0), pa.array(bitmaps, pa.binary())], names=["doc_id", "n_shingles", "cls", "bitmap"])

    rows = work.write(docs.mapInArrow(classes, "doc_id long, n_shingles long, cls long, bitmap binary"), "classes")
    # equal sets have equal bitmaps; the copies of a class are combined within each task first
    reps = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("rep"), F.max("bitmap").alias("bitmap"))
    reps = work.write(reps, "reps")
    found = work.write(_regions(_entries(docs, _frequencies(docs), 4 * slices), slices), "regions")
    pairs = found.where("kind = 0").select("a", "b", "na", "nb")
    members = found.where("kind = 1")
    stars = members.where("a <> b AND 4 * least(na, nb) >= 3 * greatest(na, nb)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"))
    first = work.write(pairs.unionByName(stars).distinct(), "pairs")
    tested = work.write(_verify(docs, first, reps, work), "tested")
    links = tested.where(_is_link()).select("a", "b")
    labels = components(links, work)
    if members.limit(1).count():
        distance = tested.select("a", "b", (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("distance"))
        both = distance.unionByName(distance.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        labels = work.write(labels, "labels")
        more = work.write(_rest_of_regions(docs, members, labels, both, reps, slices, work), "links")
        if more.limit(1).count():
            labels = components(labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), work)
    labels = work.write(labels, "labels")
    named = rows.drop("bitmap").join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    return named, named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))


def jaccard_components(docs: DataFrame, work: Workspace | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and the class of equal sets ``cls``."""
    named, least = _components(docs, work or Workspace(docs.sparkSession, "jaccard"))
    return named.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "cls")


def keep_one(docs: DataFrame, work: Workspace | None = None) -> DataFrame:
    """The rows of ``docs`` with one row of each component, that with the least id; rows without shingles all stay."""
    work = work or Workspace(docs.sparkSession, "jaccard")
    named, least = _components(docs, work)
    verdict = work.write(named.where("cls IS NOT NULL").select("cls", "component").distinct().join(least, "component"), "verdict")
    at = text_column(docs)

    def tag(batch):
        for chunk in K.chunks(batch.column(at).cast(pa.string())):
            _, _, sizes, prints = shingle_sets(chunk)
            rows = batch.slice(chunk.first, chunk.n)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(K.as_long(prints), mask=sizes == 0)], names=[*rows.schema.names, "cls"])

    tagged = map_rows(docs, tag, ("cls", T.LongType()))
    id_ = F.col(f"c_{docs.columns.index('doc_id')}")
    kept = tagged.join(verdict, "cls", "left").where(F.col("cls").isNull() | id_.eqNullSafe(F.col("least")))
    # an id may have several rows in its component: then only the first of them by its columns stays
    again = named.join(verdict.select("cls", "least"), "cls").where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    own = [f"c_{i}" for i in range(len(docs.columns))]
    if again.limit(1).count():
        again = work.write(again, "again")
        first = F.row_number().over(Window.partitionBy("component").orderBy(f"c_{at}", *(F.xxhash64(F.col(c).cast("string")) for c in own)))
        one = kept.join(again, "component", "left_semi").withColumn("r", first).where("r = 1")
        kept = kept.join(again, "component", "left_anti").select(own).unionByName(one.select(own))
    return kept.select(own).toDF(*docs.columns)
