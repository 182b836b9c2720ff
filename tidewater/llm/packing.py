"""Packing of token pieces into sequences: best-fit decreasing with certified bin counts.

Tokens come from a tokenizer file given by path. Texts are cut where the byte-level pre-tokenizer always
cuts (before white space after a non-space, after a lone line break, between a letter and ASCII
punctuation); each distinct unit is encoded once per worker and the ids of a document are gathered from that
table. Units are encoded by a rank encoder over the file's own vocabulary where that gives the file's ids (byte-level BPE with
ids in the order of merges), else by the tokenizer. Texts with unusual white space or control bytes are encoded whole by the tokenizer.

Every partition of pieces is packed by best-fit decreasing on its lengths. Dual feasible functions (the
identity, Martello and Toth's thresholds and Fekete and Schepers' roundings) give a lower bound on the number of
sequences: a partition that meets it is certified. While the sum of the partitions has a gap to the bound
over all pieces, partitions with a gap exchange their documents, and certified ones, whose last sequences add up, give those with room:
sequences are dealt anew, by their number and the round, to groups of about ``EXCHANGE`` pieces, which are packed by best-fit
decreasing; a new packing of a group is taken if it needs fewer sequences. This goes on until the whole packing is certified,
a round saves no more than ``MIN_GAIN`` of the open sequences, or ``MAX_STAGES`` are done. Pieces are numbered as they are written and dealt by that number, so rows that repeat are spread and no task holds more than a group.
``packing_bound`` gives the sequences used and the lower bound over all pieces.

Defined cases: null and empty texts are one piece with the end id alone; documents of more than ``capacity`` ids
are cut so that only the first piece can be shorter; repeated rows are packed as rows of their own; ties between
equal lengths go by doc_id, piece and checksum; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import Workspace

CAPACITY = 1024
END_ID = 2
PART_PIECES = 1 << 14
EXCHANGE = 1 << 18
MIN_GAIN = 1e-4
MAX_STAGES = 31  # a stage's number is in the upper five bits of its sequence ids
CACHE_UNITS = 250_000
_CODES = K.byte_codes()
#: bytes after which the cuts below could differ from the pre-tokenizer's: control bytes and white space beyond space and \n
_UNUSUAL = re.compile(rb"[\x00-\x09\x0b-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


#: Fixed value: the cuts of the byte-level pre-tokenizer.
PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones themselves, the others numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return letters


def rank_encoder(path: str):
    """A faster encoder of the same ids, if the file is a byte-level BPE whose ids follow the order of its merges; else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges"):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if [model["vocab"].get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    import tiktoken

    letters = byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in model["vocab"].items() if i < 256 + len(merges)}
    return tiktoken.Encoding("units", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class UnitTable:
    """Ids of the units met so far; one per Python worker, emptied when it has ``CACHE_UNITS`` units."""

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None
        self.encode_lines = rank_encoder(path) or (lambda text: self.encode([text])[0])
        (self.line_break,) = self.encode_lines("\n")
        self.clear()

    def clear(self) -> None:
        self.row: dict[int, int] = {}
        self.ids, self.first, self.count, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.tokenizer is None:  # loaded by the workers that need it
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def split(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units and how many each has. Units are encoded as lines of one text where that cannot change them."""
        size = ends - starts
        inner = K.expand(starts, size)
        of = np.repeat(np.arange(len(starts)), size)
        odd = np.zeros(len(starts), bool)
        odd[of[data[inner] == 10]] = True
        odd |= data[ends - 1] == 32
        plain = np.flatnonzero(~odd)
        counts = np.zeros(len(starts), np.int64)
        ids = np.zeros(0, np.uint32)
        if len(plain):
            lines = np.full(int((size[plain] + 1).sum()), 10, np.uint8)
            at = np.cumsum(size[plain] + 1) - size[plain] - 1
            lines[K.expand(at, size[plain])] = data[K.expand(starts[plain], size[plain])]
            ids = np.array(self.encode_lines(lines.tobytes().decode()), np.uint32)
            stop = np.flatnonzero(ids == self.line_break)
            counts[plain] = np.diff(np.concatenate([[-1], stop])) - 1
            ids = ids[ids != self.line_break]
        first = np.cumsum(counts) - counts
        rest = np.flatnonzero(odd)
        if len(rest):
            other = [self.encode_lines(data[starts[i] : ends[i]].tobytes().decode()) for i in rest.tolist()]
            first[rest] = len(ids) + np.cumsum([0, *map(len, other)])[:-1]
            counts[rest] = [len(x) for x in other]
            ids = np.concatenate([ids, np.array([x for o in other for x in o], np.uint32)])
        return ids[K.expand(first, counts)], counts

    def rows(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Table rows of distinct units given by their hashes and places."""
        if len(self.row) > CACHE_UNITS:
            self.clear()
        known = hashes.tolist()
        new = np.array([i for i, h in enumerate(known) if h not in self.row], np.int64)
        if len(new):
            ids, counts = self.split(data, starts[new], ends[new])
            n, at = len(self.row), self.used
            self.first, self.count, self.ids = _room(self.first, n + len(new)), _room(self.count, n + len(new)), _room(self.ids, at + len(ids))
            self.count[n : n + len(new)] = counts
            self.first[n : n + len(new)] = at + np.cumsum(counts) - counts
            self.ids[at : at + len(ids)] = ids
            self.used = at + len(ids)
            self.row.update(zip(hashes[new].tolist(), range(n, n + len(new)), strict=True))
        return np.fromiter(map(self.row.__getitem__, known), np.int64, len(known))


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


_TABLES: dict[str, UnitTable] = {}


def unit_table(path: str) -> UnitTable:
    if path not in _TABLES:
        _TABLES[path] = UnitTable(path)
    return _TABLES[path]


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where the pre-tokenizer certainly cuts, document starts included."""
    n = len(data)
    space = (data == 32) | (data == 10)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = edge[:n]
    before[0] = after[-1] = True
    cut = begins | (space & ~before)
    # after a line break that stands alone and is followed by a non-space in the same document
    alone = (data == 10) & (~before | begins) & ~after & ~edge[1:]
    cut[1:] |= alone[:-1]
    letter = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    # the second byte of U+00C0..U+00FF but the two signs among them
    accented = np.zeros(n, bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    mark = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57))
    cut[1:] |= (letter | accented)[:-1] & mark[1:]
    return np.flatnonzero(cut)


def token_ids(chunk: K.Chunk, table: UnitTable, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a chunk, each closed by ``end_id``, and their offsets."""
    data = chunk.data
    plain = _UNUSUAL.search(data.tobytes()) is None
    if not plain and chunk.n > 1:  # document by document; few are unusual
        parts = []
        for i in range(chunk.n):
            a, b = chunk.offsets[i], chunk.offsets[i + 1]
            parts.append(token_ids(K.Chunk(0, data[a:b], np.array([0, b - a])), table, end_id)[0])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    if not len(data):
        return np.full(chunk.n, end_id, np.uint32), np.arange(chunk.n + 1)
    if not plain:
        ids = np.array([*table.encode([data.tobytes().decode()])[0], end_id], np.uint32)
        return ids, np.array([0, len(ids)])
    starts = unit_starts(data, chunk.offsets)
    ends = np.append(starts[1:], len(data))
    hashes, sample, at = np.unique(K.span_hash(K.prefix_sums(data, _CODES), starts, ends), return_index=True, return_inverse=True)
    rows = table.rows(hashes, data, starts[sample], ends[sample])[at]
    counts = table.count[rows]
    doc = np.searchsorted(chunk.offsets, starts, side="right") - 1
    per_doc = np.bincount(doc, counts, minlength=chunk.n).astype(np.int64) + 1
    offsets = np.concatenate([[0], np.cumsum(per_doc)])
    out = np.full(int(offsets[-1]), end_id, np.uint32)
    inside = np.ones(len(out), bool)
    inside[offsets[1:] - 1] = False
    out[inside] = table.ids[K.expand(table.first[rows], counts)]
    return out, offsets


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (uint32 bytes)."""

    def each(batches):
        table = unit_table(tokenizer_path)
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                ids, offsets = token_ids(chunk, table, end_id)
                raw = ids.astype("<u4").tobytes()
                row, number, start, length, crc, blob = [], [], [], [], [], []
                for i in range(chunk.n):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    at, k = a, 0
                    while at < b:
                        to = at + ((b - at) % capacity or capacity)
                        row.append(chunk.first + i)
                        number.append(k)
                        start.append(at - a)
                        length.append(to - at)
                        crc.append(zlib.crc32(raw[4 * at : 4 * to]))
                        if with_ids:
                            blob.append(raw[4 * at : 4 * to])
                        at, k = to, k + 1
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(blob, pa.binary())] * with_ids, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(each, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item; ``lengths`` descend. Equal lengths are placed many at a time."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by the room left
    open_ = np.zeros(capacity + 1, bool)
    used = 0
    sizes, first, counts = np.unique(lengths, return_index=True, return_counts=True)
    for size, at, left in zip(sizes[::-1].tolist(), first[::-1].tolist(), counts[::-1].tolist(), strict=True):
        while left:
            room = size + int(open_[size:].argmax())
            if not open_[room]:  # no open bin has room: new ones, filled one after the other
                room = capacity
                want = -(-left // (capacity // size))
                own = list(range(used + want - 1, used - 1, -1))
                used += want
            else:
                own = free[room]
            each = min(room // size, left)  # the fullest bin that fits stays the fullest until it is full
            take = min(len(own), left // each)
            chosen = own[len(own) - take :]
            del own[len(own) - take :]
            k = take * each
            bins[at : at + k] = np.repeat(chosen, each)
            offsets[at : at + k] = capacity - room + np.tile(np.arange(each) * size, take)
            rest = room - each * size
            if rest:
                free[rest].extend(chosen)
                open_[rest] = True
            at, left = at + k, left - k
            if room < capacity:
                open_[room] = bool(own)
            elif own:  # the last new bin takes what is left
                used -= len(own)
    return bins, offsets, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """Largest of three families of dual feasible bounds on the number of bins; ``count`` holds the items of each length."""
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    above = count[::-1].cumsum()[::-1]  # items of at least this size
    weight = np.concatenate([[0], np.cumsum(count * size)])
    for k in range(1, capacity // 2 + 1):
        # items over capacity - k need a bin of their own, those down to k fill the rest of the others
        big = int(above[capacity - k + 1])
        best = max(best, big - (-int(weight[capacity - k + 1] - weight[k]) // capacity))
    for k in range(1, 100):
        whole = (size * (k + 1)) % capacity == 0
        scaled = np.where(whole, size * k, (size * (k + 1)) // capacity * capacity)  # k * capacity times the rounded size
        best = max(best, -(-int((count * scaled).sum()) // (k * capacity)))
    return best


_ROW = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_ROW}, part long, sequence_id long, offset long, open boolean"


def _pack_group(rows: pa.Table, part: int, stage: int, capacity: int) -> pa.Table:
    """Packs a group anew if that needs fewer sequences than it has; leaves open all of it, or if it is certified its sequences with room."""
    n = len(rows)
    length = rows.column("length").to_numpy()
    order = np.lexsort((rows.column("ids_crc32").to_numpy(), rows.column("piece").to_numpy(), rows.column("doc_id").fill_null(0).to_numpy(), -length))
    had = len(np.unique(rows.column("sequence_id").to_numpy())) if stage else n + 1
    bound = lower_bound(length, capacity)
    bins, offsets, used = (None, None, had) if had == bound else best_fit_decreasing(length[order], capacity)
    if used < had:
        sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
        sequence[order], offset[order] = (stage << 58) + (part << 26) + bins, offsets
    else:
        used, sequence, offset = had, rows.column("sequence_id").to_numpy(), rows.column("offset").to_numpy()
    if used > bound:
        open_ = np.ones(n, bool)
    else:
        _, at = np.unique(sequence, return_inverse=True)
        open_ = np.bincount(at, length)[at] < capacity
    return pa.table([*(rows.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(np.full(n, part)), pa.array(sequence), pa.array(offset), pa.array(open_)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "sequence_id", "offset", "open"])


def _stage(stage: int, capacity: int):
    def each(key, table):
        return _pack_group(table, key[0].as_py(), stage, capacity)

    return each


def _bound(rows: DataFrame, capacity: int) -> int:
    count = np.zeros(capacity + 1, np.int64)
    for row in rows.groupBy("length").count().collect():  # one row per length
        count[row["length"]] = row["count"]
    return bound_of_counts(count, capacity)


def packing_bound(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences of a packing, each of which begins with one piece at offset 0, and the lower bound for all its pieces."""
    return packed.where("offset = 0").count(), _bound(packed, capacity)


def pack(rows: DataFrame, work: Workspace, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, exchange: int = EXCHANGE, min_gain: float = MIN_GAIN) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that are read from a written table; its ``number`` tells rows apart."""
    parts = max(1, -(-rows.count() // part_pieces))
    bound = _bound(rows, capacity)
    zero = F.lit(0).cast("long")
    keyed = rows.select("doc_id", "piece", "start", "length", "ids_crc32", F.pmod(F.xxhash64("number"), F.lit(parts)).alias("part"), zero.alias("sequence_id"), zero.alias("offset"), F.lit(True).alias("open"))
    closed, shut, before = None, 0, None
    for stage in range(MAX_STAGES + 1):
        done = work.write(keyed.groupBy("part").applyInArrow(_stage(stage, capacity), _PACKED), "packed")
        begins = F.col("offset") == 0  # of each sequence one row
        seen = done.agg(F.count_if("open").alias("pieces"), F.count_if(begins).alias("all"), F.count_if(begins & F.col("open")).alias("open")).first()
        saved = None if before is None else before - seen["all"]
        if not seen["pieces"] or shut + seen["all"] == bound or (saved is not None and saved <= min_gain * before) or stage == MAX_STAGES:
            break
        full = done.where("NOT open")
        closed = full if closed is None else closed.unionByName(full)
        shut, before = shut + seen["all"] - seen["open"], seen["open"]
        groups = max(1, -(-seen["pieces"] // exchange))
        keyed = done.where("open").withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(stage)), F.lit(groups)))
    packed = done if closed is None else closed.unionByName(done)
    return packed.drop("part", "open")


def pack_documents(docs: DataFrame, tokenizer_path: str, work: Workspace | None = None, capacity: int = CAPACITY) -> DataFrame:
    work = work or Workspace(docs.sparkSession, "packing")
    cut = pieces(docs, tokenizer_path, capacity).withColumn("number", F.monotonically_increasing_id())  # fixed by writing it
    return pack(work.write(cut, "pieces"), work, capacity)
