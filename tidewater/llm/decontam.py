"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``width`` consecutive words; a shorter item that has words
is one window. Containment of a whole window needs every one of its words, so a prefix of one
word is enough: the window's rarest word over all documents. A document position can
only begin an occurrence if it holds such a word at the window's offset of it and if the window
fits into the document around it (length and positional bounds).

There is one way at every size of the benchmark. Its distinct windows are a Spark table. Every task
that reads documents holds two tables of fixed size, whatever the benchmark: for each of ``SLOTS`` hashes of a
word the (size, offset) pairs of the windows whose rarest word falls there, and a bit for each of
64 * ``SLOTS`` hashes of a window. What passes both leaves the task with its words, once per
document and window, and is joined with the table of windows on the words themselves, so the result
is exact; a full bit table only lets more rows through to that join. Documents are never shuffled with
their texts. Windows that are met very often are joined where their rows lie (``join_unique``).
The list of item ids and its digest are made once for each distinct combination of items.

Defined cases: null and empty texts have no words (n_words 0, not contaminated); items without
words have no window; repeated items count by distinct item_id; a repeated document row gives
a repeated result row; a null item_id is never reported; of equally rare words of a window the one with the
least hash is its prefix; a very long text is one chunk of its task (about 75 bytes of memory per byte) and gives one row;
an empty benchmark leaves all documents clean; an empty table gives no rows; further columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import Workspace, first_columns, join_unique, numbered, text_column

WIDTH = 10
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS  # entries of each fixed table: 8 MB at 8 bytes
BLOCK = 1 << 15  # windows of a long item that are handled together
_TABLE = K.is_word_byte("alnum")
_CODES = K.byte_codes(lower=True)
_ONE = K.U64(1)


def word_hashes(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, docs = K.spans(chunk, _TABLE)
    if not len(starts):
        return starts, ends, docs, np.zeros(0, K.U64)
    return starts, ends, docs, K.span_hash(K.prefix_sums(chunk.data, _CODES), starts, ends)


def item_windows(h: np.ndarray, docs: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of every window of ``n`` items."""
    counts, first = K.run_lengths(docs, n)
    m = max(0, len(h) - width + 1)
    at = np.flatnonzero(docs[:m] == docs[len(docs) - m :])
    short = np.flatnonzero((counts > 0) & (counts < width))
    return np.concatenate([docs[at], short]), np.concatenate([at, first[short]]), np.concatenate([np.full(len(at), width), counts[short]])


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> K.U64(64 - SLOT_BITS)).astype(np.int64)


def _bit(h: np.ndarray) -> np.ndarray:
    """The bit of a window's hash within its slot."""
    return _ONE << ((h >> K.U64(64 - SLOT_BITS - 6)) & K.U64(63))


def _place(size, offset):
    """Bit of a (size, offset) pair; beyond a width of 10 some pairs share one, which costs comparisons only."""
    return (size * (size - 1) // 2 + offset) % 64


def _word_sums(h: np.ndarray) -> np.ndarray:
    up, _ = K._POWERS.upto(len(h) + 1)
    sums = np.zeros(len(h) + 1, K.U64)
    np.cumsum(h * up[1 : len(h) + 1], dtype=K.U64, out=sums[1:])
    return sums


def _window_hash(sums: np.ndarray, begin: np.ndarray, size) -> np.ndarray:
    _, down = K._POWERS.upto(len(sums))
    return K.mix64((sums[begin + size] - sums[begin]) * down[begin] + np.asarray(size).astype(K.U64))


def _rarest(h: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, frequency: np.ndarray) -> np.ndarray:
    """Offset of each window's rarest word; ties go to the least hash, then to the first place."""
    offsets = np.arange(width)
    inside = offsets < size[:, None]
    words = h[np.where(inside, begin[:, None] + offsets, begin[:, None])]
    often = np.where(inside, frequency[_slot(words)], np.iinfo(np.int64).max)
    least = often == often.min(axis=1, keepdims=True)
    return np.where(least & inside, words, K.U64(0xFFFFFFFFFFFFFFFF)).argmin(axis=1)


def _fixed_table(df: DataFrame, at: str, value: str) -> np.ndarray:
    """Two columns of at most ``SLOTS`` rows as an array over all slots."""
    rows = df.toArrow()  # one row per slot at most
    out = np.zeros(SLOTS, np.int64)
    out[rows.column(at).to_numpy()] = rows.column(value).to_numpy()
    return out


def _frequencies(docs: DataFrame, items: DataFrame) -> np.ndarray:
    """How many words of all documents fall into each slot that holds a word of an item (one row per slot and task is shuffled)."""

    def slots(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                yield pa.record_batch([pa.array(np.unique(_slot(word_hashes(chunk)[3])))], names=["slot"])

    used = _fixed_table(items.mapInArrow(slots, "slot long").distinct().withColumn("used", F.lit(1).cast("long")), "slot", "used")
    names = np.flatnonzero(used)
    if not len(names):
        return used
    number = np.full(SLOTS, len(names), np.int32)
    number[names] = np.arange(len(names), dtype=np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((names, number))

    def count(batches):
        names, number = shared.value
        total = np.zeros(len(names) + 1, np.int64)
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                total += np.bincount(number[_slot(word_hashes(chunk)[3])], minlength=len(names) + 1)
        some = np.flatnonzero(total[:-1])
        yield pa.record_batch([pa.array(names[some]), pa.array(total[some])], names=["slot", "n"])

    return _fixed_table(docs.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")), "slot", "n")


class _Index:
    """Distinct windows of a benchmark as a table, and the two fixed tables that documents are held against."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, width: int, work: Workspace):
        spark = docs.sparkSession
        slim = first_columns(benchmark, "item_id", "text")
        items = slim.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
        shared = spark.sparkContext.broadcast(_frequencies(docs, items))

        def each(batches):
            frequency = shared.value
            for batch in batches:
                for chunk in K.chunks(batch.column(1)):
                    starts, ends, docs, h = word_hashes(chunk)
                    doc, begin, size = item_windows(h, docs, chunk.n, width)
                    sums, lowered = _word_sums(h), chunk.data.tobytes().lower()
                    for a in range(0, len(doc), BLOCK):
                        d, b, n = doc[a : a + BLOCK], begin[a : a + BLOCK], size[a : a + BLOCK]
                        offset = _rarest(h, b, n, width, frequency)
                        key = _window_hash(sums, b, n)
                        words = [_words(lowered, starts, ends, x, y) for x, y in zip(b.tolist(), n.tolist(), strict=True)]
                        ids = batch.column(0).take(pa.array(chunk.first + d))
                        numbers = [_slot(h[b + offset]), K.as_long(_ONE << _place(n, offset).astype(K.U64)), _slot(key), K.as_long(_bit(key))]
                        yield pa.record_batch([ids, pa.array(words, pa.binary()), *(pa.array(x) for x in numbers)], names=["item_id", "words", "slot", "place", "cell", "bit"])

        rows = items.mapInArrow(each, "item_id string, words binary, slot long, place long, cell long, bit long")
        numbers = [F.first(c).alias(c) for c in ("slot", "place", "cell", "bit")]  # equal in all rows of a window
        windows = rows.groupBy("words").agg(*numbers, F.array_sort(F.collect_set("item_id")).alias("ids"))
        self.windows = work.write(windows.withColumn("items_key", F.sha2(F.to_json("ids").cast("binary"), 256)), "windows")
        places = _fixed_table(self.windows.groupBy("slot").agg(F.bit_or("place").alias("place")), "slot", "place")
        bits = _fixed_table(self.windows.groupBy("cell").agg(F.bit_or("bit").alias("bit")), "cell", "bit")
        self.width, self.tables = width, spark.sparkContext.broadcast((places.view(K.U64), bits.view(K.U64)))

    def confirmed(self, met: DataFrame, work: Workspace) -> DataFrame:
        """Rows of ``met`` (a written table) whose ``words`` are a window, with the key of the window's items."""
        known = work.write(met.groupBy("words").agg(F.count(F.lit(1)).alias("n")).join(self.windows.select("words", "items_key"), "words"), "met")
        return join_unique(met, known, "words", "n")


def _words(lowered: bytes, starts: np.ndarray, ends: np.ndarray, begin: int, size: int) -> bytes:
    return b" ".join(lowered[s:e] for s, e in zip(starts[begin : begin + size].tolist(), ends[begin : begin + size].tolist(), strict=True))


def _candidates(chunk: K.Chunk, tables: tuple[np.ndarray, np.ndarray], width: int):
    """Words per document, and per document the windows that may occur: words -> (size, places)."""
    places, bits = tables
    starts, ends, docs, h = word_hashes(chunk)
    counts, first = K.run_lengths(docs, chunk.n)
    found: dict[int, dict[bytes, tuple[int, list[int]]]] = {}
    masks = places[_slot(h)]
    at = np.flatnonzero(masks)
    if not len(at):
        return counts, found
    masks, low, high = masks[at], first[docs[at]], (first + counts)[docs[at]]
    sums, lowered = _word_sums(h), None
    seen = np.bitwise_or.reduce(masks)
    for size in range(1, width + 1):
        for offset in range(size):
            place = _ONE << K.U64(_place(size, offset))
            if not seen & place:
                continue
            begin = at - offset
            fits = ((masks & place) != 0) & (begin >= low) & (begin + size <= high)
            begin = begin[fits]
            key = _window_hash(sums, begin, size)
            begin = begin[(bits[_slot(key)] & _bit(key)) != 0]
            if len(begin) and lowered is None:
                lowered = chunk.data.tobytes().lower()
            for b in begin.tolist():
                d = int(docs[b])
                found.setdefault(d, {}).setdefault(_words(lowered, starts, ends, b, size), (size, []))[1].append(b - int(first[d]))
    return counts, found


_FOUND = pa.list_(pa.struct([("words", pa.binary()), ("size", pa.int32()), ("at", pa.list_(pa.int64()))]))


def clean_rows(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, work: Workspace | None = None) -> DataFrame:
    """The rows of ``docs`` without an occurrence of an item window; contents that have one are told apart by SHA-256."""
    work = work or Workspace(docs.sparkSession, "decontamination")
    at = f"c_{text_column(docs)}"
    content = F.sha2(F.coalesce(F.col(at).cast("string"), F.lit("")).cast("binary"), 256)
    texts = numbered(docs).select(F.col(at).cast("string").alias("text"), content.alias("content"))
    index = _Index(texts, benchmark, width, work)
    tables = index.tables

    def scan(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(0)):
                found = _candidates(chunk, tables.value, width)[1]
                rows = [(chunk.first + d, words) for d, windows in found.items() for words in windows]
                yield pa.record_batch([batch.column(1).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.binary())], names=["content", "words"])

    met = work.write(texts.mapInArrow(scan, "content string, words binary").distinct(), "met")
    hit = work.write(index.confirmed(met, work).select(F.col("content").alias("hit")).distinct(), "hit")
    return numbered(docs).join(hit, content == F.col("hit"), "left_anti").toDF(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, work: Workspace | None = None) -> DataFrame:
    """One row per document: words, words inside an occurrence of an item window, and the items that occur."""
    work = work or Workspace(docs.sparkSession, "decontamination")
    slim = first_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = _Index(slim, benchmark, width, work)
    tables = index.tables

    def scan(batches):
        for batch in batches:
            for chunk in K.chunks(batch.column(1)):
                counts, found = _candidates(chunk, tables.value, width)
                windows = [[{"words": w, "size": n, "at": at} for w, (n, at) in found[d].items()] if d in found else None for d in range(chunk.n)]
                yield pa.record_batch([batch.column(0).slice(chunk.first, chunk.n), pa.array(counts, pa.int64()), pa.array(windows, _FOUND)], names=["doc_id", "n_words", "found"])

    scanned = slim.mapInArrow(scan, "doc_id long, n_words long, found array<struct<words:binary,size:int,at:array<bigint>>>")
    scanned = work.write(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")  # a row's number is fixed by writing it
    met = scanned.where("found IS NOT NULL").select("row", F.explode("found").alias("f")).select("row", "f.words", "f.size", "f.at")
    spans = F.transform("at", lambda a: F.struct(a.alias("at"), (a + F.col("size")).alias("to")))
    per_row = index.confirmed(met, work).groupBy("row").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"), F.array_sort(F.collect_set("items_key")).alias("keys"))
    start = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("spans", start, lambda acc, x: F.struct(F.greatest(acc["to"], x["to"]).alias("to"), (acc["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(acc["to"], x["at"]))).alias("n")))
    per_row = work.write(per_row.select("row", covered["n"].alias("n_hit"), "keys", F.sha2(F.array_join("keys", ",").cast("binary"), 256).alias("group")), "rows")
    # the items of each distinct combination of windows' items
    groups = per_row.groupBy("group").agg(F.first("keys").alias("keys")).select("group", F.explode("keys").alias("items_key"))
    named = index.windows.groupBy("items_key").agg(F.first("ids").alias("ids"))
    lists = groups.join(named, "items_key").groupBy("group").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    judged = per_row.select("row", "n_hit", "group").join(lists, "group").drop("group")
    none = F.array().cast("array<string>")
    rest = scanned.where("found IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    hit = scanned.where("found IS NOT NULL").select("row", "doc_id", "n_words").join(judged, "row", "left")
    out = rest.unionByName(hit.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items")
