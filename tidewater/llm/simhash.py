"""SimHash near duplicates: byte-position inverted index with count filtering.

A text's fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64 values (seed 42, unsigned) of
the text's 4-word shingles, repeats included. Two fingerprints link at ``DISTANCE`` = 4 or fewer differing bits.

* A differing bit spoils one of the 8 bytes at most, so linked fingerprints share at least 8 - 4 = 4 positional
  bytes, and at least three of the first seven. The postings of the index are therefore kept for three positional
  bytes together: 35 lists for a distinct fingerprint, each about N / 2**24 long, whatever N is.
* In a list the shared positional bytes of each pair are tallied; pairs that reach 4 matches are verified by counting
  their differing bits. A pair counts in the list of its first three shared positions only. Lists are dealt by
  their key and read as sorted runs, so a task holds one run of at most ``LONG_LIST`` fingerprints.
* The members of a longer list are not paired there. They go to an exact way that is linear in their number: each
  emits the 2,081 values within 2 bits of it. Two fingerprints differ in at most 4 bits exactly if they have
  such a value in common, and a value has at most 2,081 members, so all its members link to the least of them.
* Equal fingerprints are one node from the start; links of nodes become components (``graph.py``), which are joined back
  to the documents with the fingerprints and components that hold many rows broadcast (``join_unique``).

Defined cases: null, empty and word-less texts have fingerprint zero and are linked like any other; under four words the
whole sequence is one shingle; a text is hashed in blocks of 65,536 shingles, so memory beyond the text's own words is bounded;
repeated rows are each returned and are linked by distance 0; ids may repeat (the component is the least id reachable from any
row); null ids are returned and count only if nothing in the component has an id (then it is null); an empty table gives no rows;
columns other than ``doc_id`` and ``text`` are not read, and of clashing names the first column counts.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, first_columns, join_unique, map_rows, shuffle_slices
from .graph import components

WORDS = 4
DISTANCE = 4
SEED = 42
#: Bytes of a fingerprint that linked ones must share, and the positions that make a posting list's key.
SHARED = 8 - DISTANCE
KEYED = SHARED - 1
SLOTS = list(combinations(range(7), KEYED))
LONG_LIST = 1024
_BLOCK = 1 << 16


def fingerprint(text: str | bytes | None, words: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    raw = text.encode() if isinstance(text, str) else text or b""
    # bytes.lower changes A-Z only, bytes.split cuts at \x20 and \x09-\x0D only
    found = raw.lower().split()
    if not found:
        return 0
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    joined = b" ".join(found)
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(found))
    first, last = starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), _BLOCK):
        hashes = [digest(joined[a:z], SEED) for a, z in zip(first[at : at + _BLOCK], last[at : at + _BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): one row per document, the fingerprint as a bigint of the same bits."""
    def each(batch):
        prints = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch.column(1)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["c_0", "print"])

    return map_rows(first_columns(docs, "doc_id", "text"), each, ("print", T.LongType()), drop=1).withColumnRenamed("c_0", "doc_id")


def _masks() -> tuple[list[int], np.ndarray]:
    """Per slot the bits of its key, and the earlier positions outside it, where a pair of this slot may not agree."""
    keys = [sum(0xFF << (8 * p) for p in slot) for slot in SLOTS]
    outside = np.array([[p < slot[-1] and p not in slot for p in range(8)] for slot in SLOTS])
    return keys, outside


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


def _pairs(slot: np.ndarray, prints: np.ndarray, run: np.ndarray, outside: np.ndarray):
    """Verified links of all runs at once: members at distance 1, 2, .. in the sorted order, while their runs last."""
    ends = np.append(np.flatnonzero(np.diff(run)) + 1, len(run))
    behind = ends[run] - np.arange(len(run)) - 1
    for step in range(1, int(behind.max(initial=0)) + 1):
        at = np.flatnonzero(behind >= step)
        differ = (prints[at] ^ prints[at + step]).view(np.uint8).reshape(-1, 8)
        shared = differ == 0
        match = (shared.sum(axis=1) >= SHARED) & ~(shared & outside[slot[at]]).any(axis=1)
        at, differ = at[match], differ[match]
        at = at[_BITS[differ].sum(axis=1) <= DISTANCE]
        if len(at):
            yield prints[at], prints[at + step]


def _tally(long_list: int):
    """Sorted postings (slot, key, print) to links (a, b), and (a, null) for the members of long lists."""
    outside = _masks()[1]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def rows(a, b=None):
        last = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), last], schema=schema)

    def settle(slot, key, prints):
        fresh = np.concatenate([[True], (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])])
        run = np.cumsum(fresh) - 1
        crowded = (np.bincount(run) > long_list)[run]
        if crowded.any():
            yield rows(prints[crowded])
        if not crowded.all():
            keep = ~crowded
            again = np.unique(run[keep], return_inverse=True)[1]
            for a, b in _pairs(slot[keep], prints[keep], again, outside):
                yield rows(a, b)

    def each(batches):
        held, passing = None, None  # the last run, not yet at its end; the key of a long run that passes through
        for batch in batches:
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            if passing is not None:
                same = (now[0] == passing[0]) & (now[1] == passing[1])
                if same.any():
                    yield rows(now[2][same])
                    now = [x[~same] for x in now]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            tail = int(np.flatnonzero((now[0] == now[0][-1]) & (now[1] == now[1][-1]))[0])
            if tail:
                yield from settle(*(x[:tail] for x in now))
            held, passing = [x[tail:] for x in now], None
            if len(held[0]) > long_list:
                yield rows(held[2])
                passing, held = (held[0][0], held[1][0]), None
        if held is not None and len(held[0]):
            yield from settle(*held)

    return each


def _crowd_links(crowd: DataFrame) -> DataFrame:
    """Links that connect whatever is within 4 bits: the members of each value within 2 bits of them, to the least."""
    flips = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in combinations(range(64), 2))]
    signed = np.array(flips, np.uint64).view(np.int64).tolist()
    table = F.broadcast(crowd.sparkSession.createDataFrame([(x,) for x in signed], "flip long"))
    near = crowd.crossJoin(table).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("value"))
    least = near.groupBy("value").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return near.join(least, "value").where("a <> b").select("a", "b").distinct()


def links(prints: DataFrame, work: Workspace, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column ``print`` that connect all within ``DISTANCE`` bits."""
    keys, _ = _masks()
    signed = np.array(keys, np.uint64).view(np.int64).tolist()
    postings = prints.select(F.col("print"), F.posexplode(F.array(*(F.col("print").bitwiseAND(F.lit(k)) for k in signed))).alias("slot", "key"))
    dealt = postings.select("slot", "key", "print").repartition(shuffle_slices(prints.sparkSession), "slot", "key").sortWithinPartitions("slot", "key")
    found = work.write(dealt.mapInArrow(_tally(long_list), "a long, b long").distinct(), "tally")
    crowd = found.where("b is null").select("a")
    verified = found.where("b is not null")
    if crowd.isEmpty():
        return verified
    return verified.unionByName(_crowd_links(crowd))


def simhash_components(docs: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document, see the module's text for its defined cases."""
    work = Workspace(docs.sparkSession, "simhash")
    hashed = work.write(fingerprints(docs), "prints")
    distinct = work.write(hashed.groupBy("print").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")), "distinct")
    linked = components(links(distinct.select("print"), work, long_list), work).withColumnRenamed("node", "print")
    placed = work.write(distinct.join(linked, "print", "left").select("print", "n", "low", F.coalesce("component", "print").alias("component")), "placed")
    whole = placed.groupBy("component").agg(F.count("*").alias("members"), F.min("low").alias("component_id"))
    named = work.write(join_unique(placed.select("print", "n", "component"), whole, "component", "members").select("print", "n", "component_id"), "named")
    out = join_unique(hashed, named, "print", "n")
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
