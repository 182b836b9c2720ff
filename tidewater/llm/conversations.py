"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn-id columns.

A conversation's turns become ids (128 bits of the SHA-256 of role and text, then the text's length in bytes), and its sequence
is cut into blocks of ``WIDTH`` positions: one row per conversation and block, with columns t1 .. t8 and the block's
prior node. ``GROUP BY prior, ROLLUP (t1, .., t8)`` then aggregates the prefixes of all lengths together; grouping_id tells
a group's length, and groups whose last id is null are those of conversations that had ended before. A node is
named by a hash of its path, so the next block can be keyed by it. Conversations go on to the next block only while
their node has more than one member; what follows a node of a single member is a chain that its length describes.

The smallest member of a node is its owner. Along a conversation's path there is one depth from which on it owns all nodes
(one more than its length if it owns none); a first rollup finds it. From this every sum over a subtree is a plain sum
over members, taken by a second rollup:

* a child is owned by the owner of its parent or by a conversation that owns nodes from that depth on;
* a leaf is counted with its owner;
* the nodes that a conversation shares without owning them are those above its own first one, so the bytes it saves
  below a node are the bytes of its path from there to its own first node.

No group is ever gathered: positions come from a range shuffle (``global_positions``), so a conversation with a third of all
turns spans many tasks; rollups combine before they shuffle; nodes with very many members, children or turns are joined
by broadcast (``join_unique``). The ids that end at a node are joined to text in many tasks; only these
pieces are read in order by one hasher, as SHA-256 requires, a piece at a time.

Defined cases: a null role or text is empty; turns sort null first, equal ones by the hash of role and text; repeated rows are turns of their
own; rows without a conv_id belong to no conversation; an empty table gives no nodes; texts of any length are hashed by Spark, and
only their hash moves; negative ids take the remainder with their own sign; columns other than the four named are not read, and of clashing names the first
column counts.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import global_positions
from .common import Workspace, first_columns, join_unique, shuffle_slices

#: Positions of a block, i.e. columns of a rollup.
WIDTH = 8
#: Rebuilding: conversations share the beginning of the first of their ``FAMILY``, of under ``SHARED`` turns.
FAMILY, SHARED = 5, 9
_STEPS = 10_000


def _digest(content: Column) -> Column:
    return F.substring(F.unhex(F.sha2(content, 256)), 1, 16)


def turn_id() -> Column:
    """Role and text as 24 bytes: 16 of their hash, 8 of the text's length."""
    size = F.octet_length("text").cast("long")
    content = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")
    return F.concat(_digest(content), F.unhex(F.lpad(F.hex(size), 16, "0")))


def _size(turn: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(turn, 17, 8)), 16, 10).cast("long"), F.lit(0))


def ordered_turns(conversations: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, turn_id, pos): every turn with its place in its conversation, from 1."""
    turns = first_columns(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL").fillna("", ["role", "text"])
    # equal turns may not meet in one task either: the last key only spreads them
    slim = turns.select("conv_id", "turn", turn_id().alias("turn_id"), F.monotonically_increasing_id().alias("tie"))
    placed = global_positions(slim, [F.col("turn").asc_nulls_first(), "turn_id", "tie"], ["conv_id"], "pos")
    return work.write(placed.select("conv_id", "turn_id", F.col("pos").cast("long").alias("pos")), "turns")


def rebuild(turns: DataFrame, work: Workspace, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (conv_id, length), and their turns (conv_id, length, pos, turn_id).

    A conversation takes the first h turns of the first of its family, h = crc32(id) % ``shared``, then its own from the (h + 1)-th on.
    """
    sizes = work.write(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    source = sizes.select(F.col("conv_id").alias("source"), F.col("n").alias("source_n"))
    found = sizes.withColumn("source", F.col("conv_id") - F.col("conv_id") % family).join(source, "source", "left")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    found = found.withColumn("h", h).withColumn("k", F.least("h", F.coalesce("source_n", F.lit(0))))
    convs = work.write(found.select("conv_id", "n", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    own = join_unique(turns, convs, "conv_id", "n").where("pos > h").select("conv_id", "length", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn_id")
    lead = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < shared)).withColumnRenamed("conv_id", "source")
    near = F.explode(F.array(*(F.try_add(F.col("source"), F.lit(i)) for i in range(1 - family, family))))
    lead = lead.select("source", "turn_id", "pos", near.alias("conv_id")).where(F.col("conv_id") - F.col("conv_id") % family == F.col("source"))
    lead = lead.join(convs, "conv_id").where("pos <= h").select("conv_id", "length", "pos", "turn_id")
    return convs.select("conv_id", "length"), own.unionByName(lead)


def _blocks(convs: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """(conv_id, block, length, t1 ..): a row per conversation and block; a conversation without turns has a block 0, too."""
    cells = turns.select("conv_id", "length", F.expr(f"(pos - 1) DIV {width}").alias("block"), ((F.col("pos") - 1) % width).alias("cell"), "turn_id")
    none = convs.select("conv_id", "length", F.lit(0).cast("long").alias("block"), F.lit(None).cast("long").alias("cell"), F.lit(None).cast("binary").alias("turn_id"))
    columns = (F.max(F.when(F.col("cell") == j, F.col("turn_id"))).alias(f"t{j + 1}") for j in range(width))
    return cells.unionByName(none).groupBy("conv_id", "block", "length").agg(*columns)


def _path(width: int, upto: Column | None = None) -> Column:
    """Name of the node that the block's turns (only the first ``upto``) lead to; the prior node's if there are none."""
    cells = [F.col(f"t{j + 1}") if upto is None else F.when(upto > j, F.col(f"t{j + 1}")) for j in range(width)]
    content = F.concat("prior", *(F.coalesce(c, F.lit(b"")) for c in cells))
    return F.when(F.length(content) == F.length("prior"), F.col("prior")).otherwise(_digest(content))


def _bytes(width: int, upto: Column | None = None) -> Column:
    """Bytes of the texts before the block and in it (in its first ``upto`` turns)."""
    sizes = [_size(F.col(f"t{j + 1}")) for j in range(width)]
    return sum((s if upto is None else F.when(upto > j, s).otherwise(0) for j, s in enumerate(sizes)), F.col("before"))


def _rollup(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """All prefixes within the blocks of ``rows``; ``steps`` is the number of turns of a prefix in its block."""
    cells = ", ".join(f"t{j + 1}" for j in range(width))
    groups = rows.sparkSession.sql(
        f"SELECT base, prior, before, {cells}, {width} - bit_count(grouping_id()) AS steps, {aggregates} "
        f"FROM {{rows}} GROUP BY base, prior, before, ROLLUP ({cells})", rows=rows)
    # the last id is there, and only block 0 has a node (the root) before its first turn
    last = F.coalesce(*(F.when(F.col("steps") == j + 1, F.col(f"t{j + 1}").isNotNull()) for j in range(width)), F.col("base") == 0)
    return groups.where(last).withColumn("depth", F.col("base") + F.col("steps"))


def _owners(walk: list[DataFrame], single: DataFrame, convs: DataFrame, work: Workspace) -> DataFrame:
    """Per conversation: the depth from which on it owns nodes, the bytes above it, the owner of the node above it, leaf."""
    nodes = walk[0]
    for more in walk[1:]:
        nodes = nodes.unionByName(more)
    first = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "parent", "above")).alias("first"), F.max("leaf").alias("leaf"))
    first = work.write(first.select("conv_id", "leaf", "first.*"), "first")
    branches = first.where("depth > 0").groupBy("parent").agg(F.count("*").alias("n"))
    above = work.write(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv")).join(branches, "parent"), "branches")
    named = join_unique(first.where("depth > 0"), above, "parent", "n").select("conv_id", "parent_conv")
    chain = single.select("conv_id", F.lit(1).cast("long").alias("chained"))
    joined = convs.join(first, "conv_id", "left").join(named, "conv_id", "left").join(chain, "conv_id", "left")
    owned = joined.select("conv_id", F.coalesce("depth", F.col("length") + 1).alias("owns"), F.coalesce("above", "total").alias("shared"), "parent_conv",
                          F.greatest(F.coalesce("leaf", F.lit(0)), F.coalesce("chained", F.lit(0))).cast("long").alias("leaf"))
    return work.write(owned, "owners")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the ids that end at a node, numerically ascending, comma-joined."""
    slices = shuffle_slices(ends.sparkSession)

    def runs(column):
        values = column.to_pylist()
        starts = [i for i in range(len(values)) if i == 0 or values[i] != values[i - 1]]
        return values, zip(starts, [*starts[1:], len(values)])

    def join_ids(batches):
        for batch in batches:
            nodes, found = runs(batch.column(0))
            ids = batch.column(1).to_pylist()
            out = [(nodes[a], ids[a], ",".join(map(str, ids[a:z])).encode()) for a, z in found]
            yield pa.RecordBatch.from_pylist([dict(zip(("node", "first", "ids"), row)) for row in out])

    def seal(batches):
        node, hasher = None, None
        for batch in batches:
            done, pieces = [], batch.column(2)
            nodes, found = runs(batch.column(0))
            for a, z in found:
                if hasher is not None and nodes[a] == node:
                    hasher.update(b",")
                else:
                    if hasher is not None:
                        done.append((node, hasher.hexdigest()))
                    node, hasher = nodes[a], hashlib.sha256()
                for i in range(a, z):
                    hasher.update((b"," if i > a else b"") + pieces[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["node", "ends_sha256"])
        if hasher is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([hasher.hexdigest()])], names=["node", "ends_sha256"])

    ordered = ends.select("node", "conv_id").repartitionByRange(slices, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    kind = ends.schema["conv_id"].dataType.simpleString()
    joined = ordered.mapInArrow(join_ids, f"node binary, first {kind}, ids binary")
    return joined.repartition(slices, "node").sortWithinPartitions("node", "first").mapInArrow(seal, "node binary, ends_sha256 string")


def _chains(single: DataFrame) -> DataFrame:
    """Nodes below those of a single member: one per further turn, made in steps so that no array is long."""
    part = single.select("conv_id", "length", F.explode(F.sequence(F.col("depth") + 1, "length", F.lit(_STEPS).cast("long"))).alias("first"))
    each = part.select("conv_id", "length", F.explode(F.sequence("first", F.least(F.col("first") + _STEPS - 1, "length"))).alias("depth"))
    more = F.col("depth") < F.col("length")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return each.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), more.cast("long").alias("n_children"), one.alias("n_leaves"),
                       zero.alias("saved_tokens"), F.sha2(F.when(more, "").otherwise(F.col("conv_id").cast("string")), 256).alias("ends_sha256"))


def trie(convs: DataFrame, turns: DataFrame, work: Workspace, width: int = WIDTH) -> DataFrame:
    """The nodes of all prefixes of sequences given as ``convs`` (conv_id, length) and ``turns`` (conv_id, length, pos, turn_id)."""
    blocks = work.write(_blocks(convs, turns, width), "blocks")
    going = blocks.where("block = 0").withColumn("prior", F.lit(b"")).withColumn("before", F.lit(0).cast("long"))
    rows, walk, ended, single, base = [], [], [], [], 0
    while True:
        here = work.write(going.drop("block").withColumn("base", F.lit(base).cast("long")), "rows")
        groups = _rollup(here, width, f"count(*) AS n_convs, min(conv_id) AS conv_id, max(length) AS longest, count_if(length > {base + width}) AS onward")
        up = F.col("steps") - 1
        nodes = work.write(groups.select("depth", "steps", "n_convs", "conv_id", "onward", (F.col("longest") == F.col("depth")).cast("long").alias("leaf"),
                                         _path(width).alias("node"), _path(width, up).alias("parent"), _bytes(width, up).alias("above")), "nodes")
        rows.append(here)
        walk.append(nodes.select("node", "parent", "depth", "conv_id", "leaf", "above"))
        whole = here.select("conv_id", "length", _path(width).alias("node"), _bytes(width).alias("total"))
        ended.append(whole.where(F.col("length") <= base + width))
        full = nodes.where((F.col("steps") == width) & (F.col("onward") > 0)).select("node", "n_convs", "onward")
        onward = work.write(join_unique(whole.where(F.col("length") > base + width), full, "node", "onward"), "onward")
        base += width
        single.append(onward.where("n_convs = 1").select("conv_id", "length", F.lit(base).cast("long").alias("depth")))
        together = onward.where("n_convs > 1").select("conv_id", F.col("node").alias("prior"), F.col("total").alias("before"))
        if together.isEmpty():
            break
        going = blocks.where(F.col("block") == base // width).join(together, "conv_id")

    def union(frames):
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    ends, alone = work.write(union(ended), "ends"), work.write(union(single), "single")
    known = ends.select("conv_id", "length", "total").unionByName(alone.select("conv_id", "length", F.lit(0).cast("long").alias("total")))
    owners = _owners(walk, alone, known, work)
    fresh = ", ".join(f"count_if(owns = base + {j + 1} AND owns <= length) AS c{j}" for j in range(width + 1))
    owner = "min(struct(conv_id, owns, shared, length, parent_conv)) AS low"
    merged = _rollup(union(rows).join(owners, "conv_id"), width, f"count(*) AS n_convs, sum(leaf) AS n_leaves, sum(shared) AS shared, {owner}, {fresh}")
    children = F.coalesce(*(F.when(F.col("steps") == j, F.col(f"c{j}")) for j in range(width + 1))) + (F.col("low.length") > F.col("depth")).cast("long")
    saved = F.col("shared") - F.col("low.shared") - _bytes(width, F.col("steps") - 1) * (F.col("n_convs") - 1)
    parent = F.when(F.col("depth") > 0, F.when(F.col("low.owns") < F.col("depth"), F.col("low.conv_id")).otherwise(F.col("low.parent_conv")))
    nodes = merged.select(_path(width).alias("node"), F.col("low.conv_id").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", children.alias("n_children"),
                          "n_leaves", saved.alias("saved_tokens"))
    sealed = nodes.join(_end_hashes(ends), "node", "left").drop("node").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    return sealed.unionByName(_chains(alone))


def prefix_nodes(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The prefix trie of the rebuilt conversations, one row per node."""
    work = Workspace(conversations.sparkSession, "trie")
    convs, turns = rebuild(ordered_turns(conversations, work), work)
    return trie(convs, turns, work, width)
