"""Natural keys to surrogate keys over several loads, without renumbering.

A load's unseen keys take the numbers after the highest one given so far, in the order of the natural key; known keys
keep theirs, so a repeated load changes nothing. Keys are made distinct before they meet the map, unseen ones
are numbered through global positions, and only the highest number (one row) is broadcast.

A null natural key gets no number. Keys that a load no longer holds keep theirs. The map is pinned after each load that adds to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import global_positions


def new_keys(known: DataFrame, load: DataFrame, key: str, number: str) -> DataFrame:
    """(key, number) of the keys of a load that the map does not know, numbered on from its highest."""
    unseen = load.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
    highest = known.agg(F.coalesce(F.max(number), F.lit(0)).cast("long").alias("_highest"))
    placed = global_positions(unseen, [key], pos_col="_pos")
    return placed.crossJoin(F.broadcast(highest)).select(key, (F.col("_pos") + F.col("_highest")).cast("long").alias(number))


def extend_key_map(known: DataFrame | None, load: DataFrame, key: str, number: str, load_number: int = 1) -> DataFrame:
    """The map (key, number, load) after a load; ``load`` says which one brought the key."""
    if known is None:
        known = load.sparkSession.createDataFrame([], load.select(key).schema.add(number, "long").add("load", "integer"))
    added = new_keys(known, load, key, number).withColumn("load", F.lit(load_number))
    return cut_lineage(known.unionByName(added))


def key_map(loads: Sequence[DataFrame], key: str, number: str, known: DataFrame | None = None) -> DataFrame:
    """The map after a sequence of loads, numbered after the highest load so far."""
    first = 1 if known is None else (known.agg(F.max("load")).first()[0] or 0) + 1
    for n, load in enumerate(loads, first):
        known = extend_key_map(known, load, key, number, n)
    return known


def numbered(rows: DataFrame, known: DataFrame, key: str, number: str) -> DataFrame:
    """Rows with the number of their natural key, null where the map has none."""
    return rows.join(known.select(key, number), key, "left")
