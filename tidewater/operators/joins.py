"""Joins (J1-J8) and the fan-out check.

Join strategy is left to the planner: with AQE on, a side whose *measured* size is
under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast and everything else is
sort-merged, and a skewed partition is split. ``F.broadcast`` is written by hand only
for sides with a size bound that holds at any scale (one-row aggregates, fixed lookups).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_merge(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_prop",
               null_keys_match: bool = False) -> DataFrame:
    """Pandas ``merge(how='left', suffixes=('', suffix))``.

    Right-side columns whose names collide get ``suffix``. pandas matches NaN keys with
    NaN keys; ``null_keys_match=True`` reproduces that with a null-safe comparison. The right
    side is a lookup (one row per key, e.g. a per-key aggregate), so the join never multiplies.
    """
    on = list(on)
    renamed = right.select(*[F.col(c).alias(c if c in on or c not in left.columns else c + suffix)
                             for c in right.columns])
    if not null_keys_match:
        return left.join(renamed, on=on, how="left")
    r = renamed.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in renamed.columns])
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in on]
    return left.join(r, cond, "left").drop(*[f"_r_{c}" for c in on])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent (``left_anti``)."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def matched(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows that do have a parent (``left_semi``)."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.join(keys, child_key, "left_semi")


def fanout_report(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """How much a join multiplies the left side, without running the join.

    Counts per key on both sides, joined on the key: rows_after = sum(l * r) for inner
    matches plus unmatched left rows. One row: left_rows, rows_after, max_fanout.
    """
    on = list(on)
    lc = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r"))
    j = lc.join(rc, on, "left")
    return j.agg(
        F.sum("_l").alias("left_rows"),
        F.sum(F.col("_l") * F.coalesce(F.col("_r"), F.lit(1))).alias("rows_after"),
        F.max(F.coalesce(F.col("_r"), F.lit(1))).alias("max_fanout"),
    )


def one_row_cross(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate (a benchmark) to every row; bounded, so broadcast."""
    return df.crossJoin(F.broadcast(one_row))


def period_compare(df: DataFrame, key: str, period_col: str, value: str, first, second,
                   suffixes=("_first", "_second"), agg=F.avg) -> DataFrame:
    """Keys present in both periods, with the value of each period side by side.

    Each period is first reduced to one row per key (``agg``, mean by default; a panel with
    one row per key and period passes through unchanged), so the join is 1:1 and a key that
    repeats inside a period never multiplies into all pairs.
    """
    a = df.where(F.col(period_col) == F.lit(first)).groupBy(key).agg(agg(value).alias(value + suffixes[0]))
    b = df.where(F.col(period_col) == F.lit(second)).groupBy(key).agg(agg(value).alias(value + suffixes[1]))
    return a.join(b, key, "inner")
