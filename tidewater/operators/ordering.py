"""Order statistics without a single-task window.

A window with no ``partitionBy`` (or a group that holds a third of the data) puts
all of its rows in one task. The helpers here get the same answers from a range
shuffle instead:

1. ``repartitionByRange`` on (group keys, order keys) -- each task gets one
   contiguous slice of the global order; a hot group spans many tasks;
2. a row's index inside its task comes from ``monotonically_increasing_id`` after
   ``sortWithinPartitions`` (the low 33 bits count rows of the task);
3. per-(task, group) row counts form a table of about #tasks + #groups rows; a
   running sum over it gives each slice its starting offset.

The range-sorted copy is pinned with a reliable checkpoint (the shared checkpoint
folder), so the counts and the rows always come from the same partitions.

Exact quantiles, exact-size samples, global ranks and surrogate keys all use it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import col
from ..session import cut_lineage

#: Sub-groups of a group in ``top_k_per_group`` by row number.
TOP_K_SALTS = 64

_PID, _LOCAL, _BASE, _GROUP_N = "_tw_pid", "_tw_local", "_tw_base", "_tw_group_n"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _range_sorted(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    """Range-partition and sort once, and pin the result with a reliable checkpoint.

    The range bounds come from sampling the input; an input whose row order can change
    between evaluations (any shuffle output) would get other bounds on a second
    evaluation. Both the counting side and the row side therefore read one materialised
    copy in the shared checkpoint folder, which also survives executor loss.
    """
    ranged = df.repartitionByRange(_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)
    pinned = cut_lineage(ranged)
    return (pinned.withColumn(_PID, F.spark_partition_id())
            .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)))


def global_positions(df: DataFrame, order_by: Sequence[str | Column], by: Sequence[str] = (),
                     pos_col: str = "_pos", count_col: str | None = None,
                     num_partitions: int | None = None, offsets_bounded: bool | None = None,
                     weight: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in ``order_by`` order within its ``by`` group.

    Equals ``row_number() OVER (PARTITION BY by ORDER BY order_by)``. The order should be
    total (end it with a unique key) when rows that tie differ in other columns.
    ``count_col`` also adds the group size. With ``weight`` each row stands for that many
    rows: ``pos_col`` is the last position it covers and ``pos_col + '_start'`` the first.
    The offset table is broadcast when it is provably small (no ``by``: one row per task);
    with ``by`` the planner decides by its measured size.
    """
    by = list(by)
    keys = [*[F.col(b) for b in by], *[col(o) for o in order_by]]
    ranged = _range_sorted(df, keys, num_partitions)
    w = F.col(weight) if weight else F.lit(1)
    stats = ranged.groupBy(_PID, *by).agg(F.sum(w).alias("_n"), F.min(_LOCAL).alias("_first"))
    order = Window.partitionBy(*by).orderBy(_PID) if by else Window.orderBy(_PID)
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    offsets = stats.select(
        _PID,
        *by,
        F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_prior"),
        F.col("_first"),
        F.sum("_n").over(whole).alias(_GROUP_N),
    )
    bounded = offsets_bounded if offsets_bounded is not None else not by
    if bounded:
        offsets = F.broadcast(offsets)
    # null-safe: rows whose group key is null are a group like any other
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in [_PID, *by]})
    same = ranged[_PID] == offsets[f"_o_{_PID}"]
    for b in by:
        same = same & ranged[b].eqNullSafe(offsets[f"_o_{b}"])
    out = ranged.join(offsets, same, "inner").drop(*[f"_o_{c}" for c in [_PID, *by]])
    if weight:
        # running weight inside the slice; the slice is one task's share of one group
        run = Window.partitionBy(_PID, *by).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(pos_col, F.col("_prior") + F.sum(weight).over(run))
        out = out.withColumn(pos_col + "_start", F.col(pos_col) - F.col(weight) + 1)
    else:
        out = out.withColumn(pos_col, F.col("_prior") + F.col(_LOCAL) - F.col("_first") + 1)
    if count_col:
        out = out.withColumnRenamed(_GROUP_N, count_col)
    return out.drop(_PID, _LOCAL, "_prior", "_first", _GROUP_N)


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = (),
                    count_col: str | None = None, num_partitions: int | None = None,
                    weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (``quantile_cont`` / numpy default).

    Nulls are skipped. Returns one row per group (one row when ``by`` is empty) with a
    column per requested quantile. Values are first counted per (group, value) with a
    partial aggregate -- a value held by a third of the rows becomes one row -- then the
    distinct values get cumulative positions and only the rows at the needed positions
    are kept. No group is gathered into one buffer or one task. ``weight`` names a count
    column when ``df`` is already counted per (group, value).
    """
    by = list(by)
    if weight:
        vals = df.select(*by, F.col(value).alias("_v"), F.col(weight).alias("_w")).where(F.col("_v").isNotNull())
    else:
        vals = (df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
                .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_w")))
    pos = global_positions(vals, ["_v"], by, pos_col="_p", count_col="_n", num_partitions=num_partitions, weight="_w")
    covers = lambda t: (F.col("_p_start") <= t) & (F.col("_p") >= t)
    wanted = None
    picks = []
    for name, q in quantiles.items():
        rn = (F.col("_n") - 1).cast("double") * F.lit(float(q))
        lo, hi = F.floor(rn) + 1, F.ceil(rn) + 1
        cond = covers(lo) | covers(hi)
        wanted = cond if wanted is None else (wanted | cond)
        picks += [
            F.max(F.when(covers(lo), F.col("_v"))).alias(f"_lo_{name}"),
            F.max(F.when(covers(hi), F.col("_v"))).alias(f"_hi_{name}"),
            F.max(rn - F.floor(rn)).alias(f"_d_{name}"),
        ]
    agg = pos.where(wanted).groupBy(*by).agg(F.max("_n").alias("_n"), *picks)
    outs = [
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_d_{name}")).alias(name)
        for name in quantiles
    ]
    if count_col:
        outs.append(F.col("_n").cast("bigint").alias(count_col))
    result = agg.select(*by, *outs)
    if not by:
        # a global quantile of an empty input is one row of nulls, like an aggregate
        empty = df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(n) for n in quantiles])
        if count_col:
            empty = empty.withColumn(count_col, F.lit(None).cast("bigint"))
        result = result.unionByName(empty).agg(*[F.max(c).alias(c) for c in result.columns])
    return result


def kth_smallest(df: DataFrame, order_by: Sequence[str], k: Column | int, by: Sequence[str] = (),
                 num_partitions: int | None = None) -> DataFrame:
    """The row holding position ``k`` in ``order_by`` order (per ``by`` group)."""
    pos = global_positions(df.select(*by, *order_by), order_by, by, pos_col="_p", count_col="_n",
                           num_partitions=num_partitions)
    kk = k if isinstance(k, Column) else F.lit(k)
    return pos.where(F.col("_p") == kk)


def top_k_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence[str | tuple[str, bool]], k: int,
                    rank: str = "row_number", rank_col: str = "rank", salt_buckets: int | None = None) -> DataFrame:
    """Rows whose rank within their group is <= k, exactly, without one task per hot group.

    ``order_by`` holds column names (ascending) or ``(name, ascending)`` pairs; nulls sort
    first ascending and last descending, as in SQL. First rank inside (group, salt)
    sub-groups and keep rank <= k -- every row with a group rank <= k survives, because its
    sub-group rank can only be smaller. ``row_number`` then ranks the survivors (at most
    k * ``TOP_K_SALTS`` per group, whatever the number of shuffle partitions; Spark's window group limit
    also keeps at most k rows per sub-group in each task before the shuffle). ``rank`` / ``dense_rank`` rank the distinct order values among the
    survivors (also at most k * salts per group) and join the ranks back, so a hot group
    full of ties is never sorted in one task.
    """
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[rank]
    by = list(by)
    specs = [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order_by]
    sort_cols = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in specs]
    salts = salt_buckets or (TOP_K_SALTS if rank == "row_number" else _partitions(df, None))
    # the reading task's number spreads rows that are equal in every column; a retried task gets the same salts
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]), F.lit(salts))
    sub = Window.partitionBy(*by, "_salt").orderBy(*sort_cols)
    pre = df.withColumn("_salt", salt).withColumn("_r", fn().over(sub)).where(F.col("_r") <= k).drop("_r", "_salt")
    full = Window.partitionBy(*by) if by else Window.partitionBy()
    if rank == "row_number":
        return pre.withColumn(rank_col, fn().over(full.orderBy(*sort_cols))).where(F.col(rank_col) <= k)
    names = [c for c, _ in specs]
    vals = pre.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("_c"))
    w = full.orderBy(*sort_cols)
    if rank == "rank":
        better = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))
        vals = vals.withColumn(rank_col, (F.coalesce(better, F.lit(0)) + 1).cast("int"))
    else:
        vals = vals.withColumn(rank_col, F.row_number().over(w))
    vals = vals.where(F.col(rank_col) <= k).drop("_c")
    keys = [*by, *names]
    vals = vals.select(*[F.col(c).alias(f"_k_{c}") for c in keys], rank_col)
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return pre.join(vals, cond, "inner").drop(*[f"_k_{c}" for c in keys])


def dense_rank_global(df: DataFrame, value: str, descending: bool = False, rank_col: str = "dense_rank",
                      by: Sequence[str] = ()) -> DataFrame:
    """``DENSE_RANK() OVER ([PARTITION BY by] ORDER BY value)`` for inputs of any size.

    Distinct values get positions from ``global_positions``; rows get their value's
    position by an equi-join. Null values rank first ascending, last descending.
    """
    by = list(by)
    distinct = df.select(*by, value).distinct()
    key = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    ranks = global_positions(distinct, [key], by, pos_col=rank_col)
    keys = [*by, value]
    ranks = ranks.select(*[F.col(c).alias(f"_k_{c}") for c in keys], rank_col)
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return df.join(ranks, cond, "left").drop(*[f"_k_{c}" for c in keys])


def surrogate_keys(df: DataFrame, order_by: Sequence[str | Column], key_col: str = "id", start: int = 1) -> DataFrame:
    """Consecutive keys ``start, start+1, ..`` in a declared order, no global window."""
    out = global_positions(df, order_by, pos_col=key_col)
    if start != 1:
        out = out.withColumn(key_col, F.col(key_col) + (start - 1))
    return out


def row_of_extreme(df: DataFrame, value: str, key: str, largest: bool = True) -> DataFrame:
    """T4: the row holding the max (or min) of ``value`` -- nulls skipped, the smallest ``key`` on ties.

    A distributed top-1 (each task keeps its best row, then one merge), not a sort of the input.
    """
    order = F.col(value).desc() if largest else F.col(value).asc()
    return df.where(F.col(value).isNotNull()).orderBy(order, F.col(key).asc()).limit(1)
