"""Exact order statistics of many columns by narrowing, without a sorted copy (A17, M1, F16, NTILE).

The value at a rank is found the way a radix selection finds it: count the values by bucket, keep the one bucket that
holds the rank, and look closer at that bucket only. Buckets are ``BINS`` equal slices of the range that the values left
really have, in turn of the logarithm and of the value itself, so neither a far outlier nor a long tail slows it down.
All columns and ranks advance in the same pass: a pass is one scan with partial aggregation, at most ``BINS`` counts
for each open range, and no shuffle of rows. A bucket with one value is settled; one of at most ``FINAL``
rows is counted value by value. Nothing is sorted, checkpointed or gathered; what reaches the driver is a row per rank.

Every pass reads the input again, so an expensive one should be pinned before.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096
FINAL = 65_536


def _scaled(x: Column) -> Column:
    """Signed logarithm: a monotone map that brings all magnitudes together."""
    return F.signum(x) * F.log1p(F.abs(x))


def _bin(value: Column, lo: Column, hi: Column, logarithmic: bool) -> Column:
    """Bucket of a value in [lo, hi]: 0 for lo, ``BINS - 1`` for hi, never descending in between."""
    x, a, z = value.cast("double"), lo.cast("double"), hi.cast("double")
    infinite = (a == F.lit(-math.inf)) | (z == F.lit(math.inf))
    if logarithmic:
        x, a, z = _scaled(x), _scaled(a), _scaled(z)
    half = z / 2 - a / 2  # halves: the range of two doubles may not fit one
    inside = F.least(F.floor((x / 2 - a / 2) / half * BINS), F.lit(BINS - 1))
    ends = F.when(value == lo, 0).when(value == hi, BINS - 1)
    return ends.otherwise(F.when(infinite | (half <= 0), 1).otherwise(F.greatest(inside, F.lit(0)))).cast("int")


def _ranges(stacked: DataFrame, open_: list[dict], kind: str) -> DataFrame:
    """Rows of ``stacked`` within the open ranges, with the range's number, bounds, offset and ranks."""
    spark = stacked.sparkSession
    table = spark.createDataFrame([(i, r["column"], r["lo"], r["hi"], r["before"], r["ranks"]) for i, r in enumerate(open_)],
                                  f"_id int, _column string, _lo {kind}, _hi {kind}, _before long, _ranks array<long>")
    inside = (F.col("column") == F.col("_column")) & F.col("value").between(F.col("_lo"), F.col("_hi"))
    return stacked.join(F.broadcast(table), inside)  # one row per rank at most


def _holding(counts: DataFrame, order: str) -> DataFrame:
    """The rows of ``counts`` (per range, in order) that hold a rank; ``_upto`` ranks end with the row."""
    run = Window.partitionBy("_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)  # at most BINS or FINAL rows
    upto = counts.withColumn("_upto", F.col("_before") + F.sum("_n").over(run))
    mine = F.filter("_ranks", lambda r: (r > F.col("_upto") - F.col("_n")) & (r <= F.col("_upto")))
    return upto.withColumn("_mine", mine).where(F.size("_mine") > 0)


def stack(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """(column, value) rows of the named columns, nulls and NaN left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("_c")).select("_c.column", "_c.value").where(F.col("value").isNotNull() & ~F.isnan("value"))


def column_counts(stacked: DataFrame, weight: str | None = None) -> dict[str, tuple[int, object, object]]:
    """Per column with values: how many, the least, the greatest."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    found = stacked.groupBy("column").agg(n.cast("long").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    return {r["column"]: (r.n, r.lo, r.hi) for r in found}


def values_at_ranks(stacked: DataFrame, ranks: Mapping[str, Iterable[int]], bounds: Mapping[str, tuple] | None = None,
                    weight: str | None = None, final: int = FINAL) -> dict[tuple[str, int], tuple[object, int]]:
    """(column, rank) -> (value, rank of the value's first row), ranks from 1 in ascending order of value.

    ``stacked`` has columns (column, value) and no nulls; with ``weight`` a row stands for that many. Ranks
    outside the column are left out. The value has the type of the column ``value``.
    """
    bounds = column_counts(stacked, weight) if bounds is None else bounds
    kind = stacked.schema["value"].dataType.simpleString()
    slim = stacked.select("column", "value", (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
    found: dict[tuple[str, int], tuple[object, int]] = {}
    open_: list[dict] = []

    def settle(column, lo, hi, before, n, wanted):
        if not wanted:
            return
        if lo == hi:
            found.update({(column, r): (lo, before + 1) for r in wanted})
        else:
            open_.append({"column": column, "lo": lo, "hi": hi, "before": before, "n": n, "ranks": sorted(wanted)})

    for column, (n, lo, hi) in bounds.items():
        settle(column, lo, hi, 0, n, {int(r) for r in ranks.get(column, ()) if 1 <= r <= n})
    logarithmic = False
    while any(r["n"] > final for r in open_):
        wide, open_ = [r for r in open_ if r["n"] > final], [r for r in open_ if r["n"] <= final]
        rows = _ranges(slim, wide, kind)
        b = _bin(F.col("value"), F.col("_lo"), F.col("_hi"), logarithmic)
        counts = rows.groupBy("_id", "_before", "_ranks", b.alias("_bin")).agg(F.sum("_w").alias("_n"), F.min("value").alias("_least"), F.max("value").alias("_most"))
        for r in _holding(counts, "_bin").collect():
            settle(wide[r["_id"]]["column"], r["_least"], r["_most"], r["_upto"] - r["_n"], r["_n"], set(r["_mine"]))
        logarithmic = not logarithmic
    if open_:
        rows = _ranges(slim, open_, kind)
        counts = rows.groupBy("_id", "_before", "_ranks", "value").agg(F.sum("_w").alias("_n"))
        for r in _holding(counts, "value").collect():
            found.update({(open_[r["_id"]]["column"], k): (r["value"], r["_upto"] - r["_n"] + 1) for k in r["_mine"]})
    return found


def stacked_quantiles(stacked: DataFrame, quantiles: Mapping[str, float], weight: str | None = None, final: int = FINAL) -> dict[str, dict[str, float]]:
    """Exact quantiles with linear interpolation per column of a (column, value) table; columns without values are left out."""
    bounds = column_counts(stacked, weight)

    def places(n, q):
        at = (n - 1) * float(q)
        return math.floor(at) + 1, math.ceil(at) + 1, at - math.floor(at)

    ranks = {c: {k for q in quantiles.values() for k in places(n, q)[:2]} for c, (n, _, _) in bounds.items()}
    values = values_at_ranks(stacked, ranks, bounds, weight, final)
    out: dict[str, dict[str, float]] = {}
    for c, (n, _, _) in bounds.items():
        out[c] = {}
        for name, q in quantiles.items():
            lo, hi, share = places(n, q)
            a, z = float(values[c, lo][0]), float(values[c, hi][0])
            out[c][name] = a if a == z else a + (z - a) * share
    return out


def quantiles_of(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float], final: int = FINAL) -> dict[str, dict[str, float | None]]:
    """Exact quantiles of many numeric columns at once; None where a column has no value."""
    found = stacked_quantiles(stack(df, columns), quantiles, final=final)
    return {c: found.get(c, {name: None for name in quantiles}) for c in columns}


def ntile_cuts(n: int, buckets: int) -> list[int]:
    """Last position of every NTILE bucket but the last; the first ``n % buckets`` have a row more."""
    q, more = divmod(n, buckets)
    return [q * i + min(i, more) for i in range(1, buckets)]


def add_ntiles(df: DataFrame, scores: Mapping[str, str], tiebreak: str, buckets: int = 4, final: int = FINAL) -> DataFrame:
    """NTILE scores over all rows: ``scores`` names a numeric key column for each, ties are in the order of ``tiebreak``.

    Equals ``ntile(buckets) OVER (ORDER BY key, tiebreak)`` for a unique tiebreak without nulls. The keys at the cut
    positions come from one selection; where a cut falls among rows of one key, a second one finds the tiebreak it falls at.
    """
    keys = list(dict.fromkeys(scores.values()))
    nulls = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(k).isNull() | F.isnan(k)).alias(k) for k in keys]).first()
    if any(nulls[k] for k in keys):
        raise ValueError("NTILE keys must not be null")
    cuts = [p for p in ntile_cuts(nulls["_n"], buckets) if p > 0]
    at = values_at_ranks(stack(df, keys), {k: cuts for k in keys}, final=final)
    names = {(k, p): f"{k}:{p}" for k in keys for p in cuts}
    ties = F.array(*[F.when(F.col(k).cast("double") == F.lit(at[k, p][0]), F.struct(F.lit(names[k, p]).alias("column"), F.col(tiebreak).alias("value")))
                     for k, p in names]) if names else None
    edges = {}
    if names:
        tied = df.select(F.explode(F.filter(ties, lambda x: x.isNotNull())).alias("_c")).select("_c.column", "_c.value")
        edges = values_at_ranks(tied, {names[k, p]: [p - at[k, p][1] + 1] for k, p in names}, final=final)
    out = df
    for score, k in scores.items():
        number = F.lit(1)
        for p in cuts:
            value, first = at[k, p]
            edge = edges[names[k, p], p - first + 1][0]
            x = F.col(k).cast("double")
            number = number + F.when((x > F.lit(value)) | ((x == F.lit(value)) & (F.col(tiebreak) > F.lit(edge))), 1).otherwise(0)
        # empty leading buckets exist only where there are fewer rows than buckets, and then they are the last ones
        out = out.withColumn(score, number.cast("int"))
    return out
