"""Grouped and global statistics.

pandas-style operators (``value_counts``, ``group_means``, ``named_agg``) drop null
group keys like pandas does; SQL-style grouping keeps the null group. All of them
aggregate with partial (map-side) aggregation first, so a hot key does not put its
raw rows into one task. Quantiles go through ``ordering.exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import corr_safe, round_ratio
from .ordering import exact_quantiles
from .selection import stacked_quantiles


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


# ---------------------------------------------------------------- A11-A16

def named_agg(df: DataFrame, by: Sequence[str], drop_null_keys: bool = True, **aggs: Column) -> DataFrame:
    """``groupby(by).agg(name=(col, fn))``; ``aggs`` maps output name to an aggregate."""
    src = _drop_null_keys(df, by) if drop_null_keys else df
    return src.groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()])


def value_counts(df: DataFrame, column: str, count_col: str = "count", normalize: bool = False) -> DataFrame:
    """Frequency of each non-null value (pandas drops nulls); ``normalize`` adds the share."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_col))
    if normalize:
        counts = share_of_total(counts, count_col, "share")
    return counts


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A14 for several columns in one pass: rows (column, value, count), values as text."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.column", "kv.value")
    return stacked.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def share_of_total(df: DataFrame, count_col: str, out: str = "share") -> DataFrame:
    """Count / total over a small rollup (one row per category)."""
    total = df.agg(F.sum(count_col).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, F.col(count_col) / F.col("_total")).drop("_total")


# ---------------------------------------------------------------- A17-A19

def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pandas ``describe()`` in long form, one row per column.

    count, mean, std (sample), min, 25%, 50%, 75% (linear interpolation), max. The columns
    are stacked into (column, value) and counted per distinct value once; that narrow table
    is pinned and serves the moments and every quantile, so the input is read once.
    """
    from ..session import cut_lineage
    stacked = unpivot_numeric(df, columns).where(F.col("value").isNotNull())
    counts = cut_lineage(stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_w")))
    w, v = F.col("_w"), F.col("value")
    first = counts.groupBy("column").agg(F.sum(w).alias("count"), (F.sum(v * w) / F.sum(w)).alias("mean"),
                                         F.min(v).alias("min"), F.max(v).alias("max"))
    # one row per named column: a bounded side, and each column's values stay where they are
    spread = counts.join(F.broadcast(first.select("column", "mean", "count")), "column").groupBy("column").agg(
        F.sqrt(F.sum(w * (v - F.col("mean")) * (v - F.col("mean"))) / F.nullif(F.first("count") - 1, F.lit(0)))
        .alias("std"))
    found = stacked_quantiles(counts.where(~F.isnan("value")), {"p25": 0.25, "p50": 0.5, "p75": 0.75}, weight="_w")
    rows = [(c, *(found[c][q] if c in found else None for q in ("p25", "p50", "p75"))) for c in columns]
    names = df.sparkSession.createDataFrame(rows, "column string, p25 double, p50 double, p75 double")
    out = F.broadcast(names).join(first, "column", "left").join(spread, "column", "left")
    return out.select(
        "column", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def unpivot_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stack numeric columns into (column, value double)."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("kv")).select("kv.column", "kv.value")


def min_max_mean_range(df: DataFrame, column: str) -> DataFrame:
    """One pass; nulls skipped."""
    return df.agg(
        F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"),
        (F.max(column) - F.min(column)).alias("range"),
    )


# ---------------------------------------------------------------- A20-A22

def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation of every pair, as rows (a, b, r).

    One aggregate pass over the upper triangle (k(k+1)/2 correlations, each over the rows
    where both values exist, like pandas); the lower triangle is its mirror. The diagonal
    is 1 unless the column is constant (then null).
    """
    cols = list(columns)
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[corr_safe(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in upper])
    cells = []
    for i, j in upper:
        r = F.col(f"c{i}_{j}")
        cells.append(F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), r.alias("r")))
        if i != j:
            cells.append(F.struct(F.lit(cols[j]).alias("a"), F.lit(cols[i]).alias("b"), r.alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("kv")).select("kv.a", "kv.b", F.round("kv.r", digits).alias("r"))


def missing_percent(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Percent of nulls per column, rows (column, missing_pct, is_worst)."""
    n = F.count(F.lit(1))
    row = df.agg(n.alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = row.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns
    ])).alias("kv")).select("kv.column", "kv.nulls", "_n")
    out = stacked.select("column", round_ratio(F.col("nulls") * 100, F.col("_n"), digits).alias("missing_pct"),
                         "nulls")
    # Columns are few (a schema), so this window over them is small.
    w = Window.partitionBy().orderBy(F.desc("nulls"), "column")
    return out.withColumn("is_worst", F.row_number().over(w) == 1).drop("nulls")


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null vs rows with at least one null, in one pass."""
    cols = columns or df.columns
    any_null = None
    for c in cols:
        x = F.col(c).isNull()
        any_null = x if any_null is None else (any_null | x)
    return df.agg(F.count_if(~any_null).alias("rows_complete"), F.count_if(any_null).alias("rows_with_missing"))


# ---------------------------------------------------------------- A24-A30

def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram like numpy: edges from min/max, last bin closed.

    The min/max come from a one-row aggregate joined back by broadcast, so the plan stays
    lazy. Rows (bin, lower, upper, count); empty bins are kept.
    """
    x = F.col(column)
    bounds = df.agg(F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)))
    counts = (df.where(x.isNotNull()).crossJoin(F.broadcast(bounds))
              .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(bounds))
    lo = F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins
    hi = F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins
    return (all_bins.join(counts, "bin", "left")
            .select("bin", lo.alias("lower"), hi.alias("upper"), F.coalesce("count", F.lit(0)).alias("count")))


#: Groups up to which the fences of box statistics are broadcast (a few MB); beyond, they are joined by shuffle.
BOX_GROUPS = 100_000


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, Tukey whiskers (furthest points within 1.5 IQR) and outlier count per group; a null group is a group.

    The fences, one row per group, are pinned and counted: if they are few they are broadcast, so rows stay where they
    are and a hot group is combined in every task that reads it.
    """
    from ..session import cut_lineage
    by = list(by)
    qs = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=by, count_col="n")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    fences = cut_lineage(qs.select(F.struct(*by).alias("_group"), "q1", "median", "q3", "n", (F.col("q1") - spread).alias("_lf"), (F.col("q3") + spread).alias("_uf")))
    side = F.broadcast(fences) if fences.count() <= BOX_GROUPS else fences
    x = F.col(value)
    inside = (x >= F.col("_lf")) & (x <= F.col("_uf"))
    # structs compare null-safe, so the null group meets its fences
    rows = df.where(x.isNotNull()).select(F.struct(*by).alias("_group"), value).join(side, "_group")
    out = rows.groupBy("_group").agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3", "n")],  # the same on all rows of a group
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"), F.count_if(~inside).alias("outliers"))
    return out.select(*[F.col("_group")[c].alias(c) for c in by], "q1", "median", "q3", "n", "whisker_low", "whisker_high", "outliers")


def density_grid(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """2-D binned counts behind a scatter plot."""
    bx = F.floor(F.col(x) / x_width).cast("bigint").alias("x_bin")
    by_ = F.floor(F.col(y) / y_width).cast("bigint").alias("y_bin")
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(bx, by_).agg(F.count(F.lit(1)).alias("count"))


def cohort_compare(df: DataFrame, cohort: Column, measures: Sequence[str], labels=("yes", "no")) -> DataFrame:
    """Mean of each measure in the cohort, outside it, and the difference -- one pass.

    Rows (measure, mean_<yes>, mean_<no>, difference).
    """
    aggs = []
    for m in measures:
        aggs += [F.avg(F.when(cohort, F.col(m))).alias(f"{m}__1"), F.avg(F.when(~cohort, F.col(m))).alias(f"{m}__0")]
    row = df.agg(*aggs)
    yes, no = labels
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"{m}__1").alias(f"mean_{yes}"), F.col(f"{m}__0").alias(f"mean_{no}"))
        for m in measures
    ])).alias("kv")).select("kv.*").withColumn("difference", F.col(f"mean_{yes}") - F.col(f"mean_{no}"))


def breakdown(df: DataFrame, column: str, categories: Sequence[str], digits: int = 1) -> DataFrame:
    """Counts over a fixed category list; absent categories get 0; percent of all rows."""
    spark = df.sparkSession
    cats = spark.createDataFrame([(c, i) for i, c in enumerate(categories)], f"{column} string, _ord int")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))  # from the counts: the input is read once
    out = F.broadcast(cats).join(counts, column, "left").withColumn("count", F.coalesce("count", F.lit(0)))
    out = out.crossJoin(F.broadcast(total))
    return out.select(column, "count", round_ratio(F.col("count") * 100, F.col("_total"), digits).alias("percent"),
                      "_ord").orderBy("_ord").drop("_ord")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and duplicates in one grouping pass."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
                 (F.sum("_c") - F.count(F.lit(1))).alias("duplicates"))


# ---------------------------------------------------------------- approximate forms (scale options)

def approx_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = (),
                     accuracy: int = 10_000) -> DataFrame:
    """A17 fast path: ``percentile_approx`` (relative rank error about 1/accuracy), one pass.

    Use when an exact interpolated quantile is not required; ``exact_quantiles`` otherwise.
    """
    names = list(quantiles)
    arr = F.percentile_approx(value, [float(quantiles[n]) for n in names], accuracy)
    out = df.groupBy(*by).agg(arr.alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def distinct_count(c: str, approx: bool = False, rsd: float = 0.01) -> Column:
    """A2: exact ``count_distinct`` or HyperLogLog++ ``approx_count_distinct`` (no per-value state)."""
    return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
