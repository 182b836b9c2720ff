"""Feature preparation (M1-M7).

Fill values and caps are one-row aggregates attached by a broadcast cross join, so nothing but
the category list of the column form of one-hot encoding reaches the driver. The quantiles
behind them pin their range-sorted value counts (``ordering.py``).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import unpivot_numeric
from .ordering import global_positions
from .selection import quantiles_of


def column_quantiles(df: DataFrame, columns: Sequence[str], q: float, prefix: str = "") -> DataFrame:
    """One row holding the exact q-quantile of every column (all columns in the same passes)."""
    found = quantiles_of(df, columns, {"q": q})
    schema = ", ".join(f"`{prefix}{c}` double" for c in columns)
    return df.sparkSession.createDataFrame([tuple(found[c]["q"] for c in columns)], schema)


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M1: missing numbers take the column's exact median (computed on the frame given, in a few passes over it)."""
    med = quantiles_of(df, columns, {"m": 0.5})
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c]["m"]).cast("double")).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def constant_fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """M2: missing values of the named columns take constants ("Unknown", 0, ...)."""
    return df.fillna(values)


def cap_at_quantile(df: DataFrame, column: str, q: float = 0.99) -> DataFrame:
    """F16: values above the exact q-quantile are set to it; null stays null."""
    cap = F.lit(quantiles_of(df, [column], {"cap": q})[column]["cap"]).cast("double")
    x = F.col(column)
    return df.withColumn(column, F.when(x > cap, cap).otherwise(x))


def categories(df: DataFrame, column: str, cap: int = 1000) -> list[str]:
    """Sorted distinct non-null values of a categorical column.

    For one output column per category; beyond ``cap`` columns a frame gets too wide and
    ``one_hot_vector`` is the form to use.
    """
    vals = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct() \
        .orderBy("v").limit(cap + 1).collect()
    if len(vals) > cap:
        raise ValueError(f"{column} has more than {cap} categories; use one_hot_vector, which makes no columns")
    return [r.v for r in vals]


def one_hot(df: DataFrame, column: str, cats: Sequence[str] | None = None, drop_first: bool = True,
            prefix: str | None = None) -> DataFrame:
    """M4: ``pd.get_dummies(drop_first=True)`` -- 0/1 columns for every category but the first.

    Null and unseen categories get all zeros. ``cats`` fixes the category list (as fitted
    on training rows); otherwise it is read from ``df``.
    """
    cats = sorted(cats) if cats is not None else categories(df, column)
    keep = cats[1:] if drop_first else cats
    name = prefix or column
    x = F.col(column).cast("string")
    return df.select(*[c for c in df.columns if c != column],
                     *[F.coalesce((x == F.lit(v)).cast("int"), F.lit(0)).alias(f"{name}_{v}") for v in keep])


def one_hot_vector(df: DataFrame, column: str, out: str | None = None, drop_last: bool = True):
    """M4 for any number of categories: one sparse vector per row; returns (frame, fitted stages).

    Null and unseen categories share an index of their own.
    """
    index = f"_{column}_index"
    indexer = StringIndexer(inputCol=column, outputCol=index, handleInvalid="keep", stringOrderType="alphabetAsc").fit(df)
    indexed = indexer.transform(df)
    encoder = OneHotEncoder(inputCol=index, outputCol=out or f"{column}_vector", dropLast=drop_last).fit(indexed)
    return encoder.transform(indexed).drop(index), (indexer, encoder)


def assemble(df: DataFrame, features: Sequence[str], label: str, out: str = "features",
             forbidden: Sequence[str] = ()) -> DataFrame:
    """M5: feature vector from an allow-list; refuses the label and columns derived from it."""
    bad = [c for c in features if c == label or c in forbidden]
    if bad:
        raise ValueError(f"target leakage: {bad} derive from {label}")
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def hash_split(key: str, train_percent: int = 80, seed: int = 42) -> Column:
    """M6: 'train'/'test' from md5(key, seed); the same row lands on the same side at any partitioning."""
    h = hash_order(key, seed)
    bucket = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(100))
    return F.when(bucket < train_percent, "train").otherwise("test")


def hash_order(key: str, seed: int) -> Column:
    """The order a seeded sample draws rows in: md5 of key and seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


#: Leading hex digits of the hash that buckets of a sample are counted by: 16^4 buckets.
_SAMPLE_DIGITS = 4


def sample_flag(df: DataFrame, key: str, fraction: float | None = None, seed: int = 29, cap: int | None = None,
                by: Sequence[str] = (), flag: str = "in_sample") -> DataFrame:
    """Every row of ``df`` with a boolean: is it among the first ``round(fraction * n)`` (or ``cap``) of its
    group in hash order? Rows with equal hash and key are told apart by their position.

    Rows are counted per group and hash bucket (at most 65,536 counts a group). The running count names the
    one bucket of each group in which the sample ends; rows of earlier buckets are in, rows of later ones
    out, and only the rows of that bucket are put in order. The input is neither sorted nor written.
    """
    if (fraction is None) == (cap is None):
        raise ValueError("give either a fraction or a cap")
    by = list(by)
    h = F.coalesce(hash_order(key, seed), F.lit(""))
    bucket = F.coalesce(F.conv(F.substring(h, 1, _SAMPLE_DIGITS), 16, 10).cast("int"), F.lit(0))
    hashed = df.withColumn("_h", h).withColumn("_b", bucket)
    counts = hashed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by)  # bounded: one row per bucket
    upto = F.sum("_c").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.select(*by, "_b", "_c", upto.alias("_upto"), F.sum("_c").over(group).alias("_n"))
    if cap is not None:
        wanted = F.least(F.lit(cap).cast("bigint"), F.col("_n"))
    else:
        share = F.lit(Decimal(str(fraction))).cast("decimal(18,9)")  # decimals: the same size in every engine
        wanted = F.floor(F.col("_n").cast("decimal(20,0)") * share + F.lit(Decimal("0.5")))  # round half up
    cuts = counts.withColumn("_k", wanted.cast("bigint")) \
        .where((F.col("_upto") - F.col("_c") < F.col("_k")) & (F.col("_k") <= F.col("_upto"))) \
        .select(*[F.col(b).alias(f"_cut_{b}") for b in by], F.col("_b").alias("_cut"),
                (F.col("_k") - F.col("_upto") + F.col("_c")).alias("_need"))
    if by:
        same = F.lit(True)
        for b in by:  # null-safe: a null group is sampled like any other
            same = same & F.col(b).eqNullSafe(F.col(f"_cut_{b}"))
        joined = hashed.join(cuts, same, "left").drop(*[f"_cut_{b}" for b in by])
    else:
        joined = hashed.join(F.broadcast(cuts), F.lit(True), "left")  # one row
    edge = F.coalesce(F.col("_b") == F.col("_cut"), F.lit(False))
    sure = joined.where(~edge).withColumn(flag, F.coalesce(F.col("_b") < F.col("_cut"), F.lit(False)))
    last = global_positions(joined.where(edge), ["_h", key], by, pos_col="_pos") \
        .withColumn(flag, F.col("_pos") <= F.col("_need")).drop("_pos")
    return sure.unionByName(last).drop("_h", "_b", "_cut", "_need")


def exact_sample(df: DataFrame, key: str, fraction: float | None = None, seed: int = 29, cap: int | None = None,
                 by: Sequence[str] = ()) -> DataFrame:
    """Exactly ``round(fraction * n)`` (or ``min(cap, n)``) rows per group, first in hash order.

    The same key and seed give the same rows at any partitioning. A cap over the whole input is a
    distributed top-k by hash; all else is ``sample_flag``.
    """
    if cap is not None and not by:
        return df.withColumn("_h", F.coalesce(hash_order(key, seed), F.lit(""))).orderBy("_h", key).limit(cap).drop("_h")
    return sample_flag(df, key, fraction, seed, cap, by, flag="_in").where("_in").drop("_in")


def exact_fraction(df: DataFrame, key: str, fraction: float, seed: int, by: Sequence[str] = ()) -> DataFrame:
    return exact_sample(df, key, fraction=fraction, seed=seed, by=by)


def stratified_label(df: DataFrame, key: str, label: str, train_fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """M7: add ``split`` keeping each class's share exactly (per-class exact counts)."""
    flagged = sample_flag(df, key, fraction=train_fraction, seed=seed, by=[label], flag="_train")
    return flagged.withColumn("split", F.when(F.col("_train"), "train").otherwise("test")).drop("_train")
