"""Correlations among columns that the data chooses, and greedy removal of redundant features.

The table of all pairs is one grouped aggregate over (column, column) rows: every input row gives the pairs of its
values, which are combined in the task that reads it, so a pair costs one row of state and the plan has one correlation
in it however many columns there are. Pairs are complete pairwise, as pandas has them; null and NaN are missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import corr_safe


def varying_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns (of those named) with at least two distinct values, from one plain aggregate (least < greatest)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and (columns is None or f.name in columns)]
    if not numeric:
        return []
    row = df.agg(*[(F.min(F.nanvl(F.col(c).cast("double"), F.lit(None))) < F.max(F.nanvl(F.col(c).cast("double"), F.lit(None)))).alias(c) for c in numeric]).first()
    return [c for c in numeric if row[c]]


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, r) for every ordered pair of columns: rows with both values, and their Pearson correlation.

    r is null where either column is constant on these rows. A pair without any such row has n = 0.
    """
    columns = list(columns)
    k, spark = len(columns), df.sparkSession
    names = F.broadcast(spark.createDataFrame(list(enumerate(columns)), "i int, name string"))
    values = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns])
    rows = df.select(values.alias("v"))

    def pair(i, j):
        return F.struct(i.alias("i"), j.alias("j"), F.get("v", i).alias("x"), F.get("v", j).alias("y"))

    upper = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.transform(F.sequence(i, F.lit(k - 1)), lambda j: pair(i, j))))
    pairs = rows.select(F.explode(upper).alias("p")).select("p.*")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    found = pairs.groupBy("i", "j").agg(F.count_if(both).alias("n"), corr_safe("x", "y").alias("r"))
    mirrored = found.unionByName(found.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "n", "r"))
    a, b = names.withColumnRenamed("name", "a"), names.select(F.col("i").alias("j"), F.col("name").alias("b"))
    return mirrored.join(a, "i").join(b, "j").select("a", "b", "n", "r")


def select_uncorrelated(correlations: DataFrame, features: Sequence[str], target: str, limit: float = 0.9) -> DataFrame:
    """Features in order of |r| with the target, kept unless |r| with one already kept exceeds ``limit``.

    Rows (feature, position, target_r, kept, redundant_with, r): a removed feature names the first kept one that it
    repeats. Ties are in the order of the name; a feature without a correlation to the target comes last, one
    without a correlation to another is not redundant with it. The table read has one row per pair of features.
    """
    table = {(x.a, x.b): x.r for x in correlations.collect()}

    def strength(f):
        r = table.get((f, target))
        return (r is None, -abs(r) if r is not None else 0.0, f)

    kept: list[str] = []
    rows = []
    for position, f in enumerate(sorted(features, key=strength), 1):
        twin = next((g for g in kept if table.get((f, g)) is not None and abs(table[f, g]) > limit), None)
        if twin is None:
            kept.append(f)
        rows.append((f, position, table.get((f, target)), twin is None, twin, table.get((f, twin)) if twin else None))
    return correlations.sparkSession.createDataFrame(rows, "feature string, position int, target_r double, kept boolean, redundant_with string, r double")
