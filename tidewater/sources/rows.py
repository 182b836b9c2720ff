"""Row loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """S3: ``INSERT .. VALUES`` as a frame with a declared schema."""
    return spark.createDataFrame(rows, schema)


def generated_rows(spark: SparkSession, start: int, end_inclusive: int, **columns: Column) -> DataFrame:
    """``INSERT .. SELECT`` over a number sequence; ``id`` is the sequence value.

    ``spark.range`` replaces the recursive CTE: it is split across tasks and has no
    recursion limit.
    """
    seq = spark.range(start, end_inclusive + 1)
    return seq.select("id", *[expr.alias(name) for name, expr in columns.items()])


def resolve_natural_keys(rows: DataFrame, lookup: DataFrame, natural_key: str, surrogate_key: str,
                         row_key: str | None = None, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Replace a natural key by the surrogate key of a lookup table.

    One equi-join instead of a per-row subquery. Returns (resolved, unresolved);
    unresolved rows are the ones the per-row subquery would have turned into null.
    The join strategy is left to the planner: AQE broadcasts the lookup when its
    measured size is under the threshold and sort-merges otherwise.
    """
    keys = lookup.select(F.col(natural_key), F.col(surrogate_key), *carry)
    resolved = rows.join(keys, on=natural_key, how="inner")
    unresolved = rows.join(keys.select(natural_key), on=natural_key, how="left_anti")
    if row_key is not None:
        resolved = resolved.drop(natural_key)
    return resolved, unresolved
