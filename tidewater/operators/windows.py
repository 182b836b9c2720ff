"""Window series.

A window without ``partitionBy`` runs in one task. These helpers are meant for
rollups whose size does not grow with the data (months, categories); they refuse a
global window on a frame that is not declared to be such a rollup. Ranking raw rows
goes through ``operators.ordering`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import col


def _window(order_by: Sequence[str | Column], partition_by: Sequence[str], allow_global: bool):
    if not partition_by and not allow_global:
        raise ValueError("a window without partition_by runs in one task; aggregate first and pass allow_global=True")
    w = Window.partitionBy(*partition_by) if partition_by else Window.partitionBy()
    return w.orderBy(*[col(o) for o in order_by])


def add_lag(df: DataFrame, value: str, order_by: Sequence[str | Column], out: str, offset: int = 1,
            partition_by: Sequence[str] = (), allow_global: bool = False) -> DataFrame:
    """``LAG(value, offset) OVER (ORDER BY ..)``."""
    return df.withColumn(out, F.lag(value, offset).over(_window(order_by, partition_by, allow_global)))


def add_moving(df: DataFrame, value: str, order_by: Sequence[str | Column], out: str, preceding: int = 2,
               fn=F.avg, partition_by: Sequence[str] = (), allow_global: bool = False) -> DataFrame:
    """``fn(value) OVER (ORDER BY .. ROWS BETWEEN preceding PRECEDING AND CURRENT ROW)``."""
    w = _window(order_by, partition_by, allow_global).rowsBetween(-preceding, 0)
    return df.withColumn(out, fn(value).over(w))


def add_running_sum(df: DataFrame, value: str, order_by: Sequence[str | Column], out: str,
                    partition_by: Sequence[str] = (), allow_global: bool = False) -> DataFrame:
    """``SUM(value) OVER (ORDER BY ..)`` -- default frame RANGE .. CURRENT ROW, so peers share a total."""
    w = _window(order_by, partition_by, allow_global).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def add_rank(df: DataFrame, order_by: Sequence[str | Column], out: str, kind: str = "dense_rank",
             partition_by: Sequence[str] = (), allow_global: bool = False) -> DataFrame:
    """Rank, dense_rank or row_number over a rollup."""
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]
    return df.withColumn(out, fn().over(_window(order_by, partition_by, allow_global)))
