"""Series per key: running balances, calendar gaps, forecasts and their rolling-origin errors.

A running balance is a prefix sum within each key over movements that are first added up per key and day. It comes from
weighted global positions, so a key with a third of all movements is summed in slices across tasks, each of which
starts from the total of the slices before it. Monthly series are bounded by the calendar; their windows are per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_positions


def running_balance(moves: DataFrame, by: Sequence[str], day: str, amount: str, out: str = "moved") -> DataFrame:
    """(by, day, net, out): net movement per key and day, and the sum of all movements up to and with that day.

    Null amounts move nothing; a null key is a key, a null day comes first. Amounts should be integers or decimals, so that the
    sums do not depend on the order of the slices.
    """
    by = list(by)
    daily = moves.groupBy(*by, day).agg(F.sum(F.coalesce(F.col(amount), F.lit(0))).alias("net"))
    return global_positions(daily, [day], by, pos_col=out, weight="net").drop(f"{out}_start")


def shortages(balances: DataFrame, by: Sequence[str], day: str, balance: str, threshold) -> DataFrame:
    """One row per key: first day with a balance under the threshold (null if none), days under it, lowest and last balance."""
    low = F.col(balance) < F.lit(threshold)
    return balances.groupBy(*by).agg(
        F.min(F.when(low, F.col(day))).alias("first_day_below"), F.count_if(low).alias("days_below"),
        F.min(balance).alias("lowest"), F.max_by(balance, day).alias("last"))


def gap_filled(series: DataFrame, by: Sequence[str], month: str, value: str, fill=0) -> DataFrame:
    """Every month between a series' first and last one, with ``fill`` where it has no row; ``idx`` counts months since 1970.

    One row per series and month in ``series``; rows without a month are left out.
    """
    by = list(by)
    known = series.where(F.col(month).isNotNull())
    span = known.groupBy(*by).agg(F.min(month).alias("_a"), F.max(month).alias("_z"))
    months = span.select(*by, F.explode(F.sequence("_a", "_z", F.expr("INTERVAL 1 MONTH"))).alias(month))
    stored = known.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col(month).alias("_m"), value)
    same = F.col(month) == F.col("_m")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    out = months.join(stored, same, "left").select(*by, month, F.coalesce(F.col(value), F.lit(fill)).alias(value))
    return out.withColumn("idx", (F.year(month) - 1970) * 12 + F.month(month) - 1)


def _history(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("idx")


def rolling_origin(filled: DataFrame, by: Sequence[str], value: str, season: int = 12, history: int = 24) -> DataFrame:
    """One-month-ahead forecasts of every month from the months before it: ``trend`` and ``seasonal_naive``.

    The trend is the least-squares line through all earlier months, fitted anew at every origin by running sums.
    Months with fewer than ``history`` months before them have no forecast.
    """
    past = _history(by).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.row_number().over(_history(by)) - 1
    line = F.regr_intercept(value, "idx").over(past) + F.regr_slope(value, "idx").over(past) * F.col("idx")
    enough = F.col("_seen") >= max(history, season, 2)
    out = filled.withColumns({"_seen": seen, "_line": line, "_naive": F.lag(value, season).over(_history(by))})
    return out.withColumns({"trend": F.when(enough, F.col("_line")), "seasonal_naive": F.when(enough, F.col("_naive"))}).drop("_seen", "_line", "_naive")


def forecast_errors(forecasts: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per series: months, origins, mean absolute error of both forecasts, and which is the better one."""
    def mae(c):
        return F.avg(F.abs(F.col(value) - F.col(c)))

    out = forecasts.groupBy(*by).agg(F.count(F.lit(1)).alias("months"), F.count("trend").alias("origins"), mae("trend").alias("mae_trend"), mae("seasonal_naive").alias("mae_seasonal"))
    better = F.when(F.col("mae_trend").isNull(), None).when(F.col("mae_trend") <= F.col("mae_seasonal"), "trend").otherwise("seasonal_naive")
    return out.withColumn("better", better)


def forecast(filled: DataFrame, by: Sequence[str], month: str, value: str, horizon: int = 6, season: int = 12) -> DataFrame:
    """The ``horizon`` months after each series' last one: the line through all its months, and the value a season earlier.

    The seasonal value is null where a series is shorter than a season.
    """
    by = list(by)
    fit = filled.groupBy(*by).agg(F.regr_slope(value, "idx").alias("_b"), F.regr_intercept(value, "idx").alias("_a"), F.max("idx").alias("_last"),
                                  F.max(month).alias("_last_month"),
                                  F.map_from_entries(F.collect_list(F.struct("idx", value))).alias("_values"))  # one entry per month of the calendar
    ahead = fit.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    idx = F.col("_last") + F.col("_h")
    # beyond one season, the last season is repeated
    source = idx - season * F.ceil(F.col("_h") / season).cast("int")
    return ahead.select(*by, F.add_months("_last_month", F.col("_h")).alias(month), (F.col("_a") + F.col("_b") * idx).alias("trend"),
                        F.try_element_at("_values", source).alias("seasonal_naive"))
