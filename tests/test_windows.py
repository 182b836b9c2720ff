"""Window series on a monthly rollup (fixture: series -- missing month, one month, first rows of a 3-row window)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import windows as W


def months(spark, values):
    return spark.createDataFrame([(dt.date(2020, m, 1), v) for m, v in values], "month date, n long")


def test_lag_moving_running_with_a_missing_month(spark):
    df = months(spark, [(1, 10), (2, 20), (4, 40), (5, 50)])  # March is missing: LAG takes the previous row
    out = W.add_lag(df, "n", ["month"], "prev", allow_global=True)
    out = W.add_moving(out, "n", ["month"], "mov", 2, allow_global=True)
    out = W.add_running_sum(out, "n", ["month"], "run", allow_global=True)
    rows = [(r.month.month, r.prev, r.mov, r.run) for r in out.orderBy("month").collect()]
    assert rows == [(1, None, 10.0, 10), (2, 10, 15.0, 30), (4, 20, pytest.approx(70 / 3), 70), (5, 40, pytest.approx(110 / 3), 120)]


def test_one_month_and_running_sum_peers(spark):
    one = W.add_moving(months(spark, [(1, 7)]), "n", ["month"], "mov", 2, allow_global=True).first()
    assert one.mov == 7.0
    peers = spark.createDataFrame([(1, 5), (1, 5), (2, 1)], "k int, n long")
    got = sorted((r.k, r.run) for r in W.add_running_sum(peers, "n", ["k"], "run", allow_global=True).collect())
    assert got == [(1, 10), (1, 10), (2, 11)]  # RANGE frame: peers share the total, as the SQL default


def test_global_window_needs_a_declared_rollup(spark):
    with pytest.raises(ValueError):
        W.add_lag(months(spark, [(1, 1)]), "n", ["month"], "prev")
    part = W.add_rank(spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2)], "g string, v int"),
                      [F.desc("v")], "r", "dense_rank", partition_by=["g"])
    assert sorted((r.g, r.v, r.r) for r in part.collect()) == [("a", 1, 2), ("a", 3, 1), ("a", 3, 1), ("b", 2, 1)]
