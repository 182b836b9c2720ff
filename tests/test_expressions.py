"""Expression builders: rounding, binning, coercion, dates (fixtures: months, days, years, gdp, sentinel)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import expressions as X


def one(spark, expr, schema="x int", rows=((1,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


@pytest.mark.parametrize("num,den,digits,want", [
    (469, 200, 2, 2.35),    # 2.345 is 2.34499.. as a double; half away from zero on the exact ratio
    (201, 200, 2, 1.01),    # 1.005
    (-469, 200, 2, -2.35),
    (1, 3, 2, 0.33), (2, 3, 2, 0.67), (0, 5, 1, 0.0), (5, 0, 2, None),
])
def test_round_ratio_exact_half_away_from_zero(spark, num, den, digits, want):
    got = one(spark, X.round_ratio(F.lit(num), F.lit(den), digits))[0]
    assert got == want


def test_season_right_closed(spark):
    months = list(range(0, 14))
    got = one(spark, X.season("x"), rows=[(m,) for m in months])
    assert got == [None, "Winter", "Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                   "Fall", "Fall", "Fall", None]


def test_decade_labels_null_is_other(spark):
    years = [1989, 1990, 1999, 2000, 2010, 2020, 2021, None]
    got = one(spark, X.decade_label("x"), rows=[(y,) for y in years])
    assert got == ["Other", "1990s", "1990s", "2000s", "2010s", "2010s", "Other", "Other"]


def test_three_way_category_missing_is_high(spark):
    vals = [1.0, 5.0, 7.0, 9.0, None]
    got = one(spark, X.three_way_category("x", F.lit(5.0), F.lit(7.0)), "x double", [(v,) for v in vals])
    assert got == ["Low", "Medium", "Medium", "High", "High"]


def test_to_number_and_sentinels(spark):
    df = spark.createDataFrame([("Not Available",), ("?",), ("NULL",), (" 12.5 ",), ("abc",)], "s string")
    clean = X.sentinels_to_null(df, ["Not Available"])
    assert [r.s for r in clean.collect()] == [None, "?", "NULL", " 12.5 ", "abc"]
    assert [r[0] for r in clean.select(X.to_number("s")).collect()] == [None, None, None, 12.5, None]


def test_whole_days_between_floors(spark):
    rows = [(dt.datetime(2020, 1, 1, 10), dt.datetime(2020, 1, 1, 23)),
            (dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1)),
            (dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 1, 12))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(X.whole_days_between("a", "b")).collect()] == [0, 0, -2]


def test_month_label_and_start(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 17),)], "d date")
    r = df.select(X.month_label("d"), X.month_start("d")).first()
    assert r[0] == "2020-03" and r[1] == dt.date(2020, 3, 1)


def test_cap_keeps_null(spark):
    got = one(spark, X.cap_at("x", F.lit(10.0)), "x double", [(5.0,), (11.0,), (None,)])
    assert got == [5.0, 10.0, None]


@pytest.mark.parametrize("flags,visits,score,band", [
    (0, 4, 0.0, "Low"), (4999, 20000, 25.0, "Medium"), (4998, 20000, 24.99, "Low"),
    (1, 4, 25.0, "Medium"), (9999, 20000, 50.0, "High"), (1, 2, 50.0, "High"),
])
def test_score_edges_round_before_band(spark, flags, visits, score, band):
    """Q4: the rate is rounded to 2 decimals first, then banded (24.995 -> 25.00 -> Medium)."""
    from tidewater.plans import labels as LB
    s = X.round_ratio(F.lit(flags * 100), F.lit(visits), 2)
    b = F.when(s >= LB.RISK_SCORE_HIGH_AT, "High").when(s >= LB.RISK_SCORE_MEDIUM_AT, "Medium").otherwise("Low")
    r = spark.range(1).select(s.alias("s"), b.alias("b")).first()
    assert (r.s, r.b) == (score, band)
