"""Running balances, gap filling, rolling forecasts, key maps: hot keys, nulls, repeated rows, empty tables."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest

from tidewater.operators import keymap as KM
from tidewater.operators import series as SE


def test_running_balance_of_a_hot_key(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 5 + ["a", "b", None]), None if i % 31 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(200)), r.choice([None, Decimal(r.randrange(-50, 50))])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, day date, amount decimal(18,2)").repartition(5)
    got = {(x.k, x.day): (x.net, x.moved) for x in SE.running_balance(df, ["k"], "day", "amount").collect()}
    want = {}
    for k in {x[0] for x in rows}:
        total = Decimal(0)
        for day in sorted({x[1] for x in rows if x[0] == k}, key=lambda d: (d is not None, d)):
            net = sum((x[2] or 0 for x in rows if x[0] == k and x[1] == day), Decimal(0))
            total += net
            want[k, day] = (net, total)
    assert got == want
    low = {x.k: x for x in SE.shortages(SE.running_balance(df, ["k"], "day", "amount"), ["k"], "day", "moved", -20).collect()}
    for k, x in low.items():
        days = [(d, v[1]) for (g, d), v in want.items() if g == k]
        under = [d for d, v in days if v < -20]
        assert x.days_below == len(under) and x.first_day_below == min((d for d in under if d is not None), default=None) and x.lowest == min(v for _, v in days)
    assert SE.running_balance(df.limit(0), ["k"], "day", "amount").count() == 0


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def months(spark):
    r = random.Random(2)
    rows = [("a", month(i), float(r.randrange(100))) for i in range(40) if i not in (3, 4, 17)] + [("short", month(i), 1.0) for i in range(3)] + [(None, month(5), 2.0), ("a", None, 9.0)]
    return rows, spark.createDataFrame(rows, "s string, month date, v double").repartition(3)


def test_gaps_are_filled(months):
    rows, df = months
    got = sorted(((x.s, x.month, x.v, x.idx) for x in SE.gap_filled(df, ["s"], "month", "v", 0.0).collect()), key=repr)
    known = {(s, m): v for s, m, v in rows}
    want = [("a", month(i), known.get(("a", month(i)), 0.0), 360 + i) for i in range(40)] + [("short", month(i), 1.0, 360 + i) for i in range(3)] + [(None, month(5), 2.0, 365)]
    assert got == sorted(want, key=repr)


def test_rolling_origin_equals_refitting(months):
    _, df = months
    filled = SE.gap_filled(df, ["s"], "month", "v", 0.0)
    rows = {x.idx: x for x in SE.rolling_origin(filled, ["s"], "v", season=12, history=24).where("s = 'a'").collect()}
    values = [rows[360 + i].v for i in range(40)]
    errors = []
    for i in range(40):
        x = rows[360 + i]
        if i < 24:
            assert x.trend is None and x.seasonal_naive is None
        else:
            b, a = np.polyfit(range(360, 360 + i), values[:i], 1)
            assert x.trend == pytest.approx(a + b * (360 + i)) and x.seasonal_naive == values[i - 12]
            errors.append((abs(x.trend - x.v), abs(x.seasonal_naive - x.v)))
    got = {x.s: x for x in SE.forecast_errors(SE.rolling_origin(filled, ["s"], "v"), ["s"], "v").collect()}
    assert got["a"].origins == 16 and got["a"].mae_trend == pytest.approx(np.mean([e[0] for e in errors])) and got["a"].better in ("trend", "seasonal_naive")
    assert got["short"].origins == 0 and got["short"].better is None and got[None].months == 1


def test_forecast_goes_on_from_the_last_month(months):
    _, df = months
    filled = SE.gap_filled(df, ["s"], "month", "v", 0.0)
    values = [x.v for x in filled.where("s = 'a'").orderBy("idx").collect()]
    got = {x.month: x for x in SE.forecast(filled, ["s"], "month", "v", horizon=14).where("s = 'a'").collect()}
    b, a = np.polyfit(range(360, 400), values, 1)
    assert sorted(got) == [month(40 + h) for h in range(14)]
    for h in range(14):
        x = got[month(40 + h)]
        assert x.trend == pytest.approx(a + b * (400 + h)) and x.seasonal_naive == values[28 + h % 12]
    assert all(x.seasonal_naive is None for x in SE.forecast(filled, ["s"], "month", "v", 2).where("s = 'short'").collect())
    assert SE.forecast(filled.limit(0), ["s"], "month", "v").count() == 0


def test_keys_continue_and_never_change(spark):
    def load(*keys):
        return spark.createDataFrame([(k, 1) for k in keys], "code string, x int").repartition(3)

    first = KM.key_map([load("b", "a", "b", None, "a")], "code", "id")
    assert {r.code: (r.id, r.load) for r in first.collect()} == {"a": (1, 1), "b": (2, 1)}
    second = KM.key_map([load("d", "a", "0", "d"), load("d", "a", "0", "d"), load(), load("c", "zz")], "code", "id", known=first)
    want = {"a": (1, 1), "b": (2, 1), "0": (3, 2), "d": (4, 2), "c": (5, 5), "zz": (6, 5)}
    assert {r.code: (r.id, r.load) for r in second.collect()} == want and second.count() == 6
    again = KM.key_map([load("zz", "b")], "code", "id", known=second)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, second.collect()))
    rows = KM.numbered(load("a", None, "new"), second, "code", "id").collect()
    assert {(r.code, r.id) for r in rows} == {("a", 1), (None, None), ("new", None)}
    assert KM.key_map([load()], "code", "id").count() == 0
