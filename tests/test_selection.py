"""Order statistics by narrowing against sorting, with tails, ties, extremes, nulls, repeated rows and empty columns."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import selection as S


def quantile(values, q):
    v = sorted(values)
    at = (len(v) - 1) * q
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


@pytest.fixture(scope="module")
def columns():
    r = random.Random(2)
    n = 400
    return {"flat": [r.random() for _ in range(n)], "tail": [math.exp(r.gauss(0, 40)) * r.choice([-1, 1]) for _ in range(n)],
            "tied": [r.choice([1.0, 1.0, 1.0, 2.0, None]) for _ in range(n)], "near": [1e9 + r.randrange(50) / 1024 for _ in range(n)],
            "edge": [r.choice([math.inf, -math.inf, 1.7e308, -1.7e308, 5e-324, 0.0, -0.0, math.nan, None]) for _ in range(n)],
            "one": [7.5] + [None] * (n - 1), "none": [None] * n, "same": [3.25] * n}


@pytest.mark.parametrize("final", [S.FINAL, 3])
def test_quantiles(spark, columns, final):
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in names)).repartition(4)
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    got = S.quantiles_of(df, names, wanted, final=final)
    for c in names:
        clean = [x for x in columns[c] if x is not None and not math.isnan(x)]
        for k, q in wanted.items():
            if not clean:
                assert got[c][k] is None
            else:
                want = quantile(clean, q)
                assert got[c][k] == want or math.isnan(want)


@pytest.mark.parametrize("final", [S.FINAL, 2])
def test_ranks_of_longs_and_weights(spark, final):
    r = random.Random(4)
    big = [2**62 + r.randrange(40) for _ in range(200)]
    stacked = spark.createDataFrame([("x", v) for v in big], "column string, value long")
    ranks = [0, 1, 2, 57, 100, 199, 200, 201]
    got = S.values_at_ranks(stacked, {"x": ranks, "y": [1]}, final=final)
    ordered = sorted(big)
    assert got == {("x", k): (ordered[k - 1], ordered.index(ordered[k - 1]) + 1) for k in ranks if 1 <= k <= 200}
    counted = stacked.groupBy("column", "value").agg(F.count("*").alias("w"))
    assert S.values_at_ranks(counted, {"x": ranks}, weight="w", final=final) == got


@pytest.mark.parametrize("final", [S.FINAL, 2])
@pytest.mark.parametrize("rows", [0, 1, 3, 4, 7, 150])
def test_ntiles_equal_the_window(spark, rows, final):
    r = random.Random(rows)
    df = spark.createDataFrame([(i, r.randrange(4), r.random()) for i in range(rows)], "id long, k int, x double")
    got = S.add_ntiles(df, {"s": "k", "t": "x"}, "id", 4, final=final)
    assert got.columns == ["id", "k", "x", "s", "t"]
    want = df.selectExpr("*", "ntile(4) over (order by k, id) as s", "ntile(4) over (order by x, id) as t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_null_keys_are_refused(spark):
    with pytest.raises(ValueError):
        S.add_ntiles(spark.createDataFrame([(1, None)], "id long, k int"), {"s": "k"}, "id")
