"""Correlations of chosen columns, redundancy, permutation importance against a per-feature loop."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import correlation as CO
from tidewater.operators import evaluation as EV


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(8)
    rows = []
    for i in range(300):
        x = r.gauss(0, 1)
        rows.append((i, x, None if i % 7 == 0 else 2 * x + r.gauss(0, 0.1), r.choice([float("nan"), 1.0, 2.0]), 5.0, None, "text", i % 3))
    return spark.createDataFrame(rows + rows[:5], "id long, x double, y double, z double, same double, none double, t string, k int").repartition(4)


def test_columns_are_chosen_by_the_data(table, spark):
    assert CO.varying_columns(table) == ["id", "x", "y", "z", "k"]
    assert CO.varying_columns(table, ["x", "same", "t"]) == ["x"]
    assert CO.varying_columns(table.limit(0)) == [] and CO.varying_columns(spark.createDataFrame([("a",)], "t string")) == []


def test_pairs_equal_numpy(table):
    columns = ["x", "y", "z", "same", "none", "k"]
    rows = table.select(*columns).collect()
    got = {(r.a, r.b): (r.n, r.r) for r in CO.pair_correlations(table, columns).collect()}
    assert len(got) == 36
    for a in columns:
        for b in columns:
            both = [(float(r[a]), float(r[b])) for r in rows if r[a] is not None and r[b] is not None and not math.isnan(r[a]) and not math.isnan(r[b])]
            n, r = got[a, b]
            assert n == len(both)
            v = np.array(both)
            if len(both) < 2 or v.std(axis=0).min() == 0:
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(v.T)[0, 1], abs=1e-9)
    assert CO.pair_correlations(table.limit(0), ["x", "y"]).count() == 0


def test_redundant_features_name_the_one_they_repeat(spark):
    r = {("a", "t"): 0.9, ("b", "t"): -0.9, ("c", "t"): 0.5, ("d", "t"): None, ("a", "b"): -0.95, ("a", "c"): 0.1, ("b", "c"): 0.99, ("a", "d"): None, ("b", "d"): 0.1, ("c", "d"): -0.97}
    pairs = spark.createDataFrame([(a, b, v) for (a, b), v in r.items()] + [(b, a, v) for (a, b), v in r.items()], "a string, b string, r double")
    got = {x.feature: tuple(x)[1:] for x in CO.select_uncorrelated(pairs, ["d", "c", "b", "a"], "t").collect()}
    assert got == {"a": (1, 0.9, True, None, None), "b": (2, -0.9, False, "a", -0.95), "c": (3, 0.5, True, None, None), "d": (4, None, False, "c", -0.97)}


def test_permutation_equals_a_loop_over_features(spark):
    r = random.Random(9)
    rows = [(i if i % 50 else None, r.random(), r.randrange(3), r.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, k int, y double").repartition(5)

    def score(d):
        return d.withColumn("prediction", 2 * F.col("x") + F.col("k"))

    got = {x.feature: x.rmse_increase for x in EV.permutation_importances(score, df, ["x", "k"], ["id", "x"], "y").collect()}

    def rmse(data):
        return math.sqrt(sum((y - (2 * x + k)) ** 2 for _, x, k, y in data) / len(data))

    def text(row):
        return "-".join(str(v) for v in row[:2] if v is not None)

    rows = [tuple(x) for x in df.withColumn("t", F.concat_ws("-", F.col("id").cast("string"), F.col("x").cast("string"))).collect()]
    own = sorted(rows, key=lambda w: (w[0] is not None, w[0] or 0, w[1]))
    other = sorted(rows, key=lambda w: (hashlib.md5(f"{w[4]}7".encode()).hexdigest(), w[0] is not None, w[0] or 0, w[1]))
    base = rmse([w[:4] for w in own])
    assert got["x"] == pytest.approx(rmse([(a[0], b[1], a[2], a[3]) for a, b in zip(own, other)]) - base)
    assert got["k"] == pytest.approx(rmse([(a[0], a[1], b[2], a[3]) for a, b in zip(own, other)]) - base)
