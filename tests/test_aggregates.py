"""Profiling aggregates (fixtures: nulls_keys, hist, corr, dup, checks)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as A


def test_value_counts_drop_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert {r.k: r["count"] for r in A.value_counts(df, "k").collect()} == {"a": 2, "b": 1}


def test_named_agg_drops_null_group_but_sql_grouping_keeps_it(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", None), ("x", 2.0)], "k string, v double")
    got = A.named_agg(df, ["k"], s=F.sum("v")).collect()
    assert [(r.k, r.s) for r in got] == [("x", 2.0)]
    assert df.groupBy("k").count().count() == 2


def test_describe_matches_numpy(spark):
    xs = [1.0, 2.0, 2.0, 3.5, 10.0, None]
    df = spark.createDataFrame([(x, None if x is None else int(x)) for x in xs], "a double, b int")
    r = {row.column: row for row in A.describe(df, ["a", "b"]).collect()}
    arr = np.array([x for x in xs if x is not None])
    assert r["a"]["count"] == 5
    assert r["a"].mean == pytest.approx(arr.mean())
    assert r["a"].std == pytest.approx(arr.std(ddof=1), abs=1e-6)
    assert r["a"].p25 == pytest.approx(np.percentile(arr, 25))
    assert r["a"].p75 == pytest.approx(np.percentile(arr, 75))


def test_histogram_edges_like_numpy(spark):
    xs = [0.0, 1.0, 2.5, 9.99, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    h = A.histogram(df, "x", 4).orderBy("bin").collect()
    counts, _ = np.histogram(xs, bins=4)
    assert [r["count"] for r in h] == list(counts)
    const = A.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in const] == [2, 0, 0]


def test_corr_matrix_pairwise_complete(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.2, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    r = {(x.a, x.b): x.r for x in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 8.2])[0, 1], abs=1e-6)
    assert r[("a", "c")] is None  # constant column


def test_missing_percent_and_complete_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 3)], "a int, b int")
    miss = {r.column: (r.missing_pct, r.is_worst) for r in A.missing_percent(df, ["a", "b"]).collect()}
    assert miss == {"a": (33.33, False), "b": (66.67, True)}
    c = A.complete_rows(df).first()
    assert (c.rows_complete, c.rows_with_missing) == (1, 2)


def test_breakdown_keeps_zero_categories(spark):
    df = spark.createDataFrame([("High",), ("High",), ("Low",)], "c string")
    got = [(r.c, r["count"], r.percent) for r in A.breakdown(df, "c", ["Very High", "High", "Low"]).collect()]
    assert got == [("Very High", 0, 0.0), ("High", 2, 66.7), ("Low", 1, 33.3)]


def test_duplicate_counts_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "x int, y string")
    r = A.duplicate_counts(df).first()
    assert (r.rows, r.distinct_rows, r.duplicates) == (5, 3, 2)
    assert df.dropDuplicates().count() == 3


def test_box_stats_whiskers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(0, x) for x in xs], "g int, x double")
    r = A.box_stats(df, "x", ["g"]).first()
    q1, q3 = np.percentile(xs, [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r.outliers == 1 and r.whisker_high == 4.0 and r.whisker_low == 1.0


def test_cohort_compare(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 20.0), (0, 5.0)], "y int, v double")
    r = A.cohort_compare(df, F.col("y") == 1, ["v"]).first()
    assert (r.mean_yes, r.mean_no, r.difference) == (15.0, 5.0, 10.0)


def test_histogram_single_row(spark):
    h = A.histogram(spark.createDataFrame([(4.5,)], "x double"), "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 0, 0, 0, 0] and h[0].lower == 4.5
