"""Order statistics: positions, quantiles, top-k, ranks, samples."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.features import exact_fraction
from tidewater.operators.ordering import (dense_rank_global, exact_quantiles, global_positions, surrogate_keys,
                                          top_k_per_group)


def test_global_positions_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), F.col("id"),
                                     F.md5(F.col("id").cast("string")).alias("h")).repartition(13)
    got = global_positions(df, ["h", "id"], ["g"], pos_col="p", count_col="n")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    bad = got.join(want, ["g", "id"]).where((F.col("p") != F.col("rn")))
    assert bad.count() == 0
    assert got.count() == 5000
    sizes = {r.g: r.n for r in got.select("g", "n").distinct().collect()}
    assert sizes == {r.g: r["count"] for r in df.groupBy("g").count().collect()}


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_positions_do_not_depend_on_partitioning(spark, parts):
    df = spark.range(0, 2000).withColumn("h", F.md5(F.col("id").cast("string"))).repartition(parts)
    got = global_positions(df, ["h", "id"], pos_col="p", num_partitions=parts)
    ref = sorted(range(2000), key=lambda i: __import__("hashlib").md5(str(i).encode()).hexdigest())
    rows = {r.id: r.p for r in got.select("id", "p").collect()}
    assert [rows[i] for i in ref] == list(range(1, 2001))


def test_exact_quantiles_match_numpy_with_nulls_and_hot_value(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(size=700)) + [5.0] * 300 + [None] * 20
    groups = [i % 3 for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(groups, [None if v is None else float(v) for v in vals])), "g int, x double")
    got = {r.g: r for r in exact_quantiles(df, "x", {"q1": 0.25, "med": 0.5, "p99": 0.99}, by=["g"], count_col="n").collect()}
    for g in range(3):
        arr = np.array([v for v, gg in zip(vals, groups) if gg == g and v is not None])
        assert got[g].n == len(arr)
        for name, q in (("q1", 0.25), ("med", 0.5), ("p99", 0.99)):
            assert got[g][name] == pytest.approx(np.percentile(arr, q * 100), abs=1e-12)
    glob = exact_quantiles(df, "x", {"med": 0.5}).first()
    assert glob.med == pytest.approx(np.median([v for v in vals if v is not None]))


def test_exact_quantile_of_empty_input_is_null(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, "x", {"med": 0.5}).first().med is None


def test_top_k_per_group_equals_window_rank_with_ties(spark):
    rows = [(g, v, i) for i, (g, v) in enumerate([(0, 5), (0, 5), (0, 4), (0, 3), (1, 9), (1, 9), (1, 9), (1, 1)] * 50)]
    df = spark.createDataFrame(rows, "g int, v int, id long")
    for kind in ("rank", "dense_rank", "row_number"):
        order = [F.desc("v"), F.asc("id")] if kind == "row_number" else [F.desc("v")]
        spec = [("v", False), ("id", True)] if kind == "row_number" else [("v", False)]
        got = top_k_per_group(df, ["g"], spec, 3, rank=kind, rank_col="r", salt_buckets=7)
        fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]
        want = df.withColumn("r", fn().over(Window.partitionBy("g").orderBy(*order))).where("r <= 3")
        assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))


def test_dense_rank_global(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([10, 30, 30, 20, None, 10])], "id long, v int")
    got = {r.id: r.dr for r in dense_rank_global(df, "v", descending=True, rank_col="dr").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 0: 3, 5: 3, 4: 4}


def test_surrogate_keys_are_consecutive(spark):
    df = spark.range(0, 1000).select(F.md5(F.col("id").cast("string")).alias("code")).repartition(9)
    keys = sorted(r.id for r in surrogate_keys(df, ["code"], "id", start=101).collect())
    assert keys == list(range(101, 1101))


def test_exact_fraction_per_class_and_determinism(spark):
    df = spark.range(0, 999).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    a = exact_fraction(df, "id", 0.7, 42, by=["y"])
    counts = {r.y: r["count"] for r in a.groupBy("y").count().collect()}
    assert counts == {1: round(333 * 0.7), 0: round(666 * 0.7)}
    b = exact_fraction(df.repartition(5), "id", 0.7, 42, by=["y"])
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())


def test_hot_group_is_split_across_tasks(spark):
    """A group holding a third of all rows is spread over several range slices, not one task."""
    from tidewater.operators.ordering import _range_sorted
    n = 30000
    df = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                                  .alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    ranged = _range_sorted(df, [F.col("g"), F.col("h")], 8)
    sizes = [r["count"] for r in ranged.groupBy("_tw_pid").count().collect()]
    hot_tasks = ranged.where("g = 'hot'").select("_tw_pid").distinct().count()
    assert max(sizes) < 2 * n / 8 and hot_tasks >= 2
    got = global_positions(df, ["h"], ["g"], pos_col="p", count_col="k", num_partitions=8).where("g = 'hot'")
    r = got.agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count("*").alias("c"), F.max("k").alias("k")).first()
    assert (r.lo, r.hi, r.c, r.k) == (1, n // 3, n // 3, n // 3)


def test_top_k_rank_with_a_hot_group_of_ties(spark):
    """All rows of the hot group tie: every one has rank 1 and is kept (results stay whole)."""
    rows = [("hot", 5, i) for i in range(600)] + [("hot", 4, 600 + i) for i in range(5)] + [("b", i, 700 + i) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, v int, id long")
    got = top_k_per_group(df, ["g"], [("v", False)], 2, rank="rank", rank_col="r", salt_buckets=8)
    counts = {(r.g, r.r): r["count"] for r in got.groupBy("g", "r").count().collect()}
    assert counts == {("hot", 1): 600, ("b", 1): 1, ("b", 2): 1}
    dense = top_k_per_group(df, ["g"], [("v", False)], 2, rank="dense_rank", rank_col="r", salt_buckets=8)
    assert {(r.g, r.r): r["count"] for r in dense.groupBy("g", "r").count().collect()} == \
        {("hot", 1): 600, ("hot", 2): 5, ("b", 1): 1, ("b", 2): 1}


def test_kth_smallest_and_grouped_dense_rank(spark):
    from tidewater.operators.ordering import kth_smallest
    df = spark.createDataFrame([("a", 5), ("a", 1), ("a", 3), ("b", 9), ("b", 9), ("b", 2)], "g string, v int")
    got = {r.g: r.v for r in kth_smallest(df, ["v"], 2, by=["g"]).collect()}
    assert got == {"a": 3, "b": 9}
    ranks = {(r.g, r.v): r.dr for r in dense_rank_global(df, "v", rank_col="dr", by=["g"]).collect()}
    assert ranks == {("a", 1): 1, ("a", 3): 2, ("a", 5): 3, ("b", 2): 1, ("b", 9): 2}


def test_row_of_extreme_ties_and_nulls(spark):
    from tidewater.operators.ordering import row_of_extreme
    df = spark.createDataFrame([(3, 9.0), (1, 9.0), (2, None), (4, 1.0), (5, 1.0)], "id long, v double")
    assert row_of_extreme(df, "v", "id").first().id == 1
    assert row_of_extreme(df, "v", "id", largest=False).first().id == 4
