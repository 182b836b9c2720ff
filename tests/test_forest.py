"""Forests grown in tasks of bounded size, and the grid search on all rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidewater.operators import forest as FO
from tidewater.operators import forest_core as core
from tidewater.operators import tuning as TU
from tidewater.operators.evaluation import regression_metrics
from tidewater.operators.models import grown_forest, random_forest_regressor


def squares(y, w):
    return (w * y).sum() ** 2 / w.sum()


def plain_cut(bins, y, w):
    cuts = [(squares(y[left], w[left]) + squares(y[~left], w[~left]), f, c)
            for f in range(bins.shape[1]) for c in range(core.BINS - 1)
            for left in [bins[:, f] <= c] if left.any() and not left.all()]
    return max(cuts, key=lambda c: c[0])


def test_cuts_equal_a_plain_search():
    g = np.random.default_rng(3)
    bins, y, w = g.integers(0, 32, (200, 4)).astype(np.uint8), g.normal(size=200), g.poisson(1.0, 200) + 1.0
    feat, cut, left, value = core.grow(bins, y, w, 2, np.random.default_rng(0), 4, 1e-12)
    assert plain_cut(bins, y, w)[1:] == (feat[0], cut[0]) and left[0] == 1
    at = bins[:, feat[0]] <= cut[0]
    for child, rows in ((1, at), (2, ~at)):
        assert plain_cut(bins[rows], y[rows], w[rows])[1:] == (feat[child], cut[child])
        assert value[child] == pytest.approx(np.average(y[rows], weights=w[rows]))
    assert len(feat) == 7 and (feat[3:] == -1).all()


def test_a_tree_cut_at_a_depth_is_the_tree_of_that_depth():
    g = np.random.default_rng(4)
    bins, y, w = g.integers(0, 9, (500, 6)).astype(np.uint8), g.normal(size=500), np.ones(500)
    whole = core.grow(bins, y, w, None, np.random.default_rng(1), 2, 1e-12)
    found = core.predicted(whole, bins, [0, 3, 7, None])
    for i, d in enumerate((0, 3, 7, None)):
        own = core.grow(bins, y, w, d, np.random.default_rng(1), 2, 1e-12)
        assert np.array_equal(core.predicted(own, bins, [None])[0], found[i])
    same = core.grow(bins, np.full(500, 2.5), w, None, np.random.default_rng(1), 2, 1e-12)
    assert same[0].tolist() == [-1] and same[3].tolist() == [2.5]


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(2)
    rows = [(i, x := r.uniform(0, 10), r.random(), float(i % 3), 3 * x + 5 * (i % 3) + r.gauss(0, 1)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x double, junk double, kind double, label double").repartition(3, "id")
    return VectorAssembler(inputCols=["x", "junk", "kind"], outputCol="features").transform(df).cache()


def test_points_part_frequent_and_few_values(spark):
    rows = [([float(i % 4), float(i) if i < 100 else 1000.0, float(i), float("nan")],) for i in range(2000)]
    points = FO.split_points(spark.createDataFrame(rows, "x array<double>").repartition(5), 4)
    assert points[0].tolist() == [0.5, 1.5, 2.5] and not len(points[3])
    assert points[1][-2] < 1000 <= points[1][-1]
    assert points[2].tolist() == pytest.approx([1999 * i / 32 for i in range(1, 32)])
    assert max(map(len, points)) < core.BINS


def test_predictions_of_several_settings_equal_separate_fits(planted):
    settings = TU.grid(trees=[2, 5], depth=[1, 4, None])
    both = {r.id: r.predictions for r in FO.Forest(settings).fit(planted).predictions(planted).collect()}
    assert len(both) == 900
    for i, s in enumerate(settings):
        alone = grown_forest(**s).fit(planted).transform(planted)
        assert alone.columns == [*planted.columns, "prediction"]
        assert {r.id: r.prediction for r in alone.collect()} == pytest.approx({k: v[i] for k, v in both.items()})


def test_forest_is_as_good_as_spark_mls(planted):
    train, test = planted.where("id % 4 > 0"), planted.where("id % 4 = 0")
    for depth in (4, 12):
        own, spark_ml = (regression_metrics(make(60, depth).fit(train).transform(test)).first() for make in (grown_forest, random_forest_regressor))
        assert own.n == spark_ml.n == 225 and own.mae == pytest.approx(spark_ml.mae, rel=0.15) and own.r2 > 0.8


@pytest.mark.parametrize("most, at_once", [(30, 1000), (899, 2700)])
def test_trees_of_many_rows_equal_trees_of_one_task(planted, monkeypatch, most, at_once):
    settings = TU.grid(trees=[2, 4], depth=[0, 2, 5, None])

    def found():
        model = FO.Forest(settings).fit(planted)
        model.subset = model.width  # without draws of features both ways make the same cuts
        return {r.id: r.predictions for r in model.predictions(planted).collect()}

    whole = found()
    monkeypatch.setattr(FO, "TREE_ROWS", most)
    monkeypatch.setattr(FO, "DEALT_ROWS", at_once)
    dealt = found()
    assert len(dealt) == 900
    limited = [i for i, s in enumerate(settings) if s["depth"] is not None]
    for k, v in whole.items():
        assert [dealt[k][i] for i in limited] == pytest.approx([v[i] for i in limited])
    # leaves of two or three rows have cuts of equal gain, between which rounding decides
    off = [abs(dealt[k][-1] - v[-1]) for k, v in whole.items()]
    assert sum(off) / len(off) < 0.2 and sorted(off)[450] < 1e-9


def test_one_value_and_few_rows_and_none(spark, planted, monkeypatch):
    flat = planted.withColumn("label", F.lit(7.0))
    for most in (FO.TREE_ROWS, 100):
        monkeypatch.setattr(FO, "TREE_ROWS", most)
        got = grown_forest(3, None).fit(flat).transform(planted).agg(F.min("prediction"), F.max("prediction")).first()
        assert list(got) == pytest.approx([7.0, 7.0])
        assert grown_forest(3, 2).fit(flat).transform(planted.where("id < 0")).count() == 0
    assert grown_forest(3, 2).fit(planted.where("id = 5")).transform(planted).select("prediction").distinct().count() == 1
    for bad in (planted.where("id < 0"), planted.withColumn("label", F.when(F.col("id") > 3, F.col("label"))), planted.withColumn("label", F.lit(float("nan")))):
        with pytest.raises(ValueError):
            grown_forest(3, 2).fit(bad)


def test_a_joint_search_scores_as_separate_fits_and_resumes(planted, tmp_path):
    settings = TU.grid(trees=[2, 4], depth=[1, None])
    asked = []

    def joint(some):
        asked.append(len(some))
        return FO.Forest(some)

    one = TU.grid_search(planted, grown_forest, settings, "id", store=str(tmp_path / "a"))
    all_ = TU.grid_search(planted, grown_forest, settings, "id", store=str(tmp_path / "b"), joint=joint)
    assert asked == [4, 4, 4] and all_.fitted_now == one.fitted_now == 12 and all_.best == one.best
    want = {(r.setting, r.fold): r for r in one.scores.collect()}
    for r in all_.scores.collect():
        assert r.n == 300 and r.mae == pytest.approx(want[r.setting, r.fold].mae, rel=0.3)
    again = TU.grid_search(planted, grown_forest, settings, "id", store=str(tmp_path / "b"), joint=joint)
    assert again.fitted_now == 0 and asked == [4, 4, 4]


@pytest.fixture(scope="module")
def meters(spark, tmp_path_factory):
    """Some 900 line items that are grid readings, so that the training split has more than 500."""
    d, r, day = str(tmp_path_factory.mktemp("meters")), random.Random(5), dt.date(1995, 1, 1)
    customers = [(k, f"c{k}", k % 25, r.uniform(-500, 9000), ("BUILDING", "MACHINERY")[k % 2]) for k in range(1, 60)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{d}/customer.parquet")
    orders = [(k, 1 + k % 59, day + dt.timedelta(k % 700), ("1-URGENT", "5-LOW")[k % 2], 1000.0 + k) for k in range(1, 301)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_totalprice double").coalesce(1).write.parquet(f"{d}/orders.parquet")
    lines = [(o, n, o * 7 + n, n, 100.0 + o + 50 * n, "A", "F", day + dt.timedelta(o % 700 + n)) for o in range(1, 301) for n in (1, 2, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate date").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_registered_search_is_the_references_on_all_training_rows(spark, meters):
    from tidewater.plans import energy as EN
    from tidewater.plans.registry import QUERIES
    from tidewater.sources.tables import Tables

    rows = {r["split"]: r["count"] for r in EN.model_frame(Tables(spark, meters))[0].groupBy("split").count().collect()}
    assert rows["train"] > 500
    per_setting: dict = {}
    for r in QUERIES["m12_forest_grid"](spark, meters).collect():
        per_setting.setdefault((r.trees, r.depth), []).append(r.n)
    assert set(per_setting) == {(t, d) for t in (100, 200, 300) for d in (5, 10, 20, None)}
    assert {(len(n), sum(n)) for n in per_setting.values()} == {(3, rows["train"])}
    report = {r["split"]: r for r in QUERIES["m12_best_forest"](spark, meters).collect()}
    assert {k: r.n for k, r in report.items()} == rows and report["train"].trees in (100, 200, 300)
