"""Exact folds, and a grid search that goes on where it was stopped."""

import hashlib
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidewater.operators import models as MD
from tidewater.operators import tuning as TU


@pytest.mark.parametrize("rows, folds", [(0, 3), (1, 3), (2, 3), (100, 3), (101, 4)])
def test_folds_are_exact_in_hash_order(spark, rows, folds):
    keys = [f"k{i}" for i in range(rows)]
    df = spark.createDataFrame([(k, "c") for k in keys], "id string, _x string").repartition(3)
    got = {r.id: r.fold for r in TU.fold_column(df, "id", folds, 42).collect()}
    ordered = sorted(keys, key=lambda k: (hashlib.md5(f"{k}42".encode()).hexdigest(), k))
    cuts = [(2 * i * rows + folds) // (2 * folds) for i in range(1, folds)]
    assert got == {k: sum(p >= c for c in cuts) for p, k in enumerate(ordered)}


def test_folds_split_copies_and_null_keys(spark):
    df = spark.createDataFrame([(None,)] * 20 + [("same",)] * 30 + [("a",)] * 1, "id string")
    sizes = {r.fold: r.n for r in TU.fold_column(df, "id", 3).groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 17, 1: 17, 2: 17}


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(1)
    rows = [(i, x := r.uniform(0, 10), r.random(), 3 * x + r.gauss(0, 1)) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, x double, junk double, label double")
    return VectorAssembler(inputCols=["x", "junk"], outputCol="features").transform(df).cache()


def tree(trees, depth):
    return MD.random_forest_regressor(trees, depth)


def test_search_resumes_and_equals_a_plain_loop(spark, planted, tmp_dir):
    settings = TU.grid(trees=[2, 4], depth=[1, 4])
    assert settings == [{"trees": 2, "depth": 1}, {"trees": 2, "depth": 4}, {"trees": 4, "depth": 1}, {"trees": 4, "depth": 4}]
    made = []

    def lost(trees, depth):
        if len(made) == 5:
            raise RuntimeError("driver lost")
        made.append((trees, depth))
        return tree(trees, depth)

    with pytest.raises(RuntimeError):
        TU.grid_search(planted, lost, settings, "id", store=tmp_dir, parallelism=1)
    result = TU.grid_search(planted, tree, settings, "id", store=tmp_dir)
    assert result.fitted_now == 4 * 3 - 5 and result.scores.count() == 12
    again = TU.grid_search(planted.repartition(7), tree, settings, "id", store=tmp_dir)
    assert again.fitted_now == 0 and again.best == result.best
    scores = {(r.setting, r.fold): r for r in result.scores.collect()}
    parts = TU.fold_column(planted.withColumn("id", F.col("id").cast("string")), "id", 3, 42).cache()
    from tidewater.operators.evaluation import regression_metrics
    for s, f in ((0, 0), (3, 2)):
        model = tree(**settings[s]).fit(parts.where(F.col("fold") != f))
        want = regression_metrics(model.transform(parts.where(F.col("fold") == f))).first()
        assert scores[s, f].n == want.n == 80 and scores[s, f].mae == pytest.approx(want.mae, rel=0.2)
    means = [sum(scores[s, f].mae for f in range(3)) / 3 for s in range(4)]
    assert result.best == means.index(min(means)) and result.best_setting["depth"] == 4
    other = TU.grid_search(planted.where("id < 200"), tree, settings[:1], "id", store=tmp_dir)
    assert other.fitted_now == 3


def test_refit_reports_both_splits(planted):
    train, test = planted.where("id % 4 > 0"), planted.where("id % 4 = 0")
    _, report = TU.refit(train, test, tree, {"trees": 4, "depth": 6})
    found = {r.split: r for r in report.collect()}
    assert found["train"].r2 > 0.9 and found["test"].r2 > 0.8 and found["test"].n == 60


def test_rows_without_labels_are_refused(spark, planted, tmp_dir):
    with pytest.raises(Exception):
        TU.grid_search(planted.where("id < 0"), tree, TU.grid(trees=[1], depth=[1]), "id", store=tmp_dir)
