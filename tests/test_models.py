"""Models and evaluation (fixtures: planted, classes, split)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import evaluation as EV
from tidewater.operators import features as FE
from tidewater.operators import models as MD


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 10, 800)
    noise = rng.normal(0, 1, 800)
    rows = [(i, float(a), float(b), float(3 * a + e)) for i, (a, b, e) in enumerate(zip(x, rng.normal(size=800), noise))]
    df = spark.createDataFrame(rows, "id long, x double, junk double, y double")
    df = df.withColumn("split", FE.hash_split("id", 80, 42))
    return FE.assemble(df, ["x", "junk"], "y").withColumnRenamed("y", "label")


def test_linear_and_lasso_beat_baseline(planted):
    train, test = planted.where("split = 'train'"), planted.where("split = 'test'")
    base = EV.regression_metrics(EV.mean_baseline(train, test, "label")).first()
    lin = EV.regression_metrics(MD.linear_regression().fit(train).transform(test)).first()
    las = EV.regression_metrics(MD.lasso().fit(train).transform(test)).first()
    assert lin.rmse < 0.5 * base.rmse and las.rmse < 0.5 * base.rmse and lin.r2 > 0.9
    m = MD.linear_regression().fit(train)
    assert m.coefficients[0] == pytest.approx(3.0, abs=0.1)


def test_lasso_soft_threshold_one_feature(spark):
    # centred data, one feature: w = S(x.y/n, alpha) / (x.x/n)
    rows = [(float(x), float(2 * x)) for x in (-2, -1, 1, 2)]
    df = FE.assemble(spark.createDataFrame(rows, "x double, label double"), ["x"], "label")
    alpha = 0.5
    m = MD.lasso(alpha=alpha).fit(df)
    xy, xx = sum(x * y for x, y in rows) / 4, sum(x * x for x, _ in rows) / 4
    assert m.coefficients[0] == pytest.approx((xy - alpha) / xx, abs=1e-4)


def test_forest_same_seed_same_metrics(planted):
    train, test = planted.where("split = 'train'"), planted.where("split = 'test'")
    a = EV.regression_metrics(MD.random_forest_regressor(10, 5).fit(train).transform(test)).first()
    b = EV.regression_metrics(MD.random_forest_regressor(10, 5).fit(train).transform(test)).first()
    assert a.rmse == b.rmse
    imp = EV.feature_importances(MD.random_forest_regressor(10, 5).fit(train), ["x", "junk"]).collect()
    assert imp[0].feature == "x"


def test_classification_report_and_auc(spark):
    perfect = spark.createDataFrame([(1.0, 1.0, 0.9), (0.0, 0.0, 0.1), (1.0, 1.0, 0.8), (0.0, 0.0, 0.2)],
                                    "label double, prediction double, score double")
    rep = {r.cls: r for r in EV.classification_report(perfect).collect()}
    assert rep["1"].precision == 1.0 and rep["accuracy"].f1 == 1.0 and rep["macro avg"].recall == 1.0
    assert EV.roc_auc(perfect).first().auc == 1.0
    tied = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.5), (0.0, 0.5)], "label double, score double")
    assert EV.roc_auc(tied).first().auc == 0.5
    one_class = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    r = {x.cls: x for x in EV.classification_report(one_class).collect()}
    assert r["1"].recall == 0.5 and r["0"].precision == 0.0


def test_one_hot_drop_first_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    cats = FE.categories(train, "t")
    test = spark.createDataFrame([("c",), ("z",), (None,)], "t string")
    got = [tuple(r) for r in FE.one_hot(test, "t", cats).collect()]
    assert cats == ["a", "b", "c"] and got == [(0, 1), (0, 0), (0, 0)]


def test_leak_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "usage double, log_usage double")
    with pytest.raises(ValueError):
        FE.assemble(df, ["usage"], "log_usage", forbidden=["usage"])


def test_hash_split_is_stable(spark):
    df = spark.range(0, 1000)
    a = {r.id: r.s for r in df.select("id", FE.hash_split("id").alias("s")).collect()}
    b = {r.id: r.s for r in df.repartition(7).select("id", FE.hash_split("id").alias("s")).collect()}
    assert a == b and 700 < sum(v == "train" for v in a.values()) < 900


def test_median_fill_and_cap(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (100.0,)], "x double")
    filled = [r.x for r in FE.median_fill(df, ["x"]).collect()]
    assert sorted(filled) == [1.0, 2.0, 2.0, 100.0]
    capped = sorted(r.x for r in FE.cap_at_quantile(df, "x", 0.5).collect() if r.x is not None)
    assert capped == [1.0, 2.0, 2.0]


def test_grid_search_small_grid(planted):
    train = planted.where("split = 'train'")
    cv = MD.forest_grid_search(train, trees=(5, 10), depths=(3,), folds=2, parallelism=2)
    assert len(cv.avgMetrics) == 2 and cv.bestModel.getNumTrees in (5, 10)


def test_approx_quantiles_close_to_exact(spark):
    from tidewater.operators.aggregates import approx_quantiles, distinct_count
    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("x"))
    r = approx_quantiles(df, "x", {"med": 0.5}).first()
    assert abs(r.med - 5000) <= 5
    n = df.agg(distinct_count("x", approx=True).alias("n")).first().n
    assert abs(n - 10001) / 10001 < 0.05


def test_residual_table_and_distribution(planted):
    from tidewater.operators.aggregates import describe, histogram
    train, test = planted.where("split = 'train'"), planted.where("split = 'test'")
    res = EV.residuals(MD.linear_regression().fit(train).transform(test))
    d = describe(res, ["residual"]).first()
    assert abs(d.mean) < 0.3 and 0.7 < d.std < 1.3
    assert sum(r["count"] for r in histogram(res, "residual", 10).collect()) == test.count()
