"""Models (M8-M13, M20-M24) as Spark ML estimators with the reference's settings.

Fitting is distributed by Spark ML; the driver only loops over iterations. Settings that
have no Spark equivalent are mapped: an unlimited tree depth becomes 30 (Spark's maximum),
scikit-learn's Lasso objective equals Spark's elastic net with ``elasticNetParam=1`` and
``standardization=False``.
"""

from __future__ import annotations

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import Forest

UNLIMITED_DEPTH = 30


def linear_regression(features="features", label="label"):
    """M9: ordinary least squares."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0)


def lasso(alpha: float = 0.001, max_iter: int = 10000, features="features", label="label"):
    """Min (1/2n)||y - Xw||^2 + alpha * ||w||_1."""
    return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=1.0, regParam=alpha,
                            standardization=False, maxIter=max_iter, tol=1e-4)


def random_forest_regressor(trees: int = 300, depth: int | None = None, seed: int = 42, features="features",
                            label="label"):
    """Forest of ``trees``; ``depth=None`` (unlimited) maps to the deepest Spark allows."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees,
                                 maxDepth=UNLIMITED_DEPTH if depth is None else depth, seed=seed)


def grown_forest(trees: int = 300, depth: int | None = None, seed: int = 42, features="features", label="label"):
    """The forest of ``random_forest_regressor`` grown in tasks of bounded size, of really unlimited depth for ``depth=None``."""
    return Forest([{"trees": trees, "depth": depth}], seed, features, label)


def forest_grid_search(train: DataFrame, trees=(100, 200, 300), depths=(5, 10, 20, None), folds: int = 3,
                       seed: int = 42, parallelism: int = 4, features="features", label="label"):
    """Grid over trees x depth, k-fold cross-validation scored by MAE."""
    rf = RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, list(trees))
            .addGrid(rf.maxDepth, [UNLIMITED_DEPTH if d is None else d for d in depths]).build())
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mae")
    cv = CrossValidator(estimator=rf, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed,
                        parallelism=parallelism)
    return cv.fit(train)


def random_forest_classifier(trees: int = 100, depth: int = 10, seed: int = 42, features="features", label="label"):
    """Forest classifier; ``probability`` holds class probabilities."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)


def logistic_regression(features="features", label="label"):
    """M20."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=100)


def decision_tree(depth: int = 5, features="features", label="label"):
    """M20."""
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=depth)


def gradient_boosting_classifier(iters: int = 50, depth: int = 5, features="features", label="label"):
    """M21."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=iters, maxDepth=depth, seed=42)


def gradient_boosting_regressor(iters: int = 50, depth: int = 5, features="features", label="label"):
    """M21."""
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=iters, maxDepth=depth, seed=42)


def positive_score(pred: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    from pyspark.ml.functions import vector_to_array
    return pred.withColumn(out, vector_to_array("probability")[1])


def kmeans_clusters(df: DataFrame, k: int = 4, seed: int = 42, features="features"):
    """K-means and the silhouette of the clustering."""
    model = KMeans(featuresCol=features, k=k, seed=seed).fit(df)
    pred = model.transform(df)
    silhouette = ClusteringEvaluator(featuresCol=features).evaluate(pred)
    return model, pred, silhouette


def select_features_by_variance(df: DataFrame, columns, min_variance: float = 0.0) -> list[str]:
    """Keep columns whose sample variance exceeds a threshold (one aggregate pass)."""
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > min_variance]
