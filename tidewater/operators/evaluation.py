"""Model evaluation (M14-M19, M22) as aggregates over prediction frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import global_positions


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R^2 (1 - SSE/SST) in one pass, optionally per split."""
    e = F.col(label) - F.col(prediction)
    return pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(label))).alias("r2"),
    )


def mean_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """M8: predict the training mean for every test row (one-row broadcast)."""
    m = train.agg(F.avg(label).alias("prediction"))
    return test.crossJoin(F.broadcast(m))


def residuals(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Label - prediction, for the residual distribution (describe / histogram / grid)."""
    return pred.withColumn("residual", F.col(label) - F.col(prediction))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted averages.

    All from the (label, prediction) count table, whose size is classes^2.
    """
    as_class = lambda c: F.col(c).cast("double").cast("int").cast("string")  # noqa: E731 -- 1, 1.0 -> "1"
    cm = pred.groupBy(as_class(label).alias("y"), as_class(prediction).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    tp = cm.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("c").alias("tp"))
    sup = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("c").alias("support"))
    pc = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("predicted"))
    per = sup.join(pc, "cls", "full_outer").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select("cls", prec.alias("precision"), rec.alias("recall"), "support")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(0.0))
    tot = per.agg(F.sum("support").alias("n"))
    acc = cm.agg((F.sum(F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0)) / F.sum("c")).alias("a"))
    macro = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    weighted = per.crossJoin(F.broadcast(tot)).agg(
        F.lit("weighted avg").alias("cls"),
        (F.sum(F.col("precision") * F.col("support")) / F.first("n")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.first("n")).alias("recall"),
        F.sum("support").alias("support"),
        (F.sum(F.col("f1") * F.col("support")) / F.first("n")).alias("f1"))
    accuracy = acc.crossJoin(tot).select(F.lit("accuracy").alias("cls"), F.lit(None).cast("double").alias("precision"),
                                         F.lit(None).cast("double").alias("recall"), F.col("n").alias("support"),
                                         F.col("a").alias("f1"))
    return per.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of (actual, predicted) pairs, long form."""
    return pred.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC-AUC by the rank-sum rule (ties count one half), distributed.

    Scores are counted per distinct value (positives, negatives); the negatives ranked
    below each score come from weighted global positions, not from one sorted task.
    """
    per = scored.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    pos = global_positions(per, ["s"], pos_col="_cum_neg", weight="neg")
    below = F.col("_cum_neg") - F.col("neg")
    # null with one class only; doubles, since the product of two counts can pass the range of bigint
    return pos.agg(F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                                F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def feature_importances(model, names: Sequence[str], top: int | None = None) -> DataFrame:
    """Importances of a tree ensemble as rows (feature, importance), largest first."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()  # one value per feature: bounded by the schema
    df = spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def permuted_metrics(score: Callable[[DataFrame], DataFrame], df: DataFrame, features: Sequence[str], key: Sequence[str], label: str,
                     seed: int = 7) -> DataFrame:
    """Metrics of a model with each feature permuted in turn, and unpermuted (feature null): one row each.

    The row at position i in key order takes a feature's value from the row at position i in the order of
    md5(key, seed). Both positions are made once for all features and joined; a row then stands for itself once per
    feature, and one scoring pass with one grouped aggregate serves all of them.
    """
    key, features = list(key), list(features)
    text = F.concat_ws("-", *[F.col(k).cast("string") for k in key])
    slim = df.select(*dict.fromkeys([*key, *features, label])).withColumn("_h", F.md5(F.concat(text, F.lit(str(seed)))))
    own = global_positions(slim.drop("_h"), key, pos_col="_i")
    other = global_positions(slim.select(*key, "_h", *[F.col(c).alias(f"_p_{c}") for c in features]), ["_h", *key], pos_col="_i").drop("_h", *key)
    pairs = own.join(other, "_i")
    variants = [F.struct(F.lit(name).cast("string").alias("_feature"), *[(F.col(f"_p_{c}") if c == name else F.col(c)).alias(c) for c in features])
                for name in (None, *features)]
    rest = [c for c in dict.fromkeys([*key, label]) if c not in features]
    each = pairs.select(*rest, F.explode(F.array(*variants)).alias("_v")).select(*rest, "_v.*")
    return regression_metrics(score(each), label, by=["_feature"]).withColumnRenamed("_feature", "feature")


def permutation_importances(score: Callable[[DataFrame], DataFrame], df: DataFrame, features: Sequence[str], key: Sequence[str], label: str,
                            seed: int = 7) -> DataFrame:
    """Increase in RMSE when one feature's values are permuted, rows (feature, rmse_increase)."""
    found = permuted_metrics(score, df, features, key, label, seed)
    base = found.where("feature IS NULL").select(F.col("rmse").alias("_base"))
    return found.where("feature IS NOT NULL").crossJoin(F.broadcast(base)).select("feature", (F.col("rmse") - F.col("_base")).alias("rmse_increase"))


def permutation_importance(model, df: DataFrame, feature_cols: Sequence[str], key: str, label: str,
                           assemble_fn, seed: int = 7) -> DataFrame:
    """M22 of a fitted Spark ML model whose features ``assemble_fn`` puts together."""
    return permutation_importances(lambda rows: model.transform(assemble_fn(rows)), df, feature_cols, [key], label, seed)
