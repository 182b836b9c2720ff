"""Cross-validated grid search that survives the loss of its driver.

``fold_column`` gives every row its fold exactly: the rows in hash order are cut into ``k`` runs whose sizes differ by
one at most, whatever the partitioning. Rows are counted by hash bucket; only the rows of the at most ``k - 1`` buckets in which a run
ends are put in order.

``grid_search`` fits one model for each (setting, fold) on the other folds and scores it on the fold, several at a time. Each
score is written to a folder of its own in the shared store as soon as it is known, below a name made from the training rows,
the settings and the folds. A search that starts again -- in another session, after a lost driver -- reads what
is there and fits only what is missing. Fitting is Spark ML's; the driver's threads only submit its jobs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, sized
from .evaluation import regression_metrics
from .features import _SAMPLE_DIGITS, hash_order
from .ordering import global_positions

SCORES = "setting int, fold int, n long, mae double, rmse double, r2 double"


def fold_column(df: DataFrame, key: str, folds: int = 3, seed: int = 42, name: str = "fold") -> DataFrame:
    """``df`` with the fold (0 .. folds - 1) of every row; equals cutting the rows, ordered by hash and key, at round(i * n / folds)."""
    h = F.coalesce(hash_order(key, seed), F.lit(""))
    bucket = F.coalesce(F.conv(F.substring(h, 1, _SAMPLE_DIGITS), 16, 10).cast("int"), F.lit(0))
    hashed = df.withColumn("_h", h).withColumn("_b", bucket)
    # at most 65,536 rows: one per bucket
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_c").over(Window.partitionBy())
    counts = counts.select("_b", (upto - F.col("_c")).alias("_before"), upto.alias("_upto"), total.alias("_n"))
    cuts = [F.floor((F.col("_n") * (2 * i) + folds) / (2 * folds)) for i in range(1, folds)]

    def passed(position: Column) -> Column:
        return sum((F.when(position >= c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")

    edge = F.lit(False)
    for c in cuts:
        edge = edge | ((F.col("_before") < c) & (c < F.col("_upto")))
    joined = hashed.join(F.broadcast(counts.withColumn("_edge", edge)), "_b")
    sure = joined.where(~F.col("_edge")).withColumn(name, passed(F.col("_before")))
    placed = global_positions(joined.where("_edge"), ["_h", key], ["_b"], pos_col="_pos")
    last = placed.withColumn(name, passed(F.col("_before") + F.col("_pos") - 1))
    return sure.unionByName(last.drop("_pos")).select(*df.columns, name)


@dataclass
class GridResult:
    settings: list[dict]
    scores: DataFrame  # one row per (setting, fold)
    best: int  # number of the best setting
    fitted_now: int  # fits this run made; the others were read

    @property
    def best_setting(self) -> dict:
        return self.settings[self.best]


def grid(**values: Sequence) -> list[dict]:
    """All combinations, the last name varying fastest."""
    out: list[dict] = [{}]
    for name, options in values.items():
        out = [{**s, name: v} for s in out for v in options]
    return out


def _name_of(train: DataFrame, model: str, settings: Sequence[Mapping], folds: int, seed: int) -> str:
    """A name that changes with the rows (in any order), the model, the settings and the folds."""
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(c).cast("string") for c in train.columns]).cast("decimal(38,0)")).alias("h")).first()
    return hashlib.sha256(json.dumps([row.n, str(row.h), model, list(map(dict, settings)), folds, seed], sort_keys=True).encode()).hexdigest()[:24]


def grid_search(train: DataFrame, estimator: Callable[..., object], settings: Sequence[Mapping], key: str, folds: int = 3, seed: int = 42,
                metric: str = "mae", store: str | None = None, model: str = "", parallelism: int = 6,
                joint: Callable[[Sequence[Mapping]], object] | None = None) -> GridResult:
    """Scores of every setting on every fold; the best has the lowest mean ``metric`` (of r2 the highest), ties to the first.

    ``train`` has ``features`` and ``label`` (pinned by the caller, or cheap); ``estimator(**setting)`` makes a Spark ML
    estimator, ``model`` names its kind where several share a store. ``store`` is a folder that every restart sees; by default one below the shared checkpoint folder.
    ``joint(settings)``, where given, makes one estimator of several settings whose model's ``predictions`` are a list, one for each, equal to those of separate fits:
    the missing settings of a fold are then fitted together.
    """
    spark, settings = train.sparkSession, [dict(s) for s in settings]
    named = train.select(F.col(key).cast("string").alias("_key"), "features", "label")
    root = f"{store or ensure_checkpoint_dir(spark) + '/grid'}/{_name_of(named, model, settings, folds, seed)}"
    def scores_found() -> DataFrame:
        try:
            return spark.read.schema(SCORES).parquet(f"{root}/*")
        except AnalysisException:  # nothing stored yet
            return spark.createDataFrame([], SCORES)

    known = {(r.setting, r.fold) for r in scores_found().select("setting", "fold").collect()}
    wanted = [(s, f) for s in range(len(settings)) for f in range(folds) if (s, f) not in known]
    if wanted:
        parts = sized(cut_lineage(fold_column(named, "_key", folds, seed)), "_key")

        def put(s: int, f: int, scored: DataFrame) -> None:
            row = regression_metrics(scored).select(F.lit(s).alias("setting"), F.lit(f).alias("fold"), F.col("n").cast("long").alias("n"), "mae", "rmse", "r2")
            row.coalesce(1).write.mode("overwrite").parquet(f"{root}/{s}-{f}")

        def score(at: tuple[int, int]) -> None:
            s, f = at
            fitted = estimator(**settings[s]).fit(parts.where(F.col("fold") != f))
            put(s, f, fitted.transform(parts.where(F.col("fold") == f)))

        def score_fold(f: int) -> None:
            several = [s for s, g in wanted if g == f]
            fitted = joint([settings[s] for s in several]).fit(parts.where(F.col("fold") != f))
            scored = cut_lineage(fitted.predictions(parts.where(F.col("fold") == f)).select("label", "predictions"))
            for i, s in enumerate(several):
                put(s, f, scored.select("label", F.col("predictions")[i].alias("prediction")))

        pool = ThreadPoolExecutor(parallelism)
        try:
            list(pool.map(score_fold, sorted({f for _, f in wanted})) if joint else pool.map(score, wanted))
        finally:
            pool.shutdown(cancel_futures=True)
    scores = scores_found()
    means = scores.groupBy("setting").agg(F.avg(metric).alias("m")).where(F.col("m").isNotNull())
    first = means.orderBy(F.desc("m") if metric == "r2" else F.asc("m"), "setting").first()
    if first is None:
        raise ValueError("no fold could be scored: the training rows have no label")
    return GridResult(settings, scores, first["setting"], len(wanted))


def refit(train: DataFrame, test: DataFrame, estimator: Callable[..., object], setting: Mapping) -> tuple[object, DataFrame]:
    """The model of a setting on all training rows, and its metrics on the training and on the test rows."""
    model = estimator(**setting).fit(train)
    splits = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    scored = cut_lineage(model.transform(splits).select("split", "label", "prediction"))
    both = [regression_metrics(scored.where(F.col("split") == name)).withColumn("split", F.lit(name)) for name in ("train", "test")]
    return model, both[0].unionByName(both[1])
