"""Q14: meter readings -> cleaned feature table -> regression models.

Domain on the driver tables: a meter entry is a line item (its property is the ordering
customer, the reading period runs from order date to ship date, usage is the extended
price), a property is a customer (floor area = account balance, of which some are <= 0),
a property's uses are its orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import season, whole_days_between
from ..operators import correlation as CO
from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import models as MD
from ..operators import tuning as TU
from ..operators.aggregates import box_stats, describe, duplicate_counts, named_agg
from ..operators.forest import Forest
from ..operators.joins import left_merge
from ..operators.quality import rename_required
from ..session import cut_lineage, sized
from ..sources.tables import Tables

NUMERIC = ["gross_floor_area", "occupancy", "n_uses", "total_use_area", "year", "month", "days_in_period"]
CATEGORICAL = ["property_type", "season"]
# Columns that carry the target: never features.
TARGET_DERIVED = ("usage_kwh", "log_usage_kwh", "kwh_per_sqft")


def meter_entries(t: Tables) -> DataFrame:
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("entry_id"),
        F.col("o_custkey").alias("pm_id"),
        F.when(F.col("l_linestatus") == "F", "Electric - Grid").otherwise("Natural Gas").alias("meter_type"),
        F.when(F.col("l_returnflag").isin("A", "N"), "kWh (thousand Watt-hours)").otherwise("therms").alias("usage_units"),
        F.when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_extendedprice")).alias("usage_quantity"),
        F.col("o_orderdate").alias("start_date"),
        F.col("l_shipdate").alias("end_date"),
    )


def properties(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("pm_id"), F.col("c_acctbal").alias("gross_floor_area"),
                    F.when(F.col("c_custkey") % 9 == 0, None).otherwise((F.col("c_custkey") % 50 + 50).cast("double"))
                    .alias("occupancy"),
                    F.col("c_mktsegment").alias("property_type"))


def uses(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("pm_id"), F.col("o_orderpriority").alias("use_type"),
                           F.col("o_totalprice").alias("use_area"))


def electric_entries(t: Tables) -> DataFrame:
    """Steps 1-4: de-duplicate, keep grid electricity in kWh, rename, keep positive usage."""
    me = meter_entries(t).dropDuplicates()
    elec = me.where((F.col("meter_type") == "Electric - Grid") & F.col("usage_units").rlike("kWh"))
    elec = rename_required(elec, {"usage_quantity": "usage_kwh"})
    return elec.where(F.col("usage_kwh") > 0)


def cleaning_counts(t: Tables) -> DataFrame:
    """U5 + P6: duplicate meter rows, and rows removed by the two positivity filters -- one row."""
    me = cut_lineage(meter_entries(t))  # read by the duplicate count and by the filters
    dups = duplicate_counts(me).select(F.col("duplicates").alias("duplicate_entries"))
    elec = me.dropDuplicates().where((F.col("meter_type") == "Electric - Grid") & F.col("usage_units").rlike("kWh"))
    e = elec.agg(F.count(F.lit(1)).alias("electric_rows"),
                 F.count_if(~F.coalesce(F.col("usage_quantity") > 0, F.lit(False))).alias("removed_non_positive_usage"))
    p = properties(t).agg(F.count_if(~F.coalesce(F.col("gross_floor_area") > 0, F.lit(False)))
                          .alias("removed_non_positive_area"))
    return dups.crossJoin(e).crossJoin(p)


def merged_table(t: Tables) -> DataFrame:
    """Steps 5-8: entries with their property and its uses, derived columns; pinned, missing values as they are."""
    elec = electric_entries(t)
    props = properties(t).where(F.col("gross_floor_area") > 0)
    data = left_merge(elec, props, ["pm_id"], suffix="_prop")
    uses_agg = named_agg(uses(t), ["pm_id"], n_uses=F.count_distinct("use_type"),
                         total_use_area=F.sum(F.col("use_area").cast("decimal(18,2)")).cast("double"))
    data = left_merge(data, uses_agg, ["pm_id"]).dropna(subset=["usage_kwh"])
    data = data.select(
        "entry_id", "usage_kwh", "gross_floor_area", "occupancy", "n_uses", "total_use_area",
        F.year("start_date").alias("year"), F.month("start_date").alias("month"),
        whole_days_between("start_date", "end_date").alias("days_in_period"),
        season(F.month("start_date")).alias("season"), "property_type",
    )
    # medians, cap and correlations each read the merged table; pin it once instead of re-joining
    return cut_lineage(data)


def feature_table(t: Tables) -> DataFrame:
    """Steps 5-12: merge, derive, impute (exact medians), cap at p99, log target."""
    data = merged_table(t)
    filled = FE.median_fill(data, NUMERIC)
    filled = FE.constant_fill(filled, {c: "Unknown" for c in CATEGORICAL})
    capped = FE.cap_at_quantile(filled, "gross_floor_area", 0.99)
    # medians and cap are known values by now: the table is a projection of the pinned one
    return capped.withColumn("log_usage_kwh", F.log1p("usage_kwh"))


def model_frame(t: Tables) -> tuple[DataFrame, list[str]]:
    """One-hot (first category dropped), split label, feature vector on an allow-list."""
    ft = feature_table(t)
    cats = {c: FE.categories(ft, c) for c in CATEGORICAL}
    enc = ft
    for c in CATEGORICAL:
        enc = FE.one_hot(enc, c, cats[c])
    feats = [c for c in enc.columns if c not in ("entry_id", *TARGET_DERIVED)]
    enc = enc.withColumn("split", FE.hash_split("entry_id", 80, 42))
    enc = FE.assemble(enc, feats, "log_usage_kwh", forbidden=TARGET_DERIVED)
    frame = enc.withColumnRenamed("log_usage_kwh", "label").select("entry_id", "features", "label", "split")
    # a forest holds each row with a count for every tree: a task's rows must not grow with the input
    return sized(frame, "entry_id"), feats


def model_metrics(t: Tables, forest_trees: int = 300, forest_depth: int | None = None) -> DataFrame:
    """Baseline, linear, lasso and forest scored on the test split."""
    frame, feats = model_frame(t)
    frame = cut_lineage(frame)
    train, test = frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")
    rows = [EV.regression_metrics(EV.mean_baseline(train, test, "label")).withColumn("model", F.lit("mean_baseline"))]
    for name, est in (("linear", MD.linear_regression()), ("lasso", MD.lasso()),
                      ("random_forest", MD.random_forest_regressor(forest_trees, forest_depth))):
        model = est.fit(train)
        scored = model.transform(frame)
        m = EV.regression_metrics(scored, by=["split"]).withColumn("model", F.lit(name))
        rows.append(m.where(F.col("split") == "test").drop("split"))
        if name == "random_forest":
            rows.append(m.where(F.col("split") == "train").drop("split").withColumn("model", F.lit("random_forest_train")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("model", "n", "mae", "rmse", "r2")


def baseline_metrics(t: Tables) -> DataFrame:
    """M8 + M14 on the hash split: SQL-checkable."""
    ft = feature_table(t).withColumn("split", FE.hash_split("entry_id", 80, 42))
    train, test = ft.where(F.col("split") == "train"), ft.where(F.col("split") == "test")
    m = EV.regression_metrics(EV.mean_baseline(train, test, "log_usage_kwh"), "log_usage_kwh")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


def forest_importances(t: Tables, trees: int = 300, depth: int | None = None, top: int = 15) -> DataFrame:
    """Top feature importances of the forest."""
    frame, feats = model_frame(t)
    train = frame.where(F.col("split") == "train")
    model = MD.random_forest_regressor(trees, depth).fit(train)
    return EV.feature_importances(model, feats, top)


def usage_describe(t: Tables) -> DataFrame:
    """A19 of the usage column."""
    return describe(merged_table(t), ["usage_kwh"], digits=4)


def usage_box_by_type(t: Tables, rows: int = 2000) -> DataFrame:
    """Box statistics of the usage by property type, on a capped sample as for the plot; entries without a property are a group."""
    few = FE.exact_sample(merged_table(t).select("entry_id", "property_type", "usage_kwh"), "entry_id", cap=rows, seed=42)
    found = box_stats(few, "usage_kwh", ["property_type"])
    return found.select("property_type", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "n", "whisker_low", "whisker_high", "outliers")


def heat_map(t: Tables) -> DataFrame:
    """Correlations of all numeric columns of the merged table that vary, the log usage included."""
    data = merged_table(t).withColumn("log_usage_kwh", F.log1p("usage_kwh")).withColumn("constant", F.lit(1.0))
    table = CO.pair_correlations(data, CO.varying_columns(data))
    return table.select("a", "b", "n", F.round("r", 6).alias("r"))


def redundancy_selection(t: Tables, limit: float = 0.2) -> DataFrame:
    """Features of the log usage, those left out that repeat a stronger one."""
    ft = feature_table(t)
    table = CO.pair_correlations(ft, [*NUMERIC, "log_usage_kwh"]).withColumn("r", F.round("r", 6))
    return CO.select_uncorrelated(table, NUMERIC, "log_usage_kwh", limit)


def fixed_line(df: DataFrame) -> DataFrame:
    """A fixed predictor of the log usage, so that what is made of its predictions can be held against SQL."""
    return df.withColumn("prediction", F.lit(9.0) + F.col("gross_floor_area") / 10000 + F.col("occupancy") / 100 - F.col("month") / 10)


def line_permutation(t: Tables) -> DataFrame:
    """M22 of the fixed predictor: what permuting each of its features, and one it does not use, costs."""
    found = EV.permutation_importances(fixed_line, feature_table(t), ["gross_floor_area", "occupancy", "month", "year"], ["entry_id"], "log_usage_kwh")
    return found.select("feature", F.round("rmse_increase", 6).alias("rmse_increase"))


def regression_permutation(t: Tables) -> DataFrame:
    """M22 of the fitted linear regression."""
    ft = feature_table(t).withColumn("split", FE.hash_split("entry_id", 80, 42))

    def assembled(df: DataFrame) -> DataFrame:
        return FE.assemble(df, NUMERIC, "log_usage_kwh", forbidden=TARGET_DERIVED)

    model = MD.linear_regression(label="log_usage_kwh").fit(assembled(ft.where(F.col("split") == "train")))
    return EV.permutation_importance(model, ft.where(F.col("split") == "test"), NUMERIC, "entry_id", "log_usage_kwh", assembled)


# The reference's grid.
GRID_TREES, GRID_DEPTHS = (100, 200, 300), (5, 10, 20, None)


def _grid_search(t: Tables, trees, depths, folds: int) -> tuple[TU.GridResult, DataFrame, DataFrame]:
    """The forest's grid search on all rows of the training split."""
    frame, _ = model_frame(t)
    frame = cut_lineage(frame)
    train, test = frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")
    result = TU.grid_search(train, MD.grown_forest, TU.grid(trees=trees, depth=depths), "entry_id", folds, model="grown forest", joint=Forest)
    return result, train, test


def forest_grid(t: Tables, trees=GRID_TREES, depths=GRID_DEPTHS, folds: int = 3) -> DataFrame:
    """The score of every (setting, fold), a missing depth meaning no limit."""
    result, train, _ = _grid_search(t, trees, depths, folds)
    table = train.sparkSession.createDataFrame([(i, s["trees"], s["depth"], i == result.best) for i, s in enumerate(result.settings)],
                                               "setting int, trees int, depth int, best boolean")
    return F.broadcast(table).join(result.scores, "setting").select("trees", "depth", "fold", "n", "mae", "best")


def best_forest(t: Tables, trees=GRID_TREES, depths=GRID_DEPTHS, folds: int = 3) -> DataFrame:
    """M12 + M15: the best setting fitted on all training rows, with its train and test metrics."""
    result, train, test = _grid_search(t, trees, depths, folds)
    _, report = TU.refit(train, test, MD.grown_forest, result.best_setting)
    best = result.best_setting
    return report.select("split", F.lit(best["trees"]).alias("trees"), F.lit(best["depth"]).cast("int").alias("depth"), "n", "mae", "rmse", "r2")
