"""Single-operator queries over the driver tables, one per inventory item not covered by a
larger analysis (lookups, predicates, previews, labels, keys, encodings, simple fits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import case_value, millions, sentinels_to_null, to_number, to_timestamp
from ..operators import aggregates as A
from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators.keymap import key_map
from ..operators.ordering import surrogate_keys
from ..operators.quality import non_constant_columns
from ..sources.rows import resolve_natural_keys
from ..sources.tables import Tables, read_sql
from . import energy as EN
from .domain import Domain


def drug_code_lookup(t: Tables) -> DataFrame:
    """Drug links arrive with the drug *code*; one join resolves the surrogate id.

    Codes that resolve to nothing are reported (the per-row subquery would have given null).
    Links use code 'D<part>'; lines numbered 7 carry a code that no drug has.
    """
    dom = Domain(t.spark, t.sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    links = li.select("l_orderkey", F.when(F.col("l_linenumber") == 7, F.concat(F.lit("X"), F.col("l_partkey").cast("string")))
                      .otherwise(F.concat(F.lit("D"), F.col("l_partkey").cast("string"))).alias("drug_code"))
    drugs = dom.drugs().select("drug_code", "drug_id", "drug_class")
    resolved, unresolved = resolve_natural_keys(links, drugs, "drug_code", "drug_id", carry=("drug_class",))
    per_class = resolved.groupBy("drug_class").agg(F.count(F.lit(1)).alias("links"))
    missing = unresolved.agg(F.count(F.lit(1)).alias("links")).select(F.lit("<unresolved>").alias("drug_class"), "links")
    return per_class.unionByName(missing)


def predicate_counts(t: Tables) -> DataFrame:
    """IN, BETWEEN, LIKE (with '_' wildcard), IS NULL / COALESCE, !=, modulo bucket -- one pass."""
    o = t.orders
    return o.agg(
        F.count_if(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("in_list"),
        F.count_if(F.col("o_totalprice").between(100000, 200000)).alias("between"),
        F.count_if(F.col("o_orderpriority").like("_-%")).alias("like_wildcard"),
        F.count_if(F.coalesce(F.col("o_orderstatus"), F.lit("?")) != "F").alias("not_equal"),
        F.count_if(F.col("o_orderkey") % 10 == 1).alias("modulo_bucket"),
        F.count_if(F.col("o_custkey").isNull()).alias("is_null"),
    )


def status_labels(t: Tables) -> DataFrame:
    """Simple CASE ``status WHEN 'F' THEN .. `` per order status, counted."""
    label = case_value("o_orderstatus", {"F": "finished", "O": "open", "P": "pending"}, "other")
    return t.orders.groupBy(label.alias("status_label")).agg(F.count(F.lit(1)).alias("orders"))


def constant_columns(t: Tables) -> DataFrame:
    """Distinct counts of the numeric meter columns; constant ones are dropped."""
    ft = EN.feature_table(t)
    return non_constant_columns(ft, ["usage_kwh", "gross_floor_area", "occupancy", "n_uses", "total_use_area",
                                     "year", "month", "days_in_period"])


def meter_types(t: Tables) -> DataFrame:
    """The distinct meter types and units."""
    return EN.meter_entries(t).select("meter_type", "usage_units").distinct()


def usage_density(t: Tables) -> DataFrame:
    """2-D grid behind the usage vs floor-area scatter."""
    ft = EN.feature_table(t)
    return A.density_grid(ft, "gross_floor_area", "log_usage_kwh", 1000.0, 0.5)


def monthly_usage(t: Tables) -> DataFrame:
    """Total usage per month and mean usage per calendar month (both in one frame)."""
    e = EN.electric_entries(t)
    per_month = e.groupBy(F.trunc(F.col("start_date").cast("date"), "MM").alias("month")).agg(
        F.sum(F.col("usage_kwh").cast("decimal(18,2)")).cast("double").alias("total_usage"))
    per_cal = e.groupBy(F.month("start_date").alias("calendar_month")).agg(
        (F.sum(F.col("usage_kwh").cast("decimal(18,2)")).cast("double") / F.count("usage_kwh")).alias("mean_usage"))
    return per_month.join(per_cal, F.month("month") == F.col("calendar_month"), "left") \
        .select("month", "total_usage", "calendar_month", "mean_usage")


def field_previews(t: Tables, rows: int = 3, width: int = 80) -> DataFrame:
    """U2 + F4: evidence rows for the semi-structured fields -- the first ``rows`` JSON risk-factor
    documents and XML monographs (by key), each cut to ``width`` characters for display."""
    dom = Domain(t.spark, t.sf_dir)

    def sample(df, field, kind, key, text):
        return df.orderBy(key).limit(rows).select(
            F.lit(field).alias("field"), F.lit(kind).alias("type"), F.col(key).cast("bigint").alias("sample_id"),
            F.substring(F.col(text).cast("string"), 1, width).alias("sample_data"))
    return sample(dom.patients(), "patients.risk_factors", "JSON", "patient_id", "risk_factors") \
        .unionByName(sample(dom.drugs(), "drugs.monograph_xml", "XML", "drug_id", "monograph_xml"))


def provider_labels(t: Tables) -> DataFrame:
    """Display name ``Dr. <letter>. <name>`` and licence ``LIC-000042`` per provider."""
    s = t.supplier
    return s.select(
        F.col("s_suppkey").alias("provider_id"),
        F.concat(F.lit("Dr. "), F.expr("char(65 + CAST(s_suppkey % 26 AS INT))"), F.lit(". "), F.col("s_name"))
        .alias("provider_name"),
        F.concat(F.lit("LIC-"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("license_number"),
    )


def drug_surrogate_keys(t: Tables) -> DataFrame:
    """Consecutive surrogate ids for drug codes in code order, without a global window."""
    codes = t.part.select(F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("drug_code"))
    return surrogate_keys(codes, ["drug_code"], "drug_id")


def segment_one_hot(t: Tables) -> DataFrame:
    """M4: customer segment as 0/1 columns, first category (alphabetically) dropped."""
    c = t.customer.select("c_custkey", "c_mktsegment")
    return FE.one_hot(c, "c_mktsegment", prefix="segment")


def one_feature_fit(t: Tables) -> DataFrame:
    """M9 (one feature): least-squares line of log usage on floor area over the training split."""
    ft = EN.feature_table(t).withColumn("split", FE.hash_split("entry_id", 80, 42)).where(F.col("split") == "train")
    return ft.agg(F.round(F.regr_slope("log_usage_kwh", "gross_floor_area"), 9).alias("slope"),
                  F.round(F.regr_intercept("log_usage_kwh", "gross_floor_area"), 6).alias("intercept"),
                  F.count(F.lit(1)).alias("n"))


def variance_selection(t: Tables, min_variance: float = 0.0) -> DataFrame:
    """Sample variance per numeric feature and whether it passes the threshold (one pass)."""
    ft = EN.feature_table(t)
    cols = EN.NUMERIC
    row = ft.agg(*[F.var_samp(c).alias(c) for c in cols])
    out = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in cols]))
                     .alias("kv")).select("kv.*")
    # seven significant digits: the last digits of a large variance depend on the summation algorithm
    return out.select("feature", F.format_string("%.6e", "variance").alias("variance"),
                      (F.col("variance") > min_variance).alias("keep"))


def price_rule(t: Tables) -> DataFrame:
    """A fixed predictor over all orders: an expensive order is taken for a finished one.

    Its predictions can be written in SQL, so the evaluation operators can be held against it.
    """
    o = t.orders.where(F.col("o_orderstatus").isNotNull() & F.col("o_totalprice").isNotNull())
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
                    (F.col("o_totalprice") > 150000).cast("int").alias("prediction"), F.col("o_totalprice").alias("score"))


def rule_report(t: Tables) -> DataFrame:
    """M16 on the price rule."""
    rep = EV.classification_report(price_rule(t))
    return rep.select("cls", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


def rule_confusion_auc(t: Tables) -> DataFrame:
    """M17 on the price rule: confusion cells and the exact ROC-AUC of the price as a score."""
    rule = price_rule(t)
    return EV.confusion_matrix(rule).crossJoin(F.broadcast(EV.roc_auc(rule).select(F.round("auc", 9).alias("auc"))))


def baseline_residuals(t: Tables, bins: int = 50) -> DataFrame:
    """Histogram of the residuals of order prices against the mean price of their priority."""
    o = t.orders.where(F.col("o_totalprice").isNotNull() & F.col("o_orderpriority").isNotNull())
    means = o.groupBy("o_orderpriority").agg(
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)), 2).alias("prediction"))
    pred = o.join(means, "o_orderpriority").withColumnRenamed("o_totalprice", "label")
    res = EV.residuals(pred).select(F.round("residual", 2).alias("residual"))
    return A.histogram(res, "residual", bins).select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"),
                                                     "count")


def train_test_metrics(t: Tables) -> DataFrame:
    """Metrics of the training mean on the training rows and on the test rows."""
    ft = EN.feature_table(t).withColumn("split", FE.hash_split("entry_id", 80, 42))
    scored = EV.mean_baseline(ft.where(F.col("split") == "train"), ft, "log_usage_kwh")
    m = EV.regression_metrics(scored, "log_usage_kwh", by=["split"])
    return m.select("split", "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"),
                    F.round("r2", 6).alias("r2"))


def coerced_fields(t: Tables) -> DataFrame:
    """Order fields arrive as text with sentinels, blanks and broken dates, and are coerced."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    raw = t.orders.select(
        "o_orderkey",
        F.when(key % 11 == 0, "Not Available").when(key % 13 == 0, " ").when(key % 17 == 0, "12x").otherwise(price).alias("price"),
        F.when(key % 7 == 0, "Not Available").when(key % 5 == 0, "no date").otherwise(day).alias("placed"))
    clean = sentinels_to_null(raw)
    return clean.select("o_orderkey", to_number("price").alias("price"), F.round(millions(to_number("price")), 6).alias("price_millions"),
                        to_timestamp("placed").cast("timestamp_ntz").alias("placed"), F.col("price").isNull().alias("price_sentinel"))


def line_key_duplicates(t: Tables) -> DataFrame:
    """U5 on (order, line number), which the data repeats."""
    return A.duplicate_counts(t.lineitem.select("l_orderkey", "l_linenumber"))


def distinct_line_keys(t: Tables) -> DataFrame:
    """U4: the distinct (order, line number) pairs."""
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates()


def usage_log_by_month(t: Tables) -> DataFrame:
    """Mean of the log usage per calendar month."""
    e = EN.electric_entries(t)
    return e.groupBy(F.month("start_date").alias("calendar_month")).agg(
        F.round(F.avg(F.log1p("usage_kwh")), 6).alias("mean_log_usage"), F.count(F.lit(1)).alias("entries"))


def intensity(t: Tables) -> DataFrame:
    """Energy intensity: usage per square foot of every entry of the feature table."""
    ft = EN.feature_table(t)
    return ft.select("entry_id", "occupancy", F.try_divide("usage_kwh", "gross_floor_area").alias("kwh_per_sqft"))


def intensity_describe(t: Tables) -> DataFrame:
    """A19 of the intensity."""
    return A.describe(intensity(t), ["kwh_per_sqft"])


def occupancy_grid(t: Tables) -> DataFrame:
    """Grid of occupancy against intensity."""
    return A.density_grid(intensity(t), "occupancy", "kwh_per_sqft", 5.0, 10.0)


def read_through_sql(t: Tables) -> DataFrame:
    """A parameterised query over the registered tables, read as a frame."""
    return read_sql(t.spark, t.sf_dir, """SELECT c.c_mktsegment, COUNT(*) AS orders, MAX(o.o_totalprice) AS largest
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > :least GROUP BY c.c_mktsegment""",
                    {"least": 100000.0})


def incremental_key_map(t: Tables) -> DataFrame:
    """S5 + D12: drug codes get ids over three loads: small parts, the codes on lines, and the same again.

    Lines numbered 7 carry codes that no part has; the third load brings nothing new.
    """
    part, key = t.part, F.col("l_partkey").cast("string")
    small = part.where(F.col("p_size") <= 25).select(F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("drug_code"))
    lines = t.lineitem.select(F.concat(F.when(F.col("l_linenumber") == 7, "X").otherwise("D"), key).alias("drug_code"))
    return key_map([small, lines, lines], "drug_code", "drug_id")
