"""Profiling analyses: dataset profile and cohort insights (Q13), country indicators (Q15, Q16).

pandas rules are kept where the analysis came from pandas: null group keys are dropped,
means skip nulls, ``idxmax`` takes the first row on ties (here: smallest id), a failed
comparison with a missing value falls to the last branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import corr_safe, decade_label, millions, round_ratio, three_way_category
from ..operators import aggregates as A
from ..operators.features import exact_sample, stratified_label
from ..operators.ordering import row_of_extreme
from ..operators.selection import quantiles_of
from .analyses import patient_risk_profile
from .domain import Domain, indicators


def exact_mean(c: str, scale: int) -> Column:
    """Mean of a column whose values have at most ``scale`` decimals, summed exactly."""
    return F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast("double") / F.count(c)


def rounded_mean(c: str, scale: int, digits: int = 2) -> Column:
    """``round(mean, digits)`` half away from zero, exact (integer arithmetic on the scaled sum)."""
    units = F.sum((F.col(c).cast(f"decimal(18,{scale})") * (10 ** scale)).cast("bigint"))
    return round_ratio(units, F.count(c) * (10 ** scale), digits)


# ---------------------------------------------------------------- Q13 profile of the classification dataset

NUMERIC_FEATURES = ("total_encounters", "avg_los", "unique_drugs", "unique_diagnoses",
                    "total_emergency_visits", "total_inpatient_visits", "readmission_30d_binary")
from .labels import RISK_CATEGORIES  # noqa: E402


def _classification(dom: Domain, pin: bool = False) -> DataFrame:
    """The Q11 dataset. ``pin=True`` for profiles that read it twice (bounds then counts, cuts then
    tails, positions then rows, or a checkpoint of their own): one reliable checkpoint instead of
    running Q11 twice."""
    from ..session import cut_lineage
    df = patient_risk_profile(dom)
    return cut_lineage(df) if pin else df


def q13_describe(dom: Domain) -> DataFrame:
    # describe pins its (column, value) counts; writing that checkpoint re-runs its input's last stage,
    # so the expensive Q11 input is pinned first
    return A.describe(_classification(dom, pin=True), NUMERIC_FEATURES)


def q13_value_counts(dom: Domain) -> DataFrame:
    return A.value_counts_long(_classification(dom), ["readmission_30d_binary", "risk_category", "race", "gender", "age"])


def q13_cohorts(dom: Domain) -> DataFrame:
    """Readmitted (<30 days) vs not, mean of the utilisation measures and the difference."""
    out = A.cohort_compare(_classification(dom), F.col("readmission_30d_binary") == 1,
                           ["avg_los", "unique_drugs", "unique_diagnoses", "total_emergency_visits",
                            "total_inpatient_visits"], labels=("readmitted", "not_readmitted"))
    return out.select("measure", *[F.round(c, 6).alias(c) for c in ("mean_readmitted", "mean_not_readmitted",
                                                                       "difference")])


def q13_risk_breakdown(dom: Domain) -> DataFrame:
    return A.breakdown(_classification(dom), "risk_category", RISK_CATEGORIES, digits=1)


def q13_correlations(dom: Domain) -> DataFrame:
    return A.corr_matrix(_classification(dom), NUMERIC_FEATURES)


def q13_los_histogram(dom: Domain) -> DataFrame:
    h = A.histogram(_classification(dom, pin=True), "avg_los", 20)
    return h.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "count")


def q13_los_box(dom: Domain) -> DataFrame:
    b = A.box_stats(_classification(dom, pin=True), "avg_los", ["readmission_30d_binary"])
    return b.select("readmission_30d_binary", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "n",
                    "whisker_low", "whisker_high", "outliers")


def q13_readmission_share(dom: Domain) -> DataFrame:
    vc = A.value_counts(_classification(dom), "readmission_30d_binary")
    return A.share_of_total(vc, "count", "share").withColumn("share", F.round("share", 6))


# ---------------------------------------------------------------- Q15 country indicators

INDICATOR_COLUMNS = ("Year", "LifeExpectancy", "GDPperCapita", "GDPGrowth", "HealthExpenditure", "LiteracyRate",
                     "Population")


def q15_overview(dom: Domain) -> DataFrame:
    """Task 1: rows, columns, year range, number of countries (one row)."""
    df = indicators(dom)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("Year").alias("year_min"), F.max("Year").alias("year_max"),
                  F.count_distinct("Country").alias("countries")).withColumn("columns", F.lit(len(df.columns)))


def q15_filters(dom: Domain, since: int = 2000) -> DataFrame:
    """Task 2: rows since a year; rows with life > 75 and GDP > 30,000 -- one pass."""
    df = indicators(dom)
    return df.agg(F.count_if(F.col("Year") >= since).alias("rows_since"),
                  F.count_if((F.col("LifeExpectancy") > 75) & (F.col("GDPperCapita") > 30000)).alias("rows_high_life_gdp"))


def q15_country_means(dom: Domain) -> DataFrame:
    """Task 3: mean life expectancy and GDP per country, rounded to 2, sorted by life expectancy."""
    df = indicators(dom).where(F.col("Country").isNotNull())
    return df.groupBy("Country").agg(rounded_mean("LifeExpectancy", 2).alias("LifeExpectancy"),
                                     rounded_mean("GDPperCapita", 3).alias("GDPperCapita")) \
        .orderBy(F.desc("LifeExpectancy"), "Country")


def q15_top5_gdp(dom: Domain) -> DataFrame:
    """Task 3: the five countries with the highest mean GDP (ties by name)."""
    return q15_country_means(dom).orderBy(F.desc("GDPperCapita"), "Country").limit(5)


def q15_top5_life(dom: Domain) -> DataFrame:
    """Task 3: the five countries with the highest mean life expectancy (ties by name)."""
    return q15_country_means(dom).orderBy(F.desc("LifeExpectancy"), "Country").limit(5)


def q15_first_countries(dom: Domain, rows: int = 10) -> DataFrame:
    """Task 2: the first observations, in the order of their key, with life > 75 and GDP > 30,000."""
    df = indicators(dom).where((F.col("LifeExpectancy") > 75) & (F.col("GDPperCapita") > 30000))
    return df.select("obs_id", "Country").orderBy("obs_id").limit(rows)


def q15_population_millions(dom: Domain) -> DataFrame:
    """Task 6: population in millions of every observation."""
    return indicators(dom).select("obs_id", "Country", F.round(millions("Population"), 6).alias("PopulationMillions"))


def q15_growth_by_decade(dom: Domain) -> DataFrame:
    df = indicators(dom)
    return df.groupBy(decade_label("Year").alias("Decade")).agg(exact_mean("GDPGrowth", 6).alias("GDPGrowth"))


def q15_extremes(dom: Domain) -> DataFrame:
    """Task 4: row of the highest life expectancy and of the lowest GDP (first by id on ties)."""
    df = indicators(dom)
    hi = row_of_extreme(df, "LifeExpectancy", "obs_id", largest=True).withColumn("extreme", F.lit("max_LifeExpectancy"))
    lo = row_of_extreme(df, "GDPperCapita", "obs_id", largest=False).withColumn("extreme", F.lit("min_GDPperCapita"))
    return hi.unionByName(lo)


def q15_top10_life(dom: Domain) -> DataFrame:
    return indicators(dom).where(F.col("LifeExpectancy").isNotNull()) \
        .orderBy(F.desc("LifeExpectancy"), "obs_id").limit(10)


def q15_counts(dom: Domain) -> DataFrame:
    """Task 5: observations per year and per decade, countries per decade, in long form."""
    df = indicators(dom).withColumn("Decade", decade_label("Year"))
    per_year = df.where(F.col("Year").isNotNull()).groupBy(F.col("Year").cast("string").alias("key")) \
        .agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit("observations_per_year"))
    per_decade = df.groupBy(F.col("Decade").alias("key")).agg(F.count(F.lit(1)).alias("value")) \
        .withColumn("measure", F.lit("observations_per_decade"))
    countries = df.groupBy(F.col("Decade").alias("key")).agg(F.count_distinct("Country").alias("value")) \
        .withColumn("measure", F.lit("countries_per_decade"))
    return per_year.unionByName(per_decade).unionByName(countries)


def q15_gdp_categories(dom: Domain) -> DataFrame:
    """Task 6: GDP below the median Low, up to p75 Medium, else (also missing) High; counts."""
    from ..session import cut_lineage
    df = cut_lineage(indicators(dom).select("GDPperCapita"))  # read by the quantiles and by the labelling
    found = quantiles_of(df, ["GDPperCapita"], {"median": 0.5, "p75": 0.75})["GDPperCapita"]
    median, p75 = (F.lit(found[k]).cast("double") for k in ("median", "p75"))
    counts = df.groupBy(three_way_category("GDPperCapita", median, p75).alias("GDPCategory")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select("GDPCategory", "count", F.round(median, 6).alias("gdp_median"), F.round(p75, 6).alias("gdp_p75"))


def q15_missing(dom: Domain) -> DataFrame:
    """Task 7: missing percent per numeric column (worst flagged) and complete-row counts."""
    df = indicators(dom)
    miss = A.missing_percent(df, INDICATOR_COLUMNS)
    rows = A.complete_rows(df)
    return miss.crossJoin(F.broadcast(rows))


def q15_subsets(dom: Domain) -> DataFrame:
    """Task 8: two conditional subsets, their sizes and mean literacy."""
    df = indicators(dom)
    a = F.col("LifeExpectancy") > 80
    b = (F.col("HealthExpenditure") > 8) & (F.col("GDPGrowth") > 3)
    return df.agg(
        F.count_if(a).alias("rows_life_over_80"),
        F.count_if(b).alias("rows_health_and_growth"),
        F.round(F.avg(F.when(a, F.col("LiteracyRate"))), 6).alias("literacy_life_over_80"),
        F.round(F.avg(F.when(b, F.col("LiteracyRate"))), 6).alias("literacy_health_and_growth"),
    )


def q15_life_stats(dom: Domain) -> DataFrame:
    """Task 9: min, max, mean, range, quartiles of life expectancy; GDP-life correlation.

    The correlation uses rows where both values exist (the reference dropped missing GDP
    only, which makes the result NaN whenever a life value is missing on a kept row).
    """
    from ..session import cut_lineage
    df = cut_lineage(indicators(dom).select("LifeExpectancy", "GDPperCapita"))  # moments + quantiles
    base = df.agg(F.min("LifeExpectancy").alias("min"), F.max("LifeExpectancy").alias("max"),
                  exact_mean("LifeExpectancy", 2).alias("mean"),
                  (F.max("LifeExpectancy") - F.min("LifeExpectancy")).alias("range"),
                  F.round(corr_safe("GDPperCapita", "LifeExpectancy"), 6).alias("corr_gdp_life"))
    qs = quantiles_of(df, ["LifeExpectancy"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})["LifeExpectancy"]
    return base.select("min", "max", F.round("mean", 6).alias("mean"), F.round("range", 6).alias("range"),
                       *[F.round(F.lit(qs[c]).cast("double"), 6).alias(c) for c in ("p25", "p50", "p75")], "corr_gdp_life")


def country_year_panel(dom: Domain) -> DataFrame:
    """One row per (country, year): mean life expectancy -- the grain the period comparison needs."""
    df = indicators(dom).where(F.col("Country").isNotNull() & F.col("Year").isNotNull())
    return df.groupBy("Country", "Year").agg(exact_mean("LifeExpectancy", 2).alias("LifeExpectancy"))


def q16_life_change(dom: Domain, first: int = 1995, second: int = 2001, top: int = 3) -> DataFrame:
    """Q16: countries present in both years, change in life expectancy, top ``top`` improvements."""
    from ..operators.joins import period_compare
    panel = country_year_panel(dom)
    both = period_compare(panel, "Country", "Year", "LifeExpectancy", first, second,
                          suffixes=(f"_{first}", f"_{second}"))
    change = both.withColumn("LifeExp_Change", F.col(f"LifeExpectancy_{second}") - F.col(f"LifeExpectancy_{first}"))
    return change.select("Country", *[F.round(c, 6).alias(c) for c in change.columns if c != "Country"]) \
        .orderBy(F.desc("LifeExp_Change"), "Country").limit(top)


# ---------------------------------------------------------------- T5, T6, M7 sampling and splits

def q15_sample(dom: Domain) -> DataFrame:
    """WDI sampling step: 15 % of the observations, seed 29."""
    return exact_sample(indicators(dom), "obs_id", fraction=0.15, seed=29).select("obs_id", "Country", "Year")


def capped_sample(dom: Domain) -> DataFrame:
    """At most 2,000 observations for a plot, seed 42."""
    return exact_sample(indicators(dom), "obs_id", cap=2000, seed=42).select("obs_id", "Country", "Year")


def stratified_split(dom: Domain, train_fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """M7: 70/30 split of the classification dataset keeping class shares (per-class exact counts)."""
    df = _classification(dom, pin=True).select("patient_id", "readmission_30d_binary")
    return stratified_label(df, "patient_id", "readmission_30d_binary", train_fraction, seed)
