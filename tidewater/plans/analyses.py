"""Named end-to-end analyses (Q1-Q16) over the domain views.

Each function takes a ``Domain`` (or tables) plus keyword options and returns a lazy
``DataFrame``. Child tables are aggregated per parent before they are joined, which
is both what the reference's own derived-table query does and what keeps the joins
1:1 at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import month_label, month_start, round_ratio
from ..operators import windows as W
from ..session import sized
from . import labels as LB
from .domain import Domain


# ---------------------------------------------------------------- Q12 monthly series

def monthly_series(dom: Domain) -> DataFrame:
    """Q12: encounters per month with previous month, 3-month moving average, running total.

    The monthly rollup has one row per calendar month -- its size is set by the date
    range, not by the data volume -- so the three windows over it are global by design.
    """
    e = dom.encounters()
    monthly = e.groupBy(month_start("encounter_date").alias("period_start"),
                        month_label("encounter_date").alias("period_label")).agg(
        F.count_distinct("encounter_id").alias("total_encounters"),
        F.sum("time_in_hospital").alias("_los_sum"),
        F.count("time_in_hospital").alias("_los_n"),
        F.sum("number_inpatient").alias("total_inpatient_visits"),
        F.count_distinct("patient_id").alias("unique_patients"),
    )
    order = ["period_start"]
    out = W.add_lag(monthly, "total_encounters", order, "prev_month_encounters", allow_global=True)
    out = W.add_moving(out, "total_encounters", order, "_mov_sum", 2, fn=F.sum, allow_global=True)
    out = W.add_moving(out, "total_encounters", order, "_mov_n", 2, fn=F.count, allow_global=True)
    out = W.add_running_sum(out, "total_encounters", order, "cumulative_encounters", allow_global=True)
    return out.select(
        "period_label",
        "total_encounters",
        round_ratio("_los_sum", "_los_n", 2).alias("avg_los"),
        F.col("total_inpatient_visits").cast("bigint").alias("total_inpatient_visits"),
        "unique_patients",
        "prev_month_encounters",
        round_ratio("_mov_sum", "_mov_n", 2).alias("moving_avg_3month"),
        F.col("cumulative_encounters").cast("bigint").alias("cumulative_encounters"),
    )


# ---------------------------------------------------------------- shared per-encounter child counts

def encounter_child_counts(dom: Domain) -> DataFrame:
    """Distinct drugs and diagnoses per encounter, from one pass over lineitem.

    Replaces the reference's double LEFT JOIN + COUNT(DISTINCT) (which first builds every
    drug x diagnosis pair of an encounter) by an aggregate per encounter; the result is
    identical because the view groups by encounter.
    """
    li = dom.t.lineitem
    return li.groupBy(F.col("l_orderkey").alias("encounter_id")).agg(
        F.count_distinct("l_partkey").alias("n_drugs"),
        F.count_distinct("l_linenumber").alias("n_diagnoses"),
    )


def int_avg(c: str):
    """AVG of an integer column as sum/count in double (same bits in every engine)."""
    return F.sum(c).cast("double") / F.count(c)


# ---------------------------------------------------------------- Q1-Q3 feature views

def readmission_view(dom: Domain) -> DataFrame:
    """Q1: one row per encounter with patient attributes, specialty, drug/diagnosis counts."""
    e, p = dom.encounters(), dom.patients()
    kids = encounter_child_counts(dom)
    j = (e.join(p.select("patient_id", "race", "gender", "risk_factors"), "patient_id", "inner")
         .join(dom.medical_specialties(), "medical_specialty_id", "left")
         .join(kids, "encounter_id", "left"))
    return j.select(
        "encounter_id", "patient_id", "race", "gender",
        F.col("encounter_age").alias("age_group"),
        "time_in_hospital", "number_outpatient", "number_emergency", "number_inpatient",
        F.col("specialty_name").alias("treating_specialty"),
        F.coalesce("n_drugs", F.lit(0)).alias("total_drugs_prescribed"),
        F.coalesce("n_diagnoses", F.lit(0)).alias("diagnosis_count"),
        F.get_json_object("risk_factors", "$.diabetes").alias("has_diabetes"),
        F.col("readmitted_flag").alias("is_readmitted"),
    )


def length_of_stay_view(dom: Domain) -> DataFrame:
    """Q2: regression dataset for length of stay."""
    e, p = dom.encounters(), dom.patients()
    kids = encounter_child_counts(dom)
    j = (e.join(p.select("patient_id", "race", "gender"), "patient_id", "inner")
         .join(dom.medical_specialties(), "medical_specialty_id", "left")
         .join(kids, "encounter_id", "left"))
    return j.select(
        "encounter_id", F.col("encounter_age").alias("age_group"), "gender", "race", "admission_type_name",
        "specialty_name",
        F.coalesce("n_drugs", F.lit(0)).alias("medication_count"),
        F.coalesce("n_diagnoses", F.lit(0)).alias("diagnosis_count"),
        F.col("time_in_hospital").alias("length_of_stay_days"),
    )


def patient_encounter_rollup(dom: Domain) -> DataFrame:
    """Per-patient encounter aggregates (aggregate before joining to patients)."""
    e = dom.encounters()
    kids = encounter_child_counts(dom).select("encounter_id", "n_drugs")
    # one row per encounter after the 1:1 join, and encounter_id is the declared key: a plain count
    return e.join(kids, "encounter_id", "left").groupBy("patient_id").agg(
        F.count("encounter_id").alias("total_encounters"),
        F.sum("time_in_hospital").alias("_los_sum"),
        F.count("time_in_hospital").alias("_los_n"),
        F.sum("readmitted_flag").alias("_flags"),
        F.sum("n_drugs").alias("_drug_sum"),
        F.count("n_drugs").alias("_drug_n"),
    )


def patient_risk_view(dom: Domain) -> DataFrame:
    """Q3: every patient (also those without encounters) with encounter statistics."""
    p = dom.patients()
    r = patient_encounter_rollup(dom)
    j = p.join(r, "patient_id", "left")
    return j.select(
        "patient_id", "race", "gender",
        F.coalesce("total_encounters", F.lit(0)).alias("total_encounters"),
        (F.col("_los_sum").cast("double") / F.col("_los_n")).alias("avg_length_of_stay"),
        F.coalesce("_flags", F.lit(0)).cast("bigint").alias("total_readmissions"),
        (F.col("_drug_sum").cast("double") / F.nullif(F.col("_drug_n"), F.lit(0))).alias("avg_medications_per_visit"),
        F.get_json_object("risk_factors", "$.diabetes").alias("has_diabetes"),
    )


# ---------------------------------------------------------------- Q4-Q6 procedures and 5A

def patient_risk_scores(dom: Domain, patient_id: int | None = None) -> DataFrame:
    """Q4: readmission rate in percent, rounded to 2 decimals, then banded (>= 50 High, >= 25 Medium).

    The procedure computed one patient; this computes all (or one when ``patient_id``
    is given, as a pushed-down filter).
    """
    p = dom.patients().select("patient_id")
    r = patient_encounter_rollup(dom).select("patient_id", "total_encounters", "_flags")
    if patient_id is not None:
        p, r = p.where(F.col("patient_id") == patient_id), r.where(F.col("patient_id") == patient_id)
    j = p.join(r, "patient_id", "left")
    n = F.coalesce(F.col("total_encounters"), F.lit(0))
    score = F.coalesce(round_ratio(F.col("_flags") * 100, n, 2), F.lit(0.0))
    return j.select(
        "patient_id", n.alias("total_encounters"), score.alias("risk_score"),
    ).withColumn("risk_category", F.when(F.col("risk_score") >= LB.RISK_SCORE_HIGH_AT, LB.RISK_SCORE_BANDS[0])
                 .when(F.col("risk_score") >= LB.RISK_SCORE_MEDIUM_AT, LB.RISK_SCORE_BANDS[1])
                 .otherwise(LB.RISK_SCORE_BANDS[2]))


def encounter_summary(dom: Domain, encounter_id: int | None = None) -> DataFrame:
    """Q5: encounter with its outcome category (one key, or all when no key is given)."""
    e, o = dom.encounters().drop("readmitted_category"), dom.outcomes().select("encounter_id", "readmitted_category")
    if encounter_id is not None:  # on both sides, so that both scans are cut down
        e, o = e.where(F.col("encounter_id") == encounter_id), o.where(F.col("encounter_id") == encounter_id)
    return e.join(o, "encounter_id", "left").select("encounter_id", "patient_id", "encounter_date", "time_in_hospital", "readmitted_category")


def patient_risk_level(dom: Domain) -> DataFrame:
    """Q6 (5A): encounters and readmissions per patient, HIGH when at least one."""
    p = dom.patients().select("patient_id")
    r = patient_encounter_rollup(dom).select("patient_id", "total_encounters", "_flags")
    j = p.join(r, "patient_id", "left")
    readm = F.coalesce(F.col("_flags"), F.lit(0)).cast("bigint")
    return j.select(
        "patient_id", F.coalesce("total_encounters", F.lit(0)).alias("total_encounters"),
        readm.alias("readmissions"), F.when(readm >= 1, LB.RISK_LEVELS[0]).otherwise(LB.RISK_LEVELS[1]).alias("risk_level"),
    )


# ---------------------------------------------------------------- Q7 (5B) group vs global average

def admission_types_vs_global(dom: Domain, min_count: int = 5) -> DataFrame:
    """Q7: mean length of stay per admission type against the hospital-wide mean."""
    e = dom.encounters()
    glob = e.agg(F.sum("time_in_hospital").alias("_g_sum"), F.count("time_in_hospital").alias("_g_n"))
    per = e.groupBy("admission_type_name").agg(
        F.count("encounter_id").alias("encounter_count"),
        F.sum("time_in_hospital").alias("_sum"), F.count("time_in_hospital").alias("_n"),
    )
    j = per.crossJoin(F.broadcast(glob)).where(F.col("encounter_count") > min_count)
    type_avg = F.col("_sum").cast("double") / F.col("_n")
    glob_avg = F.col("_g_sum").cast("double") / F.col("_g_n")
    return j.select(
        "admission_type_name", "encounter_count",
        round_ratio("_sum", "_n", 2).alias("type_avg_los"),
        round_ratio("_g_sum", "_g_n", 2).alias("hospital_avg_los"),
        F.when(type_avg > glob_avg, LB.COMPARISON[0]).otherwise(LB.COMPARISON[1]).alias("comparison_status"),
    ).orderBy(F.desc("type_avg_los"))


# ---------------------------------------------------------------- Q8 (5C) providers vs benchmark

def provider_stats(dom: Domain) -> DataFrame:
    """Cases and readmissions per provider name; encounters without a provider form one group.

    Counts are partially aggregated per provider id before the name lookup (one row per
    provider), so the lookup join is 1:1.
    """
    e = dom.encounters().select("encounter_id", "readmitted_flag")
    # distinct pairs first: partial aggregation collapses a hot order's lines before any shuffle
    li = dom.t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_suppkey").alias("provider_id"))
    links = li.distinct()
    # = encounters LEFT JOIN links, written as inner join (the large side on the left, where AQE can split a
    # skewed key) plus the encounters without any link (anti-join against distinct keys)
    assigned = links.join(e, "encounter_id", "inner")
    unassigned = e.join(links.select("encounter_id").distinct(), "encounter_id", "left_anti") \
        .withColumn("provider_id", F.lit(None).cast("bigint"))
    pairs = assigned.unionByName(unassigned)
    per_id = pairs.groupBy("provider_id").agg(
        F.count("encounter_id").alias("cases"),
        F.sum(F.when(F.col("readmitted_flag") == 1, 1).otherwise(0)).alias("readmits"),
    )
    named = per_id.join(dom.providers().select("provider_id", "provider_name"), "provider_id", "left")
    return named.groupBy("provider_name").agg(
        F.sum("cases").cast("bigint").alias("Total_Cases"),
        F.sum("readmits").cast("bigint").alias("Readmission_Count"),
    ).select(F.coalesce("provider_name", F.lit(LB.UNASSIGNED_PROVIDER)).alias("Provider_Name"), "Total_Cases",
             "Readmission_Count")


def provider_performance(dom: Domain, top: int = 15) -> DataFrame:
    """Q8: top providers by caseload with rate, benchmark, status and dense caseload rank.

    The top-``top`` cut is taken first (a distributed top-k); the dense rank of those rows
    equals their rank among all providers, since every larger caseload is in the cut.
    """
    bench = dom.encounters().agg(F.sum("readmitted_flag").alias("_b_sum"), F.count("readmitted_flag").alias("_b_n"))
    ps = provider_stats(dom)
    top_rows = ps.orderBy(F.desc("Total_Cases"), F.asc("Provider_Name")).limit(top)
    j = top_rows.crossJoin(F.broadcast(bench))
    rate_gt = F.col("Readmission_Count") * F.col("_b_n") > F.col("_b_sum") * F.col("Total_Cases")
    out = j.select(
        "Provider_Name", "Total_Cases", "Readmission_Count",
        round_ratio(F.col("Readmission_Count") * 100, "Total_Cases", 1).alias("Provider_Readmit_Pct"),
        round_ratio(F.col("_b_sum") * 100, "_b_n", 1).alias("Hospital_Avg_Pct"),
        F.when(rate_gt, LB.PERFORMANCE[0]).otherwise(LB.PERFORMANCE[1]).alias("Performance_Status"),
    )
    out = W.add_rank(out, [F.desc("Total_Cases")], "Caseload_Rank", "dense_rank", allow_global=True)
    return out.orderBy(F.desc("Total_Cases"), "Provider_Name")


# ---------------------------------------------------------------- Q11 patient risk profile

def patient_risk_profile(dom: Domain, corrected: bool = False, ordered: bool = False) -> DataFrame:
    """Q11: patient risk profile, faithful or fan-out-safe; ``ordered`` by early readmissions, then encounters, both falling.

    The reference joins each encounter to its drugs *and* diagnoses before SUM/AVG, so
    every encounter counts (drugs x diagnoses) times. ``corrected=False`` reproduces those
    numbers without building the pairs: each encounter carries its multiplicity
    ``max(drugs,1) * max(diagnoses,1)`` as a weight. ``corrected=True`` uses weight 1.
    COUNT(DISTINCT) columns are the same in both forms.
    """
    e = dom.encounters()
    li = dom.t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), "l_partkey", "l_linenumber")
    lines = li.join(e.select("encounter_id", "patient_id"), "encounter_id", "inner")
    # per-encounter counts need no patient: aggregate lineitem directly (the left join below drops orphans)
    per_enc = encounter_child_counts(dom).select("encounter_id", F.col("n_drugs").alias("_d"),
                                                 F.col("n_diagnoses").alias("_g"))
    per_pat_distinct = lines.groupBy("patient_id").agg(
        F.count_distinct("l_partkey").alias("unique_drugs"),
        F.count_distinct("l_linenumber").alias("unique_diagnoses"),
    )
    ew = e.join(per_enc, "encounter_id", "left")
    if corrected:
        m = F.lit(1)
    else:
        m = F.greatest(F.coalesce("_d", F.lit(0)), F.lit(1)) * F.greatest(F.coalesce("_g", F.lit(0)), F.lit(1))
    cat = F.col("readmitted_category")
    pe = ew.withColumn("_m", m.cast("bigint")).groupBy("patient_id").agg(
        F.count_distinct("encounter_id").alias("total_encounters"),
        F.sum(F.col("_m") * F.col("time_in_hospital")).alias("_los_sum"),
        F.sum("_m").alias("_los_n"),
        F.max("encounter_age").alias("latest_age"),
        F.sum(F.when(cat.isin("<30", ">30"), F.col("_m")).otherwise(0)).alias("total_readmissions"),
        F.sum(F.when(cat == "<30", F.col("_m")).otherwise(0)).alias("early_readmissions"),
        F.sum(F.col("_m") * F.col("number_emergency")).alias("total_emergency_visits"),
        F.sum(F.col("_m") * F.col("number_inpatient")).alias("total_inpatient_visits"),
    ).where(F.col("total_encounters") > 0)
    pe = pe.join(per_pat_distinct, "patient_id", "left")
    p = dom.patients()
    j = p.join(pe, "patient_id", "inner")
    early, total = F.col("early_readmissions"), F.col("total_encounters")
    out = j.select(
        "patient_id",
        F.when(F.col("race").isNull(), "Unknown").otherwise(F.col("race")).alias("race"),
        "gender",
        F.col("latest_age").alias("age"),
        F.get_json_object("risk_factors", "$.diabetes").alias("has_diabetes"),
        "total_encounters",
        round_ratio("_los_sum", "_los_n", 2).alias("avg_los"),
        F.col("total_readmissions").cast("bigint").alias("total_readmissions"),
        early.cast("bigint").alias("early_readmissions"),
        F.coalesce("unique_drugs", F.lit(0)).alias("unique_drugs"),
        F.coalesce("unique_diagnoses", F.lit(0)).alias("unique_diagnoses"),
        F.col("total_emergency_visits").cast("bigint").alias("total_emergency_visits"),
        F.col("total_inpatient_visits").cast("bigint").alias("total_inpatient_visits"),
        F.when(early > 0, 1).otherwise(0).alias("readmission_30d_binary"),
        F.when(early >= 2, LB.RISK_CATEGORIES[0]).when(early == 1, LB.RISK_CATEGORIES[1])
        .when(total >= 3, LB.RISK_CATEGORIES[2]).otherwise(LB.RISK_CATEGORIES[3]).alias("risk_category"),
    )
    return out.orderBy(F.desc("early_readmissions"), F.desc("total_encounters"), "patient_id") if ordered else out


# ---------------------------------------------------------------- Q9 JSON bands after bulk JSON updates

from pyspark.sql import types as T  # noqa: E402

from ..functions.semistructured import json_number, json_set, monograph_fields  # noqa: E402
from ..operators import changes as C  # noqa: E402
from ..operators import text_search as X  # noqa: E402

RISK_FACTORS_SCHEMA = T.StructType([
    T.StructField("diabetes", T.BooleanType()),
    T.StructField("on_diabetes_medication", T.BooleanType()),
    T.StructField("a1c_tested", T.BooleanType()),
    T.StructField("hba1c_last", T.DoubleType()),
])

# The bulk HbA1c update, last digit of the patient id -> value.
HBA1C_BY_LAST_DIGIT = {1: 9.5, 2: 7.8, 3: 6.2}


def patients_after_hba1c_update(dom: Domain):
    """``UPDATE patients SET risk_factors = JSON_SET(.., '$.hba1c_last', v) WHERE id % 10 = d``.

    All three statements as one pass; returns (snapshot, audit rows of the patient trigger).
    """
    p = dom.patients()
    digit = F.col("patient_id") % 10
    value = None
    for d, v in HBA1C_BY_LAST_DIGIT.items():
        value = F.when(digit == d, F.lit(v)) if value is None else value.when(digit == d, F.lit(v))
    tag = F.concat(F.lit("Patient:"), F.col("patient_id").cast("string"))
    return C.update_where(
        p, digit.isin(list(HBA1C_BY_LAST_DIGIT)),
        {"risk_factors": json_set("risk_factors", RISK_FACTORS_SCHEMA, "hba1c_last", value)},
        audit=C.AuditSpec("patients", "patient_id", old_value=tag, new_value=tag),
    )


def glycemic_bands(dom: Domain) -> DataFrame:
    """Q9 (5D): HbA1c from the JSON document, banded (> 8.5 poor, 7.0-8.5 borderline)."""
    snapshot, _ = patients_after_hba1c_update(dom)
    h = json_number("risk_factors", "$.hba1c_last")
    return snapshot.select(
        "patient_id", h.alias("hba1c_last"),
        F.when(h > LB.HBA1C_POOR_ABOVE, LB.GLYCEMIC_BANDS[0])
        .when(h.between(LB.HBA1C_BORDERLINE_FROM, LB.HBA1C_POOR_ABOVE), LB.GLYCEMIC_BANDS[1])
        .otherwise(LB.GLYCEMIC_BANDS[2]).alias("glycemic_band"),
    )


def patient_update_audit(dom: Domain) -> DataFrame:
    """Audit rows the patient trigger writes for the bulk JSON update."""
    _, audit = patients_after_hba1c_update(dom)
    return audit


def event_prop_bands(dom: Domain) -> DataFrame:
    """F17/F19 on the event stream: numeric JSON property banded, counted per event type."""
    ev = dom.t.events
    k = json_number("props", "$.k")
    band = F.when(k > 66, "HIGH").when(k.between(33, 66), "MEDIUM").otherwise("LOW")
    return ev.groupBy("event_type", band.alias("k_band")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
    )


# ---------------------------------------------------------------- Q10 text search, F21 XML

def text_search(dom: Domain, terms=("tion",)) -> DataFrame:
    """Q10 (5E): documents holding the terms, whole-word and case-insensitive, with relevance."""
    docs = dom.t.documents.select("doc_id", "lang", "source", "text")
    hits = X.search(docs, "text", list(terms))
    return hits.select("doc_id", "lang", "source", *[c for c in hits.columns if c.startswith("tf_")], "relevance") \
        .orderBy(F.desc("relevance"), "doc_id")


def monograph_search(dom: Domain, term: str = "high") -> DataFrame:
    """Q10 (5E) on what the reference searches: drugs whose monograph holds the word, most relevant first."""
    drugs = dom.drugs().select("drug_id", "generic_name", "drug_class", "monograph_xml")
    hits = X.search(drugs.select("drug_id", "monograph_xml"), "monograph_xml", [term]).select("drug_id", "relevance")
    return drugs.join(hits, "drug_id").select(*drugs.columns, "relevance").orderBy(F.desc("relevance"), "drug_id")


def drug_fanout(dom: Domain) -> DataFrame:
    """What joining encounters to their drugs does to the row count."""
    from ..operators.joins import fanout_report
    return fanout_report(dom.encounters().select("encounter_id"), dom.encounter_drugs(), ["encounter_id"])


def corpus_term_frequencies(dom: Domain) -> DataFrame:
    """X2 index: term count and document count of every token of the corpus."""
    return X.document_frequencies(dom.t.documents, "doc_id", "text")


#: Documents that one task parses, in some 3 seconds.
MONOGRAPH_TASK_ROWS = 1 << 14


def drug_monographs(dom: Domain) -> DataFrame:
    """the fields of every drug monograph XML document; the part table is small for its work, so its rows are spread."""
    return sized(dom.drugs(), per_task=MONOGRAPH_TASK_ROWS, all_cores=True).select("drug_id", "generic_name", *monograph_fields("monograph_xml"))


# ---------------------------------------------------------------- D1/D13 encounter and outcome updates

def encounter_los_update(dom: Domain):
    """D1 + D13: ``SET time_in_hospital = time_in_hospital + 1`` for early readmissions, with audit."""
    e = dom.encounters()
    return C.update_where(
        e, F.col("readmitted_category") == "<30",
        {"time_in_hospital": F.col("time_in_hospital") + 1},
        audit=C.AuditSpec("encounters", "encounter_id",
                          old_value=F.concat(F.lit("LOS:"), F.col("time_in_hospital").cast("string")),
                          new_value=F.concat(F.lit("LOS:"), F.col("_new_time_in_hospital").cast("string"))),
    )


def outcome_category_update(dom: Domain, fix_flag: bool = False) -> DataFrame:
    """Urgent 'NO' outcomes become '>30'. The reference left the flag as it was; ``fix_flag`` keeps it consistent."""
    o = dom.encounters().select("encounter_id", "admission_type_name", "readmitted_category", "readmitted_flag")
    pred = (F.col("readmitted_category") == "NO") & (F.col("admission_type_name") == "1-URGENT")
    sets = {"readmitted_category": F.lit(">30")}
    if fix_flag:
        sets["readmitted_flag"] = F.lit(0)
    return C.update_where(o, pred, sets).drop("admission_type_name")


# ---------------------------------------------------------------- D3-D6 deletes with reference actions

def _removed_orders(dom: Domain):
    o = dom.t.orders
    return C.deleted_keys(o, (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "o_orderkey")


def cascade_delete_summary(dom: Domain) -> DataFrame:
    """D3 + D4: delete low-priority pending orders; their lines go with them (cascade)."""
    li = dom.t.lineitem
    kept = C.cascade_delete(li, "l_orderkey", _removed_orders(dom), "o_orderkey")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines_left"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity_left"),
    )


def set_null_delete_summary(dom: Domain) -> DataFrame:
    """Delete the suppliers of one nation; lines keep existing with a null supplier."""
    s = dom.t.supplier
    gone = C.deleted_keys(s, F.col("s_nationkey") == 7, "s_suppkey")
    li = dom.t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    out = C.set_null_on_delete(li, "l_suppkey", gone, "s_suppkey")
    return out.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"),
                                           F.count_if(F.col("l_suppkey").isNull()).alias("lines_without_supplier"))


def restrict_delete_violations(dom: Domain) -> DataFrame:
    """Customers of a segment with negative balance cannot go while orders reference them."""
    c = dom.t.customer
    gone = C.deleted_keys(c, (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 0), "c_custkey")
    blocking = C.restrict_violations(dom.t.orders, "o_custkey", gone, "c_custkey")
    return blocking.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("blocking_orders"))


def orders_lines_one_to_one(dom: Domain) -> DataFrame:
    """Orders vs the orders named by lineitem -- counts and keys missing on either side."""
    lines = dom.t.lineitem.select("l_orderkey").distinct()
    return C.one_to_one_check(dom.t.orders, "o_orderkey", lines, "l_orderkey")


# ---------------------------------------------------------------- D7-D11, A31, A32 audits

from ..operators import quality as QA  # noqa: E402


def constraint_audit(dom: Domain) -> DataFrame:
    """Every declared rule of every registered table, violations counted."""
    return QA.constraint_audit(dom.t.all())


def duplicate_line_keys(dom: Domain) -> DataFrame:
    """(order, line number) pairs that occur more than once."""
    return QA.key_audit(dom.t.lineitem, ["l_orderkey", "l_linenumber"])


def table_inventory(dom: Domain) -> DataFrame:
    """Row count and size class of every driver table."""
    from ..sources.tables import TABLE_NAMES
    return QA.table_inventory({n: getattr(dom.t, n) for n in TABLE_NAMES})


def table_classes(dom: Domain) -> DataFrame:
    """Row count of every table and its class by name: a list of core tables, a pattern for junctions, the rest."""
    name = F.col("table_name")
    kind = F.when(name.isin("customer", "orders", "part", "supplier"), "Core").when(name.like("line%"), "Junction").otherwise("Lookup/System")
    return QA.table_inventory(dom.t.all()).select("table_name", "row_count", kind.alias("table_type")).orderBy(F.desc("row_count"), "table_name")


def name_columns(dom: Domain) -> DataFrame:
    """Text columns of the tables whose name is LIKE '%\\_name', with the rows that have a value."""
    tables = dom.t.all()
    found = QA.column_inventory(tables, name_like="%\\_name").collect()  # rows of the schema
    parts = [tables[r.table_name].agg(F.count(r.column_name).alias("rows_filled"), F.count_if(F.col(r.column_name).isNull()).alias("rows_missing"))
             .select(F.lit(r.table_name).alias("table_name"), F.lit(r.column_name).alias("column_name"), F.lit(r.data_type).alias("data_type"), "*") for r in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def requirement_dashboard(dom: Domain) -> DataFrame:
    """Requirements measured on the data, status computed against the threshold."""
    def cnt(df):
        return df.agg(F.count(F.lit(1)).alias("value"))

    e = dom.encounters()
    return QA.requirement_dashboard([
        ("patients", cnt(dom.patients()), 200),
        ("encounters", cnt(e), 200),
        ("early_readmissions", cnt(e.where(F.col("readmitted_category") == "<30")), 20),
        ("drug_links", cnt(dom.encounter_drugs()), 200),
        ("diagnosis_links", cnt(dom.encounter_diagnoses()), 500),
        ("provider_links", cnt(dom.encounter_providers()), 200),
        ("patients_with_hba1c", cnt(patients_after_hba1c_update(dom)[0]
                                    .where(json_number("risk_factors", "$.hba1c_last").isNotNull())), 60),
        ("orphan_encounters", cnt(dom.encounters().join(dom.patients(), "patient_id", "left_anti")), 0, "at most"),
    ])


# ---------------------------------------------------------------- M13, M16, M17, M20, M21, M24 on the patient datasets

def readmission_classifier(dom: Domain, model: str = "forest"):
    """30-day readmission from utilisation features; stratified 70/30 split (seed 42).

    Returns test predictions with ``label``, ``prediction`` and the class-1 ``score``.
    """
    from ..operators import features as FE
    from ..operators import models as MD
    from ..session import cut_lineage
    cols = ["total_encounters", "avg_los", "unique_drugs", "unique_diagnoses", "total_emergency_visits",
            "total_inpatient_visits"]
    cls = patient_risk_profile(dom).select("patient_id", *[F.col(c).cast("double").alias(c) for c in cols],
                                           F.col("readmission_30d_binary").cast("double").alias("label"))
    # the split reads the rows three times (counts, rows, the bucket a cut falls in): the profile is made once
    cls = cut_lineage(cls.fillna(0.0, cols))
    split = cut_lineage(FE.assemble(FE.stratified_label(cls, "patient_id", "label", 0.7, 42), cols, "label"))
    split = sized(split, "patient_id", all_cores=True)
    est = {"forest": MD.random_forest_classifier(100, 10, 42), "logistic": MD.logistic_regression(),
           "tree": MD.decision_tree(), "gbt": MD.gradient_boosting_classifier()}[model]
    fitted = est.fit(split.where(F.col("split") == "train"))
    pred = MD.positive_score(fitted.transform(split.where(F.col("split") == "test")))
    return pred.select("patient_id", "label", "prediction", "score"), fitted, cols


def readmission_report(dom: Domain, model: str = "forest") -> DataFrame:
    """Classification report of the readmission classifier on the test split."""
    from ..operators.evaluation import classification_report
    pred, _, _ = readmission_classifier(dom, model)
    return classification_report(pred)


def readmission_confusion_auc(dom: Domain) -> DataFrame:
    """Confusion matrix cells plus the exact ROC-AUC of the forest's scores."""
    from ..operators.evaluation import confusion_matrix, roc_auc
    pred, _, _ = readmission_classifier(dom)
    cm = confusion_matrix(pred)
    auc = roc_auc(pred)
    return cm.crossJoin(auc)


def readmission_importances(dom: Domain) -> DataFrame:
    """Importances of the readmission forest."""
    from ..operators.evaluation import feature_importances
    _, fitted, cols = readmission_classifier(dom)
    return feature_importances(fitted, cols)


def patient_clusters(dom: Domain, k: int = 4) -> DataFrame:
    """K-means on the patient risk dataset; cluster sizes, centres and silhouette."""
    from ..operators import features as FE
    from ..operators import models as MD
    cols = ["total_encounters", "avg_length_of_stay", "total_readmissions"]
    data = patient_risk_view(dom).select("patient_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                                           for c in cols])
    model, pred, silhouette = MD.kmeans_clusters(FE.assemble(data, cols, "none"), k)
    return pred.groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("patients"), *[F.avg(c).alias(f"mean_{c}") for c in cols]
    ).withColumn("silhouette", F.lit(float(silhouette)))


def encounter_snapshot_diff(dom: Domain) -> DataFrame:
    """D13 for changes made elsewhere: compare the encounter snapshot before and after the LOS update."""
    before = dom.encounters().select("encounter_id", "time_in_hospital", "readmitted_category")
    after, _ = encounter_los_update(dom)
    return C.snapshot_diff(before, after.select("encounter_id", "time_in_hospital", "readmitted_category"),
                           ["encounter_id"], ["time_in_hospital", "readmitted_category"])
