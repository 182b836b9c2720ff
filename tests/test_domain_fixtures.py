"""Analyses on tiny invented star-schema tables written to a temporary folder (fixtures: fanout, score_edges)."""

import datetime as dt

import pytest

from tidewater.plans import analyses as Q
from tidewater.plans.domain import Domain
from tidewater.sources.tables import REGISTRY


def write_tables(spark, root, rows_by_table):
    for name, spec in REGISTRY.items():
        rows = rows_by_table.get(name, [])
        spark.createDataFrame(rows, spec.schema).write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture()
def fanout_dir(spark, tmp_dir):
    # one patient, one '<30' visit (status F) with 2 drugs (parts) and 3 diagnoses (line numbers)
    customer = [(7, "c7", 1, 100.0, "MACHINERY"), (8, "c8", 2, 5000.0, "BUILDING"), (9, "c9", 1, -5.0, "BUILDING")]
    orders = [(100, 7, "F", 10.0, dt.datetime(2020, 1, 5), "1-URGENT"),
              (200, 8, "O", 10.0, dt.datetime(2020, 2, 5), "5-LOW")]
    lineitem = [(100, p, 1, ln, 1.0, 10.0, 0.0, 0.0, "N", "O", dt.datetime(2020, 1, 9))
                for p, ln in [(1, 1), (2, 2), (1, 3)]]
    nation = [(1, "N1", 0), (2, "N2", 0)]
    part = [(1, "p1", "B#1", "SMALL", 5, 1.0), (2, "p2", "B#2", "LARGE", 50, 2.0)]
    supplier = [(1, "s1", 1, 0.0)]
    return write_tables(spark, tmp_dir, {"customer": customer, "orders": orders, "lineitem": lineitem,
                                         "nation": nation, "part": part, "supplier": supplier})


def test_q11_faithful_inflates_and_corrected_does_not(spark, fanout_dir):
    dom = Domain(spark, fanout_dir)
    faithful = {r.patient_id: r for r in Q.patient_risk_profile(dom).collect()}
    corrected = {r.patient_id: r for r in Q.patient_risk_profile(dom, corrected=True).collect()}
    # 2 distinct drugs x 3 diagnoses = 6 joined rows for the one early readmission
    assert faithful[7].early_readmissions == 6 and corrected[7].early_readmissions == 1
    assert faithful[7].unique_drugs == corrected[7].unique_drugs == 2
    assert faithful[7].unique_diagnoses == corrected[7].unique_diagnoses == 3
    assert faithful[7].risk_category == "Very High Risk" and corrected[7].risk_category == "High Risk"
    # without fan-out both forms agree
    assert faithful[8].asDict() == corrected[8].asDict()


def test_q4_scores_and_bands(spark, fanout_dir):
    dom = Domain(spark, fanout_dir)
    got = {r.patient_id: (r.total_encounters, r.risk_score, r.risk_category)
           for r in Q.patient_risk_scores(dom).collect()}
    assert got == {7: (1, 100.0, "High"), 8: (1, 0.0, "Low"), 9: (0, 0.0, "Low")}  # 9 has no visit


def test_q3_keeps_patients_without_visits(spark, fanout_dir):
    dom = Domain(spark, fanout_dir)
    r = {x.patient_id: x for x in Q.patient_risk_view(dom).collect()}
    assert (r[9].total_encounters, r[9].total_readmissions, r[9].avg_length_of_stay) == (0, 0, None)
    assert r[7].avg_medications_per_visit == 2.0 and r[8].avg_medications_per_visit is None


def test_q1_counts_children_without_fanout(spark, fanout_dir):
    dom = Domain(spark, fanout_dir)
    r = {x.encounter_id: x for x in Q.readmission_view(dom).collect()}
    assert (r[100].total_drugs_prescribed, r[100].diagnosis_count) == (2, 3)
    assert (r[200].total_drugs_prescribed, r[200].diagnosis_count) == (0, 0)
