"""Deletes over the relation graph and ordered change scripts on the analysed domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semistructured import json_set
from ..operators import changelog as CL
from ..operators import relations as R
from ..session import tasks_for
from ..sources.tables import Tables
from .analyses import RISK_FACTORS_SCHEMA
from .domain import Domain

RELATED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _plan(t: Tables, roots) -> R.DeletePlan:
    return R.plan_delete({n: getattr(t, n) for n in RELATED}, R.declared_relations(RELATED), roots)


def _removals() -> dict:
    """A nation, the suppliers of another one, the low-priority pending orders, the largest parts."""
    return {"nation": F.col("n_nationkey") == 7, "supplier": F.col("s_nationkey") == 3,
            "orders": (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "part": F.col("p_size") == 50}


def graph_delete_report(t: Tables) -> DataFrame:
    """The removals above and the customers of one nation, whose orders block them: figures of every table."""
    return _plan(t, {**_removals(), "customer": F.col("c_nationkey") == 7}).report()


def graph_delete_blocking(t: Tables) -> DataFrame:
    """Which rows hold on to which keys when a region's and a nation's rows and some customers are to go."""
    roots = {"region": F.col("r_regionkey") == 1, "customer": (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 0)}
    return _plan(t, roots).blocking()


def graph_delete_rows(t: Tables) -> DataFrame:
    """D4 + D5: the keys and references of all rows left after a delete that nothing blocks, over all tables."""
    plan = _plan(t, _removals())
    left = plan.apply()
    columns = {"nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"), "supplier": ("s_suppkey", "s_nationkey"),
               "part": ("p_partkey", "p_size"), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_suppkey")}
    out = None
    for name, (key, reference) in columns.items():
        rows = left[name].select(F.col(key).cast("long").alias("key"), F.col(reference).cast("long").alias("reference"))
        tasks = tasks_for(plan.rows(name), R.TABLE_TASK_ROWS)
        if tasks > 1:  # the keys are all but unique: their hash tables are as large as a task's share of the rows
            rows = rows.repartition(tasks, "key", "reference")
        rows = rows.groupBy("key", "reference").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- the change script, in its order

#: Ids of the script's own encounters start here; the driver's keys stay below.
SCRIPT_IDS = 2_000_000_000


def change_script(dom: Domain) -> CL.ScriptResult:
    """Updates of patients, outcomes and encounters, encounters inserted with their outcomes, a noted and a logged delete."""
    eid, lab = F.col("encounter_id"), F.col("readmitted_category")
    los = F.concat(F.lit("LOS:"), F.col("time_in_hospital").cast("string"))
    patient = F.concat(F.lit("Patient:"), F.col("patient_id").cast("string"))
    made = dom.patients().where(F.col("patient_id") % 10 == 1).select(
        (F.col("patient_id") + SCRIPT_IDS).alias("encounter_id"), "patient_id", F.lit(1).cast("long").alias("time_in_hospital"))
    outcome = made.select("encounter_id", F.lit("NO").alias("readmitted_category"), F.lit(0).alias("readmitted_flag"))
    dummy = (eid >= SCRIPT_IDS) & (eid % 4 == 1)
    tables = {"patients": dom.patients().select("patient_id", "risk_factors"), "outcomes": dom.outcomes(),
              "encounters": dom.encounters().select("encounter_id", "patient_id", "time_in_hospital")}
    script = [
        CL.Update("patients", F.col("patient_id") % 97 == 5, {"risk_factors": json_set("risk_factors", RISK_FACTORS_SCHEMA, "hba1c_last", F.lit(7.8))}, patient, patient),
        CL.Update("outcomes", eid % 50 == 7, {"readmitted_category": F.lit(">30")}, lab, lab),
        CL.Update("encounters", eid % 50 == 7, {"time_in_hospital": F.col("time_in_hospital") + 1}, los, los),
        CL.Insert("encounters", made),
        CL.Insert("outcomes", outcome, new=lab),
        CL.Update("outcomes", (lab == ">30") & (eid % 3 == 0), {"readmitted_category": F.lit("NO"), "readmitted_flag": F.lit(0)}, lab, lab),
        CL.Update("encounters", F.col("time_in_hospital") >= 14, {"time_in_hospital": F.lit(1)}, los, los),
        CL.Note("DELETE", "encounters", "Test encounters", "Deleted as controlled cleanup"),
        CL.Delete("outcomes", dummy),
        CL.Delete("encounters", dummy, old=eid, new=F.lit("deleted")),
        CL.Update("encounters", eid >= SCRIPT_IDS, {"time_in_hospital": F.col("time_in_hospital") + F.col("patient_id") % 3}, los, los),
    ]
    return CL.run_script(tables, {"patients": "patient_id", "outcomes": "encounter_id", "encounters": "encounter_id"}, script)


def script_snapshot(dom: Domain) -> DataFrame:
    """Encounters and outcomes after the script; the key check comes first."""
    result = change_script(dom)
    result.check()
    return result.snapshot("encounters").join(result.snapshot("outcomes"), "encounter_id", "full_outer").select(
        "encounter_id", "patient_id", "time_in_hospital", "readmitted_category", "readmitted_flag")


def script_audit(dom: Domain) -> DataFrame:
    """The audit rows of all steps, those of the outcome updates and the hand-written one included."""
    return change_script(dom).audit()
