"""Shares of a task that do not grow with the input, and frames that are made once (fixtures: made rows)."""

import datetime
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewater import session
from tidewater.operators import features as FE
from tidewater.operators import models as MD
from tidewater.operators import relations as R
from tidewater.operators import tuning as TU
from tidewater.plans import analyses as Q
from tidewater.plans import energy as EN
from tidewater.plans import graph_changes as GC
from tidewater.plans.domain import Domain
from tidewater.sources.tables import REGISTRY, Tables


def _table(spark, folder, name, rows):
    spec = REGISTRY[name]
    full = [tuple(r.get(f.name) for f in spec.schema.fields) for r in rows]
    spark.createDataFrame(full, spec.schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("made"))

    def day(name, field, i):
        kind = REGISTRY[name].schema[field].dataType.simpleString()
        found = datetime.datetime(1997, 1 + i % 12, 1 + i % 28)
        return found.date() if kind == "date" else found if kind.startswith("timestamp") else found.date().isoformat()

    _table(spark, folder, "region", [{"r_regionkey": i, "r_name": f"R{i}"} for i in range(3)])
    _table(spark, folder, "nation", [{"n_nationkey": i, "n_name": f"N{i}", "n_regionkey": i % 3} for i in range(9)])
    _table(spark, folder, "customer", [{"c_custkey": i, "c_name": f"C{i}", "c_nationkey": i % 9, "c_acctbal": 10.0 * i - 50, "c_mktsegment": "AB"[i % 2]} for i in range(60)])
    _table(spark, folder, "supplier", [{"s_suppkey": i, "s_name": f"S{i}", "s_nationkey": i % 9} for i in range(20)])
    _table(spark, folder, "part", [{"p_partkey": i, "p_name": f"part {i}", "p_brand": f"B{i % 5}", "p_type": f"T{i % 7}", "p_size": 45 + i % 6} for i in range(100)]
           + [{"p_partkey": None, "p_name": None, "p_brand": "B", "p_type": "T", "p_size": None}])
    _table(spark, folder, "orders", [{"o_orderkey": i, "o_custkey": i % 60, "o_orderstatus": "FOP"[i % 3], "o_totalprice": 100.0 + i, "o_orderdate": day("orders", "o_orderdate", i),
                                      "o_orderpriority": ("5-LOW", "1-URGENT")[i % 2]} for i in range(400)])
    _table(spark, folder, "lineitem", [{"l_orderkey": i % 400, "l_partkey": i % 97, "l_suppkey": i % 19, "l_linenumber": 1 + i // 400, "l_quantity": 1.0 + i % 9, "l_extendedprice": 50.0 + i % 333,
                                        "l_returnflag": "ANR"[i % 3], "l_linestatus": "FO"[i // 400 % 2], "l_shipdate": day("lineitem", "l_shipdate", i + 3)} for i in range(2000)])
    return folder


def test_sized_cuts_and_joins_partitions(spark):
    df = spark.range(1000).coalesce(1)
    cut = session.sized(df, "id", per_task=10)
    assert cut.rdd.getNumPartitions() == 100 and sorted(r.id for r in cut.collect()) == list(range(1000))
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(20 * cores)
    assert session.sized(many, per_task=10**6).rdd.getNumPartitions() == session.TASKS_PER_CORE * cores
    assert session.sized(spark.range(0).coalesce(1)).rdd.getNumPartitions() == 1


def test_monographs_are_parsed_by_many_tasks(spark, made, monkeypatch):
    whole = Counter(tuple(r) for r in Q.drug_monographs(Domain(spark, made)).collect())
    monkeypatch.setattr(Q, "MONOGRAPH_TASK_ROWS", 20)
    spread = Q.drug_monographs(Domain(spark, made)).withColumn("_p", F.spark_partition_id()).collect()
    assert len({r["_p"] for r in spread}) > 1
    assert Counter(tuple(r)[:-1] for r in spread) == whole and len(spread) == 101


def test_graph_delete_rows_are_counted_in_small_tasks(spark, made, monkeypatch):
    whole = Counter(tuple(r) for r in GC.graph_delete_rows(Tables(spark, made)).collect())
    monkeypatch.setattr(R, "TABLE_TASK_ROWS", 10)  # also few keys are then joined by sorting
    cut = GC.graph_delete_rows(Tables(spark, made))
    assert Counter(tuple(r) for r in cut.collect()) == whole
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 200), REPARTITION_BY_NUM" in plan


def test_forest_rows_of_a_task_are_bounded(spark, made, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 16)
    frame, _ = EN.model_frame(Tables(spark, made))
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) > 200 and max(sizes) <= 3 * 16


def test_folds_of_few_rows_are_fitted_in_few_tasks(spark):
    cores, seen = spark.sparkContext.defaultParallelism, []
    train = spark.createDataFrame([(i, Vectors.dense([float(i)]), float(i)) for i in range(60)], ["id", "features", "label"])

    class Watched:
        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return MD.linear_regression().fit(df)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(8 * cores))
    try:
        TU.grid_search(train, lambda **_: Watched(), TU.grid(a=(1,)), "id", 2, model="watched")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen and max(seen) <= session.TASKS_PER_CORE * cores


def test_readmission_profile_is_made_once(spark, made, monkeypatch):
    plans = []
    real = FE.stratified_label

    def watched(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(FE, "stratified_label", watched)
    rows = Q.readmission_report(Domain(spark, made), model="tree").collect()
    assert rows and plans and all("Aggregate" not in p and "LogicalRDD" in p for p in plans)
