"""Sources, sinks, schema helpers and small change operations."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import changes as C
from tidewater.operators import evaluation as EV
from tidewater.operators import features as FE
from tidewater.operators import models as MD
from tidewater.operators import quality as QA
from tidewater.functions.expressions import sentinels_to_null, to_number
from tidewater.sources import files, rows, tables


def test_csv_roundtrip_with_sentinel_and_coercion(spark, tmp_dir):
    path = f"{tmp_dir}/props.csv"
    with open(path, "w") as fh:
        fh.write("Portfolio Manager ID,Gross Floor Area,Occupancy (%)\n1,1200.5,90\n2,Not Available,abc\n3, 12.5 ,\n")
    df = files.read_csv(spark, path, "id long, gfa string, occ string", null_values=("Not Available",))
    got = df.select("id", to_number("gfa").alias("gfa"), to_number("occ").alias("occ")).orderBy("id").collect()
    assert [(r.id, r.gfa, r.occ) for r in got] == [(1, 1200.5, 90.0), (2, None, None), (3, 12.5, None)]
    files.write_csv(df, f"{tmp_dir}/out")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/out")
    assert back.count() == 3 and back.columns == ["id", "gfa", "occ"]
    raw = spark.createDataFrame([("Not Available", "?")], "a string, b string")
    assert tuple(sentinels_to_null(raw, ["Not Available", "?"]).first()) == (None, None)


def test_literal_generated_rows_and_export(spark, tmp_dir):
    lit = rows.literal_rows(spark, [(1, "a"), (2, "b")], "id int, code string")
    files.register_dataset(lit, "lit_rows")
    assert spark.sql("SELECT count(*) AS n FROM lit_rows").first().n == 2
    gen = rows.generated_rows(spark, 1, 50, code=F.concat(F.lit("P"), F.lpad(F.col("id").cast("string"), 3, "0")))
    got = gen.orderBy("id").collect()
    assert len(got) == 50 and got[0].code == "P001" and got[-1].code == "P050"
    files.export_parquet(gen, f"{tmp_dir}/gen", partition_by=None)
    assert spark.read.parquet(f"{tmp_dir}/gen").count() == 50


def test_registry_loads_every_driver_table(spark):
    for name in tables.TABLE_NAMES:
        df = tables.load(spark, "/root/testdata/sf0.001", name)
        assert df.columns == tables.REGISTRY[name].schema.fieldNames()
    q = tables.read_sql(spark, "/root/testdata/sf0.001", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = :s",
                        args={"s": "F"})
    assert q.first().n > 0


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert QA.select_by_type(df).columns == ["a", "b"]
    assert QA.keep_existing(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert "usage_kwh" in QA.rename_required(df.withColumnRenamed("b", "Usage"), {"Usage": "usage_kwh"}).columns
    with pytest.raises(ValueError):
        QA.rename_required(df, {"Usage": "usage_kwh"})
    prof = {r.column: (r.type, r.rows, r.columns) for r in QA.frame_profile(df).collect()}
    assert prof == {"a": ("int", 1, 3), "b": ("double", 1, 3), "c": ("string", 1, 3)}
    inv = QA.column_inventory({"t": df}, type_names=["string"], name_like="a%")
    assert sorted(tuple(r) for r in inv.collect()) == [("t", "a", "int"), ("t", "c", "string")]


def test_insert_child_and_manual_audit(spark):
    enc = spark.createDataFrame([(1, 10)], "encounter_id long, patient_id long")
    out = spark.createDataFrame([(1, "NO")], "encounter_id long, readmitted_category string")
    enc2 = C.insert_rows(enc, spark.createDataFrame([(99, 10)], "encounter_id long, patient_id long"))
    out2 = C.insert_rows(out, spark.createDataFrame([(99, "NO")], "encounter_id long, readmitted_category string"))
    assert QA.key_audit(enc2, ["encounter_id"]).count() == 0
    assert C.one_to_one_check(enc2, "encounter_id", out2, "encounter_id").first().keys_not_one_to_one == 0
    audit = rows.literal_rows(spark, [(None, "DELETE", "encounters", "Test encounter 99", "Deleted as cleanup")],
                              "key long, action string, table_name string, old_value string, new_value string")
    after = C.delete_where(enc2, F.col("encounter_id") == 99)
    assert after.count() == 1 and audit.first().action == "DELETE"
    defaults = C.fill_defaults(spark.createDataFrame([(None,), (3,)], "los int"), {"los": 0})
    assert [r.los for r in defaults.collect()] == [0, 3]


def test_permutation_importance_ranks_the_signal(spark):
    rows_ = [(i, float(i % 17), float((i * 7919) % 13), float(3 * (i % 17))) for i in range(400)]
    df = spark.createDataFrame(rows_, "id long, x double, junk double, label double")
    assemble = lambda d: FE.assemble(d, ["x", "junk"], "label")
    model = MD.linear_regression().fit(assemble(df))
    imp = {r.feature: r.rmse_increase for r in EV.permutation_importance(model, df, ["x", "junk"], "id", "label",
                                                                         assemble).collect()}
    assert imp["x"] > 1.0 and abs(imp["junk"]) < 0.1


def test_drop_constant_columns(spark):
    df = spark.createDataFrame([(1, 5, None, "x"), (2, 5, None, "x"), (3, None, None, "x")], "a int, b int, c int, d string")
    assert QA.drop_constant_columns(df, ["a", "b", "c", "d"]).columns == ["a"]
    flags = {r.column: r.keep for r in QA.non_constant_columns(df, ["a", "b", "c", "d"]).collect()}
    assert flags == {"a": True, "b": False, "c": False, "d": False}
