"""Nothing is lost to null groups, undeclared JSON fields, several sentinels or empty denominators."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.semistructured import json_set
from tidewater.operators.evaluation import regression_metrics, roc_auc
from tidewater.operators.features import exact_sample, hash_order, one_hot_vector, stratified_label
from tidewater.operators.ordering import exact_quantiles, top_k_per_group
from tidewater.operators.quality import requirement_dashboard
from tidewater.operators.text_search import search
from tidewater.sources.files import read_csv


def test_null_groups(spark):
    df = spark.createDataFrame([(None, i, float(i)) for i in range(10)] + [("a", 10 + i, float(i)) for i in range(4)], "g string, k long, v double")
    got = {r.g: r.m for r in exact_quantiles(df, "v", {"m": 0.5}, by=["g"]).collect()}
    assert got == {None: 4.5, "a": 1.5}
    sample = exact_sample(df, "k", fraction=0.125, seed=1, by=["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in sample} == {None: 1, "a": 1}


def test_json_set_keeps_fields(spark):
    df = spark.createDataFrame([('{"a":1,"zzz":{"x":[1,2]},"h":null,"t":"1"}',), (None,)], "j string")
    schema = T.StructType().add("h", T.DoubleType()).add("t", T.StringType())
    got = [json.loads(r[0]) for r in df.select(json_set("j", schema, "h", 9.5)).collect()]
    assert got == [{"a": 1, "zzz": {"x": [1, 2]}, "h": 9.5, "t": "1"}, {"h": 9.5}]
    assert [json.loads(r[0])["t"] for r in df.select(json_set("j", schema, "t", 'q"1')).collect()] == ['q"1', 'q"1']
    assert json.loads(df.select(json_set("j", schema, "h", F.lit(None))).first()[0])["zzz"] == {"x": [1, 2]}


def test_several_sentinels(spark, tmp_dir):
    path = f"{tmp_dir}/x.csv"
    with open(path, "w") as f:
        f.write("a,b\n1,x\nNot Available,NA\nNA,y\n")
    assert [tuple(r) for r in read_csv(spark, path, "a int, b string", ("Not Available", "NA")).collect()] == [(1, "x"), (None, None), (None, "y")]


def test_empty_denominators(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert roc_auc(one).first().auc is None
    same = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    assert regression_metrics(same).first().r2 is None


def test_direction_of_requirements(spark):
    value = spark.createDataFrame([(7,)], "value long")
    got = {r.requirement: r.status for r in requirement_dashboard([("orphans", value, 0, "at most"), ("rows", value, 5)]).collect()}
    assert got == {"orphans": "FAIL", "rows": "PASS"}


def test_absent_search_term(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "gamma")], "id long, text string")
    got = {r.id: r.relevance for r in search(df, "text", ["alpha", "absent", "beta"]).collect()}
    assert set(got) == {1} and got[1] > 0


def test_sample_equals_the_first_rows_in_hash_order(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g")).repartition(7)
    ordered = [r.id for r in df.orderBy(hash_order("id", 5), "id").collect()]
    for fraction, n in ((0.1234, 370), (0.0, 0), (1.0, 3000)):
        assert sorted(r.id for r in exact_sample(df, "id", fraction=fraction, seed=5).collect()) == sorted(ordered[:n])
    assert sorted(r.id for r in exact_sample(df, "id", cap=17, seed=5).collect()) == sorted(ordered[:17])
    by_group = exact_sample(df, "id", cap=17, seed=5, by=["g"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in by_group} == {None: 17, 1: 17, 2: 17}
    assert exact_sample(df.where("id < 0"), "id", fraction=0.5, seed=5).count() == 0


def test_sample_of_repeated_keys(spark):
    df = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("v")).repartition(4)
    assert exact_sample(df, "k", fraction=0.3, seed=1).count() == 300


def test_stratified_label_covers_null_class(spark):
    df = spark.range(40).select("id", F.when(F.col("id") < 30, F.lit(1)).alias("y"))
    got = {(r.y, r.split): r["count"] for r in stratified_label(df, "id", "y").groupBy("y", "split").count().collect()}
    assert got == {(1, "train"): 21, (1, "test"): 9, (None, "train"): 7, (None, "test"): 3}


def test_top_k_of_identical_rows(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.lit(1).alias("v")).repartition(6)
    assert top_k_per_group(df, ["g"], ["v"], 3).count() == 3
    assert top_k_per_group(df, ["g"], ["v"], 3, rank="rank").count() == 5000
    salts = df.select(F.xxhash64(F.spark_partition_id(), "g", "v").alias("s")).distinct().count()
    assert salts > 1


def test_one_hot_vector_has_no_limit(spark):
    df = spark.range(1500).select(F.concat(F.lit("c"), "id").alias("c"))
    out, _ = one_hot_vector(df, "c")
    assert out.first().c_vector.size == 1500 and out.select("c_vector").distinct().count() == 1500
