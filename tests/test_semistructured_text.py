"""JSON, XML and text search (fixtures: json_bands, json_set, xml, text)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.semistructured import json_number, json_set, monograph_fields
from tidewater.operators.text_search import search


def test_json_set_keeps_types_and_handles_null(spark):
    schema = T.StructType([T.StructField("diabetes", T.BooleanType()), T.StructField("hba1c_last", T.DoubleType())])
    df = spark.createDataFrame([('{"diabetes": true}',), (None,), ('{"diabetes": false, "hba1c_last": 6.0}',)], "j string")
    got = [r[0] for r in df.select(json_set("j", schema, "hba1c_last", 7.8)).collect()]
    assert got == ['{"diabetes":true,"hba1c_last":7.8}', '{"hba1c_last":7.8}', '{"diabetes":false,"hba1c_last":7.8}']


def test_json_number_bands(spark):
    docs = ['{"h": 9.5}', '{"h": 8.5}', '{"h": 7.0}', '{"h": 6.9}', '{"x": 1}', None]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    h = json_number("j", "$.h")
    band = F.when(h > 8.5, "POOR").when(h.between(7.0, 8.5), "BORDER").otherwise("OK")
    assert [r[0] for r in df.select(band).collect()] == ["POOR", "BORDER", "BORDER", "OK", "OK", "OK"]


def test_xml_fields_missing_and_empty(spark):
    docs = ["<drug><indication>a</indication><contraindication>b</contraindication><warning>c</warning>"
            "<risk_level>HIGH</risk_level></drug>", "<drug><indication/><warning>w</warning></drug>"]
    df = spark.createDataFrame([(d,) for d in docs], "x string")
    rows = [tuple(r) for r in df.select(*monograph_fields("x")).collect()]
    assert rows == [("a", "b", "c", "HIGH"), ("", "", "w", "")]


def test_text_search_whole_word_case_insensitive(spark):
    docs = [(1, "Hypoglycemia, seen."), (2, "hypoglycemias only"), (3, "HYPOGLYCEMIA and hypoglycemia"), (4, "none")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.tf_0, r.relevance) for r in search(df, "text", ["hypoglycemia"]).collect()}
    assert set(got) == {1, 3}
    assert got[3][0] == 2 and got[3][1] > got[1][1] > 0
