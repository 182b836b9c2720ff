"""Joins, change jobs and audits (fixtures: refs, checks, audit, two_years, fanout)."""

from pyspark.sql import functions as F

from tidewater.operators import changes as C
from tidewater.operators import joins as J
from tidewater.operators import quality as QA


def test_left_merge_suffix_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, name string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, name string")
    plain = {r.name: r.name_prop for r in J.left_merge(left, right, ["k"]).collect()}
    assert plain == {"a": "x", "b": None}
    pandas_like = {r.name: r.name_prop for r in J.left_merge(left, right, ["k"], null_keys_match=True).collect()}
    assert pandas_like == {"a": "x", "b": "y"}


def test_orphans_and_fanout(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "pid int")
    assert [r.pid for r in J.orphans(child, parent, "pid", "id").collect()] == [3]
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    r = J.fanout_report(left, right, ["k"]).first()
    assert (r.left_rows, r.rows_after, r.max_fanout) == (2, 4, 3)
    assert left.join(right, "k", "left").count() == 4


def test_period_compare_one_row_per_key(spark):
    """Fixture two_years: a country in one year only is dropped; a repeated key is reduced, not paired."""
    df = spark.createDataFrame([("A", 1990, 1.0), ("A", 2020, 2.0), ("B", 1990, 1.0), ("C", 2020, 3.0), ("C", 2020, 4.0),
                                ("C", 1990, 0.0)], "c string, y int, v double")
    got = sorted(map(tuple, J.period_compare(df, "c", "y", "v", 1990, 2020).collect()))
    assert got == [("A", 1.0, 2.0), ("C", 0.0, 3.5)]


def test_update_audit_logs_matched_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "id int, los int")
    snap, audit = C.update_where(df, F.col("los") >= 5, {"los": F.greatest(F.col("los"), F.lit(6))},
                                 audit=C.AuditSpec("enc", "id"))
    assert {r.id: r.los for r in snap.collect()} == {1: 6, 2: 7, 3: None}
    assert sorted((r.key, r.old_value, r.new_value) for r in audit.collect()) == [(1, "5", "6"), (2, "7", "7")]
    _, changed = C.update_where(df, F.col("los") >= 5, {"los": F.greatest(F.col("los"), F.lit(6))},
                                audit=C.AuditSpec("enc", "id", changed_only=True))
    assert [r.key for r in changed.collect()] == [1]


def test_delete_actions(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, tag string")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)], "cid int, pid int")
    gone = C.deleted_keys(parent, F.col("tag") == "x", "id")
    assert sorted(r.id for r in C.delete_where(parent, F.col("tag") == "x").collect()) == [2, 3]
    assert sorted(r.cid for r in C.cascade_delete(child, "pid", gone, "id").collect()) == [11, 12, 13]
    nulls = {r.cid: r.pid for r in C.set_null_on_delete(child, "pid", gone, "id").collect()}
    assert nulls == {10: None, 11: 2, 12: 3, 13: None}
    assert [r.cid for r in C.restrict_violations(child, "pid", gone, "id").collect()] == [10]


def test_snapshot_diff_and_one_to_one(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    d = {r.k: r.action for r in C.snapshot_diff(old, new, ["k"], ["v"]).collect()}
    assert d == {2: "UPDATE", 3: "DELETE", 4: "INSERT"}
    r = C.one_to_one_check(old, "k", new, "k").first()
    assert (r.left_rows, r.right_rows, r.missing_on_right, r.missing_on_left) == (3, 3, 1, 1)


def test_key_audit_and_checks(spark):
    df = spark.createDataFrame([(1, "ok"), (1, "dup"), (None, "x" * 30)], "id int, name string")
    assert {(r.id, r.occurrences) for r in QA.key_audit(df, ["id"]).collect()} == {(None, 1), (1, 2)}
    from tidewater.sources.tables import TableSpec
    spec = TableSpec("t", df.schema, ("id",), checks={"id_pos": "id > 0"}, not_null=("id",), max_length={"name": 25})
    got = {r.rule: r.violations for r in QA.row_rules_audit(df, "t", spec).collect()}
    assert got == {"check:id_pos": 0, "not_null:id": 1, "max_length:name<=25": 1}
