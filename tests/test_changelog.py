"""Change scripts against a row-by-row interpreter: order, nulls, repeated rows, inserted and deleted keys, empty tables."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import changelog as CL

SCHEMA = "id long, v int, tag string"


def brute(rows, steps):
    """steps: (kind, predicate, function or rows); returns (rows, audit)."""
    rows, audit = [dict(zip(("id", "v", "tag"), r)) for r in rows], []
    for i, (kind, test, act) in enumerate(steps, 1):
        if kind == "insert":
            rows += [dict(zip(("id", "v", "tag"), r)) for r in act]
            audit += [(i, r[0], "INSERT", None, str(r[1]) if r[1] is not None else None) for r in act]
            continue
        hit = [r for r in rows if test(r)]
        if kind == "delete":
            audit += [(i, r["id"], "DELETE", r["tag"], None) for r in hit]
            rows = [r for r in rows if not test(r)]
        else:
            for r in hit:
                old = r["v"]
                r.update(act(r))
                audit.append((i, r["id"], "UPDATE", None if old is None else str(old), None if r["v"] is None else str(r["v"])))
    return collections.Counter(tuple(r.values()) for r in rows), collections.Counter(audit)


def run(spark, rows, script):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return CL.run_script({"t": df, "other": df}, {"t": "id", "other": "id"}, script)


def test_script_equals_statements_in_order(spark):
    r = random.Random(6)
    rows = [(i, r.choice([None, 0, 1, 2, 3]), r.choice([None, "a", "b"])) for i in range(40)] + [(3, 1, "a"), (3, 1, "a")]
    new = [(100, 2, "n"), (101, None, None)]
    v, tag = F.col("v"), F.col("tag")
    script = [
        CL.Update("t", v >= 2, {"v": v + 1, "tag": F.lit("up")}, old=v, new=v),
        CL.Insert("t", spark.createDataFrame(new, SCHEMA), new=v),
        CL.Update("t", (v == 3) | (tag == "n"), {"v": F.col("id").cast("int"), "tag": F.concat(tag, F.col("v").cast("string"))}, old=v, new=v),
        CL.Delete("t", tag == "a", old=tag),
        CL.Insert("t", spark.createDataFrame([(7, 5, "again")], SCHEMA), new=v),
        CL.Update("t", v == 5, {"v": F.lit(None)}, old=v, new=v),
        CL.Note("NOTE", "t", "x", None),
        CL.Delete("t", F.col("id") >= 100),
    ]
    steps = [
        ("update", lambda x: x["v"] is not None and x["v"] >= 2, lambda x: {"v": x["v"] + 1, "tag": "up"}),
        ("insert", None, new),
        ("update", lambda x: x["v"] == 3 or x["tag"] == "n", lambda x: {"v": x["id"], "tag": None if x["tag"] is None or x["v"] is None else x["tag"] + str(x["v"])}),
        ("delete", lambda x: x["tag"] == "a", None),
        ("insert", None, [(7, 5, "again")]),
        ("update", lambda x: x["v"] == 5, lambda x: {"v": None}),
        ("update", lambda x: False, None),
        ("delete", lambda x: x["id"] >= 100, None),
    ]
    want, audit = brute(rows, steps)
    result = run(spark, rows, script)
    assert collections.Counter(map(tuple, result.snapshot("t").collect())) == want
    got = collections.Counter((x.step, x.key, x.action, x.old_value, x.new_value) for x in result.audit().where("action <> 'NOTE'").collect())
    assert got == collections.Counter({k: n for k, n in audit.items() if k[0] != 8})  # the last delete keeps no audit
    note = result.audit().where("action = 'NOTE'").first()
    assert (note.step, note.key, note.table_name, note.old_value, note.new_value) == (7, None, "t", "x", None)
    assert result.snapshot("other").count() == len(rows) and result.snapshot("t").columns == ["id", "v", "tag"]


def test_assignments_see_the_row_before_the_step(spark):
    df = spark.createDataFrame([(1, 1, 2)], "id long, a int, b int")
    result = CL.run_script({"t": df}, {"t": "id"}, [CL.Update("t", F.lit(True), {"a": F.col("b"), "b": F.col("a")})])
    assert tuple(result.snapshot("t").first()) == (1, 2, 1) and result.audit().count() == 0


def test_key_clashes(spark):
    rows = [(1, 0, "a"), (2, 0, "b"), (None, 0, None)]

    def ins(*ids):
        return CL.Insert("t", spark.createDataFrame([(i, 0, "x") for i in ids], SCHEMA))

    gone = CL.Delete("t", F.col("id") == 1)
    for script, clash in (([ins(1)], {(1, 1)}), ([gone, ins(1)], set()), ([ins(1), gone], {(1, 1)}), ([ins(5, 5)], {(5, 1)}), ([ins(5), ins(5)], {(5, 2)}),
                          ([ins(5), CL.Delete("t", F.col("id") == 5), ins(5)], set()), ([ins(None)], set())):
        result = run(spark, rows, script)
        assert {(r.key, r.step) for r in result.clashes().collect()} == clash
        if clash:
            with pytest.raises(CL.KeyClash):
                result.check()
        else:
            result.check()


def test_empty_tables_and_wrong_names(spark):
    result = run(spark, [], [CL.Update("t", F.lit(True), {"v": F.lit(1)}, old=F.col("v")), CL.Insert("t", spark.createDataFrame([(1,)], "id long"))])
    assert [tuple(r) for r in result.snapshot("t").collect()] == [(1, None, None)] and result.audit().count() == 0
    assert run(spark, [], []).audit().count() == 0
    for bad in (CL.Delete("x", F.lit(True)), CL.Update("t", F.lit(True), {"w": F.lit(1)}), CL.Insert("t", spark.createDataFrame([(1,)], "w long"))):
        with pytest.raises(KeyError):
            run(spark, [], [bad])
