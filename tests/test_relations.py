"""Deletes over a relation graph: every action, circles, nulls, repeated rows, empty tables, equal to deleting row by row."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import relations as R

LINKS = [R.Relation("b", "a_id", "a", "id", "cascade"), R.Relation("c", "b_id", "b", "id", "cascade"), R.Relation("c", "a_id", "a", "id", "set null"),
         R.Relation("d", "c_id", "c", "id", "restrict"), R.Relation("e", "c_id", "c", "id", "no action"), R.Relation("e", "a_id", "a", "id", "cascade")]
SCHEMAS = {"a": "id int, v int", "b": "id int, a_id int", "c": "id int, b_id int, a_id int", "d": "id int, c_id int", "e": "id int, c_id int, a_id int"}


def brute(rows, links, gone):
    """Row by row: (left rows, blocking row ids by relation)."""
    dead = {(t, i) for t, found in gone.items() for i in found}
    while True:
        more = set()
        for r in links:
            if r.on_delete == "cascade":
                keys = {rows[t][i][r.parent_column] for t, i in dead if t == r.parent} - {None}
                more |= {(r.child, i) for i, x in enumerate(rows[r.child]) if x[r.column] in keys}
        if more <= dead:
            break
        dead |= more
    left, blocked = {t: [] for t in rows}, {}
    keys = {(r.parent, r.parent_column): {rows[t][i][r.parent_column] for t, i in dead if t == r.parent} - {None} for r in links}
    for t, i in ((t, i) for t in rows for i in range(len(rows[t]))):
        x = dict(rows[t][i])
        for r in links:
            hit = r.child == t and x[r.column] in keys[r.parent, r.parent_column]
            if hit and (r.on_delete == "restrict" or (r.on_delete == "no action" and (t, i) not in dead)):
                blocked[r.name] = blocked.get(r.name, 0) + 1
        for r in links:
            if r.child == t and r.on_delete == "set null" and x[r.column] in keys[r.parent, r.parent_column]:
                x[r.column] = None
        if (t, i) not in dead:
            left[t].append(tuple(x.values()))
    return {t: sorted(v, key=repr) for t, v in left.items()}, blocked


def frames(spark, rows, schemas):
    names = {t: [c.split()[0] for c in s.split(", ")] for t, s in schemas.items()}
    return {t: spark.createDataFrame([tuple(x[n] for n in names[t]) for x in rows[t]], s) for t, s in schemas.items()}


def test_random_graphs_equal_row_by_row(spark):
    r = random.Random(3)

    def some(n):
        return r.choice([None, *range(n)])

    for trial in range(3):
        rows = {"a": [{"id": i, "v": some(4)} for i in range(8)], "b": [{"id": i, "a_id": some(8)} for i in range(10)],
                "c": [{"id": i, "b_id": some(12), "a_id": some(8)} for i in range(14)],
                "d": [{"id": i, "c_id": r.choice([None, 99]) if trial == 0 else some(14)} for i in range(4)],
                "e": [{"id": i // 2, "c_id": r.choice([None, 99]) if trial == 0 else some(14), "a_id": some(8)} for i in range(8)]}
        rows["c"] += rows["c"][:2]  # repeated rows
        gone = {"a": [i for i, x in enumerate(rows["a"]) if x["v"] == 1], "b": [0]}
        plan = R.plan_delete(frames(spark, rows, SCHEMAS), LINKS, {"a": F.col("v") == 1, "b": F.col("id") == 0})
        left, blocked = brute(rows, LINKS, gone)
        assert {t: sorted(map(tuple, plan.left(t).collect()), key=repr) for t in rows} == left
        assert {x.relation: x.n for x in plan.blocking().groupBy("relation").agg(F.sum("rows").alias("n")).collect()} == blocked
        report = {x.table_name: x for x in plan.report().collect()}
        for t in rows:
            assert report[t].rows == len(rows[t]) and report[t].rows_left == len(left[t]) == report[t].rows - report[t].rows_removed
            assert report[t].rows_blocking == sum(n for k, n in blocked.items() if k.startswith(f"{t}."))
            assert plan.left(t).columns == plan.tables[t].columns
        if blocked:
            with pytest.raises(R.DeleteBlocked):
                plan.apply()
        else:
            assert plan.apply()["c"].count() == len(left["c"])


def test_circles_and_self_references(spark):
    links = [R.Relation("staff", "boss", "staff", "id", "cascade"), R.Relation("team", "lead", "staff", "id", "cascade"), R.Relation("staff", "team", "team", "id", "cascade")]
    rows = {"staff": [{"id": i, "boss": None if i % 4 == 0 else i - 1, "team": [None, 0, 1, 2][i % 4]} for i in range(12)] + [{"id": None, "boss": 1, "team": None}],
            "team": [{"id": 0, "lead": 5}, {"id": 1, "lead": 9}, {"id": 2, "lead": None}]}
    tables = frames(spark, rows, {"staff": "id int, boss int, team int", "team": "id int, lead int"})
    for start in (0, 4, 8, 11):
        plan = R.plan_delete(tables, links, {"staff": F.col("id") == start})
        left, _ = brute(rows, links, {"staff": [start]})
        assert {t: sorted(map(tuple, x.collect()), key=repr) for t, x in plan.apply().items()} == left


def test_nothing_to_delete_and_empty_tables(spark):
    tables = frames(spark, {t: [] for t in SCHEMAS}, SCHEMAS)
    plan = R.plan_delete(tables, LINKS, {"a": F.col("v") == 1})
    assert all(x.count() == 0 for x in plan.apply().values())
    assert {tuple(x)[1:] for x in plan.report().collect()} == {(0, 0, 0, 0, 0)}
    assert R.plan_delete(tables, LINKS, {}).blocking().count() == 0
    with pytest.raises(KeyError):
        R.plan_delete(tables, LINKS, {"x": F.lit(True)})


def test_order_and_declared_actions():
    assert [sorted(g) for g in R.visiting_order("edcba", LINKS)][:2] == [["a"], ["b"]]
    circle = [R.Relation("x", "y", "y", "id", "cascade"), R.Relation("y", "z", "z", "id", "cascade"), R.Relation("z", "x", "x", "id", "cascade"), R.Relation("w", "x", "x", "id", "cascade")]
    for names in itertools.permutations("wxyz"):
        assert [sorted(g) for g in R.visiting_order(names, circle)] == [["x", "y", "z"], ["w"]]
    found = {r.name: r.on_delete for r in R.declared_relations(on_delete={"orders.o_custkey": "cascade"})}
    assert found["orders.o_custkey"] == "cascade" and found["lineitem.l_orderkey"] == "cascade" and found["nation.n_regionkey"] == "restrict"
    with pytest.raises(KeyError):
        R.declared_relations(on_delete={"orders.nothing": "cascade"})
    with pytest.raises(ValueError):
        R.Relation("a", "b", "c", "d", "sometimes")


def test_reference_audit_counts_rows_of_all_references_at_once(spark):
    from tidewater.operators.quality import foreign_key_audit
    from tidewater.sources.tables import REGISTRY
    rows = {"region": [(0, "a")], "nation": [(1, "x", 0), (2, "y", 5), (3, "z", None)], "customer": [(1, "c", 1, 0.0, "s"), (2, "c", 9, 0.0, "s"), (2, "c", 9, 0.0, "s"), (3, "c", None, 0.0, "s")]}
    tables = {n: spark.createDataFrame(r, REGISTRY[n].schema) for n, r in rows.items()}
    found = {(r.table_name, r.rule): r.violations for r in foreign_key_audit(tables).collect()}
    assert found == {("nation", "foreign_key:n_regionkey->region.r_regionkey"): 1, ("customer", "foreign_key:c_nationkey->nation.n_nationkey"): 2}
    empty = {n: t.limit(0) for n, t in tables.items()}
    assert {r.violations for r in foreign_key_audit(empty).collect()} == {0}
    assert foreign_key_audit({"region": tables["region"]}) is None
