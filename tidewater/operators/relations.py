"""Deletes over a whole graph of foreign keys.

``plan_delete`` takes the rows to delete in any tables and follows every declared relation at once:

* ``cascade``    -- child rows of removed rows are removed too, and so on down the graph;
* ``set null``   -- child rows stay, their reference becomes null;
* ``restrict``   -- any child row of a removed row blocks the whole delete;
* ``no action``  -- only child rows that would still be there afterwards block it.

Tables are visited parents first, so an acyclic schema takes one pass: the removed rows of a table leave only their
distinct key values, which its children are joined with. Tables that refer to one another in a circle (or to
themselves) are visited again with the keys that are new, until there are none. Key sets are pinned in the shared checkpoint
folder, so no table is scanned once for each path that leads to it. Nothing is removed if anything blocks.

A key of null refers to nothing; repeated rows are each judged; references are by value, so a removed key value
counts as removed even where another row still holds it (a declared parent key is unique).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, tasks_for
from ..sources.tables import REGISTRY
from .changes import _matched

ACTIONS = ("cascade", "set null", "restrict", "no action")
_GONE = "_tw_gone"
#: Rows of a table that one task joins or counts.
TABLE_TASK_ROWS = 1 << 19


@dataclass(frozen=True)
class Relation:
    """``child.column`` refers to ``parent.parent_column``."""

    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str = "restrict"

    def __post_init__(self):
        if self.on_delete not in ACTIONS:
            raise ValueError(f"unknown delete action {self.on_delete!r}")

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


class DeleteBlocked(ValueError):
    """A delete that restricting relations do not allow; nothing was removed."""


def declared_relations(names: Iterable[str] | None = None, on_delete: Mapping[str, str] | None = None) -> list[Relation]:
    """Relations of the registered tables; ``on_delete`` overrides actions by 'table.column'."""
    chosen, wanted = dict(on_delete or {}), set(REGISTRY if names is None else names)
    found = [Relation(s.name, c, p, pc, chosen.pop(f"{s.name}.{c}", s.on_delete.get(c, "restrict")))
             for s in REGISTRY.values() for c, p, pc in s.foreign_keys if s.name in wanted and p in wanted]
    if chosen:
        raise KeyError(f"no such relation: {sorted(chosen)}")
    return found


def visiting_order(names: Iterable[str], relations: Iterable[Relation]) -> list[list[str]]:
    """Tables in groups, parents first; tables that depend on one another in a circle share a group."""
    names = list(names)
    parents = {n: {r.parent for r in relations if r.child == n and r.parent in names} for n in names}
    reach = {n: set(parents[n]) for n in names}  # everything above a table
    for via in names:
        for n in names:
            if via in reach[n]:
                reach[n] |= reach[via]
    groups: list[list[str]] = []
    for n in sorted(names, key=lambda n: (len(reach[n] | {n}), names.index(n))):
        circle = next((g for g in groups if g[0] in reach[n] and n in reach[g[0]]), None)
        if circle is not None:
            circle.append(n)
        else:
            groups.append([n])
    return groups


@dataclass
class DeletePlan:
    tables: dict[str, DataFrame]
    relations: list[Relation]
    roots: dict[str, Column]
    #: removed key values by (table, column), for every column that a relation points to
    keys: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    _rows: dict[str, int] = field(default_factory=dict)
    _held: dict[tuple[str, str], int] = field(default_factory=dict)  # key values in each of ``keys``

    def rows(self, name: str) -> int:
        """Rows of a table, counted once."""
        if name not in self._rows:
            self._rows[name] = self.tables[name].count()
        return self._rows[name]

    def _marked(self, name: str) -> DataFrame:
        """The table with one flag per relation (its parent row goes) and ``_tw_gone`` (the row itself goes)."""
        df = self.tables[name].withColumn("_tw_root", _matched(self.roots[name]) if name in self.roots else F.lit(False))
        gone = F.col("_tw_root")
        for i, r in enumerate(x for x in self.relations if x.child == name):
            keys = self.keys.get((r.parent, r.parent_column))
            flag = f"_tw_hit{i}"
            if keys is None:
                df = df.withColumn(flag, F.lit(False))
            else:
                if self._held[r.parent, r.parent_column] > TABLE_TASK_ROWS:  # too many to be broadcast: the join sorts the table
                    df = df.repartition(tasks_for(self.rows(name), TABLE_TASK_ROWS), r.column)
                hit = keys.select(F.col("key").alias(f"_tw_key{i}"), F.lit(True).alias(flag))
                df = df.join(hit, F.col(r.column) == F.col(f"_tw_key{i}"), "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop(f"_tw_key{i}")
            if r.on_delete == "cascade":
                gone = gone | F.col(flag)
        return df.withColumn(_GONE, gone)

    def _of(self, name: str) -> list[tuple[str, Relation]]:
        return [(f"_tw_hit{i}", r) for i, r in enumerate(x for x in self.relations if x.child == name)]

    def _blocks(self, flag: str, relation: Relation) -> Column:
        if relation.on_delete == "restrict":
            return F.col(flag)
        return F.col(flag) & ~F.col(_GONE) if relation.on_delete == "no action" else F.lit(False)

    def blocking(self) -> DataFrame:
        """(relation, key, rows): the removed key values that child rows hold on to, over all blocking relations."""
        out = None
        for name in self.tables:
            for flag, r in self._of(name):
                if r.on_delete not in ("restrict", "no action"):
                    continue
                rows = (self._marked(name).where(self._blocks(flag, r)).groupBy(F.col(r.column).cast("string").alias("key"))
                        .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r.name).alias("relation"), "key", "rows"))
                out = rows if out is None else out.unionByName(rows)
        if out is None:
            spark = next(iter(self.tables.values())).sparkSession
            return spark.createDataFrame([], "relation string, key string, rows long")
        return out

    def report(self) -> DataFrame:
        """One row per table: rows, rows that go, rows left, references set to null, rows that block (one scan each).

        The figures say what the delete would do; if any table has blocking rows it does nothing.
        """
        out = None
        for name in self.tables:
            nulled, blocking = F.lit(0), F.lit(0)
            for flag, r in self._of(name):
                if r.on_delete == "set null":
                    nulled = nulled + (F.col(flag) & ~F.col(_GONE)).cast("int")
                blocking = blocking + self._blocks(flag, r).cast("int")
            row = self._marked(name).agg(
                F.count(F.lit(1)).alias("rows"), F.count_if(F.col(_GONE)).alias("rows_removed"), F.count_if(~F.col(_GONE)).alias("rows_left"),
                F.coalesce(F.sum(nulled), F.lit(0)).cast("long").alias("keys_nulled"), F.count_if(blocking > 0).alias("rows_blocking"),
            ).select(F.lit(name).alias("table_name"), "*")
            out = row if out is None else out.unionByName(row)
        return out

    def left(self, name: str) -> DataFrame:
        """The rows of a table that stay, references to removed rows set to null where the relation says so."""
        df = self._marked(name).where(~F.col(_GONE))
        nulled = {r.column: flag for flag, r in self._of(name) if r.on_delete == "set null"}
        return df.select(*[F.when(~F.col(nulled[c]), F.col(c)).alias(c) if c in nulled else F.col(c) for c in self.tables[name].columns])

    def apply(self) -> dict[str, DataFrame]:
        """The snapshots after the delete; raises ``DeleteBlocked`` if a relation forbids it."""
        held = [f"{r.relation} ({r.rows} rows)" for r in self.blocking().groupBy("relation").agg(F.sum("rows").alias("rows")).collect()]
        if held:
            raise DeleteBlocked(f"delete blocked by {', '.join(sorted(held))}")
        return {name: self.left(name) for name in self.tables}


def plan_delete(tables: Mapping[str, DataFrame], relations: Iterable[Relation], roots: Mapping[str, Column]) -> DeletePlan:
    """Follows the relations from the rows that ``roots`` (predicates by table) remove, down to all rows affected."""
    unknown = set(roots) - set(tables)
    if unknown:
        raise KeyError(f"no such table: {sorted(unknown)}")
    relations = [r for r in relations if r.child in tables and r.parent in tables]
    plan = DeletePlan(dict(tables), relations, dict(roots))
    cascades = [r for r in relations if r.on_delete == "cascade"]

    def removed_keys(name: str) -> dict[tuple[str, str], DataFrame]:
        """Distinct non-null removed values of the columns of a table that relations point to."""
        if name not in plan.roots and not any(r.child == name and (r.parent, r.parent_column) in plan.keys for r in cascades):
            return {}  # nothing of it can go
        columns = sorted({r.parent_column for r in relations if r.parent == name})
        gone = plan._marked(name).where(F.col(_GONE))
        return {(name, c): cut_lineage(gone.select(F.col(c).alias("key")).where("key IS NOT NULL").distinct()) for c in columns}

    for group in visiting_order(tables, cascades):
        circular = len(group) > 1 or any(r.child == r.parent == group[0] for r in cascades)
        while True:
            before = dict(plan._held)
            for name in group:
                found = removed_keys(name)
                plan.keys.update(found)
                plan._held.update({k: v.count() for k, v in found.items()})
            if not circular or before == plan._held:
                break
    return plan
