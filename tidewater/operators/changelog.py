"""Ordered change scripts as one fold per row, with the audit rows of every step.

A script is a list of statements -- update, insert, delete, note -- over several tables, in the order in which they are
to take effect. Statements of one table do not make a snapshot each: every row is carried through all of them in
one scan, as a state (its columns, since which step it exists, at which step it went) that each step may change. Predicates and
assignments see the row as the steps before left it; rows inserted at a step are met by later steps only. The
audit rows that triggers would have written come from the same pass, numbered by step.

Inserted keys are checked like a primary key: a row may not be inserted while another of its key lives. Only the keys
that a script inserts are looked up; nothing is applied if any of them clashes.

A predicate that is null matches nothing; repeated rows are each changed; audit values are text, null where the script says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import _matched

AUDIT = "step int, key long, action string, table_name string, old_value string, new_value string"
_BORN, _DIED = "_tw_born", "_tw_died"


@dataclass(frozen=True)
class Update:
    """``UPDATE table SET set WHERE where``; ``old`` is read before the assignments, ``new`` after them."""

    table: str
    where: Column
    set: Mapping[str, Column]
    old: Column | None = None
    new: Column | None = None


@dataclass(frozen=True)
class Insert:
    """Rows for a table, by column name; missing columns are null."""

    table: str
    rows: DataFrame
    new: Column | None = None


@dataclass(frozen=True)
class Delete:
    """``DELETE FROM table WHERE where``; with ``old`` each deleted row leaves an audit row."""

    table: str
    where: Column
    old: Column | None = None
    new: Column | None = None


@dataclass(frozen=True)
class Note:
    """An audit row written by hand."""

    action: str
    table: str
    old: str | None = None
    new: str | None = None


class KeyClash(ValueError):
    """A script inserts a key that exists at that step; nothing was applied."""


@dataclass
class ScriptResult:
    tables: dict[str, DataFrame]
    keys: Mapping[str, str]
    staged: dict[str, DataFrame] = field(default_factory=dict)
    notes: DataFrame | None = None
    inserts: dict[str, DataFrame] = field(default_factory=dict)

    def clashes(self) -> DataFrame:
        """(table_name, key, step): inserted keys of which another row lives at that step."""
        out = None
        for name, inserted in self.inserts.items():
            key = self.keys[name]
            new = inserted.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"), F.col(_BORN).alias("step")).agg(F.count(F.lit(1)).alias("n"))
            lives = self.staged[name].select(F.col(key).alias("_key"), _BORN, F.coalesce(_DIED, F.lit(2**31 - 1)).alias(_DIED))
            met = new.join(lives, (F.col("key") == F.col("_key")) & (F.col(_BORN) < F.col("step")) & (F.col("step") <= F.col(_DIED)), "left_semi")
            rows = met.unionByName(new.where("n > 1")).select(F.lit(name).alias("table_name"), F.col("key").cast("long").alias("key"), "step").distinct()
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else next(iter(self.tables.values())).sparkSession.createDataFrame([], "table_name string, key long, step int")

    def check(self) -> None:
        """Raises if an inserted key exists at its step (one action over the inserted keys)."""
        found = self.clashes().limit(5).collect()
        if found:
            raise KeyClash(f"inserted keys exist: {[(r.table_name, r.key, r.step) for r in found]}")

    def snapshot(self, name: str) -> DataFrame:
        """The rows of a table after the last step."""
        if name not in self.staged:
            return self.tables[name]
        return self.staged[name].where(F.col(_DIED).isNull()).select(*self.tables[name].columns)

    def audit(self) -> DataFrame:
        """The audit rows of all steps (``AUDIT``)."""
        out = self.notes
        for name, df in self.staged.items():
            entries = [c for c in df.columns if c.startswith("_tw_entry")]
            if not entries:
                continue
            log = F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")
            rows = df.select(F.col(self.keys[name]).cast("long").alias("key"), log).select(
                "e.step", "key", "e.action", F.lit(name).alias("table_name"), "e.old_value", "e.new_value")
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else next(iter(self.tables.values())).sparkSession.createDataFrame([], AUDIT)


def _text(value: Column | None) -> Column:
    return F.lit(None).cast("string") if value is None else value.cast("string")


def _entry(step: int, action: str, old: Column, new: Column) -> Column:
    return F.struct(F.lit(step).alias("step"), F.lit(action).alias("action"), old.alias("old_value"), new.alias("new_value"))


def run_script(tables: Mapping[str, DataFrame], keys: Mapping[str, str], script: Sequence[Update | Insert | Delete | Note]) -> ScriptResult:
    """Folds the script over the tables; steps are numbered from 1. ``keys`` names each table's key column."""
    for s in script:
        if not isinstance(s, Note) and s.table not in tables:
            raise KeyError(f"no such table: {s.table}")
    result = ScriptResult(dict(tables), dict(keys))
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        steps = [(i, s) for i, s in enumerate(script, 1) if not isinstance(s, Note) and s.table == name]
        if not steps:
            continue
        columns = df.columns
        state = df.withColumn(_BORN, F.lit(0))
        for i, s in steps:
            if isinstance(s, Insert):
                rows = s.rows.withColumn(_BORN, F.lit(i))
                if set(s.rows.columns) - set(columns):
                    raise KeyError(f"{name} has no columns {sorted(set(s.rows.columns) - set(columns))}")
                mine = result.inserts.get(name)
                result.inserts[name] = rows if mine is None else mine.unionByName(rows, allowMissingColumns=True)
                state = state.unionByName(rows, allowMissingColumns=True)
        state = state.withColumn(_DIED, F.lit(None).cast("int"))
        for i, s in steps:
            if isinstance(s, Insert):
                if s.new is not None:
                    state = state.withColumn(f"_tw_entry{i}", F.when(F.col(_BORN) == i, _entry(i, "INSERT", _text(None), _text(s.new))))
                continue
            hit = (F.col(_BORN) < i) & F.col(_DIED).isNull() & _matched(s.where)
            if isinstance(s, Delete):
                if s.old is not None:
                    state = state.withColumn(f"_tw_entry{i}", F.when(hit, _entry(i, "DELETE", _text(s.old), _text(s.new))))
                state = state.withColumn(_DIED, F.when(hit, F.lit(i)).otherwise(F.col(_DIED)))
                continue
            unknown = set(s.set) - set(columns)
            if unknown:
                raise KeyError(f"{name} has no columns {sorted(unknown)}")
            # all right-hand sides see the row as it was
            state = state.withColumns({"_tw_hit": hit, "_tw_old": _text(s.old), **{f"_tw_set_{c}": e for c, e in s.set.items()}})
            state = state.withColumns({c: F.when(F.col("_tw_hit"), F.col(f"_tw_set_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in s.set})
            if s.old is not None or s.new is not None:
                state = state.withColumn(f"_tw_entry{i}", F.when(F.col("_tw_hit"), _entry(i, "UPDATE", F.col("_tw_old"), _text(s.new))))
            state = state.drop("_tw_hit", "_tw_old", *[f"_tw_set_{c}" for c in s.set])
        result.staged[name] = state
    notes = [(i, None, s.action, s.table, s.old, s.new) for i, s in enumerate(script, 1) if isinstance(s, Note)]
    result.notes = spark.createDataFrame(notes, AUDIT) if notes else None
    return result
