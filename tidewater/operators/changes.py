"""Change jobs on snapshots.

Tables are immutable snapshots: an update or delete is a new ``DataFrame`` (written as a
new snapshot by the caller), and the audit rows that a trigger would have written are
produced by the same pass. Predicates are null-safe: a row whose predicate is null is
not matched, as in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("key", "action", "table_name", "old_value", "new_value")


def _matched(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


@dataclass(frozen=True)
class AuditSpec:
    """How one matched row becomes an audit row (like an AFTER UPDATE trigger body)."""

    table_name: str
    key: str
    old_value: Column | None = None  # expression over the *old* row; default: the changed column
    new_value: Column | None = None  # expression over the *new* row
    changed_only: bool = False  # the reference's triggers log every matched row


def update_where(df: DataFrame, pred: Column, assignments: dict[str, Column], audit: AuditSpec | None = None):
    """``UPDATE t SET col = expr WHERE pred`` as a new snapshot (+ audit rows).

    Returns ``snapshot`` or ``(snapshot, audit_rows)``. Both come from one scan: the old
    value and the new value are two expressions over the same row, so no join of old and
    new snapshots is needed.
    """
    hit = _matched(pred)
    staged = df.withColumn("_hit", hit)
    for c, expr in assignments.items():
        staged = staged.withColumn(f"_new_{c}", F.when(F.col("_hit"), expr).otherwise(F.col(c)))
    snapshot = staged.select(*[F.col(f"_new_{c}").alias(c) if c in assignments else F.col(c) for c in df.columns])
    if audit is None:
        return snapshot
    first = next(iter(assignments))
    old_v = audit.old_value if audit.old_value is not None else F.col(first).cast("string")
    new_row = {c: F.col(f"_new_{c}") for c in assignments}
    new_v = audit.new_value(new_row) if callable(audit.new_value) else (
        audit.new_value if audit.new_value is not None else F.col(f"_new_{first}").cast("string"))
    rows = staged.where(F.col("_hit"))
    if audit.changed_only:
        rows = rows.where(~F.col(first).eqNullSafe(F.col(f"_new_{first}")))
    audit_rows = rows.select(
        F.col(audit.key).alias("key"), F.lit("UPDATE").alias("action"), F.lit(audit.table_name).alias("table_name"),
        old_v.alias("old_value"), new_v.alias("new_value"),
    )
    return snapshot, audit_rows


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """D13 for changes made elsewhere: rows whose columns differ between two snapshots.

    Full outer join on the key; inserted and deleted keys are reported as such.
    """
    key = list(key)
    o = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in columns]).withColumn("_in_old", F.lit(True))
    n = new.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns]).withColumn("_in_new", F.lit(True))
    j = o.join(n, key, "full_outer")
    changed = None
    for c in columns:
        d = ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
        changed = d if changed is None else (changed | d)
    action = (F.when(F.col("_in_old").isNull(), "INSERT").when(F.col("_in_new").isNull(), "DELETE")
              .otherwise("UPDATE"))
    old_txt = F.to_json(F.struct(*[F.col(f"_old_{c}").alias(c) for c in columns]))
    new_txt = F.to_json(F.struct(*[F.col(f"_new_{c}").alias(c) for c in columns]))
    return j.where(F.col("_in_old").isNull() | F.col("_in_new").isNull() | changed).select(
        *key, action.alias("action"),
        F.when(F.col("_in_old").isNotNull(), old_txt).alias("old_value"),
        F.when(F.col("_in_new").isNotNull(), new_txt).alias("new_value"),
    )


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """D3: rows for which ``pred`` is not true remain."""
    return df.where(~_matched(pred))


def deleted_keys(df: DataFrame, pred: Column, key: str) -> DataFrame:
    return df.where(_matched(pred)).select(key)


def cascade_delete(child: DataFrame, child_key: str, removed_keys: DataFrame, parent_key: str) -> DataFrame:
    """ON DELETE CASCADE -- child rows of removed parents go too."""
    gone = removed_keys.select(F.col(parent_key).alias(child_key)).distinct()
    return child.join(gone, child_key, "left_anti")


def set_null_on_delete(child: DataFrame, child_key: str, removed_keys: DataFrame, parent_key: str) -> DataFrame:
    """ON DELETE SET NULL -- the child's reference becomes null."""
    gone = removed_keys.select(F.col(parent_key).alias("_gone")).distinct().withColumn("_hit", F.lit(True))
    j = child.join(gone, child[child_key] == gone["_gone"], "left")
    return j.select(*[F.when(F.col("_hit"), F.lit(None).cast(child.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                      if c == child_key else F.col(c) for c in child.columns])


def restrict_violations(child: DataFrame, child_key: str, removed_keys: DataFrame, parent_key: str) -> DataFrame:
    """ON DELETE RESTRICT -- child rows that block the delete (empty means allowed)."""
    gone = removed_keys.select(F.col(parent_key).alias(child_key))
    return child.join(gone, child_key, "left_semi")


def assert_allowed(violations: DataFrame) -> None:
    """Raise when any child blocks the delete (one tiny action)."""
    if violations.limit(1).count() > 0:
        raise ValueError("delete restricted: child rows reference the removed keys")


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column DEFAULTs for missing values (``CURRENT_TIMESTAMP`` via a Column)."""
    def default(v):
        return v if isinstance(v, Column) else F.lit(v)
    return df.select(*[F.coalesce(F.col(c), default(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name."""
    return table.unionByName(rows)


def one_to_one_check(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Row counts of both sides plus keys missing on either side, one row."""
    lk = left.select(F.col(left_key).alias("k")).withColumn("_l", F.lit(1))
    rk = right.select(F.col(right_key).alias("k")).withColumn("_r", F.lit(1))
    lc = lk.groupBy("k").agg(F.count(F.lit(1)).alias("_ln"))
    rc = rk.groupBy("k").agg(F.count(F.lit(1)).alias("_rn"))
    j = lc.join(rc, "k", "full_outer")
    return j.agg(
        F.coalesce(F.sum("_ln"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("_rn"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("_rn").isNull()).alias("missing_on_right"),
        F.count_if(F.col("_ln").isNull()).alias("missing_on_left"),
        F.count_if((F.col("_ln") > 1) | (F.col("_rn") > 1)).alias("keys_not_one_to_one"),
    )
