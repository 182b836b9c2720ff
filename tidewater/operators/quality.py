"""Data-quality audits and inventories.

A constraint that a storage engine would enforce on write is checked here as a job
over the data: one aggregate pass per table for CHECK / NOT NULL / length rules, a
grouped count for keys, an anti-join for references. Results are rows
(table, rule, violations) so that any number of tables and rules stack into one frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import REGISTRY, TableSpec


def _stack(table: str, row: DataFrame, names: Sequence[str]) -> DataFrame:
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("rule"), F.col(f"`{n}`").cast("bigint").alias("violations"))
        for n in names
    ])).alias("kv")).select("kv.*")


def row_rules_audit(df: DataFrame, table: str, spec: TableSpec) -> DataFrame | None:
    """D7 + D9 + D11 in one pass: CHECK predicates (null passes), NOT NULL, max length."""
    aggs, names = [], []
    for name, pred in spec.checks.items():
        names.append(f"check:{name}")
        aggs.append(F.count_if(~F.coalesce(F.expr(pred), F.lit(True))).alias(names[-1]))
    for c in spec.not_null:
        names.append(f"not_null:{c}")
        aggs.append(F.count_if(F.col(c).isNull()).alias(names[-1]))
    for c, n in spec.max_length.items():
        names.append(f"max_length:{c}<={n}")
        aggs.append(F.count_if(F.length(c) > n).alias(names[-1]))
    if not aggs:
        return None
    return _stack(table, df.agg(*aggs), names)


def key_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (or hold a null), with their counts."""
    key = list(key)
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
    has_null = None
    for k in key:
        x = F.col(k).isNull()
        has_null = x if has_null is None else (has_null | x)
    return g.where((F.col("occurrences") > 1) | has_null)


def key_audit_summary(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    bad = key_audit(df, key)
    return bad.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("primary_key:" + ",".join(key)).alias("rule"), "violations")


def foreign_key_audit(tables: dict[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame | None:
    """Child rows without a parent for every declared reference of the tables, all references together.

    A table is read once for all its references: its rows give (reference, key) pairs, which are counted before they are
    shuffled, and the counts -- one row per key value, a hot key included -- meet the parents' keys in one anti-join.
    """
    references = [(i, t, c, p, pc) for i, (t, c, p, pc) in enumerate((t, *ref) for t in names or list(tables) for ref in REGISTRY[t].foreign_keys)]
    if not references:
        return None

    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def pair(i: int, column: str):
        return F.struct(F.lit(i).alias("ref"), F.col(column).cast("string").alias("key"))

    children = union([tables[t].select(F.explode(F.array(*[pair(i, c) for i, of, c, _, _ in references if of == t])).alias("x")).select("x.*")
                      for t in dict.fromkeys(r[1] for r in references)])
    parents = union([tables[p].select(pair(i, pc).alias("x")).select("x.*") for i, _, _, p, pc in references])
    counts = children.where(F.col("key").isNotNull()).groupBy("ref", "key").agg(F.count(F.lit(1)).alias("n"))
    orphaned = counts.join(parents, ["ref", "key"], "left_anti").groupBy("ref").agg(F.sum("n").alias("n"))
    rules = children.sparkSession.createDataFrame([(i, t, f"foreign_key:{c}->{p}.{pc}") for i, t, c, p, pc in references], "ref int, table_name string, rule string")
    return rules.join(F.broadcast(orphaned), "ref", "left").select(  # a row per declared reference at most
        "table_name", "rule", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))


def constraint_audit(tables: dict[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """D7-D11 for every registered table: rows (table_name, rule, violations)."""
    parts: list[DataFrame] = []
    for name in names or list(tables):
        spec = REGISTRY[name]
        df = tables[name]
        r = row_rules_audit(df, name, spec)
        if r is not None:
            parts.append(r)
        if spec.primary_key:
            parts.append(key_audit_summary(df, name, spec.primary_key))
    references = foreign_key_audit(tables, names)
    if references is not None:
        parts.append(references)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_inventory(tables: dict[str, DataFrame], large: int = 10_000, medium: int = 1_000) -> DataFrame:
    """Row count and a size class per table (one count job per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("size_class", F.when(F.col("row_count") >= large, "LARGE")
                          .when(F.col("row_count") >= medium, "MEDIUM").otherwise("SMALL"))


def requirement_dashboard(measures: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """Each requirement is (name, one-row frame with column ``value``, threshold).

    The status is computed from the measured value. A measure is (name, one-row frame, threshold) and must
    reach the threshold, or (.., "at most") and must not pass it.
    """
    parts = [m.select(F.lit(name).alias("requirement"), F.col("value").cast("bigint").alias("value"),
                      F.lit(threshold).cast("bigint").alias("threshold"))
             .withColumn("_at_most", F.lit(bool(at_most)))
             for name, m, threshold, *rest in measures for at_most in [rest == ["at most"]]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    met = F.when(F.col("_at_most"), F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))
    return out.withColumn("status", F.when(met, "PASS").otherwise("FAIL")).drop("_at_most")


# ---------------------------------------------------------------- schema-level helpers (driver side, no data read)

def frame_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and the type of every column, as rows (column, type, rows, columns)."""
    spark = df.sparkSession
    schema_rows = spark.createDataFrame([(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)],
                                        "column string, type string, position int")
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    return schema_rows.crossJoin(F.broadcast(n)).withColumn("columns", F.lit(len(df.columns)))


def column_inventory(tables: dict[str, DataFrame], type_names: Sequence[str] = (),
                     name_like: str | None = None) -> DataFrame:
    """Rows (table_name, column_name, data_type) for columns of given types or with a name LIKE the pattern."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    out = spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
    wanted = F.col("data_type").isin(list(type_names))
    return out.where(wanted | F.col("column_name").like(name_like) if name_like else wanted)


def select_by_type(df: DataFrame, kinds=(T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)):
    """P20: columns of the given Spark types."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))])


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the requested columns that exist, in the requested order."""
    return df.select(*[c for c in columns if c in df.columns])


def rename_required(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename, or fail when a source column is missing and the target is absent too."""
    for src, dst in mapping.items():
        if dst in df.columns:
            continue
        if src not in df.columns:
            raise ValueError(f"neither {dst!r} nor {src!r} found")
        df = df.withColumnRenamed(src, dst)
    return df


def non_constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass of exact distinct counts (nulls not counted) -> rows (column, n_distinct, keep)."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in columns
    ])).alias("kv")).select("kv.*").withColumn("keep", F.col("n_distinct") > 1)


def drop_constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P21 as a transformation: drop columns with fewer than two distinct non-null values.

    ``nunique() > 1`` is the same test as ``min < max`` over non-null values, which one plain
    aggregate pass answers (no per-column distinct state). Reads one row of flags on the driver.
    """
    row = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if not row[c]])
