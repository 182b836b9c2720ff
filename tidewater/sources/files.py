"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, null_values=("Not Available",),
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema.

    Every sentinel maps to null: a single one by the reader itself, several after the columns
    were read as text, before they are cast to the declared types.
    Numbers that fail to parse become null (PERMISSIVE), like a coercing reader.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if len(null_values) <= 1:
        reader = reader.option("nullValue", null_values[0]) if null_values else reader
        return reader.schema(schema).csv(path)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared.fields])
    raw = reader.schema(text).csv(path)
    known = lambda c: F.when(~F.col(c).isin(*null_values), F.col(c))
    return raw.select(*(known(f.name).try_cast(f.dataType).alias(f.name) for f in declared.fields))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header and no index column; one file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Export a named dataset."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def register_dataset(df: DataFrame, name: str) -> DataFrame:
    """A named dataset (view) usable from ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return df
