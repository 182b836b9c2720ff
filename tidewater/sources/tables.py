"""Table registry and loaders.

Every table is declared with an explicit schema plus its keys and constraints, so
readers never infer types and the quality jobs know what to audit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(name, typ, True) for name, typ in cols])


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)
    not_null: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)  # rule name -> SQL predicate
    max_length: dict[str, int] = field(default_factory=dict)
    bounded_rows: int | None = None  # fixed domain size, independent of scale
    on_delete: dict[str, str] = field(default_factory=dict)  # foreign key column -> action; restrict if not named


REGISTRY: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        TableSpec("region", _schema(("r_regionkey", I), ("r_name", S)), ("r_regionkey",), bounded_rows=5),
        TableSpec(
            "nation",
            _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
            ("n_nationkey",),
            (("n_regionkey", "region", "r_regionkey"),),
            bounded_rows=25,
        ),
        TableSpec(
            "customer",
            _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)),
            ("c_custkey",),
            (("c_nationkey", "nation", "n_nationkey"),),
            not_null=("c_custkey", "c_name"),
            max_length={"c_name": 25, "c_mktsegment": 10},
            on_delete={"c_nationkey": "set null"},
        ),
        TableSpec(
            "supplier",
            _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
            ("s_suppkey",),
            (("s_nationkey", "nation", "n_nationkey"),),
            max_length={"s_name": 25},
            on_delete={"s_nationkey": "set null"},
        ),
        TableSpec(
            "part",
            _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I), ("p_retailprice", D)),
            ("p_partkey",),
            checks={"p_size_positive": "p_size > 0", "p_retailprice_positive": "p_retailprice > 0"},
        ),
        TableSpec(
            "orders",
            _schema(
                ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                ("o_orderdate", TS), ("o_orderpriority", S),
            ),
            ("o_orderkey",),
            (("o_custkey", "customer", "c_custkey"),),
            not_null=("o_orderkey", "o_custkey", "o_orderdate"),
            checks={"o_orderstatus_domain": "o_orderstatus IN ('F', 'O', 'P')"},
            max_length={"o_orderpriority": 15},
        ),
        TableSpec(
            "lineitem",
            _schema(
                ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I), ("l_quantity", D),
                ("l_extendedprice", D), ("l_discount", D), ("l_tax", D), ("l_returnflag", S), ("l_linestatus", S),
                ("l_shipdate", TS),
            ),
            ("l_orderkey", "l_linenumber"),
            (
                ("l_orderkey", "orders", "o_orderkey"),
                ("l_partkey", "part", "p_partkey"),
                ("l_suppkey", "supplier", "s_suppkey"),
            ),
            not_null=("l_orderkey", "l_partkey", "l_suppkey"),
            checks={
                "l_quantity_range": "l_quantity BETWEEN 1 AND 50",
                "l_discount_range": "l_discount BETWEEN 0 AND 0.1",
                "l_returnflag_domain": "l_returnflag IN ('A', 'N', 'R')",
            },
            on_delete={"l_orderkey": "cascade", "l_partkey": "cascade", "l_suppkey": "cascade"},
        ),
        TableSpec(
            "events",
            _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
            ("event_id",),
        ),
        TableSpec(
            "documents",
            _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
            ("doc_id",),
        ),
        TableSpec(
            "embeddings",
            _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
            ("vec_id",),
        ),
        TableSpec("pages", _schema(("page_id", L), ("url", S), ("html", S)), ("page_id",)),
        TableSpec("benchmark", _schema(("item_id", L), ("text", S)), ("item_id",)),
        TableSpec(
            "labels",
            _schema(("doc_id", L), ("quality", I), ("toxic", I)),
            ("doc_id",),
            (("doc_id", "documents", "doc_id"),),
            on_delete={"doc_id": "cascade"},
        ),
        TableSpec(
            "conversations",
            _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
            ("conv_id", "turn"),
        ),
    ]
}

TABLE_NAMES = tuple(REGISTRY)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the declared schema (no inference, no extra file listing)."""
    spec = REGISTRY[name]
    return spark.read.schema(spec.schema).parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a parquet scan of orders."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in REGISTRY:
            raise AttributeError(name)
        return load(self.spark, self.sf_dir, name)

    def all(self) -> dict[str, DataFrame]:
        return {name: load(self.spark, self.sf_dir, name) for name in TABLE_NAMES}


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Make every table queryable from ``spark.sql``."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def read_sql(spark: SparkSession, sf_dir: str, query: str, args: dict | None = None) -> DataFrame:
    """A query result as a frame; parameters are bound, never spliced into the text."""
    register_views(spark, sf_dir)
    return spark.sql(query, args=args) if args else spark.sql(query)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """S2 for an external database: partitioned JDBC read so the scan is parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    return reader.load()
