"""Shared helpers of the training-data operators: inputs, written tables in the shared folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


TOKENIZER = _tokenizer_path()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewater_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, path = tempfile.mkstemp(prefix="tidewater-", suffix=".zip")  # read by the driver only, which serves it
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tidewater", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tidewater_shipped = True


def shuffle_slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame) -> DataFrame:
    """The columns under plain numbered names, so that names of any kind, even equal ones, pass through Arrow."""
    return df.toDF(*(f"c_{i}" for i in range(len(df.columns))))


def first_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; where a name occurs more than once its first column counts."""
    slim = numbered(df)
    return slim.select(*(F.col(f"c_{df.columns.index(name)}").alias(name) for name in names))


def map_rows(df: DataFrame, function, *added: tuple[str, T.DataType], drop: int = 0) -> DataFrame:
    """All columns of ``df``, numbered, through ``function(batch) -> batch``; ``added`` columns come after them.

    The last ``drop`` columns of ``df`` are read by ``function`` but not returned.
    """
    slim = numbered(df)
    schema = T.StructType([*slim.schema.fields[: len(slim.schema.fields) - drop], *(T.StructField(name, kind) for name, kind in added)])

    def each(batches):
        for batch in batches:
            yield from function(batch)

    return slim.mapInArrow(each, schema)


#: A key counts as hot from this share of all rows on, so there are fewer hot keys than this.
HOT_SHARE = 4096


def join_unique(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """``left`` (written tables) joined with the one row of ``right`` per ``key``; column ``rows`` of it counts the key's rows in ``left``.

    Keys with over 1 / ``HOT_SHARE`` of all rows are fewer than ``HOT_SHARE``, so their rows of ``right`` are broadcast
    and the rows of ``left`` stay where they are. The others are shuffled; none of them can fill a task.
    """
    total = int(right.agg(F.sum(rows)).first()[0] or 0)
    hot = F.broadcast(right.where(F.col(rows) * HOT_SHARE > F.lit(total)))
    cold = right.where(F.col(rows) * HOT_SHARE <= F.lit(total))
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return left.join(hot, key).unionByName(rest)


def text_column(df: DataFrame) -> int:
    return df.columns.index("text")


class Workspace:
    """A folder of one run below the shared checkpoint folder, for tables that are read more than once."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def write(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Writes ``df`` as zstd Parquet and returns the table read back (lineage ends here)."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{label}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._workspace_path = path
        return out

    def tidy(self) -> None:
        """Lets Spark's cleaner remove the shuffle files of steps whose results are written: it follows the driver's garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        """Removes a table of this workspace that nothing reads any more."""
        path = getattr(df, "_workspace_path", None)
        if path is None:
            return
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
