"""Latest value per key as a table in hash buckets, of which a micro-batch rewrites the touched ones only (ST1).

Layout below ``root``:

* ``data/version=N/bucket=B`` -- the rows of bucket B as batch N left them;
* ``manifest/version=N``      -- one row per bucket that has rows: which version holds it now.

Batch N reads the newest manifest before N, the old rows of the buckets its keys fall into, and writes these buckets anew
under its own version; then its manifest. What it writes is bounded by the touched buckets, not by the
table. A manifest has at most ``buckets`` rows and is the only thing read on the driver. Readers take the newest
manifest, so a batch without one has not happened; a replayed batch starts from the same older manifest and
overwrites its own folders. ``expire`` removes the bucket folders that none of the last manifests names.

A bucket is written by one task: choose ``buckets`` so that one holds some hundred megabytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "bucket int, holder long, version long"


class KeyedSnapshot:
    def __init__(self, spark: SparkSession, root: str, schema: str, key: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, list(key), buckets
        self.columns = spark.createDataFrame([], schema).columns

    def bucket(self) -> Column:
        """The bucket of a row; a null key has one like any other."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException:  # no version yet
            return self.spark.createDataFrame([], MANIFEST)

    def versions(self) -> list[int]:
        """Numbers of the versions that have a manifest, ascending."""
        return sorted(r.version for r in self._manifests().select("version").distinct().collect())

    def holders(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> version that holds it, by the newest manifest (older than ``before``)."""
        found = self._manifests()
        if before is not None:
            found = found.where(F.col("version") < before)
        newest = found.agg(F.max("version")).first()[0]
        return {} if newest is None else {r.bucket: r.holder for r in found.where(F.col("version") == newest).collect()}

    def read(self, holders: dict[int, int] | None = None) -> DataFrame:
        """The rows of the buckets named (all of the newest version by default)."""
        holders = self.holders() if holders is None else holders
        if not holders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/version={v}/bucket={b}" for b, v in sorted(holders.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, batch: DataFrame) -> list[int]:
        """Buckets that the keys of a batch fall into."""
        return sorted(r.bucket for r in batch.select(self.bucket().alias("bucket")).distinct().collect())

    def before(self, batch: DataFrame, version: int) -> DataFrame:
        """The stored rows that a batch of keys can meet: its buckets, as they were before ``version``."""
        touched = set(self.touched(batch))
        return self.read({b: v for b, v in self.holders(version).items() if b in touched})

    def write(self, rows: DataFrame, version: int) -> list[int]:
        """Writes whole buckets under ``version`` and its manifest; returns the buckets written."""
        data = f"{self.root}/data/version={version}"
        dealt = rows.select(*self.columns).withColumn("bucket", self.bucket())
        dealt.repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        try:
            written = sorted(int(r.bucket) for r in self.spark.read.parquet(data).select("bucket").distinct().collect())
        except AnalysisException:  # an empty batch leaves no file
            written = []
        holders = {**self.holders(version), **dict.fromkeys(written, version)}
        if holders:
            table = self.spark.createDataFrame([(b, v, version) for b, v in sorted(holders.items())], MANIFEST)
            table.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{self.root}/manifest")
        return written

    def expire(self, keep: int = 2) -> int:
        """Removes what the last ``keep`` manifests do not name; returns how many bucket folders went.

        ``keep`` of 2 or more lets the last batch be replayed.
        """
        if keep < 1:
            raise ValueError("the newest version must be kept")
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        if not old:
            return 0
        found = self._manifests().select("version", "bucket", "holder").collect()  # buckets x versions not yet expired
        named = {(r.holder, r.bucket) for r in found if r.version in kept}
        gone = {(r.holder, r.bucket) for r in found} - named
        for holder, bucket in gone:
            self._delete(f"{self.root}/data/version={holder}/bucket={bucket}")
        for version in old:
            self._delete(f"{self.root}/manifest/version={version}")
        return len(gone)

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
