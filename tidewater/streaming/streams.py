"""Structured Streaming forms of three batch jobs (ST1-ST3).

* ST1 ``audit_stream``: each micro-batch of value changes is applied to the current
  snapshot (latest value per key, in hash buckets of which only touched ones are rewritten) and writes
  audit rows; outputs are versioned by batch id and overwritten on replay, so a re-run batch gives the same files.
* ST2 ``windowed_volume``: tumbling-window counts per event type with a watermark; rows
  later than the watermark are dropped and closed windows leave the state (append mode), or the whole
  state equals the batch aggregate (complete mode).
* ST3 ``deduplicated``: ``dropDuplicatesWithinWatermark`` on the event key.

Sinks write files into the shared checkpoint folder named by the session; nothing is
collected into the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.tables import REGISTRY
from .snapshots import KeyedSnapshot


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one streaming run."""
    return f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Event files (parquet) as a stream with the declared schema.

    ``path`` is a folder of event files or one file (read through a glob on its folder).
    Event time becomes TIMESTAMP (watermarks need it; the session zone is UTC).
    """
    reader = spark.readStream.schema(REGISTRY["events"].schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path.endswith(".parquet"):
        folder, name = path.rsplit("/", 1)
        reader = reader.option("basePath", folder)
        path = f"{folder}/{name[:-len('.parquet')]}[.]parquet"
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_volume(stream: DataFrame, window: str = "1 day", watermark: str = "1 hour",
                    approx_users: bool = False) -> DataFrame:
    """ST2: events and value per tumbling window and type; exact distinct is not allowed in a stream."""
    aggs = [F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")]
    if approx_users:
        aggs.append(F.approx_count_distinct("user_id").alias("approx_users"))
    return stream.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), "event_type").agg(*aggs) \
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                F.col("w.end").cast("timestamp_ntz").alias("window_end"), "event_type", "events",
                F.col("total_value").cast("double").alias("total_value"), *(["approx_users"] if approx_users else []))


def deduplicated(stream: DataFrame, key: str = "event_id", watermark: str = "10 minutes") -> DataFrame:
    """ST3: drop repeated keys seen within the watermark delay."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available, write parquet batches, stop."""
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint) \
            .outputMode("append").trigger(availableNow=True).start()
    elif mode == "complete":
        def write(batch: DataFrame, batch_id: int) -> None:
            # the complete result of this trigger replaces the previous one
            batch.write.mode("overwrite").parquet(out_path)
        q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode) \
            .trigger(availableNow=True).start()
    else:  # an update holds changed rows only; files that replace each other would lose the rest
        raise ValueError(f"output mode {mode!r}: append and complete are supported")
    q.awaitTermination()


def _write_version(df: DataFrame, root: str, batch_id: int) -> None:
    """Write (or on replay, rewrite) the ``batch_id`` partition only."""
    df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(root)


def audit_stream(stream: DataFrame, root: str, key: str = "user_id", value: str = "value", order: str = "ts",
                 tiebreak: str = "event_id", buckets: int = 64, keep: int = 2):
    """ST1: returns a ``foreachBatch`` function applying each batch to the snapshot with audit rows.

    For every key in the batch its last value (by ``order`` then ``tiebreak``) replaces the
    snapshot value if it is later than the one stored there, so a late event never undoes a newer one
    and leaves no audit row. Audit rows say INSERT (new key) or UPDATE (old -> new value); a key whose
    stored value is null is known all the same, and a null key is a key like any other. The snapshot lies in hash
    buckets of the key (``snapshots.KeyedSnapshot``): a batch reads and rewrites the buckets of its keys only, and
    versions that the last ``keep`` manifests do not name are removed. A replayed batch starts from the
    same older version and rewrites its own folders: idempotent.
    """
    spark = stream.sparkSession
    columns = [key, value, order, tiebreak]
    types = dict(stream.select(*columns).dtypes)
    snapshot = KeyedSnapshot(spark, f"{root}/snapshot", ", ".join(f"`{c}` {types[c]}" for c in columns), [key], buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = F.max(F.struct(order, tiebreak, value)).alias("_v")
        last = batch.select(*[F.col(c).cast(types[c]).alias(c) for c in columns]).groupBy(key).agg(newest)
        last = cut_lineage(last.select(key, *[F.col(f"_v.{c}").alias(c) for c in columns[1:]]))  # read by keys, audit and merge
        old = snapshot.before(last, batch_id)
        stored = old.select(*[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_known"))
        j = last.join(stored, F.col(key).eqNullSafe(F.col(f"_old_{key}")), "left")
        j = j.where(F.col("_known").isNull()
                    | (F.struct(order, tiebreak) > F.struct(F.col(f"_old_{order}"), F.col(f"_old_{tiebreak}"))))
        audit = j.select(key, F.when(F.col("_known").isNull(), "INSERT").otherwise("UPDATE").alias("action"),
                         F.col(f"_old_{value}").cast("string").alias("old_value"), F.col(value).cast("string").alias("new_value"))
        _write_version(audit, f"{root}/audit", batch_id)
        latest = old.unionByName(last.select(*columns)).groupBy(key).agg(newest)
        snapshot.write(latest.select(key, *[F.col(f"_v.{c}").alias(c) for c in columns[1:]]), batch_id)
        snapshot.expire(keep)

    return apply


def run_audit_stream(stream: DataFrame, root: str, checkpoint: str, **kw) -> None:
    q = stream.writeStream.foreachBatch(audit_stream(stream, root, **kw)).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()


# ---------------------------------------------------------------- registered forms over the driver's events table

def _arrivals(spark: SparkSession, sf_dir: str, root: str, slices: int = 3):
    """Write the events into an input folder slice by slice (event_id modulo ``slices``, so times overlap and many
    events arrive late); yields after each slice has arrived."""
    events = spark.read.schema(REGISTRY["events"].schema).parquet(f"{sf_dir}/events.parquet")
    for i in range(slices):
        events.where(F.pmod("event_id", F.lit(slices)) == i).write.mode("append").parquet(f"{root}/in")
        yield i


def st1_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 over three arrivals of events: one micro-batch each, with inserts, updates and late events."""
    root = scratch_path(spark, "st1")
    for _ in _arrivals(spark, sf_dir, root):
        run_audit_stream(event_stream(spark, f"{root}/in"), root, f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/audit").select("batch_id", "user_id", "action", "old_value", "new_value")


def st1_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: the snapshot that the three arrivals leave: the last event of every user."""
    root = scratch_path(spark, "st1")
    for _ in _arrivals(spark, sf_dir, root):
        run_audit_stream(event_stream(spark, f"{root}/in"), root, f"{root}/_checkpoint")
    kept = KeyedSnapshot(spark, f"{root}/snapshot", "user_id long, value double, ts timestamp, event_id long", ["user_id"])
    return kept.read().select("user_id", "event_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


def st2_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 in append mode: windows are written once the watermark has passed their end, and their state is let go."""
    root = scratch_path(spark, "st2")
    run_available_now(windowed_volume(event_stream(spark, f"{sf_dir}/events.parquet")), f"{root}/out",
                      f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/out")


def st3_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 over the events and a second delivery of every third user's events."""
    root = scratch_path(spark, "st3")
    once = event_stream(spark, f"{sf_dir}/events.parquet")
    again = event_stream(spark, f"{sf_dir}/events.parquet").where(F.col("user_id") % 3 == 0)
    run_available_now(deduplicated(once.unionByName(again)), f"{root}/out", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*REGISTRY["events"].schema.fieldNames())
