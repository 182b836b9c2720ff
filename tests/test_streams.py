"""Streams (fixture: stream -- duplicates, late rows beyond the watermark, replayed batch)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from tidewater.sources.tables import REGISTRY
from tidewater.streaming import streams as ST
from tidewater.streaming.snapshots import KeyedSnapshot


def write_batches(spark, root, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, REGISTRY["events"].schema).coalesce(1).write.mode("overwrite") \
            .parquet(f"{root}/in/part={i:03d}")
    return f"{root}/in"


def ev(i, minute, user, value, day=1):
    return (i, dt.datetime(2024, 1, day, 0, 0) + dt.timedelta(minutes=minute), user, "click", value, '{"k": 1}')


def stored(spark, root, buckets=64):
    return KeyedSnapshot(spark, root, "user_id long, value double, ts timestamp, event_id long", ["user_id"], buckets)


def test_windowed_volume_final_state_equals_batch(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0), ev(2, 70, 2, 2.0)], [ev(3, 10, 1, 3.0, day=2)]])
    stream = ST.event_stream(spark, src, max_files_per_trigger=1)
    ST.run_available_now(ST.windowed_volume(stream), f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="complete")
    got = {(r.window_start.day, r.events, r.total_value) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {(1, 2, 3.0), (2, 1, 3.0)}


def test_late_rows_beyond_watermark_are_dropped_in_append_mode(spark, tmp_dir):
    # batch 1 moves the watermark past day 1; late rows are judged against the watermark of the
    # batch before the current one, so the day-1 row of batch 3 is the one that is too late
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0)], [ev(2, 0, 1, 1.0, day=3)], [ev(5, 0, 1, 1.0, day=4)],
                                         [ev(3, 6, 1, 5.0)], [ev(4, 0, 1, 1.0, day=6)]])
    stream = ST.event_stream(spark, src, max_files_per_trigger=1)
    ST.run_available_now(ST.windowed_volume(stream, "1 day", "1 hour"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    rows = {(r.window_start.day, r.events) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert (1, 1) in rows and (1, 2) not in rows


def test_dedup_within_watermark(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0), ev(1, 5, 1, 1.0)], [ev(1, 6, 1, 1.0), ev(2, 7, 2, 2.0)]])
    stream = ST.event_stream(spark, src, max_files_per_trigger=1)
    ST.run_available_now(ST.deduplicated(stream), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == [1, 2]


def test_audit_stream_inserts_updates_and_replay_is_idempotent(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0), ev(2, 6, 1, 2.0), ev(3, 7, 2, 9.0)],
                                         [ev(4, 8, 1, 4.0)]])
    stream = ST.event_stream(spark, src, max_files_per_trigger=1)
    root = f"{tmp_dir}/audit"
    ST.run_audit_stream(stream, root, f"{tmp_dir}/ck")
    audit = {(r.batch_id, r.user_id, r.action, r.old_value, r.new_value)
             for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit == {(0, 1, "INSERT", None, "2.0"), (0, 2, "INSERT", None, "9.0"), (1, 1, "UPDATE", "2.0", "4.0")}
    # replay batch 1 by hand: same partitions, same content
    apply = ST.audit_stream(stream, root)
    batch1 = spark.createDataFrame([ev(4, 8, 1, 4.0)], REGISTRY["events"].schema)
    apply(batch1, 1)
    again = {(r.batch_id, r.user_id, r.action, r.old_value, r.new_value)
             for r in spark.read.parquet(f"{root}/audit").collect()}
    assert again == audit
    snap = stored(spark, f"{root}/snapshot").read()
    assert {(r.user_id, r.value) for r in snap.collect()} == {(1, 4.0), (2, 9.0)}


def test_windowed_volume_with_approximate_users(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0), ev(2, 6, 2, 1.0), ev(3, 7, 2, 1.0)]])
    stream = ST.event_stream(spark, src)
    ST.run_available_now(ST.windowed_volume(stream, approx_users=True), f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="complete")
    r = spark.read.parquet(f"{tmp_dir}/out").first()
    assert (r.events, r.approx_users) == (3, 2)


def test_late_events_and_null_values_in_the_audit_stream(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 50, 1, 20.0), ev(2, 50, 2, None), ev(3, 50, None, 1.0)],
                                         [ev(4, 8, 1, 10.0), ev(5, 60, 2, 3.0), ev(6, 60, None, 2.0)]])
    stream = ST.event_stream(spark, src, max_files_per_trigger=1)
    root = f"{tmp_dir}/audit"
    ST.run_audit_stream(stream, root, f"{tmp_dir}/ck")
    audit = {(r.batch_id, r.user_id, r.action, r.old_value, r.new_value) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit == {(0, 1, "INSERT", None, "20.0"), (0, 2, "INSERT", None, None), (0, None, "INSERT", None, "1.0"),
                     (1, 2, "UPDATE", None, "3.0"), (1, None, "UPDATE", "1.0", "2.0")}
    snap = stored(spark, f"{root}/snapshot").read()
    assert {(r.user_id, r.value) for r in snap.collect()} == {(1, 20.0), (2, 3.0), (None, 2.0)}


def test_update_mode_is_refused(spark, tmp_dir):
    src = write_batches(spark, tmp_dir, [[ev(1, 5, 1, 1.0)]])
    volume = ST.windowed_volume(ST.event_stream(spark, src))
    with pytest.raises(ValueError):
        ST.run_available_now(volume, f"{tmp_dir}/out", f"{tmp_dir}/ck", mode="update")


def pairs(df):
    return sorted(map(tuple, df.select("k", "v").collect()), key=repr)


def test_snapshot_rewrites_touched_buckets_only(spark, tmp_dir):
    snap = KeyedSnapshot(spark, f"{tmp_dir}/s", "k long, v string", ["k"], buckets=8)
    assert snap.versions() == [] and snap.read().count() == 0 and snap.before(spark.createDataFrame([(1,)], "k long"), 0).count() == 0
    first = spark.createDataFrame([(i, "a") for i in [None, *range(40)]], "k long, v string")
    assert snap.write(first, 0) == list(range(8)) and pairs(snap.read()) == pairs(first)
    change = spark.createDataFrame([(7, "b")], "k long, v string")
    touched = snap.touched(change)
    old = snap.before(change, 1)
    assert len(touched) == 1 and 0 < old.count() < 41 and old.where("k = 7").count() == 1
    merged = old.where("k <> 7 OR k IS NULL").unionByName(change)
    for _ in range(2):  # the second time is a replay
        assert snap.write(merged, 1) == touched
        assert sorted(set(snap.holders().values())) == [0, 1] and [b for b, v in snap.holders().items() if v == 1] == touched
        assert pairs(snap.read()) == pairs(first.where("k <> 7 OR k IS NULL").unionByName(change))
        assert pairs(snap.read(snap.holders(before=1))) == pairs(first)
    assert os.listdir(f"{tmp_dir}/s/data/version=1") and len([d for d in os.listdir(f"{tmp_dir}/s/data/version=1") if d.startswith("bucket=")]) == 1
    # an empty batch changes nothing
    before = pairs(snap.read())
    assert snap.write(change.limit(0), 2) == [] and pairs(snap.read()) == before and snap.versions() == [0, 1, 2]
    # version 0 keeps the buckets that are still read
    assert snap.expire(keep=3) == 0 and pairs(snap.read(snap.holders(before=1))) == pairs(first)
    assert snap.expire(keep=2) == 1 and pairs(snap.read()) == before and snap.versions() == [1, 2]
    assert snap.expire(keep=1) == 0 and pairs(snap.read()) == before and snap.versions() == [2]
    left = [d for d in os.listdir(f"{tmp_dir}/s/data/version=0") if d.startswith("bucket=")]
    assert len(left) == 7 and f"bucket={touched[0]}" not in left
    with pytest.raises(ValueError):
        snap.expire(0)


def test_replayed_batches_of_a_bucketed_audit_stream(spark, tmp_dir):
    root = f"{tmp_dir}/audit"
    batches = [[ev(10 * b + i, 5 * b + i, (7 * b + i) % 6, float(b)) for i in range(4)] for b in range(4)]
    frames = [spark.createDataFrame(x, REGISTRY["events"].schema).withColumn("ts", F.col("ts").cast("timestamp")) for x in batches]
    apply = ST.audit_stream(frames[0], root, buckets=4)
    for b in (0, 1, 1, 2, 3, 3):
        apply(frames[b], b)
    last = {}
    for x in batches:
        for e in x:
            last[e[2]] = max(last.get(e[2], e[1:2] + e[0:1] + (e[4],)), e[1:2] + e[0:1] + (e[4],))
    assert {(r.user_id, r.value) for r in stored(spark, f"{root}/snapshot", 4).read().collect()} == {(u, v[2]) for u, v in last.items()}
    assert len(stored(spark, f"{root}/snapshot", 4).versions()) == 2
