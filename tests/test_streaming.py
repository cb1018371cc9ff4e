"""Restartable streams: exactly-once epochs, new files only, failure recovery."""

import pytest
from pyspark.sql import functions as F

from tunelake.session import scratch_path
from tunelake.sinks.export import write_messages
from tunelake.streaming.events import decode_events
from tunelake.streaming.runner import (
    epoch_writer, read_epochs, read_topic, run_to_end, start_append, start_decode,
)


def _msgs(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.to_json(F.struct(F.col("id").cast("string").alias("event_id"))).alias("value"))


def test_restart_adds_only_new_files_and_never_duplicates(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 500).repartition(3), topic)
    for _ in range(2):   # second run on the same checkpoint finds nothing new
        run_to_end(start_append(read_topic(spark, topic, max_per_trigger=1), sink, ckpt,
                                decode_events))
    assert read_epochs(spark, sink).count() == 500
    write_messages(_msgs(spark, 500, 501), topic)
    run_to_end(start_append(read_topic(spark, topic), sink, ckpt, decode_events))
    out = read_epochs(spark, sink)
    assert out.count() == 501 and out.select("event_id").distinct().count() == 501


def test_failed_epoch_is_replayed_exactly_once(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 300).repartition(2), topic)
    inner = epoch_writer(sink, lambda b, e: decode_events(b))
    state = {"failed": False}

    def flaky(batch, epoch_id):
        inner(batch, epoch_id)           # write lands, then the callback fails
        if not state["failed"]:
            state["failed"] = True
            raise RuntimeError("sink failure after write")

    q = (read_topic(spark, topic).writeStream.foreachBatch(flaky)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        run_to_end(q)
    run_to_end(start_append(read_topic(spark, topic), sink, ckpt, decode_events))
    out = read_epochs(spark, sink)
    assert out.count() == 300 and out.select("event_id").distinct().count() == 300


def test_stream_equals_batch_decode(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 200), topic)
    run_to_end(start_decode(read_topic(spark, topic), sink, ckpt))
    batch = decode_events(spark.read.schema("value string").text(topic))
    assert sorted(spark.read.parquet(sink).collect()) == sorted(batch.collect())


def test_live_latest_keeps_state_across_restarts(spark):
    """The newest row survives restarts; older late rows do not replace it."""
    from tunelake.sinks.publish import read_published
    from tunelake.streaming.runner import start_latest

    topic, root, ckpt = (scratch_path(spark, n) for n in ("topic", "published", "ckpt"))

    def wave(ids):
        return spark.createDataFrame([(i,) for i in ids], "id long").select(
            F.to_json(F.struct(F.col("id").cast("string").alias("event_id"),
                               F.format_string("t%03d", "id").alias("created_at"))).alias("value"))

    def prep(values):
        d = values.select(F.from_json("value", "event_id string, created_at string").alias("d"))
        return d.select("d.*", F.col("d.event_id").cast("bigint").alias("_eid"))

    def run():
        run_to_end(start_latest(read_topic(spark, topic, max_per_trigger=1), root, "now",
                                ckpt, ["created_at", "_eid"], ["event_id", "created_at"], prep))
        return [tuple(r) for r in read_published(spark, root, "now").collect()]

    write_messages(wave(range(100, 150)).repartition(2), topic)
    assert run() == [("149", "t149")]
    write_messages(wave(range(0, 50)), topic)          # late, older events
    assert run() == [("149", "t149")]
    write_messages(wave([150, 7]), topic)
    assert run() == [("150", "t150")]


def test_enrich_counts_rows_per_epoch_without_an_extra_pass(spark):
    """A6 in the stream: the per-epoch row count comes from ``observe``."""
    from tunelake.streaming.runner import start_enrich
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 240).repartition(3), topic)
    q = run_to_end(start_enrich(read_topic(spark, topic, max_per_trigger=1), sink, ckpt,
                                trigger="availableNow"))
    counts = [p["observedMetrics"]["enrich"]["rows"] for p in q.recentProgress
              if p.get("observedMetrics", {}).get("enrich")]
    assert len(counts) == 3 and sum(counts) == 240
    assert read_epochs(spark, sink, fmt="text").count() == 240


def test_service_mode_picks_up_new_files_until_stopped(spark):
    """A processing-time trigger keeps running, handles files that
    arrive while it runs, and stops cleanly."""
    import time
    from tunelake.streaming.runner import start_enrich
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 100), topic)
    q = start_enrich(read_topic(spark, topic), sink, ckpt, trigger="1 second")

    def wait_for(n, timeout=90):
        end = time.time() + timeout
        while time.time() < end:
            if q.exception() is not None:
                raise AssertionError(str(q.exception()))
            done = sum(p["numInputRows"] for p in q.recentProgress)
            if done >= n:
                return done
            time.sleep(0.5)
        raise AssertionError(f"only {done} of {n} rows in {timeout}s")

    try:
        assert wait_for(100) == 100
        write_messages(_msgs(spark, 100, 130), topic)   # arrives while the query runs
        assert wait_for(130) == 130
        assert q.isActive
    finally:
        q.stop()
    assert not q.isActive
    assert read_epochs(spark, sink, fmt="text").count() == 130
