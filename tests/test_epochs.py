"""Compaction of epochs, a topic's end as the start, keyed messages, the bucketed lookup."""

import os

import pytest
from pyspark.sql import functions as F

from tunelake.session import scratch_path
from tunelake.sinks import commits
from tunelake.sinks.export import write_messages
from tunelake.streaming.compact import compact_epochs, epoch_path, read_epochs, sink_folders
from tunelake.streaming.events import decode_events, index_lookup, keyed_pick, store_lookup
from tunelake.streaming.runner import (
    drop_replays, message_writer, read_topic, run_to_end, run_until, start_append, start_decode,
    start_enrich,
)


def _epoch(spark, sink, e, rows=3):
    spark.range(rows).select(F.format_string(f"{e}-%d", "id").alias("event_id")).write.parquet(epoch_path(sink, e))


def _ids(spark, sink):
    return sorted(r.event_id for r in read_epochs(spark, sink).collect())


def test_folders_to_read_stay_few_and_rows_stay_whole(spark):
    sink = scratch_path(spark, "sink")
    want = []
    for e in range(40):
        if e % 9 != 4:                                     # an empty epoch has no folder
            _epoch(spark, sink, e)
            want += [f"{e}-{i}" for i in range(3)]
        if e % 3 == 2:
            compact_epochs(spark, sink, retain_s=0)
            assert len(sink_folders(spark, sink)) <= 7
    assert _ids(spark, sink) == sorted(want)
    local = sink.replace("file:", "")
    assert len([d for d in os.listdir(local) if d.startswith("epoch=")]) <= 4
    assert len([d for d in os.listdir(local + "-compacted") if d.startswith("v=")]) <= 7
    assert not compact_epochs(spark, sink + "-nothing")


def test_a_death_between_merge_and_switch_loses_and_doubles_nothing(spark, monkeypatch):
    sink = scratch_path(spark, "sink")
    for e in range(5):
        _epoch(spark, sink, e)
    want = _ids(spark, sink)

    def dying(*_):
        raise OSError("the driver dies")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", dying)
        with pytest.raises(OSError):
            compact_epochs(spark, sink, retain_s=0)
    assert _ids(spark, sink) == want and len(sink_folders(spark, sink)) == 5
    commit = commits.commit

    def overtaken(session, folder, text):
        monkeypatch.setattr(commits, "commit", commit)
        assert compact_epochs(spark, sink, retain_s=0)     # another compactor commits first
        return commit(session, folder, text)

    monkeypatch.setattr(commits, "commit", overtaken)
    assert not compact_epochs(spark, sink, retain_s=0)
    assert _ids(spark, sink) == want and len(sink_folders(spark, sink)) == 2


def test_an_open_reader_keeps_its_files(spark):
    sink = scratch_path(spark, "sink")
    for e in range(3):
        _epoch(spark, sink, e)
    reader = read_epochs(spark, sink)
    assert compact_epochs(spark, sink)                     # retained for an hour
    assert reader.count() == 9 and read_epochs(spark, sink).count() == 9
    _epoch(spark, sink, 2 + 1)
    assert compact_epochs(spark, sink, retain_s=0) and _ids(spark, sink) == sorted(
        f"{e}-{i}" for e in range(4) for i in range(3))


def _msgs(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.to_json(F.struct(F.col("id").cast("string").alias("event_id"))).alias("value"))


def test_a_topic_read_from_its_end_reads_no_older_file(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 300).repartition(3), topic)

    def run():
        q = run_to_end(start_decode(read_topic(spark, topic, starting_offsets="latest", checkpoint=ckpt),
                                    sink, ckpt))
        return sum(p["numInputRows"] for p in q.recentProgress)

    assert run() == 0
    write_messages(_msgs(spark, 300, 400).repartition(2), topic)
    assert run() == 100
    write_messages(_msgs(spark, 400, 450), topic)          # lands while the query is down
    assert run() == 50 and run() == 0
    got = sorted(int(r.event_id) for r in spark.read.parquet(sink).collect())
    assert got == list(range(300, 450))


def test_a_query_that_ran_from_the_first_file_loses_nothing_to_latest(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 10), topic)
    run_to_end(start_append(read_topic(spark, topic), sink, ckpt, decode_events))
    write_messages(_msgs(spark, 10, 20), topic)
    stream = read_topic(spark, topic, starting_offsets="latest", checkpoint=ckpt)
    run_to_end(start_append(stream, sink, ckpt, decode_events))
    assert read_epochs(spark, sink).count() == 20
    for bad in ({"starting_offsets": "latest"}, {"starting_offsets": "12"}):
        with pytest.raises(ValueError):
            read_topic(spark, topic, **bad)


def test_replayed_messages_have_the_same_keys(spark):
    topic, result, ckpt = (scratch_path(spark, n) for n in ("topic", "result", "ckpt"))
    write_messages(_msgs(spark, 0, 90).repartition(3), topic)
    write = message_writer(result, ckpt, lambda b: b.select("value"))

    def twice(batch, epoch_id):
        write(batch, epoch_id)
        write(batch, epoch_id)

    run_to_end(read_topic(spark, topic, max_per_trigger=1).writeStream.foreachBatch(twice)
               .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    lines = spark.read.text(result).select(F.from_json("value", "key string, value string").alias("m"))
    assert lines.count() == 180 and lines.select("m.key").distinct().count() == 90
    assert lines.distinct().count() == 90                  # a key always has the same message
    sink, read = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    stamped = read_topic(spark, result, keyed=True).withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    for _ in range(2):                                     # the state survives a restart
        run_to_end(drop_replays(stamped, "at").writeStream.format("parquet")
                   .option("checkpointLocation", read).trigger(availableNow=True).start(sink))
        twice(spark.read.text(topic).limit(0), 0)
    assert spark.read.parquet(sink).select("value").distinct().count() == 90 == spark.read.parquet(sink).count()


def test_run_until_reports_epochs_and_a_query_that_stops(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, 0, 20), topic)
    q = start_enrich(read_topic(spark, topic), sink, ckpt, trigger="200 milliseconds")
    assert run_until(q, 20) == {0: 20}
    with pytest.raises(TimeoutError):
        run_until(q, 21, timeout_s=1)
    q.stop()
    with pytest.raises(TimeoutError):
        run_until(q, 21)


def test_a_bucketed_lookup_is_not_shuffled(spark):
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.format_string("t%04d", "id").alias("track_name"))
    indexed = store_lookup(index_lookup(lookup, "k"), "lookup_plan_test", scratch_path(spark, "lookup"), 8)
    events = spark.range(20_000).withColumnRenamed("id", "event_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        picked = keyed_pick(events, indexed, F.col("event_id"), 5000)
        plan = picked._jdf.queryExecution().executedPlan().toString()
        rows = picked.filter("event_id in (0, 4999, 5000, 19999)").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sql("DROP TABLE lookup_plan_test")
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    assert {r.event_id: r.track_name for r in rows} == {0: "t0000", 4999: "t4999", 5000: "t0000", 19999: "t4999"}


def test_a_small_stored_lookup_is_not_broadcast(spark):
    """Before, every epoch sent a lookup below the broadcast threshold through the driver."""
    lookup = spark.range(50).select(F.col("id").alias("k"), F.format_string("t%02d", "id").alias("track_name"))
    indexed = store_lookup(index_lookup(lookup, "k"), "small_lookup_test", scratch_path(spark, "lookup"), 8)
    events = spark.range(3000).select(F.when(F.col("id") < 1000, F.col("id")).alias("event_id"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        picked = keyed_pick(events, indexed, F.col("event_id"), indexed.count())
        plan = picked._jdf.queryExecution().executedPlan().toString()
        rows = picked.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.sql("DROP TABLE small_lookup_test")
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.event_id: r.track_name for r in rows if r.event_id is not None} == {
        i: f"t{i % 50:02d}" for i in range(1000)}
    keyless = [r for r in rows if r.event_id is None]
    assert len(keyless) == 2000 and all(r.track_name is None for r in keyless)
    assert len({r.task for r in keyless}) == 8             # not all in one task
