"""Inputs that earlier fixtures avoided: stored positions, header-bound CSV, the daily
chart's dates, sinks with an owner, odd event ids, retention."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

import tunelake as tl
from tunelake.cli import run
from tunelake.session import scratch_path
from tunelake.sinks.export import write_messages
from tunelake.sinks.publish import publish, read_published, snapshot_dirs
from tunelake.streaming.events import decode_events, index_lookup, keyed_pick
from tunelake.streaming.runner import (
    read_epochs, read_topic, run_to_end, start_append,
)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_index_is_dense_without_exchange_reuse(spark, adaptive):
    n = 400_000
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        lookup = spark.range(n).select(F.xxhash64("id").alias("k"),
                                       F.col("id").cast("string").alias("track_name"))
        idx = index_lookup(lookup, "k")
        got = idx.agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()
        assert tuple(got) == (n, n, 0, n - 1)
        picked = keyed_pick(spark.range(n), idx, F.col("id"), n)
        assert tuple(picked.agg(F.count("*"), F.count("track_name")).first()) == (n, n)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


CSV = """key,energy,unknown,id
1,0.5,u,a
2,0.25,"x,y",b
3,
4
3,4,5,6,
3,4,5,6,,
3,4,5,6,7
5,NA,nan,None
"6",1,2,"c""d"
"""


def test_lenient_csv_equals_pandas(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(CSV)
    want = pd.read_csv(path, dtype=str, on_bad_lines="skip")
    rows = tl.read_lenient_csv(spark, str(path))
    got = rows.toPandas()
    assert list(got.columns) == list(want.columns)

    def plain(df):
        return sorted(tuple("" if pd.isna(v) else str(v).replace('"', "") for v in r)
                      for r in df.itertuples(index=False))

    assert plain(got) == plain(want)
    one = tl.read_lenient_csv(spark, str(path), ["id", "track", "key"])
    assert one.columns == ["id", "track", "key"]
    assert sorted(str(r.key) for r in one.select("key").collect()) == sorted(want["key"])
    assert one.filter("track is not null").count() == 0


def _document(names, **more):
    entries = [{"chartEntryData": {"currentRank": i + 1},
                "trackMetadata": {"trackName": n, "artists": [{"name": "x"}]}}
               for i, n in enumerate(names)]
    return {"chartEntryViewResponses": [{"entries": entries}], **more}


def _daily(spark, tmp_path, *extra):
    run(spark, ["daily-chart", "--landing", str(tmp_path / "landing"), "--root",
                str(tmp_path / "root"), "--history", str(tmp_path / "history"), *extra])
    rows = read_published(spark, str(tmp_path / "root"), "daily_charts").collect()
    return sorted((r.Rank, r.TrackName) for r in rows)


def test_daily_chart_without_a_date_gets_the_day_of_the_run(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text(json.dumps(_document(["A", "B"])))
    assert _daily(spark, tmp_path) == [(1, "A"), (2, "B")]
    today = spark.sql("select date_format(current_date(), 'dd-MM-yyyy')").first()[0]
    assert list((tmp_path / "history").glob(f"v=*/dt={today}"))
    assert _daily(spark, tmp_path, "--date", "2024-01-02") == [(1, "A"), (2, "B")]
    assert list((tmp_path / "history").glob("v=*/dt=02-01-2024"))


def test_daily_chart_takes_the_newest_document_of_a_date(spark, tmp_path):
    import os
    (tmp_path / "landing").mkdir()
    for name, rows, when in (("b", ["old"], 1_000), ("a", ["new", "more"], 2_000)):
        path = tmp_path / "landing" / f"{name}.json"
        path.write_text(json.dumps(_document(rows, chartDate="2024-01-02")))
        os.utime(path, (when, when))
    (tmp_path / "landing" / "c.json").write_text(json.dumps(_document(["x"], chartDate="2024-01-01")))
    assert _daily(spark, tmp_path) == [(1, "new"), (2, "more")]


def test_pretty_printed_document_and_no_entries(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    path = tmp_path / "landing" / "a.json"
    path.write_text(json.dumps(_document(["A"], chartDate="2024-01-02"), indent=2))
    assert _daily(spark, tmp_path, "--multi-line") == [(1, "A")]
    with pytest.raises(ValueError, match="no entries"):      # read line by line: nothing decodes
        _daily(spark, tmp_path)
    path.write_text(json.dumps(_document([], chartDate="2024-01-03")))
    with pytest.raises(ValueError, match="no entries"):
        _daily(spark, tmp_path)
    kept = read_published(spark, str(tmp_path / "root"), "daily_charts").collect()
    assert [r.TrackName for r in kept] == ["A"]


def _msgs(spark, ids):
    return spark.createDataFrame([(json.dumps({"event_id": str(i), "created_at": "t"}),)
                                  for i in ids], "value string")


def test_new_checkpoint_on_a_used_sink_is_refused(spark):
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    write_messages(_msgs(spark, range(100)), topic)
    run_to_end(start_append(read_topic(spark, topic), sink, ckpt, decode_events))
    write_messages(_msgs(spark, range(100, 110)), topic)
    with pytest.raises(Exception, match="sink of its own"):
        run_to_end(start_append(read_topic(spark, topic), sink, scratch_path(spark, "ckpt"),
                                decode_events))
    assert read_epochs(spark, sink).count() == 100
    run_to_end(start_append(read_topic(spark, topic), sink, ckpt, decode_events))
    assert read_epochs(spark, sink).count() == 110


def test_event_id_that_is_no_number(spark):
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "root")
    write_messages(_msgs(spark, ["7", "e-1", "12"]), topic)
    run_to_end(run(spark, ["now-playing", "--topic", topic, "--root", root, "--checkpoint",
                           scratch_path(spark, "ckpt"), "--trigger", "availableNow"]))
    assert [r.event_id for r in read_published(spark, root, "now_playing").collect()] == ["12"]


def test_live_feed_command(spark, tmp_path):
    topic, sink = scratch_path(spark, "topic"), scratch_path(spark, "feed")
    write_messages(_msgs(spark, ["7", "e-1", "12"]), topic)
    (tmp_path / "songs.csv").write_text("track_name,n\nA,1\nNA,2\nB,3\n")
    run_to_end(run(spark, ["feed", "--topic", topic, "--sink", sink, "--lookup-csv",
                           str(tmp_path / "songs.csv"), "--checkpoint", scratch_path(spark, "ckpt"),
                           "--trigger", "availableNow"]))
    out = read_epochs(spark, sink).collect()
    assert {r.event_id for r in out} == {"7", "e-1", "12"}
    assert {r["track name"] for r in out} <= {"A", "B"}


def test_folder_topic_refuses_a_start_it_cannot_honour(spark):
    with pytest.raises(ValueError, match="checkpoint"):
        read_topic(spark, scratch_path(spark, "topic"), starting_offsets="latest")
    with pytest.raises(ValueError, match="earliest"):
        read_topic(spark, scratch_path(spark, "topic"), starting_offsets='{"t":{"0":5}}')


def test_enrich_without_a_target_is_refused_at_once(spark):
    with pytest.raises(SystemExit):
        run(spark, ["enrich", "--topic", "t", "--checkpoint", "c"])


def test_snapshots_are_kept_for_the_retention_time(spark):
    root = scratch_path(spark, "pub")
    for i in range(4):
        publish(spark.range(i), root, "t", keep=1)
    assert len(snapshot_dirs(spark, root, "t")) == 4
    publish(spark.range(9), root, "t", keep=2, retain_s=0)
    assert len(snapshot_dirs(spark, root, "t")) == 2 and read_published(spark, root, "t").count() == 9


def test_large_n_needs_a_total_order(spark):
    with pytest.raises(ValueError, match="tie keys"):
        tl.top_n(spark.range(3).withColumn("g", F.lit(1)), ["g"], "id", [], n=5000)


def test_topic_write_follows_the_input_splits(spark, small_dir):
    from tunelake.plans.streams import event_messages
    plan = event_messages(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
