"""Command line for the reference's runnable jobs (``python -m tunelake.cli ...``, or
``spark-submit --py-files tunelake.zip tunelake/cli.py ...``).

The library never builds a session; this application does (``getOrCreate``, so
the master and settings come from ``spark-submit`` / the cluster defaults), and
``spark.checkpoint.dir`` must name a shared folder on a cluster.

  refresh      Q1-Q5: chart CSV -> five published result tables (one pass)
  daily-chart  Q6: landed chart documents -> daily_charts + dated CSV history
  encode       Q7: source CSV rows -> JSON event messages on a topic
  enrich       Q8: topic -> decoded, stamped JSON values (runs until stopped)
  now-playing  Q13: result topic -> live now_playing table (runs until stopped)
  feed         Q13: result topic + lookup CSV -> every event with a track name,
               appended per epoch (runs until stopped)
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.plans.jobs import DEFAULT_ARTIST_PREFIX, DEFAULT_YEAR


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tunelake")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("refresh", help="Q1-Q5 from a chart CSV")
    r.add_argument("--chart-csv", required=True)
    r.add_argument("--root", required=True, help="published tables root")
    r.add_argument("--year", default=DEFAULT_YEAR)
    r.add_argument("--artist-prefix", default=DEFAULT_ARTIST_PREFIX)
    r.add_argument("--keep", type=int, default=None, help="snapshots to keep per table")

    d = sub.add_parser("daily-chart", help="Q6 from landed chart documents")
    d.add_argument("--landing", required=True)
    d.add_argument("--root", required=True)
    d.add_argument("--history", required=True)
    d.add_argument("--chart-index", type=int, default=0)
    d.add_argument("--date", default=None, help="yyyy-MM-dd of documents that state none "
                                                "(default: the day of the run)")
    d.add_argument("--multi-line", action="store_true", help="one document per file, any layout")

    e = sub.add_parser("encode", help="Q7: source CSV -> event messages")
    e.add_argument("--source-csv", required=True)
    e.add_argument("--topic", required=True, help="topic folder, or Kafka topic with --servers")
    e.add_argument("--servers", default=None)

    for name, text in (("enrich", "Q8 stream"), ("now-playing", "Q13 live stream"),
                       ("feed", "Q13 live feed")):
        s = sub.add_parser(name, help=text)
        s.add_argument("--topic", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--servers", default=None)
        s.add_argument("--trigger", default="30 seconds" if name == "enrich" else "2 seconds")
        s.add_argument("--max-per-trigger", type=int, default=None)
        s.add_argument("--start", choices=("earliest", "latest"), default=None,
                       help="where a new query starts (default: a folder's first file, Kafka's latest)")
        if name == "enrich":
            s.add_argument("--sink", default=None, help="result folder (without --servers)")
            s.add_argument("--result-topic", default="result")
            s.add_argument("--on-bad", choices=("keep", "drop"), default="keep")
        elif name == "feed":
            s.add_argument("--sink", required=True, help="feed folder")
            s.add_argument("--lookup-csv", required=True)
            s.add_argument("--lookup-col", default="track_name")
            s.add_argument("--compact-every", type=int, default=100, help="epochs between compactions")
        else:
            s.add_argument("--root", required=True)
    return p


def run(spark: SparkSession, argv: list[str]):
    """Run one command on ``spark``; returns what the command produced
    (snapshot paths, or the started ``StreamingQuery``)."""
    import tunelake as tl
    from tunelake.schema import EVENT_SCHEMA, FEED_TRACK_ID, NOW_PLAYING, PROCESSING_TIME_COLUMN

    parser = _parser()
    a = parser.parse_args(argv)
    if a.cmd == "enrich" and not (a.sink or a.servers):
        parser.error("enrich needs --sink (a folder) or --servers (Kafka)")
    if a.cmd == "refresh":
        return tl.refresh_results(tl.read_chart_csv(spark, a.chart_csv), a.root, a.year,
                                  a.artist_prefix, a.keep)
    if a.cmd == "daily-chart":
        docs = tl.read_chart_documents(spark, a.landing, a.multi_line)
        return tl.save_daily_chart(docs, a.root, a.history, a.date, a.chart_index)
    if a.cmd == "encode":
        msgs = tl.encode_events(tl.rename_source_columns(tl.read_lenient_csv(spark, a.source_csv)))
        if a.servers:
            return tl.write_kafka(msgs, a.servers, a.topic)
        return tl.write_messages(msgs, a.topic)
    stream = tl.read_topic(spark, a.topic, servers=a.servers, starting_offsets=a.start,
                           max_per_trigger=a.max_per_trigger, checkpoint=a.checkpoint)
    if a.cmd == "enrich":
        return tl.start_enrich(stream, a.sink, a.checkpoint, a.trigger, a.on_bad,
                               a.servers, a.result_topic)

    if a.cmd == "feed":
        lookup = tl.read_lookup(spark, a.lookup_csv, a.lookup_col).withColumnRenamed(
            a.lookup_col, "track_name")
        indexed = tl.index_lookup(lookup.withColumn("_key", F.col("track_name")), "_key")
        n = indexed.count()
        schema = T.StructType(EVENT_SCHEMA.fields
                              + [T.StructField(PROCESSING_TIME_COLUMN, T.TimestampType())])

        def feed(values):
            ev = values.select(F.from_json("value", schema).alias("d")).select("d.*")
            return tl.now_playing_rows(ev, indexed, n)

        return tl.start_append(stream, a.sink, a.checkpoint, feed, a.trigger, a.compact_every)

    def prepare(values):
        ev = tl.decode_events(values)
        return ev.select("event_id", tl.with_default("track_id").alias(FEED_TRACK_ID), "created_at",
                         F.col("event_id").try_cast("bigint").alias("_eid"))

    return tl.start_latest(stream, a.root, NOW_PLAYING, a.checkpoint,
                           ["created_at", "_eid", "event_id"],
                           ["event_id", FEED_TRACK_ID, "created_at"], prepare, a.trigger)


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("tunelake").getOrCreate()
    out = run(spark, sys.argv[1:] if argv is None else argv)
    if hasattr(out, "awaitTermination"):
        out.awaitTermination()
    elif out is not None:
        print(out)


if __name__ == "__main__":
    main()
