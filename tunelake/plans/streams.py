"""Registered streaming queries (Q7, Q8, Q13 and their parts).

The topic is produced by Spark from the ``events`` table (K7): the events are
renamed to the message fields, encoded as JSON and written as text files in a
fresh folder, one file per input split: no fixed partition count, and no key that
could send a hot user's events through one task. Each query then runs a real Structured Streaming job over that folder with an
``availableNow`` trigger and a fresh checkpoint, and returns what the sink
holds, read back as a batch frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.schema import (
    EVENT_SCHEMA, EVENT_SOURCE_RENAMES, FEED_TRACK_ID, FEED_TRACK_NAME, PROCESSING_TIME_COLUMN,
)
from tunelake.session import scratch_path
from tunelake.sinks.export import write_messages
from tunelake.sources.charts import read_lookup
from tunelake.sources.fixtures import EVENT_NUMBERS, EVENT_TEXTS, event_source_rows, read_table
from tunelake.streaming.events import (
    decode_events, encode_events, enrich, index_lookup, keyed_pick, latest, now_playing_rows,
    random_key, rename_source_columns, store_lookup, to_values,
)
from tunelake.functions.format import time_of_day, with_default
from tunelake.streaming.compact import compact_epochs, read_epochs
from tunelake.streaming.runner import (
    drop_replays, message_writer, read_topic, run_to_end, run_until, start_append, start_decode,
    start_enrich, start_latest,
)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 (P7 X7): events as JSON message values, encoded where they are read."""
    return encode_events(rename_source_columns(event_source_rows(spark, sf_dir)))


def produce_topic(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> str:
    """K7: write the messages (default: the events) to a new topic folder."""
    topic = scratch_path(spark, "topic")
    write_messages(messages if messages is not None else event_messages(spark, sf_dir), topic)
    return topic


def event_encode_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: encoded messages decoded again (field-by-field comparison)."""
    return decode_events(spark.read.schema("value string").text(produce_topic(spark, sf_dir)))


def event_decode_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 (folder) T1 T2: stream decode into an append-only parquet sink."""
    topic = produce_topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "decoded"), scratch_path(spark, "ckpt")
    run_to_end(start_decode(read_topic(spark, topic, max_per_trigger=2), sink, ckpt))
    return spark.read.schema(EVENT_SCHEMA).parquet(sink)


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with malformed lines injected by key arithmetic."""
    rows = rename_source_columns(event_source_rows(spark, sf_dir))
    msgs = encode_events(rows, beside=[F.col("event_id").cast("bigint").alias("_id")])
    v, i = F.col("value"), F.col("_id")
    dirty = (F.when(i % 53 == 0, F.expr("substring(value, 1, length(value) - 1)"))  # broken
              .when(i % 59 == 0, F.lit("[]"))
              .when(i % 61 == 0, F.lit("null"))
              .when(i % 67 == 0, F.lit(""))
              .when(i % 71 == 0, F.regexp_replace(v, r'"music_energy":[-0-9.eE]+',
                                                  '"music_energy":"abc"'))
              .when(i % 73 == 0, F.regexp_replace(v, r'"track_id":"([0-9]+)"', '"track_id":$1'))
              .otherwise(v))
    return msgs.select(dirty.alias("value"))


def _decode_dirty(spark: SparkSession, sf_dir: str, on_bad: str) -> DataFrame:
    topic = produce_topic(spark, sf_dir, dirty_messages(spark, sf_dir))
    sink, ckpt = scratch_path(spark, "decoded"), scratch_path(spark, "ckpt")
    run_to_end(start_decode(read_topic(spark, topic), sink, ckpt, on_bad=on_bad))
    return spark.read.schema(EVENT_SCHEMA).parquet(sink)


def event_decode_dirty_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decode_dirty(spark, sf_dir, "keep")


def event_decode_dirty_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decode_dirty(spark, sf_dir, "drop")


def _result_schema() -> T.StructType:
    return T.StructType(EVENT_SCHEMA.fields
                        + [T.StructField(PROCESSING_TIME_COLUMN, T.TimestampType(), True)])


def run_enrich(spark: SparkSession, sf_dir: str) -> str:
    """Q8 over the topic; returns the result folder (JSON values per epoch)."""
    topic = produce_topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "result"), scratch_path(spark, "ckpt")
    run_to_end(start_enrich(read_topic(spark, topic, max_per_trigger=2), sink, ckpt,
                            trigger="availableNow"))
    return sink


def read_result_topic(spark: SparkSession, sink: str) -> DataFrame:
    """The result messages decoded with the processing-time field."""
    values = read_epochs(spark, sink, fmt="text")
    return values.select(F.from_json("value", _result_schema()).alias("d")).select("d.*")


def event_enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: every event once in the result topic, each with a processing stamp."""
    res = read_result_topic(spark, run_enrich(spark, sf_dir))
    return res.withColumn("has_stamp", F.col(PROCESSING_TIME_COLUMN).isNotNull()) \
              .drop(PROCESSING_TIME_COLUMN)


def event_append_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: events arrive in two waves; the stream is restarted on the same
    checkpoint after each wave and once more with nothing new. The sink must
    hold every event exactly once."""
    rows = rename_source_columns(event_source_rows(spark, sf_dir))
    topic = scratch_path(spark, "topic")
    sink, ckpt = scratch_path(spark, "appended"), scratch_path(spark, "ckpt")
    for wave in (0, 1, None):
        if wave is not None:
            part = rows.filter(F.col("event_id").cast("bigint") % 2 == wave)
            write_messages(encode_events(part), topic)
        run_to_end(start_append(read_topic(spark, topic, max_per_trigger=2), sink, ckpt,
                                lambda b: decode_events(b)))
    return read_epochs(spark, sink)


def event_append_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six waves, an epoch each; closed epochs are merged while the stream runs and once more
    after it. Every event is read once, from the segments and the last epoch."""
    rows = rename_source_columns(event_source_rows(spark, sf_dir))
    topic = scratch_path(spark, "topic")
    sink, ckpt = scratch_path(spark, "appended"), scratch_path(spark, "ckpt")
    for wave in range(6):
        write_messages(encode_events(rows.filter(F.col("event_id").cast("bigint") % 6 == wave)), topic)
        run_to_end(start_append(read_topic(spark, topic), sink, ckpt, lambda b: decode_events(b),
                                compact_every=2, retain_s=0))
    compact_epochs(spark, sink, retain_s=0)
    return read_epochs(spark, sink)


def event_decode_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: a folder topic read from its end. A third of the events is there before the query first
    starts; the others come after it, before and after a restart."""
    rows = rename_source_columns(event_source_rows(spark, sf_dir))
    topic = scratch_path(spark, "topic")
    sink, ckpt = scratch_path(spark, "decoded"), scratch_path(spark, "ckpt")
    for wave in range(3):
        write_messages(encode_events(rows.filter(F.col("event_id").cast("bigint") % 3 == wave)), topic)
        stream = read_topic(spark, topic, starting_offsets="latest", checkpoint=ckpt)
        run_to_end(start_decode(stream, sink, ckpt))
    return spark.read.schema(EVENT_SCHEMA).parquet(sink)


def event_publish_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + T4: the first epoch is produced, fails and is produced again, as with a broker; the consumer
    drops the replayed messages by their keys and has every event once."""
    topic = produce_topic(spark, sf_dir)
    result, made, ckpt, sink, read = (scratch_path(spark, n) for n in (
        "result-topic", "ckpt", "ckpt", "decoded", "ckpt"))
    write = message_writer(result, made, lambda batch: to_values(enrich(decode_events(batch))))
    state = {"failed": False}

    def failing(batch: DataFrame, epoch_id: int) -> None:
        write(batch, epoch_id)
        if not state["failed"]:
            state["failed"] = True
            raise OSError("the driver is lost after the epoch was produced")

    def produce(fn):
        return (read_topic(spark, topic, max_per_trigger=2).writeStream.foreachBatch(fn)
                .option("checkpointLocation", made).trigger(availableNow=True).start())

    try:
        run_to_end(produce(failing))
    except Exception:
        if not state["failed"]:
            raise
    run_to_end(produce(write))
    messages = read_topic(spark, result, keyed=True).select(
        "key", F.from_json("value", _result_schema()).alias("d")).select("key", "d.*")
    once = drop_replays(messages, PROCESSING_TIME_COLUMN)
    run_to_end(once.writeStream.format("parquet").option("checkpointLocation", read)
               .trigger(availableNow=True).start(sink))
    twice = spark.read.text(result).count() > spark.read.text(topic).count()
    return spark.read.schema(once.schema).parquet(sink).select(
        *EVENT_SCHEMA.fieldNames(), F.lit(twice).alias("topic_has_replays"))


def event_enrich_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrich job under a processing-time trigger. Three waves arrive while it runs, each
    after the one before is done, as its progress reports; then it is stopped."""
    rows = rename_source_columns(event_source_rows(spark, sf_dir))
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "result", "ckpt"))
    spark.createDataFrame([], "value string").write.text(topic)
    q = start_enrich(read_topic(spark, topic), sink, ckpt, trigger="200 milliseconds")
    sent, epochs = 0, {}
    try:
        for wave in range(3):
            part = rows.filter(F.col("event_id").cast("bigint") % 3 == wave)
            write_messages(encode_events(part), topic)
            sent += part.count()
            epochs = run_until(q, sent)
    finally:
        q.stop()
    res = read_result_topic(spark, sink)
    return res.select("event_id", F.col(PROCESSING_TIME_COLUMN).isNotNull().alias("has_stamp"),
                      F.lit(len(epochs) >= 3).alias("several_epochs"),
                      F.lit(sum(epochs.values()) == sent).alias("all_reported"))


def now_playing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13 live feed (S6 S3 F7 J1 X12 X13 T7 U2) over the enriched result topic."""
    result_sink = run_enrich(spark, sf_dir)
    source = scratch_path(spark, "lookup-csv")
    (read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("track_name"))
        .write.option("header", True).csv(source))
    lookup = read_lookup(spark, source, keep=["p_partkey"]).withColumn(
        "p_partkey", F.col("p_partkey").cast("bigint"))
    table = f"lookup_{uuid.uuid4().hex}"        # a stored, bucketed table: batches only read it
    indexed = store_lookup(index_lookup(lookup, "p_partkey"), table, scratch_path(spark, "lookup"))
    n = indexed.count()
    stream = read_topic(spark, result_sink + "/*", max_per_trigger=2)
    sink, ckpt = scratch_path(spark, "feed"), scratch_path(spark, "ckpt")

    def feed(batch: DataFrame) -> DataFrame:
        ev = batch.select(F.from_json("value", _result_schema()).alias("d")).select("d.*")
        return now_playing_rows(ev, indexed, n, key=F.col("event_id").try_cast("bigint"))

    run_to_end(start_append(stream, sink, ckpt, feed))
    spark.sql(f"DROP TABLE {table}")
    out = read_epochs(spark, sink)
    return out.select("event_id", FEED_TRACK_ID, FEED_TRACK_NAME,
                      F.col("timestamp").rlike(r"^\d{2}:\d{2}:\d{2}$").alias("time_ok"))


def now_playing_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13 "now playing" (T7 X12): the newest event of the result topic.

    Newest = largest ``created_at``, ties by the larger event id; ``max_by``
    reduces every task to one candidate row before the single final merge.
    """
    res = read_result_topic(spark, run_enrich(spark, sf_dir))
    ordered = res.withColumn("_eid", F.col("event_id").try_cast("bigint"))
    picked = latest(ordered, ["created_at", "_eid", "event_id"], ["event_id", "track_id", "created_at"])
    return picked.select("event_id", with_default("track_id").alias(FEED_TRACK_ID), "created_at")


def now_playing_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13 "now playing" as a live stateful stream over the result topic:
    a streaming ``max_by`` keeps the newest event in the state store and each
    epoch publishes it as the ``now_playing`` table, which is read back."""
    from tunelake.schema import NOW_PLAYING
    from tunelake.sinks.publish import read_published
    result_sink = run_enrich(spark, sf_dir)
    root, ckpt = scratch_path(spark, "published"), scratch_path(spark, "ckpt")

    def prepare(values: DataFrame) -> DataFrame:
        ev = values.select(F.from_json("value", _result_schema()).alias("d")).select("d.*")
        return ev.select("event_id", with_default("track_id").alias(FEED_TRACK_ID), "created_at",
                         F.col("event_id").try_cast("bigint").alias("_eid"))

    run_to_end(start_latest(read_topic(spark, result_sink + "/*", max_per_trigger=2), root,
                            NOW_PLAYING, ckpt, ["created_at", "_eid", "event_id"],
                            ["event_id", FEED_TRACK_ID, "created_at"], prepare))
    return read_published(spark, root, NOW_PLAYING)


def random_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, random mode, over all events: every event once, each with a name of the
    lookup (which name is random, so only that is compared)."""
    lookup = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("track_name"))
    indexed = index_lookup(lookup, "p_partkey")
    events = read_table(spark, sf_dir, "events").select("event_id")
    names = lookup.select("track_name").distinct().withColumn("known", F.lit(True))
    picked = keyed_pick(events, indexed, random_key(indexed.count(), seed=11), indexed.count())
    return picked.join(names, "track_name", "left").select(
        "event_id", F.coalesce("known", F.lit(False)).alias("in_lookup"))


def event_time_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13 on the events' own stamps."""
    return read_table(spark, sf_dir, "events").select("event_id", time_of_day("ts").alias("label"))


QUERIES = {
    "event_encode_fields": event_encode_fields,
    "event_decode_stream": event_decode_stream,
    "event_decode_dirty_keep": event_decode_dirty_keep,
    "event_decode_dirty_drop": event_decode_dirty_drop,
    "event_enrich_stream": event_enrich_stream,
    "event_append_epochs": event_append_epochs,
    "event_append_compacted": event_append_compacted,
    "event_decode_latest": event_decode_latest,
    "event_publish_once": event_publish_once,
    "event_enrich_service": event_enrich_service,
    "now_playing_feed": now_playing_feed,
    "now_playing_latest": now_playing_latest,
    "now_playing_live": now_playing_live,
    "random_pick": random_pick,
    "event_time_labels": event_time_labels,
}


# --- oracle SQL ----------------------------------------------------------------

def source_fields_sql() -> dict[str, str]:
    """DuckDB expression of every source column, by source name."""
    out = {
        "id": "CAST(event_id AS VARCHAR)", "user_id": "CAST(user_id AS VARCHAR)",
        "track_id": "json_extract_string(props, '$.k')",
        "created_at": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
        "tweet_language": "event_type", "energy": "CAST(value AS DOUBLE)",
    }
    for c, (prefix, m) in EVENT_TEXTS.items():
        out[c] = f"CASE WHEN event_id % {m + 4} <> 0 THEN '{prefix}' || (event_id % {m}) END"
    for c, (m, d) in EVENT_NUMBERS.items():      # NaN and missing are both left out of a message
        out[c] = (f"CASE WHEN event_id % {m + 10} <> 0 AND event_id % {m + 6} <> 0 "
                  f"THEN CAST(event_id % {m} AS DOUBLE) / {d}.0 END")
    return out


def _event_fields(bad: str | None = None, energy_bad: str | None = None) -> str:
    """The 23 decoded fields; ``bad`` nulls every field, ``energy_bad`` only energy."""
    source = source_fields_sql()
    cols = []
    for s, f in EVENT_SOURCE_RENAMES:
        conds = [c for c in (bad, energy_bad if f == "music_energy" else None) if c]
        expr = source[s]
        cols.append(f"CASE WHEN {' OR '.join(conds)} THEN NULL ELSE {expr} END AS {f}" if conds
                    else f"{expr} AS {f}")
    return ",\n  ".join(cols)


_BAD = "(event_id % 53 = 0 OR event_id % 59 = 0 OR event_id % 61 = 0 OR event_id % 67 = 0)"
_ENERGY_BAD = "event_id % 71 = 0"

_LATEST_SQL = """SELECT CAST(event_id AS VARCHAR) AS event_id,
  coalesce(json_extract_string(props, '$.k'), 'Unknown Track') AS "track ID",
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM events ORDER BY ts DESC, event_id DESC LIMIT 1"""

ORACLE = {
    "random_pick": "SELECT event_id, TRUE AS in_lookup FROM events",
    "event_time_labels": "SELECT event_id, strftime(ts, '%H:%M:%S') AS label FROM events",
    "now_playing_live": _LATEST_SQL,
    "now_playing_latest": """SELECT CAST(event_id AS VARCHAR) AS event_id,
  coalesce(json_extract_string(props, '$.k'), 'Unknown Track') AS "track ID",
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""",
    "event_encode_fields": f"SELECT\n  {_event_fields()}\nFROM events",
    "event_decode_stream": f"SELECT\n  {_event_fields()}\nFROM events",
    "event_decode_dirty_keep": f"SELECT\n  {_event_fields(_BAD, _ENERGY_BAD)}\nFROM events",
    "event_decode_dirty_drop": f"SELECT\n  {_event_fields(None, _ENERGY_BAD)}\nFROM events "
                               f"WHERE NOT {_BAD}",
    "event_enrich_stream": f"SELECT\n  {_event_fields()},\n  TRUE AS has_stamp\nFROM events",
    "event_append_epochs": f"SELECT\n  {_event_fields()}\nFROM events",
    "event_append_compacted": f"SELECT\n  {_event_fields()}\nFROM events",
    "event_decode_latest": f"SELECT\n  {_event_fields()}\nFROM events WHERE event_id % 3 <> 0",
    "event_publish_once": f"SELECT\n  {_event_fields()},\n  TRUE AS topic_has_replays\nFROM events",
    "event_enrich_service": "SELECT CAST(event_id AS VARCHAR) AS event_id, TRUE AS has_stamp, "
                            "TRUE AS several_epochs, TRUE AS all_reported FROM events",
    "now_playing_feed": """SELECT CAST(e.event_id AS VARCHAR) AS event_id,
  coalesce(json_extract_string(e.props, '$.k'), 'Unknown Track') AS "track ID",
  p.p_name AS "track name",
  TRUE AS time_ok
FROM events e
LEFT JOIN (SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx
           FROM part WHERE p_name IS NOT NULL) p
  ON p.idx = e.event_id % (SELECT count(*) FROM part WHERE p_name IS NOT NULL)""",
}
