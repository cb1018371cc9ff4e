"""Structured Streaming sources, sinks and starters.

Design
------
* A topic is either Kafka (``servers`` given; needs the spark-sql-kafka
  connector) or a folder of JSON-lines files. Both yield a ``value`` column, so
  every transform downstream is the same.
* ``checkpoint`` is a required argument of every starter: a restart resumes at
  the last committed epoch instead of skipping or repeating events.
* Sinks are written per epoch with ``foreachBatch`` into
  ``<sink>/epoch=<id>`` with overwrite. Spark replays an epoch whose commit was
  not recorded, and the replay overwrites the same folder, so the sink holds
  every event exactly once even when executors or the driver die mid-batch.
  Errors are not swallowed: a failing write fails the query, which then
  restarts from the checkpoint.
* One action per epoch in the enrich job: the batch is decoded, stamped and
  written in a single job; the row count comes from ``observe`` (no extra
  pass, no driver collect). The generic appender can probe for an empty epoch
  (F8, a limit-1 job) to avoid writing empty folders.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tunelake.sinks.commits import create_text, read_text
from tunelake.sinks.export import append_messages, write_kafka
from tunelake.streaming.compact import EPOCH_COLUMN, compact_epochs, epoch_path, read_epochs
from tunelake.streaming.events import decode_events, enrich, to_values, with_key

_OWNER = "_query_id"
_START = "start_mark"

__all__ = ["EPOCH_COLUMN", "read_epochs", "epoch_path"]


def _start_mark(spark: SparkSession, topic: str, checkpoint: str) -> dict:
    """The end of a folder topic when its query first started: the newest modification time
    (ms; -1: no file) and the files that have it. Kept in the query's checkpoint, so a restart
    starts where the query left off; a query that has run without a mark has none."""
    mark = f"{checkpoint.rstrip('/')}/{_START}"
    text = read_text(spark, mark)
    if text is None:
        end = {"time": -1, "files": []}
        if read_text(spark, f"{checkpoint.rstrip('/')}/metadata") is None:
            files = spark.read.format("binaryFile").load(topic).select(
                "path", F.unix_millis("modificationTime").alias("time"))
            last = files.agg(F.max("time")).first()[0]
            if last is not None:
                end = {"time": last, "files": [r.path for r in files.filter(
                    F.col("time") == last).select("path").collect()]}
        if not create_text(spark, mark, json.dumps(end)):
            return _start_mark(spark, topic, checkpoint)
        return end
    return json.loads(text)


def read_topic(spark: SparkSession, topic: str, servers: str | None = None,
               starting_offsets: str | None = None, fail_on_data_loss: bool = False,
               max_per_trigger: int | None = None, checkpoint: str | None = None,
               keyed: bool = False) -> DataFrame:
    """Streaming frame with a ``value`` column, and with ``keyed`` the message's ``key``.

    With ``servers``, ``topic`` is a Kafka topic name (``startingOffsets``, by
    default ``latest``, and ``failOnDataLoss`` as in the reference,
    ``maxOffsetsPerTrigger`` for back-pressure). Without, ``topic`` is a folder of
    JSON-lines files (``maxFilesPerTrigger`` for back-pressure; new files are
    picked up in arrival order), read from its first file, or with
    ``starting_offsets="latest"`` from its end at the query's first start: the mark of that end is
    stored in ``checkpoint``, which a restart finds again. A file that lands
    later with an older modification time counts as older. Keyed messages in a folder are
    lines ``{"key": .., "value": ..}`` (``append_messages``).
    """
    if servers:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic)
             .option("startingOffsets", starting_offsets or "latest")
             .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        cols = ["value", "key"] if keyed else ["value"]
        return r.load().select(*[F.col(c).cast("string").alias(c) for c in cols])
    if starting_offsets not in (None, "earliest", "latest"):
        raise ValueError(f"a folder topic starts at 'earliest' or 'latest', not at {starting_offsets!r}")
    if starting_offsets == "latest" and checkpoint is None:
        raise ValueError("a folder topic is read from its end only with a checkpoint to keep the start in")
    r = spark.readStream.schema("value string")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    lines = r.text(topic)
    if starting_offsets == "latest":
        end = _start_mark(spark, topic, checkpoint)
        time_of = F.unix_millis("_metadata.file_modification_time")
        lines = lines.filter((time_of > end["time"]) | (
            (time_of == end["time"]) & ~F.col("_metadata.file_path").isin(end["files"])))
    if keyed:
        lines = lines.select(F.from_json("value", "key string, value string").alias("m")).select("m.*")
    return lines


def _own(spark: SparkSession, sink: str, checkpoint: str) -> None:
    """Bind ``sink`` to the query of ``checkpoint``; refuse another query's sink.

    Epoch ids restart at 0 under a new checkpoint and would overwrite the epochs
    of the old one. The query's id is in its checkpoint; the sink keeps a copy.
    """
    query = query_id(spark, checkpoint)
    mark = f"{sink.rstrip('/')}/{_OWNER}"
    owner = read_text(spark, mark)
    if owner is None and not create_text(spark, mark, query):
        owner = read_text(spark, mark)
    if owner is not None and owner != query:
        raise RuntimeError(f"{sink} holds the epochs of query {owner}; query {query} must write "
                           "to a sink of its own (or resume the old checkpoint)")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that runs from ``checkpoint``; the same after every restart."""
    return str(json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata") or "{}").get("id"))


def message_writer(topic: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                   servers: str | None = None) -> Callable[[DataFrame, int], None]:
    """K4: ``foreachBatch`` callback that produces ``transform(batch)`` (``value``) to ``topic``, a Kafka
    topic or a folder, at least once: a replayed epoch is produced again, with the same keys.

    A message's key is its query, epoch and position in the epoch. A replayed epoch has
    the same input in the same splits, so ``drop_replays`` can tell its messages.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        out = with_key(transform(batch), query_id(batch.sparkSession, checkpoint), epoch_id)
        if servers:
            write_kafka(out, servers, topic)
        else:
            append_messages(out, topic)
    return write


def drop_replays(messages: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """T4: each message once, by its ``key``; a replay counts as such if it comes within ``delay`` of the
    newest ``time`` seen. State is one key a message, dropped once it is older than that."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(["key"])


def epoch_writer(sink: str, transform: Callable[[DataFrame, int], DataFrame],
                 fmt: str = "parquet", skip_empty: bool = True,
                 checkpoint: str | None = None) -> Callable[[DataFrame, int], None]:
    """K5/K6: ``foreachBatch`` callback writing ``transform(batch)`` idempotently.

    ``skip_empty`` (F8) probes the batch with a limit-1 job and writes nothing
    for an empty epoch. With ``checkpoint``, the sink belongs to that checkpoint's
    query from the first epoch on, and another query's write fails.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        if checkpoint is not None:
            _own(batch.sparkSession, sink, checkpoint)
        if skip_empty and batch.isEmpty():
            return
        out = transform(batch, epoch_id)
        out.write.mode("overwrite").format(fmt).save(epoch_path(sink, epoch_id))
    return write


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_decode(stream: DataFrame, sink: str, checkpoint: str,
                 trigger: str | None = "availableNow", on_bad: str = "keep") -> StreamingQuery:
    """T1 + T2: decoded events appended to a parquet folder."""
    decoded = decode_events(stream, on_bad=on_bad)
    q = (decoded.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start(sink)


def start_enrich(stream: DataFrame, sink: str, checkpoint: str,
                 trigger: str | None = "30 seconds", on_bad: str = "keep",
                 servers: str | None = None, topic: str = "result") -> StreamingQuery:
    """Q8 (T3 T4 X6 X4 K4 K5): decode, stamp with the processing time, publish
    one JSON ``value`` per event.

    Without ``servers`` the values go to ``<sink>/epoch=<id>`` as text files
    (exactly once); with ``servers`` they are produced to the Kafka ``topic``
    (at least once, with keys by which ``drop_replays`` removes replayed messages).
    """
    decoded = decode_events(stream, on_bad=on_bad).observe(
        "enrich", F.count(F.lit(1)).alias("rows"))

    def values(batch: DataFrame, epoch_id: int) -> DataFrame:
        return to_values(enrich(batch))

    if servers:
        fn = message_writer(topic, checkpoint, lambda batch: values(batch, 0), servers)
    else:
        # one action per epoch: no emptiness probe (Spark does not run empty
        # micro-batches for a stateless query), so `observe` counts the write
        fn = epoch_writer(sink, values, fmt="text", skip_empty=False, checkpoint=checkpoint)
    q = (decoded.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start()


def start_append(stream: DataFrame, sink: str, checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame],
                 trigger: str | None = "availableNow", compact_every: int | None = None,
                 retain_s: float = 3600.0) -> StreamingQuery:
    """Append ``transform(batch)`` to ``<sink>/epoch=<id>`` (parquet). With ``compact_every``
    the closed epochs are merged after every so many (``compact_epochs``)."""
    write = epoch_writer(sink, lambda b, _e: transform(b), checkpoint=checkpoint)

    def fn(batch: DataFrame, epoch_id: int) -> None:
        write(batch, epoch_id)
        if compact_every and (epoch_id + 1) % compact_every == 0:
            compact_epochs(batch.sparkSession, sink, retain_s=retain_s)

    q = (stream.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start()


def start_latest(stream: DataFrame, root: str, table: str, checkpoint: str,
                 order: list[str], cols: list[str],
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 trigger: str | None = "availableNow", retain_s: float = 3600.0) -> StreamingQuery:
    """T7 live "now playing": the row that is last in ``order`` over the whole
    stream so far, published as the newest snapshot of ``table`` every epoch.

    A global streaming aggregate (``max_by``) in complete mode: the state is a
    single row kept in the checkpointed state store, so a restart continues
    from it and every task reduces its rows to one candidate before the merge.
    A replayed epoch publishes the same row again (a newer snapshot with equal
    content); snapshots older than ``retain_s`` beyond the newest two are pruned.
    """
    from tunelake.sinks.publish import publish

    rows = prepare(stream) if prepare is not None else stream
    pick = F.max_by(F.struct(*cols), F.struct(*order)).alias("r")
    latest_row = rows.agg(pick)

    def write(batch: DataFrame, epoch_id: int) -> None:
        publish(batch.filter(F.col("r").isNotNull()).select("r.*"), root, table, keep=2,
                retain_s=retain_s)

    q = (latest_row.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return _trigger(q, trigger).start()


def run_to_end(q: StreamingQuery, timeout_s: int | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query, however long it takes unless ``timeout_s``
    is given; re-raise its failure, if any."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def run_until(q: StreamingQuery, rows: int, timeout_s: int = 600, every_s: float = 0.2) -> dict[int, int]:
    """Wait until a running query has processed ``rows`` input rows, by its progress reports;
    returns the rows of every epoch reported so far. The query runs on; its failure is re-raised.
    Spark reports a row as often as an epoch reads it: the query must read its batch once, as
    ``start_enrich`` and ``start_decode`` do (``start_append`` also probes for emptiness)."""
    done: dict[int, int] = {}
    end = time.monotonic() + timeout_s
    while True:
        for p in q.recentProgress:
            if p["numInputRows"]:
                done[p["batchId"]] = p["numInputRows"]
        if sum(done.values()) >= rows:
            return done
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if not q.isActive or time.monotonic() > end:
            raise TimeoutError(f"stream {q.id} has processed {sum(done.values())} of {rows} rows")
        time.sleep(every_s)
