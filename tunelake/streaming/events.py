"""Event message transforms.

All of these are plain column expressions, valid on batch and streaming
DataFrames alike, so the streamed result can be checked against the same
function applied to a batch frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.functions.format import time_of_day, with_default
from tunelake.operators.position import positioned
from tunelake.schema import (
    EVENT_FIELDS, EVENT_SCHEMA, EVENT_SOURCE_RENAMES, FEED_TIME, FEED_TRACK_ID, FEED_TRACK_NAME,
    PROCESSING_TIME_COLUMN,
)


def rename_source_columns(df: DataFrame) -> DataFrame:
    """Source CSV columns -> event message fields (missing sources -> null)."""
    have = set(df.columns)
    out = []
    for src, dst in EVENT_SOURCE_RENAMES:
        out.append((F.col(src) if src in have else F.lit(None)).alias(dst))
    return df.select(*out)


def _typed(df: DataFrame) -> DataFrame:
    """Cast message fields to the event schema's types (bad numbers -> null)."""
    cols = []
    for f in EVENT_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def encode_events(df: DataFrame, typed: bool = True, beside: Sequence[Column] = ()) -> DataFrame:
    """X7 + K7: one JSON object per row in ``value``; null and NaN fields omitted.

    ``beside`` are columns of the message fields to keep next to ``value``.
    ``to_json`` drops null fields by default; NaN is turned into null first
    because ``to_json`` would otherwise print it as ``"NaN"``.
    """
    src = _typed(df) if typed else df
    cols = [F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
            if isinstance(src.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            for c in src.columns]
    return src.select(F.to_json(F.struct(*cols)).alias("value"), *beside)


def decode_events(df: DataFrame, on_bad: str = "keep") -> DataFrame:
    """T1 (X5 X3 P6): ``value`` (binary or text) -> the 23 typed event fields.

    Malformed JSON gives an all-null row (Spark's PERMISSIVE ``from_json``);
    ``on_bad="drop"`` removes such rows, ``"keep"`` (default) keeps them as the
    reference does.
    """
    if on_bad not in ("keep", "drop"):
        raise ValueError("on_bad must be 'keep' or 'drop'")
    out = (df.select(F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("data"))
             .select("data.*"))
    if on_bad == "drop":
        out = out.filter(F.greatest(*[F.col(c).isNotNull() for c in EVENT_FIELDS]))
    return out


def enrich(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Add the processing time (one value for the whole batch)."""
    return df.withColumn(PROCESSING_TIME_COLUMN,
                         stamp if stamp is not None else F.current_timestamp())


def to_values(df: DataFrame) -> DataFrame:
    """X4 + P9: every column of the row as one JSON ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def with_key(messages: DataFrame, query: str, epoch: int) -> DataFrame:
    """K4: a ``key`` beside each message: its query, epoch and position in the epoch. The same epoch
    read again in the same splits gives the same keys."""
    at = F.monotonically_increasing_id().cast("string")
    return messages.withColumn("key", F.concat_ws(":", F.lit(query), F.lit(str(epoch)), at))


def index_lookup(lookup: DataFrame, key: str, col: str = "track_name") -> DataFrame:
    """Dense 0-based index ``idx`` over a lookup table in ``key`` order, ties by
    ``col`` (for J1). Stored once in index order (``positioned``), so micro-batches
    join a table whose numbers cannot change."""
    return positioned(lookup.select(key, col), [key, col], "idx").select("idx", col)


def store_lookup(indexed: DataFrame, table: str, path: str, buckets: int = 32) -> DataFrame:
    """J1 at scale: the index as a table below ``path``, bucketed and sorted by ``idx``, a file a bucket. A
    join on ``idx`` shuffles only the events, never the lookup, however large or small it is: a broadcast would
    send it through the driver in every epoch. ``table`` is its name in the session's catalog."""
    (indexed.repartition(buckets, "idx").write.mode("overwrite").option("path", path)
     .bucketBy(buckets, "idx").sortBy("idx").saveAsTable(table))
    return indexed.sparkSession.table(table).hint("merge")


def random_key(n: int, seed: int) -> Column:
    """J1, random mode (the reference draws a random track name per event): a
    uniform index in ``[0, n)``. Seeded: a retried task that reads its
    partition in the same order (a file split, a micro-batch's source
    partition) redraws the same values. The pick itself is the keyed join."""
    return F.floor(F.rand(seed) * F.lit(n)).cast("bigint")


def keyed_pick(events: DataFrame, indexed: DataFrame, key: Column, n: int,
               col: str = "track_name") -> DataFrame:
    """Attach ``indexed[pmod(key, n)]`` to each event (deterministic pick).

    An empty lookup (``n == 0``) gives every event a null name instead of a
    division by zero. Events without a key get numbers below 0, which no row of the
    lookup has, so that a shuffle spreads them.
    """
    idx = F.pmod(key, F.lit(n)) if n > 0 else F.lit(None).cast("bigint")
    picked = events.withColumn("_idx", F.coalesce(idx, -1 - F.floor(F.rand(0) * 1024)))
    return (picked.join(indexed.withColumnRenamed("idx", "_idx"), "_idx", "left")
                  .drop("_idx"))


def now_playing_rows(events: DataFrame, indexed: DataFrame, n: int,
                     key: Column | None = None) -> DataFrame:
    """T7 (X12 J1 X13): ``track ID``, ``track name``, ``timestamp`` per event."""
    key = key if key is not None else F.xxhash64("event_id")
    out = keyed_pick(events, indexed, key, n)
    ts = F.col(PROCESSING_TIME_COLUMN) if PROCESSING_TIME_COLUMN in events.columns \
        else F.current_timestamp()
    return out.select(
        F.col("event_id"),
        with_default("track_id").alias(FEED_TRACK_ID),
        F.col("track_name").alias(FEED_TRACK_NAME),
        time_of_day(ts).alias(FEED_TIME),
    )


def latest(df: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    """T7 "now playing": the row that is last in ``order`` (one-row result).

    ``max_by`` is an ordinary aggregate with a map-side partial step, so no
    task ever holds more than one candidate row per input partition.
    """
    pick = F.max_by(F.struct(*cols), F.struct(*order)).alias("r")
    # a global aggregate always yields one row; an empty input has nothing playing
    return df.agg(pick).filter(F.col("r").isNotNull()).select("r.*")
