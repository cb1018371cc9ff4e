"""File exports: dated CSV history (K2) and JSON message files (K7, K4 without a broker)."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.functions.format import export_date
from tunelake.session import shuffle_partitions
from tunelake.sinks import commits


def export_dated_csv(df: DataFrame, root: str, day, partition_col: str = "dt",
                     drop: tuple[str, ...] = (), replace: str = "days",
                     rows_per_file: int = 1_000_000, retain_s: float = 3600.0) -> str:
    """K2: write ``df`` as CSV with a header, a folder ``<partition_col>=<dd-MM-yyyy>`` per day.

    ``day`` is a ``datetime.date``/``datetime`` or a date column expression
    (one export then writes many days at once); ``drop`` removes helper
    columns after the day label is computed.
    The files go to a version folder of their own, ``<root>/v=<id>``; then one numbered commit
    names, for every day of the history, the version that holds it. So a reader (``read_dated_csv``) sees
    a day's old files or its new ones, never none or both, and of exports that
    overlap none loses the other's days. Reruns of one day are idempotent and the other days' history
    is kept. A version that no day needs is deleted once it has been replaced for ``retain_s`` seconds.
    Rows are clustered by day before the write, so a day becomes one file instead of
    one per task; a day of more than ``rows_per_file`` rows is dealt out, by a hash
    of the whole row, to as many tasks (and files) as it needs. The rows of
    each day are counted first (one small row a day, joined back), so ``df`` is
    evaluated twice: store it if it is expensive. The hash is deterministic: a
    retried task rebuilds exactly the rows it had.

    ``replace="days"`` (default) swaps only the days present in ``df``;
    ``replace="all"`` makes them the whole history (a backfill).
    """
    if replace not in ("days", "all"):
        raise ValueError("replace must be 'days' or 'all'")
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be >= 1")
    label = export_date(F.lit(day) if not hasattr(day, "_jc") else day)
    labelled = df.withColumn(partition_col, label).drop(*drop)
    deal = F.pmod(F.xxhash64(*labelled.columns), F.col("_files"))
    files = (labelled.groupBy(F.col(partition_col).alias("_day"))
             .agg(F.ceil(F.count("*") / rows_per_file).alias("_files")))
    out = labelled.join(files, F.col(partition_col).eqNullSafe(F.col("_day"))).withColumn(
        "_deal", deal)
    # the partition count is pinned to the session's shuffle partitions: AQE
    # would otherwise coalesce this small shuffle into one task that writes
    # every day's file in sequence; empty partitions write no files
    spark, base, version = df.sparkSession, root.rstrip("/"), f"v={uuid.uuid4().hex}"
    (out.repartition(shuffle_partitions(spark), partition_col, "_deal")
       .drop("_day", "_files", "_deal")
       .write.mode("errorifexists").option("header", True).partitionBy(partition_col)
       .csv(f"{base}/{version}"))
    fs, at, _ = commits.file_system(spark, f"{base}/{version}")
    mine = {st.getPath().getName(): version for st in fs.listStatus(at) if st.isDirectory()}
    commits.commit(spark, base, lambda text: json.dumps(
        (json.loads(text) if text and replace == "days" else {}) | mine, sort_keys=True))
    _prune(spark, base, retain_s)
    return root


def _prune(spark: SparkSession, base: str, retain_s: float) -> None:
    known = commits.numbers(spark, base)
    current = set(json.loads(commits.committed(spark, base, known[-1]) or "{}").values())
    for old, newer in zip(known, known[1:]):
        if time.time() - commits.committed_at(spark, base, newer) < retain_s:
            break
        for version in set(json.loads(commits.committed(spark, base, old) or "{}").values()) - current:
            fs, p, _ = commits.file_system(spark, f"{base}/{version}")
            fs.delete(p, True)
        commits.forget(spark, base, old)


def read_dated_csv(spark: SparkSession, root: str, schema: str, days: Sequence[str] | None = None,
                   partition_col: str = "dt") -> DataFrame:
    """The dated history as of its newest commit: the columns of ``schema`` and the day's
    label; ``days`` (labels) reads only these days' files. No commit yet: no rows."""
    base = root.rstrip("/")
    _, text = commits.newest(spark, base)
    history, held = json.loads(text) if text else {}, {}
    for day, version in history.items():
        held.setdefault(version, []).append(day)
    wanted = history if days is None else [d for d in (f"{partition_col}={x}" for x in days) if d in history]
    paths = []
    for version, mine in held.items():
        fs, at, _ = commits.file_system(spark, f"{base}/{version}")
        if days is None and len(mine) == sum(st.isDirectory() for st in fs.listStatus(at)):
            paths.append(f"{base}/{version}")          # all its days are current: one listing
        else:
            paths += [f"{base}/{version}/{d}" for d in mine if d in wanted]
    if not paths:
        return spark.createDataFrame([], f"{schema}, {partition_col} string")
    rows = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(paths)
            .select("*", F.regexp_extract("_metadata.file_path", f"/{partition_col}=([^/]+)/", 1).alias(
                partition_col)))
    none = "__HIVE_DEFAULT_PARTITION__"
    return rows.withColumn(partition_col, F.nullif(F.col(partition_col), F.lit(none)))


def write_messages(df: DataFrame, path: str, mode: str = "append") -> None:
    """K7/K4: one JSON message per line from a ``value`` string column."""
    df.select(F.col("value").cast("string")).write.mode(mode).text(path)


def append_messages(df: DataFrame, path: str) -> None:
    """K4: add messages with a ``key`` to a folder topic, as lines ``{"key": .., "value": ..}``."""
    df.select(F.to_json(F.struct("key", "value")).alias("value")).write.mode("append").text(path)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """K4 with a broker: needs the spark-sql-kafka connector on the classpath."""
    (df.select(*[F.col(c).cast("string") for c in ("key", "value") if c in df.columns])
       .write.format("kafka")
       .option("kafka.bootstrap.servers", servers)
       .option("topic", topic)
       .save())
