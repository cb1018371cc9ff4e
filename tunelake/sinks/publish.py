"""Replace-all publishing of result tables as immutable snapshots.

``publish`` never touches the snapshot readers are using: each call writes a
new directory ``<root>/<table>/v=<id>`` through Spark's file commit protocol, and
the snapshot becomes visible by a numbered commit that names it. The number is claimed by creating
the commit's file, so publishes that overlap are ordered by when they commit, whatever their clocks
say; ``read_published`` reads the snapshot of the highest number. A failed or half-written
publish (lost executors, killed driver) is simply never named; retrying it writes a fresh
directory. An empty result still publishes a readable, typed table.

Listing uses the Hadoop ``FileSystem`` of the session, so the same code works
on local disk, HDFS or an object store.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tunelake.sinks import commits


def snapshot_dirs(spark: SparkSession, root: str, table: str) -> list[str]:
    """Committed snapshot directories of ``table``, in the order of their commits."""
    base = f"{root.rstrip('/')}/{table}"
    names = [commits.committed(spark, base, n) for n in commits.numbers(spark, base)]
    return [f"{base}/{name}" for name in names if name is not None]


def newest_snapshot(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest committed snapshot: one listing and one small file."""
    base = f"{root.rstrip('/')}/{table}"
    _, name = commits.newest(spark, base)
    return f"{base}/{name}" if name is not None else None


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder the library staged (recursive); ``False`` if absent."""
    fs, p, _ = commits.file_system(spark, path)
    return bool(fs.delete(p, True))


def publish(df: DataFrame, root: str, table: str, keep: int | None = None,
            retain_s: float = 3600.0) -> str:
    """Write ``df`` as the newest snapshot of ``table``; returns its path.

    ``keep`` (optional) deletes committed snapshots beyond the newest ``keep`` once
    a newer one has been visible for ``retain_s`` seconds: a reader that opened a
    snapshot while it was the newest has that long to finish its scan.
    """
    spark, base = df.sparkSession, f"{root.rstrip('/')}/{table}"
    name = f"v={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{base}/{name}")
    commits.commit(spark, base, lambda _: name)
    if keep is not None:
        known = commits.numbers(spark, base)
        for old, newer in zip(known[:-keep], known[1:]):
            if time.time() - commits.committed_at(spark, base, newer) >= retain_s:
                stale = commits.committed(spark, base, old)
                commits.forget(spark, base, old)
                if stale is not None:
                    remove_path(spark, f"{base}/{stale}")
    return f"{base}/{name}"


def read_published(spark: SparkSession, root: str, table: str,
                   schema: str | None = None) -> DataFrame:
    """The newest committed snapshot of ``table``.

    With no snapshot yet, an empty frame of ``schema`` (if given) is returned
    so views render "no data" instead of failing.
    """
    newest = newest_snapshot(spark, root, table)
    if newest is None:
        if schema is None:
            raise FileNotFoundError(f"no published snapshot of {table!r} under {root}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(newest)
