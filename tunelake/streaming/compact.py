"""Compaction of a sink's epochs (U2, K6): many small epoch folders, few to read.

``compact_epochs`` merges the closed epochs of a sink into a segment, a folder below
``<sink>-compacted``, and makes it visible by a numbered commit that lists all segments. Readers
(``read_epochs``) take the segments of the newest commit and only the epoch folders after the last
of them, so each event is read once whenever they look. A compactor that dies before
its commit leaves a folder that nobody reads; of two that overlap, the one that commits second gives up.

An epoch is closed once a later one has begun: Spark starts an epoch only after it has
recorded the end of the one before, so a closed epoch is never written again. A segment takes in
the segments before it that are no longer than itself (as counted in epochs), so there are
logarithmically many and a row is rewritten logarithmically often.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tunelake.sinks import commits
from tunelake.sinks.publish import remove_path

EPOCH_COLUMN = "epoch"


def epoch_path(sink: str, epoch_id: int) -> str:
    return f"{sink.rstrip('/')}/{EPOCH_COLUMN}={epoch_id}"


def _base(sink: str) -> str:
    return f"{sink.rstrip('/')}-compacted"


def _epochs(spark: SparkSession, sink: str) -> list[int]:
    fs, p, _ = commits.file_system(spark, sink)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    mark = f"{EPOCH_COLUMN}="
    return sorted(int(n.removeprefix(mark)) for n in names if n.startswith(mark))


def sink_folders(spark: SparkSession, sink: str) -> list[str]:
    """The folders that together hold every event of ``sink`` once."""
    _, text = commits.newest(spark, _base(sink))
    segments = json.loads(text) if text else []
    last = segments[-1]["last"] if segments else -1
    return ([f"{_base(sink)}/{s['name']}" for s in segments]
            + [epoch_path(sink, e) for e in _epochs(spark, sink) if e > last])


def read_epochs(spark: SparkSession, sink: str, fmt: str = "parquet",
                schema: str | None = None) -> DataFrame:
    """Read every epoch of a sink as one table: segments and later epoch folders."""
    r = spark.read.format(fmt)
    if schema:
        r = r.schema(schema)
    df = r.load(sink_folders(spark, sink) or sink)
    return df.drop(EPOCH_COLUMN) if EPOCH_COLUMN in df.columns else df


class _Overtaken(Exception):
    """Another compactor has committed."""


def compact_epochs(spark: SparkSession, sink: str, fmt: str = "parquet", retain_s: float = 3600.0) -> bool:
    """Merge the closed epochs of ``sink`` into a segment; ``False`` if there is nothing to
    merge or another compactor was faster. Folders that have been replaced for ``retain_s`` seconds are
    deleted: as long a reader may take over its scan, and a stream over the
    epoch folders may lag behind."""
    base = _base(sink)
    _, text = commits.newest(spark, base)
    segments = json.loads(text) if text else []
    last = segments[-1]["last"] if segments else -1
    closed = [e for e in _epochs(spark, sink) if e > last][:-1]
    if closed:
        span, inputs = len(closed), [epoch_path(sink, e) for e in closed]
        while segments and segments[-1]["epochs"] <= span:
            inside = segments.pop()
            span += inside["epochs"]
            inputs.insert(0, f"{base}/{inside['name']}")
        name = f"v={uuid.uuid4().hex}"
        spark.read.format(fmt).load(inputs).write.mode("errorifexists").format(fmt).save(f"{base}/{name}")
        segments.append({"name": name, "epochs": span, "last": closed[-1]})

        def listed(now: str | None) -> str:
            if now != text:
                raise _Overtaken
            return json.dumps(segments)

        try:
            commits.commit(spark, base, listed)
        except _Overtaken:
            remove_path(spark, f"{base}/{name}")
            return False
    _clean(spark, sink, retain_s)
    return bool(closed)


def _clean(spark: SparkSession, sink: str, retain_s: float) -> None:
    base = _base(sink)
    known = commits.numbers(spark, base)
    lists = [json.loads(commits.committed(spark, base, n) or "[]") for n in known]
    for n, (number, segments) in enumerate(zip(known, lists)):
        if time.time() - commits.committed_at(spark, base, number) < retain_s:
            break
        for e in _epochs(spark, sink):
            if e <= segments[-1]["last"]:
                remove_path(spark, epoch_path(sink, e))
        for s in lists[n - 1] if n else []:
            if s not in segments:
                remove_path(spark, f"{base}/{s['name']}")
        if n:
            commits.forget(spark, base, known[n - 1])
