"""Snapshot publishing."""

import os

from tunelake.session import scratch_path
from tunelake.sinks import commits
from tunelake.sinks.commits import numbers
from tunelake.sinks.publish import publish, read_published, snapshot_dirs

SCHEMA = "country string, genre string, total_streams bigint"


def test_last_publish_wins_and_old_reader_is_unaffected(spark):
    root = scratch_path(spark, "pub")
    publish(spark.createDataFrame([("A", "x", 1)], SCHEMA), root, "t")
    old = read_published(spark, root, "t")
    publish(spark.createDataFrame([("B", "y", 2), ("C", "z", 3)], SCHEMA), root, "t")
    assert [tuple(r) for r in old.collect()] == [("A", "x", 1)]
    assert sorted(tuple(r) for r in read_published(spark, root, "t").collect()) == \
        [("B", "y", 2), ("C", "z", 3)]


def test_empty_publish_keeps_schema_and_missing_table_is_typed(spark):
    root = scratch_path(spark, "pub")
    publish(spark.createDataFrame([], SCHEMA), root, "t")
    back = read_published(spark, root, "t")
    assert back.count() == 0 and back.schema.simpleString() == f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>"
    assert read_published(spark, root, "nothing", SCHEMA).count() == 0


def test_uncommitted_snapshot_is_ignored_and_keep_prunes(spark):
    root = scratch_path(spark, "pub")
    for i in range(3):
        publish(spark.createDataFrame([("A", "x", i)], SCHEMA), root, "t", keep=2, retain_s=0)
    assert len(snapshot_dirs(spark, root, "t")) == 2
    assert len(numbers(spark, f"{root}/t")) == 2
    local = root.replace("file:", "")
    os.makedirs(f"{local}/t/v=half", exist_ok=True)                   # written, not committed
    assert read_published(spark, root, "t").collect()[0].total_streams == 2


def test_overlapping_publishes_are_ordered_by_commit(spark, monkeypatch):
    """The publish that starts first but commits last is the newest, and two that claim one
    number both get in."""
    root = scratch_path(spark, "pub")
    slow = spark.createDataFrame([("slow", "x", 1)], SCHEMA)
    fast = spark.createDataFrame([("fast", "x", 2)], SCHEMA)
    commit, state = commits.commit, {"first": True}

    def overtaken(session, folder, text):
        if state.pop("first", None):
            publish(fast, root, "t")          # starts later, commits before
        return commit(session, folder, text)

    monkeypatch.setattr(commits, "commit", overtaken)
    publish(slow, root, "t")
    assert read_published(spark, root, "t").collect()[0].country == "slow"
    assert len(snapshot_dirs(spark, root, "t")) == 2


def test_commits_of_many_threads_lose_none(spark):
    from concurrent.futures import ThreadPoolExecutor
    folder = scratch_path(spark, "commits")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: commits.commit(spark, folder, lambda t: f"{t or ''}{i},"), range(24)))
    number, text = commits.newest(spark, folder)
    assert sorted(got) == list(range(1, 25)) and number == 24
    assert sorted(map(int, text.strip(",").split(","))) == list(range(24))
