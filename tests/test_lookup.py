"""Dense keyed-pick index (J1) and the latest-row pick."""

from pyspark.sql import functions as F

from tunelake.streaming.events import index_lookup, keyed_pick, latest


def test_index_is_dense_and_in_key_order_across_partitions(spark):
    keys = list(range(0, 3000, 3))
    lookup = spark.createDataFrame([(k, f"t{k}") for k in reversed(keys)],
                                   "k bigint, track_name string").repartition(7)
    rows = sorted((r.idx, r.track_name) for r in index_lookup(lookup, "k").collect())
    assert rows == [(i, f"t{k}") for i, k in enumerate(keys)]


def test_keyed_pick_wraps_with_pmod(spark):
    lookup = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "k bigint, track_name string")
    idx = index_lookup(lookup, "k")
    ev = spark.createDataFrame([(7,), (-1,), (10,)], "event_id bigint")
    got = {r.event_id: r.track_name for r in keyed_pick(ev, idx, F.col("event_id"), 5).collect()}
    assert got == {7: "t2", -1: "t4", 10: "t0"}


def test_latest_row(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 30), (3, "c", 20)],
                               "id bigint, track string, ts bigint")
    assert [tuple(r) for r in latest(df, ["ts", "id"], ["track"]).collect()] == [("b",)]


def test_random_mode_picks_from_the_lookup_and_is_seeded(spark):
    from pyspark.sql import functions as F
    from tunelake.streaming.events import random_key
    lookup = spark.createDataFrame([(k, f"t{k}") for k in range(7)], "k int, track_name string")
    idx = index_lookup(lookup, "k")
    ev = spark.range(0, 500, numPartitions=4)   # no shuffle: a fixed row order per partition
    a = keyed_pick(ev, idx, random_key(7, seed=11), 7)
    b = keyed_pick(ev, idx, random_key(7, seed=11), 7)
    ra = {r.id: r.track_name for r in a.collect()}
    assert len(ra) == 500 and set(ra.values()) == {f"t{k}" for k in range(7)}
    assert ra == {r.id: r.track_name for r in b.collect()}


def test_index_with_a_hot_key_is_dense_and_spread(spark):
    from pyspark.sql import functions as F
    lookup = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.format_string("t%05d", "id").alias("track_name"))
    idx = index_lookup(lookup, "k")
    rows = idx.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(3000))
    want = sorted(((7 if i % 3 == 0 else i), f"t{i:05d}") for i in range(3000))
    assert [r.track_name for r in rows] == [t for _, t in want]


def test_empty_lookup_gives_null_names(spark):
    empty = spark.createDataFrame([], "k int, track_name string")
    ev = spark.range(0, 5)
    got = keyed_pick(ev, index_lookup(empty, "k"), ev.id, 0).collect()
    assert len(got) == 5 and all(r.track_name is None for r in got)


def test_latest_of_nothing_is_no_row(spark):
    empty = spark.createDataFrame([], "ts string, id int, track string")
    assert latest(empty, ["ts", "id"], ["track"]).count() == 0


def test_small_checkpointed_index_is_broadcast(spark, small_dir):
    """The per-epoch pick joins a checkpointed index; while it is small Spark
    broadcasts it (its size is checked against the threshold), so a
    micro-batch never shuffles the lookup."""
    from pyspark.sql import functions as F
    from tunelake.session import checkpoint_root
    from tunelake.sources.fixtures import read_table
    checkpoint_root(spark)
    lookup = read_table(spark, small_dir, "part").select(
        "p_partkey", F.col("p_name").alias("track_name"))
    idx = index_lookup(lookup, "p_partkey").checkpoint()
    ev = read_table(spark, small_dir, "events")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = keyed_pick(ev, idx, ev.event_id, idx.count())._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
