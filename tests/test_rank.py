"""Top-n per group: ties (R1), null keys (R2), all-null totals (R5), overflow."""

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tunelake.operators.rank import top_n_per_group


def test_ties_resolve_by_remaining_keys(spark):
    df = spark.createDataFrame(
        [("A", "x", 5), ("A", "y", 5), ("A", "b", 5), ("B", "z", 1)],
        "country string, genre string, streams bigint")
    out = {r.country: r.genre for r in
           top_n_per_group(df, ["country", "genre"], ["country"], "streams").collect()}
    assert out == {"A": "b", "B": "z"}


def test_result_invariant_under_repartition(spark):
    rows = [(f"c{i % 7}", f"g{i % 13}", i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "country string, genre string, streams bigint")
    base = sorted(top_n_per_group(df, ["country", "genre"], ["country"], "streams").collect())
    for n in (1, 3, 17):
        shuffled = df.repartition(n).orderBy(F.rand(n))
        assert sorted(top_n_per_group(shuffled, ["country", "genre"], ["country"],
                                      "streams").collect()) == base


def test_top1_is_subset_of_top3(spark):
    rows = [(f"c{i % 5}", f"g{i % 11}", (i * 7) % 13) for i in range(500)]
    df = spark.createDataFrame(rows, "country string, genre string, streams bigint")
    t1 = set(top_n_per_group(df, ["country", "genre"], ["country"], "streams").collect())
    t3 = set(top_n_per_group(df, ["country", "genre"], ["country"], "streams", n=3).collect())
    assert t1 <= t3 and len(t3) == 15


def test_null_partition_key_is_its_own_group_and_null_totals_sort_last(spark):
    df = spark.createDataFrame(
        [(None, "a", 3), (None, "b", 4), ("X", "n", None), ("X", "m", 1)],
        "country string, track_name string, streams bigint")
    out = {r.country: (r.track_name, r.total_streams) for r in
           top_n_per_group(df, ["country", "track_name"], ["country"], "streams").collect()}
    assert out == {None: ("b", 4), "X": ("m", 1)}


def test_long_overflow_fails_loudly(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([("A", "x", big), ("A", "x", big)],
                               "country string, genre string, streams bigint")
    with pytest.raises(Exception) as e:
        top_n_per_group(df, ["country", "genre"], ["country"], "streams").collect()
    assert "OVERFLOW" in str(e.value).upper() or isinstance(e.value, ArithmeticException)


def test_partition_must_be_group_key(spark):
    df = spark.createDataFrame([("A", "x", 1)], "country string, genre string, streams bigint")
    with pytest.raises(ValueError):
        top_n_per_group(df, ["genre"], ["country"], "streams")


def test_plan_uses_partial_window_group_limit(spark):
    df = spark.createDataFrame([("A", "x", 1)], "country string, genre string, streams bigint")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = top_n_per_group(df, ["country", "genre"], ["country"], "streams") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("WindowGroupLimit") == 2


def test_large_n_uses_exact_salted_two_step(spark):
    """n above the partial-limit threshold: same rows as the plain window."""
    from pyspark.sql import functions as F
    from tunelake.operators.rank import top_n
    base = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 7).cast("string"))
         .alias("country"),
        (F.col("id") * 7919 % 1000).cast("string").alias("genre"),
        (F.col("id") % 13).alias("total_streams"))
    plain = {tuple(r) for r in top_n(base, ["country"], "total_streams", ["genre"], 50).collect()}
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        two_step = top_n(base, ["country"], "total_streams", ["genre"], 50)
        plan = two_step._jdf.queryExecution().optimizedPlan().toString()
        got = {tuple(r) for r in two_step.collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert "_salt" in plan
    assert got == plain and len(got) == 8 * 50
