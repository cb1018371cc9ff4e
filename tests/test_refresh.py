"""One-pass refresh (Q1-Q5 together) equals the five jobs run one by one."""

from tunelake.plans import oracle
from tunelake.plans.refresh import all_results, result_tables, table_of, _TABLE_OF_JOB
from tunelake.sources.fixtures import chart_view

MID = "/root/testdata/sf0.01"


def _rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def _same_as_per_job(chart):
    combined = all_results(chart, oracle.FIXTURE_YEAR, oracle.FIXTURE_ARTIST_PREFIX).cache()
    per_job = result_tables(chart, oracle.FIXTURE_YEAR, oracle.FIXTURE_ARTIST_PREFIX)
    for job, table in _TABLE_OF_JOB.items():
        one = table_of(combined, job)
        assert one.columns == per_job[table].columns, table
        assert _rows(one) == _rows(per_job[table]), table
    combined.unpersist()


def test_one_pass_equals_per_job(spark):
    _same_as_per_job(chart_view(spark, MID))


def test_one_pass_equals_per_job_with_a_hot_key(spark):
    from test_skew import _hot_chart
    _same_as_per_job(_hot_chart(spark, ("release_date", "artist_individual", "artist_id",
                                        "danceability", "energy")))


def test_one_pass_plan_scans_once_and_shuffles_twice(spark, small_dir):
    """The production shape: a flat chart table in, one scan, one aggregate
    exchange fed by partial aggregates, one window exchange fed by the partial
    top-1 -- for all five jobs together."""
    from tunelake.session import scratch_path
    path = scratch_path(spark, "flat-chart")
    chart_view(spark, small_dir).write.parquet(path)
    flat = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = all_results(flat, oracle.FIXTURE_YEAR, oracle.FIXTURE_ARTIST_PREFIX) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    assert sum("FileScan" in s for s in lines) == 1
    exchanges = [i for i, s in enumerate(lines) if "Exchange hashpartitioning" in s]
    assert len(exchanges) == 2
    assert any("partial_sum" in s for s in lines[exchanges[1] + 1:exchanges[1] + 3])
    assert any("WindowGroupLimit" in s and "Partial" in s
               for s in lines[exchanges[0] + 1:exchanges[0] + 3])
