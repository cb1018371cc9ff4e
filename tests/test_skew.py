"""A hot key holding a third of all rows: exact results and a plan that reduces
before every shuffle (partial aggregate, partial ``WindowGroupLimit``).

The input is the sf0.01 chart view with every third order moved to one country
and every third part to one track, so one country, one track and one
(country, track) group each carry about a third of the rows.
"""

from pyspark.sql import functions as F

from tunelake.plans import jobs
from tunelake.sources.fixtures import chart_view

MID = "/root/testdata/sf0.01"


def _hot_chart(spark, extra=()):
    cols = ("country", "track_name", "uri", "artist_genre", "streams") + tuple(extra)
    base = chart_view(spark, MID, cols)
    # the hot rows keep their dirty streams values, so cleaning still applies
    h = F.xxhash64("country", "track_name", "uri", "streams")
    return base.select(
        F.when(F.pmod(h, F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("country")).alias("country"),
        F.when(F.pmod(h, F.lit(3)) == 0, F.lit("hot track")).otherwise(F.col("track_name"))
         .alias("track_name"),
        F.when(F.pmod(h, F.lit(3)) == 0, F.lit("part:hot")).otherwise(F.col("uri")).alias("uri"),
        "artist_genre", "streams", *extra)


def _brute_top1(pdf, keys, part):
    """Top-1 per ``part`` by summed streams, ties by the other keys ascending."""
    total = pdf.groupby(keys, dropna=False)["streams"].sum(min_count=1).reset_index()
    ties = [k for k in keys if k not in part]
    total = total.sort_values(["streams"] + ties, ascending=[False] + [True] * len(ties),
                              na_position="last")
    return {tuple(r[k] for k in keys): int(r["streams"])
            for _, r in total.groupby(part, dropna=False).head(1).iterrows()}


def _clean_q1(pdf):
    ok = (pdf.streams.notna() & pdf.country.notna() & pdf.track_name.notna() & pdf.uri.notna())
    pdf = pdf[ok]
    pdf = pdf[pdf.streams.str.fullmatch(r"[0-9]+(\.[0-9]+)?")
              & ~pdf.country.str.fullmatch(r"[0-9]+(\.[0-9]+)?")].copy()
    pdf["streams"] = pdf.streams.astype(float).astype("int64")
    return pdf


def test_hot_key_results_equal_brute_force(spark):
    chart = _hot_chart(spark)
    pdf = chart.toPandas()
    hot_share = (pdf.country == "HOT").mean()
    assert 0.3 < hot_share < 0.37

    got = {(r.country, r.track_name, r.uri): r.total_streams
           for r in jobs.top_track_all_time(chart).collect()}
    want = _brute_top1(_clean_q1(pdf), ["country", "track_name", "uri"], ["country"])
    assert got == want
    assert got[("HOT", "hot track", "part:hot")] > 0

    q3 = _clean_q1(pdf.rename(columns={"artist_genre": "genre"}).assign(uri="u"))
    got3 = {(r.country, r.genre): r.total_streams
            for r in jobs.top_genre_by_country(chart).collect()}
    assert got3 == _brute_top1(q3, ["country", "genre"], ["country"])


def test_hot_key_plan_reduces_before_each_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = jobs.top_track_all_time(_hot_chart(spark)) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()

    def below(op_pred, child_pred):
        """Every line matching op_pred has child_pred within its next 3 lines."""
        hits = [i for i, s in enumerate(lines) if op_pred(s)]
        return hits and all(any(child_pred(s) for s in lines[i + 1:i + 4]) for i in hits)

    # the group-key exchange is fed by the map-side partial sum
    assert below(lambda s: "Exchange hashpartitioning(country" in s and "track_name" in s,
                 lambda s: "partial_sum" in s)
    # the partition-key exchange is fed by the partial per-task top-1
    assert below(lambda s: "Exchange hashpartitioning(country" in s and "track_name" not in s,
                 lambda s: "WindowGroupLimit" in s and "Partial" in s)


def test_cleaning_runs_before_the_first_shuffle(spark, small_dir):
    """Q3 at scale settings: the regex filter sits between the lineitem scan
    and its first exchange, so rejected rows are never shuffled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jobs.top_genre_by_country(
            chart_view(spark, small_dir, ("country", "artist_genre", "streams"))) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, s in enumerate(lines) if "FileScan parquet [l_orderkey" in s)
    exchange = max(i for i in range(scan) if "Exchange" in lines[i])
    between = lines[exchange + 1:scan]
    assert any("Filter" in s and "RLIKE" in s for s in between)
