"""Publishing jobs: every result table from one pass over the chart rows
(Q1-Q5 + K1), and the daily chart (Q6: K1 + K2).

The reference runs five jobs that each rescan and re-clean the same input.
``all_results`` computes the five in one pass: each chart row emits one small
entry per job whose cleaning rules it passes (at most five; no expansion of
rows that fail), one aggregate over ``(job, k1, k2, k3)`` sums / averages them
(partial aggregation before its single shuffle), and one top-1 window ranks
all jobs together -- jobs 1-4 partition by ``(job, k1)`` and break ties on
``(k2, k3)``; job 5 has one row per ``(job, k1)``, which the top-1 keeps. Input is scanned once, there are two shuffles instead of nine,
and the large chart rows are never written. Only the small combined result is
staged below the checkpoint root (this cuts the lineage: publishing and any
retry read that table, not the input and its joins); the five tables are
published from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.functions.text import to_count, to_feature
from tunelake.operators.clean import (
    condition, feature_rules, top_artist_rules, top_genre_rules, top_track_all_time_rules,
    top_track_by_year_rules,
)
from tunelake.operators.daily import flatten_chart, newest_documents
from tunelake.operators.rank import top_n
from tunelake.plans import jobs
from tunelake.schema import (
    DAILY_CHARTS, ENERGY_PER_COUNTRY, RESULT_SCHEMAS, TOP_ARTIST_PER_GENRE, TOP_GENRE_ALL_TIME,
    TOP_SONG_2020, TOP_SONGS_ALL_TIME,
)
from tunelake.session import scratch_path
from tunelake.sinks.export import export_dated_csv
from tunelake.sinks.publish import publish, read_published, remove_path


def result_tables(rows: DataFrame, year: str = jobs.DEFAULT_YEAR,
                  artist_prefix: str = jobs.DEFAULT_ARTIST_PREFIX) -> dict[str, DataFrame]:
    """The five result tables, named by the shared catalog."""
    return {
        TOP_SONGS_ALL_TIME: jobs.top_track_all_time(rows),
        TOP_SONG_2020: jobs.top_track_by_year(rows, year),
        TOP_GENRE_ALL_TIME: jobs.top_genre_by_country(rows),
        TOP_ARTIST_PER_GENRE: jobs.top_artist_by_genre(rows, artist_prefix),
        ENERGY_PER_COUNTRY: jobs.feature_means_by_country(rows),
    }


# job ids of the combined result, and how each maps back to its table
_TABLE_OF_JOB = {1: TOP_SONGS_ALL_TIME, 2: TOP_SONG_2020, 3: TOP_GENRE_ALL_TIME,
                 4: TOP_ARTIST_PER_GENRE, 5: ENERGY_PER_COUNTRY}
_COLUMNS_OF_JOB = {
    1: (("k1", "country"), ("k2", "track_name"), ("k3", "uri"), ("total_streams", None)),
    2: (("k1", "country"), ("k2", "track_name"), ("total_streams", None)),
    3: (("k1", "country"), ("k2", "genre"), ("total_streams", None)),
    4: (("k1", "genre"), ("k2", "artist"), ("k3", "artist_id"), ("total_streams", None)),
    5: (("k1", "country"), ("avg_danceability", None), ("avg_energy", None)),
}


def all_results(chart: DataFrame, year: str = jobs.DEFAULT_YEAR,
                artist_prefix: str = jobs.DEFAULT_ARTIST_PREFIX) -> DataFrame:
    """Q1-Q5 in one pass: ``(job, k1, k2, k3, total_streams, avg_danceability,
    avg_energy)``, one row per result row of each job."""
    text = F.lit(None).cast("string")
    count = to_count("streams")
    none_l, none_d = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def entry(job, rules, k1, k2=text, k3=text, s=none_l, d=none_d, e=none_d):
        return F.when(condition(rules), F.struct(
            F.lit(job).alias("job"), k1.alias("k1"), k2.alias("k2"), k3.alias("k3"),
            s.alias("s"), d.alias("d"), e.alias("e")))

    c = F.col
    entries = F.array(
        entry(1, top_track_all_time_rules(), c("country"), c("track_name"), c("uri"), s=count),
        entry(2, top_track_by_year_rules(year), c("country"), c("track_name"), s=count),
        entry(3, top_genre_rules(), c("country"), c("artist_genre"), s=count),
        entry(4, top_artist_rules(artist_prefix), c("artist_genre"), c("artist_individual"),
              c("artist_id"), s=count),
        entry(5, feature_rules(), c("country"),
              d=to_feature("danceability"), e=to_feature("energy")),
    )
    # explode, then drop the empty slots with a plain filter: a lambda
    # (``F.filter``) would leave whole-stage codegen for every row
    rows = (chart.select(F.explode(entries).alias("x"))
                 .filter(F.col("x").isNotNull())
                 .select("x.*"))
    agg = rows.groupBy("job", "k1", "k2", "k3").agg(
        F.sum("s").alias("total_streams"),          # sum, not try_sum: overflow fails (R6)
        F.avg("d").alias("avg_danceability"), F.avg("e").alias("avg_energy"))
    # job 5 groups by country alone, so each of its (job, k1) partitions holds
    # exactly one row and the top-1 keeps it: one window for all five jobs
    return top_n(agg, ["job", "k1"], "total_streams", ["k2", "k3"])


def table_of(combined: DataFrame, job: int) -> DataFrame:
    """One result table out of the combined result, with its own column names."""
    cols = [F.col(src).alias(dst or src) for src, dst in _COLUMNS_OF_JOB[job]]
    return combined.filter(F.col("job") == job).select(*cols)


def refresh_results(chart: DataFrame, root: str, year: str = jobs.DEFAULT_YEAR,
                    artist_prefix: str = jobs.DEFAULT_ARTIST_PREFIX,
                    keep: int | None = None) -> dict[str, str]:
    """Compute all five tables in one pass, stage the small combined result,
    publish each table from it; returns the snapshot paths.

    The five publishes are independent small jobs over the staged result, so
    they are submitted together from driver threads (Spark schedules
    concurrent jobs of one application); each table's snapshot still commits
    on its own, as before. The stage is removed once all five have committed;
    if a publish fails, it stays for inspection.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = chart.sparkSession
    stage = scratch_path(spark, "results-combined")
    all_results(chart, year, artist_prefix).write.parquet(stage)
    combined = spark.read.parquet(stage)
    with ThreadPoolExecutor(max_workers=len(_TABLE_OF_JOB)) as pool:
        futures = {table: pool.submit(publish, table_of(combined, job), root, table, keep)
                   for job, table in _TABLE_OF_JOB.items()}
        paths = {table: f.result() for table, f in futures.items()}
    remove_path(spark, stage)     # every snapshot is its own copy now
    return paths


def published_summary(spark: SparkSession, root: str) -> DataFrame:
    """Row count and stream total of every published result table."""
    parts = []
    for name in (TOP_SONGS_ALL_TIME, TOP_SONG_2020, TOP_GENRE_ALL_TIME,
                 TOP_ARTIST_PER_GENRE, ENERGY_PER_COUNTRY):
        t = read_published(spark, root, name)
        total = F.sum("total_streams") if "total_streams" in t.columns else F.lit(None)
        parts.append(t.agg(F.lit(name).alias("table_name"),
                           F.count(F.lit(1)).alias("n"),
                           total.cast("bigint").alias("total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def published_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the five published tables in one shape: table, three keys, the
    stream total and the two means (to six decimals)."""
    def row(t: DataFrame, name: str, keys: list[str]) -> DataFrame:
        texts = [(F.col(keys[i]) if i < len(keys) else F.lit(None).cast("string")).alias(f"k{i + 1}")
                 for i in range(3)]
        numbers = [(F.col(c) if c in t.columns else F.lit(None)).cast(kind).alias(c)
                   for c, kind in (("total_streams", "bigint"), ("avg_danceability", "double"),
                                   ("avg_energy", "double"))]
        return t.select(F.lit(name).alias("table_name"), *texts, numbers[0],
                        *[F.round(c, 6).alias(n) for c, n in
                          zip(numbers[1:], ("avg_danceability", "avg_energy"))])

    parts = [row(read_published(spark, root, name), name, keys) for name, keys in (
        (TOP_SONGS_ALL_TIME, ["country", "track_name", "uri"]),
        (TOP_SONG_2020, ["country", "track_name"]), (TOP_GENRE_ALL_TIME, ["country", "genre"]),
        (TOP_ARTIST_PER_GENRE, ["genre", "artist", "artist_id"]), (ENERGY_PER_COUNTRY, ["country"]))]
    return reduce(DataFrame.unionByName, parts)


def save_daily_chart(docs: DataFrame, root: str, history_root: str, date: str | None = None,
                     chart_index: int = 0) -> str:
    """Q6 (K1 + K2): the newest chart of the landed documents ``docs`` replaces
    ``daily_charts`` and is added to the dated CSV history; returns the published
    snapshot path.

    The landing is read for its dates and for the newest chart, which is stored; the
    check, the export and the publish read that table. Documents that yield no entries raise an error
    and leave the published table as it is.
    """
    spark = docs.sparkSession
    stage = scratch_path(spark, "daily-chart")
    flatten_chart(newest_documents(docs, date), chart_index).write.parquet(stage)
    chart = spark.read.schema("chartDate string, " + RESULT_SCHEMAS[DAILY_CHARTS]).parquet(stage)
    if chart.isEmpty():
        remove_path(spark, stage)
        raise ValueError("the newest chart documents have no entries; nothing is published "
                         "(one JSON object per line is expected, or multi_line=True)")
    export_dated_csv(chart, history_root, F.to_date("chartDate"), drop=("chartDate",))
    path = publish(chart.drop("chartDate"), root, DAILY_CHARTS)
    remove_path(spark, stage)
    return path
