"""Q6's publish step and Q15's view dispatch over published result tables.

The reference's dashboard reads result collections by name and the writers
disagree on some names (R13, R14). Here each view query publishes its result
table under the shared catalog name, reads the newest snapshot back by that
name, and dispatches the view by its dashboard name -- the full
write/read/serve cycle, checked against the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.operators.position import positioned
from tunelake.operators.views import VIEW_NAMES, country_options, dashboard_view, has_rows
from tunelake.plans import jobs, oracle
from tunelake.plans.refresh import save_daily_chart
from tunelake.plans.roundtrips import _CHART_DAYS, land_chart_documents
from tunelake.schema import (
    ALL_COUNTRIES, DAILY_CHARTS, ENERGY_PER_COUNTRY, RESULT_SCHEMAS, TOP_ARTIST_PER_GENRE,
    TOP_GENRE_ALL_TIME, TOP_SONGS_ALL_TIME,
)
from tunelake.session import scratch_path
from tunelake.sinks.publish import publish, read_published
from tunelake.sources.charts import read_chart_documents
from tunelake.sources.fixtures import chart_view


def _result(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One batch job's result, by catalog name (fixture parameters)."""
    if table == TOP_SONGS_ALL_TIME:
        return jobs.top_track_all_time(
            chart_view(spark, sf_dir, ("country", "track_name", "uri", "streams")))
    if table == TOP_GENRE_ALL_TIME:
        return jobs.top_genre_by_country(
            chart_view(spark, sf_dir, ("country", "artist_genre", "streams")))
    if table == TOP_ARTIST_PER_GENRE:
        return jobs.top_artist_by_genre(
            chart_view(spark, sf_dir, ("artist_genre", "artist_individual", "artist_id",
                                       "streams")), oracle.FIXTURE_ARTIST_PREFIX)
    if table == ENERGY_PER_COUNTRY:
        return jobs.feature_means_by_country(
            chart_view(spark, sf_dir, ("country", "danceability", "energy")), digits=6)
    raise ValueError(table)


def _served(spark: SparkSession, sf_dir: str, table: str, view: str,
            country: str | None = None, metric: str = "avg_energy") -> DataFrame:
    root = scratch_path(spark, "published")
    publish(_result(spark, sf_dir, table), root, table)
    return dashboard_view(view, {table: read_published(spark, root, table)}, country, metric)


def view_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 for one country."""
    return _served(spark, sf_dir, TOP_SONGS_ALL_TIME, "Top Songs", oracle.FIXTURE_COUNTRY)


def view_top_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10 for all countries."""
    return _served(spark, sf_dir, TOP_GENRE_ALL_TIME, "Top Genre", ALL_COUNTRIES)


def view_top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11: genre -> artist hierarchy of the published top-artist table."""
    return _served(spark, sf_dir, TOP_ARTIST_PER_GENRE, "Top Artists")


def view_energy_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12, all countries: (country, value) of the chosen metric."""
    return _served(spark, sf_dir, ENERGY_PER_COUNTRY, "Energy Map", ALL_COUNTRIES, "avg_energy")


def view_energy_map_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12, one country: its two-decimal labels."""
    return _served(spark, sf_dir, ENERGY_PER_COUNTRY, "Energy Map", oracle.FIXTURE_COUNTRY)


def view_country_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: the country list read from the published top-genre table."""
    root = scratch_path(spark, "published")
    publish(_result(spark, sf_dir, TOP_GENRE_ALL_TIME), root, TOP_GENRE_ALL_TIME)
    return country_options(read_published(spark, root, TOP_GENRE_ALL_TIME))


def view_trending_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 + Q13 chart part: landed documents -> newest chart published as
    ``daily_charts`` (and exported) -> served by rank."""
    docs = read_chart_documents(spark, land_chart_documents(spark, sf_dir))
    root = scratch_path(spark, "published")
    save_daily_chart(docs, root, scratch_path(spark, "chart-history"))
    return dashboard_view("Trending Now", {DAILY_CHARTS: read_published(spark, root, DAILY_CHARTS)})


def country_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the place of every entry in the sorted country list."""
    path = scratch_path(spark, "country-list")
    options = country_options(_result(spark, sf_dir, TOP_GENRE_ALL_TIME))
    (options.withColumns({"part": F.spark_partition_id(), "n": F.monotonically_increasing_id()})
     .write.parquet(path))
    return positioned(spark.read.parquet(path), ["part", "n"]).select("pos", "country")


def view_no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: which views have something to show, of the published tables and of tables that are empty."""
    root = scratch_path(spark, "published")
    full, none = {}, {}
    for table in (TOP_SONGS_ALL_TIME, TOP_GENRE_ALL_TIME, TOP_ARTIST_PER_GENRE, ENERGY_PER_COUNTRY):
        publish(_result(spark, sf_dir, table), root, table)
        full[table] = read_published(spark, root, table)
        none[table] = read_published(spark, root + "-none", table, RESULT_SCHEMAS[table])
    rows = [(name, kind, has_rows(dashboard_view(name, tables, country)))
            for kind, tables in (("published", full), ("empty", none))
            for name in VIEW_NAMES[:4] for country in (oracle.FIXTURE_COUNTRY,)]
    return spark.createDataFrame(rows, "view string, tables string, has_rows boolean")


QUERIES = {
    "country_order": country_order,
    "view_no_data": view_no_data,
    "view_top_songs": view_top_songs,
    "view_top_genre": view_top_genre,
    "view_top_artists": view_top_artists,
    "view_energy_map": view_energy_map,
    "view_energy_map_country": view_energy_map_country,
    "view_trending_now": view_trending_now,
    "view_country_selector": view_country_selector,
}

ORACLE = {
    "country_order": oracle.sql([f"c AS ({oracle.country_selector()})"],
                                "SELECT row_number() OVER (ORDER BY ord, country) - 1 AS pos, country FROM c"),
    "view_no_data": "SELECT v AS view, t AS tables, t = 'published' AND EXISTS (SELECT 1 FROM lineitem) "
                    "AS has_rows FROM (VALUES ('published'), ('empty')) a(t), "
                    "(VALUES " + ", ".join(f"('{n}')" for n in VIEW_NAMES[:4]) + ") b(v)",
    "view_top_songs": oracle.country_slice(),
    "view_top_genre": oracle.country_slice_all(),
    "view_top_artists": oracle.genre_artist_totals_top1(),
    "view_energy_map": oracle.sql(oracle.q5_ctes(), "SELECT country, avg_energy AS value FROM q5"),
    "view_energy_map_country": oracle.feature_labels(oracle.FIXTURE_COUNTRY),
    "view_country_selector": oracle.country_selector(),
    "view_trending_now": f"WITH {_CHART_DAYS}\nSELECT Rank, Artist, TrackName FROM flat\n"
                         "WHERE day = (SELECT max(day) FROM flat)",
}
