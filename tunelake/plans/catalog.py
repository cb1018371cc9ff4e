"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the fixture tables in ``sf_dir`` (or data Spark derives from
them), so its work grows with the tables. Names follow SURVEY §7.3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunelake.operators import views
from tunelake.plans import jobs, oracle
from tunelake.schema import ALL_COUNTRIES
from tunelake.sources.fixtures import chart_view

Query = Callable[[SparkSession, str], DataFrame]

_Q1_COLS = ("country", "track_name", "uri", "streams")
_Q2_COLS = ("country", "track_name", "streams", "release_date")
_Q3_COLS = ("country", "artist_genre", "streams")
_Q4_COLS = ("artist_genre", "artist_individual", "artist_id", "streams")
_Q5_COLS = ("country", "danceability", "energy")


def top_genre_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_genre_by_country(chart_view(spark, sf_dir, _Q3_COLS))


def top_track_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_track_all_time(chart_view(spark, sf_dir, _Q1_COLS))


def top_track_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_track_by_year(chart_view(spark, sf_dir, _Q2_COLS), oracle.FIXTURE_YEAR)


def top_artist_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_artist_by_genre(chart_view(spark, sf_dir, _Q4_COLS),
                                    oracle.FIXTURE_ARTIST_PREFIX)


def feature_means_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.feature_means_by_country(chart_view(spark, sf_dir, _Q5_COLS), digits=6)


def top3_genre_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_genre_by_country(chart_view(spark, sf_dir, _Q3_COLS), n=3)


def clean_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunelake.operators.clean import clean_chart_rows as _clean
    return _clean(chart_view(spark, sf_dir, _Q1_COLS))


# --- serving views over the job results --------------------------------------

def country_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.country_options(top_genre_by_country(spark, sf_dir))


def country_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.headline(top_track_all_time(spark, sf_dir), oracle.FIXTURE_COUNTRY, "track_name")


def country_slice_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.headline(top_genre_by_country(spark, sf_dir), ALL_COUNTRIES, "genre")


def genre_artist_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = jobs.artist_genre_totals(chart_view(spark, sf_dir, _Q4_COLS),
                                      oracle.FIXTURE_ARTIST_PREFIX)
    return views.hierarchy_totals(totals)


def genre_artist_totals_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hierarchy_totals(top_artist_by_genre(spark, sf_dir))


def feature_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.metric_long(feature_means_by_country(spark, sf_dir),
                             ["avg_energy", "avg_danceability"])


def feature_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.metric_labels(feature_means_by_country(spark, sf_dir),
                               ["avg_energy", "avg_danceability"])


def preview_first5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.preview(top_genre_by_country(spark, sf_dir), ["country", "genre"])


def refresh_result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 + K1 from one staged scan of the chart rows; summary of what was published."""
    from tunelake.plans.refresh import published_summary, refresh_results
    from tunelake.session import scratch_path
    root = scratch_path(spark, "results")
    refresh_results(chart_view(spark, sf_dir), root, oracle.FIXTURE_YEAR,
                    oracle.FIXTURE_ARTIST_PREFIX)
    return published_summary(spark, root)


def refresh_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the five tables that the one-pass refresh publishes."""
    from tunelake.plans.refresh import published_rows, refresh_results
    from tunelake.session import scratch_path
    root = scratch_path(spark, "results")
    refresh_results(chart_view(spark, sf_dir), root, oracle.FIXTURE_YEAR,
                    oracle.FIXTURE_ARTIST_PREFIX)
    return published_rows(spark, root)


QUERIES: dict[str, Query] = {
    "top_genre_by_country": top_genre_by_country,
    "top_track_all_time": top_track_all_time,
    "top_track_by_year": top_track_by_year,
    "top_artist_by_genre": top_artist_by_genre,
    "feature_means_by_country": feature_means_by_country,
    "top3_genre_by_country": top3_genre_by_country,
    "clean_chart_rows": clean_chart_rows,
    "country_selector": country_selector,
    "country_slice": country_slice,
    "country_slice_all": country_slice_all,
    "genre_artist_totals": genre_artist_totals,
    "genre_artist_totals_top1": genre_artist_totals_top1,
    "feature_long": feature_long,
    "feature_labels": feature_labels,
    "preview_first5": preview_first5,
    "refresh_result_tables": refresh_result_tables,
    "refresh_result_rows": refresh_result_rows,
}

from tunelake.plans import dashboard, roundtrips, streams  # noqa: E402

QUERIES.update(roundtrips.QUERIES)
QUERIES.update(streams.QUERIES)
QUERIES.update(dashboard.QUERIES)

ORACLE: dict[str, str] = {
    "top_genre_by_country": oracle.q3(),
    "top_track_all_time": oracle.q1(),
    "top_track_by_year": oracle.q2(),
    "top_artist_by_genre": oracle.q4(),
    "feature_means_by_country": oracle.q5(),
    "top3_genre_by_country": oracle.q3(n=3),
    "clean_chart_rows": oracle.clean_rows(),
    "country_selector": oracle.country_selector(),
    "country_slice": oracle.country_slice(),
    "country_slice_all": oracle.country_slice_all(),
    "genre_artist_totals": oracle.genre_artist_totals(),
    "genre_artist_totals_top1": oracle.genre_artist_totals_top1(),
    "feature_long": oracle.feature_long(),
    "feature_labels": oracle.feature_labels(),
    "preview_first5": oracle.preview_first5(),
    "refresh_result_tables": oracle.refresh_summary(),
    "refresh_result_rows": oracle.refresh_rows(),
}

ORACLE.update(roundtrips.ORACLE)
ORACLE.update(streams.ORACLE)
ORACLE.update(dashboard.ORACLE)
