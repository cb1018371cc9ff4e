"""The five batch jobs (Q1-Q5) as compositions of the operators.

Each takes the string-typed chart rows and returns a lazy ``DataFrame``; the
only action is whatever the caller does with it (publish, count, collect).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tunelake.operators.clean import (
    clean, feature_rules, top_artist_rules, top_genre_rules,
    top_track_all_time_rules, top_track_by_year_rules,
)
from tunelake.operators.profile import mean_by
from tunelake.operators.rank import sum_by, top_n_per_group

# --- fixed values (must equal the reference's behaviour) -------------------
DEFAULT_YEAR = "2020"                     # Q2's release-year prefix
DEFAULT_ARTIST_PREFIX = "spotify:artist"  # Q4's artist-id prefix
# ---------------------------------------------------------------------------


def top_track_all_time(chart: DataFrame, n: int = 1) -> DataFrame:
    """Q1: best (track_name, uri) per country by summed streams."""
    rows = clean(chart, top_track_all_time_rules())
    return top_n_per_group(rows, ["country", "track_name", "uri"], ["country"], n=n)


def top_track_by_year(chart: DataFrame, year: str = DEFAULT_YEAR, n: int = 1) -> DataFrame:
    """Q2: best track per country among rows released in ``year``."""
    rows = clean(chart, top_track_by_year_rules(year))
    return top_n_per_group(rows, ["country", "track_name"], ["country"], n=n)


def top_genre_by_country(chart: DataFrame, n: int = 1) -> DataFrame:
    """Q3: best genre per country."""
    rows = clean(chart, top_genre_rules())
    return top_n_per_group(rows, ["country", "genre"], ["country"], n=n)


def top_artist_by_genre(chart: DataFrame, artist_prefix: str = DEFAULT_ARTIST_PREFIX,
                        n: int = 1) -> DataFrame:
    """Q4: best (artist, artist_id) per genre."""
    rows = clean(chart, top_artist_rules(artist_prefix))
    return top_n_per_group(rows, ["genre", "artist", "artist_id"], ["genre"], n=n)


def feature_means_by_country(chart: DataFrame, digits: int | None = None) -> DataFrame:
    """Q5: mean danceability and energy per country."""
    rows = clean(chart, feature_rules())
    return mean_by(rows, ["country"], ["danceability", "energy"], digits=digits)


def artist_genre_totals(chart: DataFrame, artist_prefix: str = DEFAULT_ARTIST_PREFIX) -> DataFrame:
    """Q4's group totals before the top-1 step (input of the A8 hierarchy)."""
    rows = clean(chart, top_artist_rules(artist_prefix))
    return sum_by(rows, ["genre", "artist", "artist_id"], "streams")
