"""Typed cleaning of string-typed chart rows.

A ``CleanRules`` value describes one job's cleaning; ``clean`` turns it into a
single ``Filter`` + ``Project`` (Catalyst merges the chained predicates, pushes
``IS NOT NULL`` / ``StartsWith`` into the parquet scan and keeps the regexes in
the codegen'd filter). Regex tests run *before* casts, on text, so the result
does not depend on how a reader typed the column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.functions.text import (
    all_not_null, has_prefix, is_plain_number, not_plain_number, to_count, to_feature,
)


@dataclass(frozen=True)
class CleanRules:
    required: tuple[str, ...] = ()            # F1: not null
    numeric: tuple[str, ...] = ()             # F2: must be a plain number
    not_numeric: tuple[str, ...] = ()         # F3: must not be a plain number
    prefixes: tuple[tuple[str, str], ...] = ()  # (column, prefix)
    counts: tuple[str, ...] = ()              # P1: text -> long
    features: tuple[str, ...] = ()            # P2: text -> double
    renames: tuple[tuple[str, str], ...] = ()  # P4: (old, new)
    keep: tuple[str, ...] = field(default=())  # projection after cleaning (empty: all)


def condition(rules: CleanRules) -> Column:
    """The row predicate of a rule set (F1-F4); null counts as false."""
    cond = all_not_null(rules.required)
    for c in rules.numeric:
        cond = cond & is_plain_number(c)
    for c in rules.not_numeric:
        cond = cond & not_plain_number(c)
    for c, p in rules.prefixes:
        cond = cond & has_prefix(c, p)
    return cond


def clean(df: DataFrame, rules: CleanRules) -> DataFrame:
    out = df.filter(condition(rules))
    casts = {c: to_count(c) for c in rules.counts}
    casts.update({c: to_feature(c) for c in rules.features})
    if casts:
        out = out.withColumns(casts)
    if rules.renames:
        out = out.withColumnsRenamed(dict(rules.renames))
    if rules.keep:
        out = out.select(*rules.keep)
    return out


# --- per-job rule sets ------------------------------------------------------

def top_track_all_time_rules() -> CleanRules:
    """Q1: complete keyed rows with a plain stream count and a textual country."""
    return CleanRules(
        required=("streams", "country", "track_name", "uri"),
        numeric=("streams",),
        not_numeric=("country",),
        counts=("streams",),
        keep=("country", "track_name", "uri", "streams"),
    )


def top_track_by_year_rules(year: str) -> CleanRules:
    """Q2: release-year prefix and non-null streams only; bad counts become
    null (no regex guard in this job), null/numeric countries are kept."""
    return CleanRules(
        required=("streams",),
        prefixes=(("release_date", str(year)),),
        counts=("streams",),
        keep=("country", "track_name", "streams"),
    )


def top_genre_rules() -> CleanRules:
    """Q3."""
    return CleanRules(
        required=("streams", "country", "artist_genre"),
        numeric=("streams",),
        not_numeric=("country",),
        counts=("streams",),
        renames=(("artist_genre", "genre"),),
        keep=("country", "genre", "streams"),
    )


def top_artist_rules(artist_prefix: str) -> CleanRules:
    """Q4: no country test; the artist id must carry the catalog prefix."""
    return CleanRules(
        required=("streams", "artist_genre", "artist_individual", "artist_id"),
        numeric=("streams",),
        prefixes=(("artist_id", artist_prefix),),
        counts=("streams",),
        renames=(("artist_genre", "genre"), ("artist_individual", "artist")),
        keep=("genre", "artist", "artist_id", "streams"),
    )


def feature_rules() -> CleanRules:
    """Q5: country not null (a numeric country is kept), both features plain numbers."""
    return CleanRules(
        required=("country", "danceability", "energy"),
        numeric=("danceability", "energy"),
        features=("danceability", "energy"),
        keep=("country", "danceability", "energy"),
    )


def clean_chart_rows(df: DataFrame) -> DataFrame:
    """Q1's cleaned rows, all four keys kept (the ``clean_chart_rows`` query)."""
    return clean(df, top_track_all_time_rules())


def count_rows(df: DataFrame) -> DataFrame:
    """A6 as a one-row DataFrame (``n``), so it composes like any other result."""
    return df.agg(F.count(F.lit(1)).alias("n"))
