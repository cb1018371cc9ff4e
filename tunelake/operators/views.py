"""Serving views over the published result tables (Q9-Q12, Q14).

The reference pulls whole collections into a UI process and filters there;
here every view is a DataFrame over the result table, so the country filter is
a pushed-down predicate and only the view's rows ever leave the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.functions.format import streams_label, two_decimals
from tunelake.operators.daily import sorted_by_rank
from tunelake.schema import (
    ALL_COUNTRIES, DAILY_CHARTS, ENERGY_PER_COUNTRY, TOP_ARTIST_PER_GENRE, TOP_GENRE_ALL_TIME,
    TOP_SONGS_ALL_TIME,
)


def country_options(df: DataFrame, col: str = "country",
                    all_label: str = ALL_COUNTRIES) -> DataFrame:
    """Q14 (F7 A7 O3 U1): the sentinel first, then the sorted distinct values.

    Returns ``(ord, country)``; ``ord`` is 0 for the sentinel and 1 for data
    values, and the frame is sorted by ``(ord, country)`` with a distributed
    range sort (no single-task global window).
    """
    values = (df.select(F.col(col).alias("country")).dropna().distinct()
                .withColumn("ord", F.lit(1)))
    sentinel = df.sparkSession.range(1).select(F.lit(0).alias("ord"),
                                               F.lit(all_label).alias("country"))
    return (sentinel.unionByName(values.select("ord", "country"))
                    .orderBy("ord", "country"))


def country_slice(df: DataFrame, country: str | None) -> DataFrame:
    """``None`` or the sentinel means every row, else one country's rows."""
    if country is None or country == ALL_COUNTRIES:
        return df
    return df.filter(F.col("country") == F.lit(country))


def headline(df: DataFrame, country: str | None, name_col: str,
             measure: str = "total_streams") -> DataFrame:
    """Q9/Q10 (F5 O4 X15): the first row of a country's slice with its label.

    Result tables hold one row per country after top-1, so "first" is the row
    with the largest measure (ties by name) -- a top-1, kept as ``limit(1)``.
    """
    s = country_slice(df, country)
    if country is not None and country != ALL_COUNTRIES:
        s = s.orderBy(F.col(measure).desc_nulls_last(), F.col(name_col).asc_nulls_first()).limit(1)
    return s.select("country", F.col(name_col), F.col(measure),
                    streams_label(measure).alias("label"))


def hierarchy_totals(df: DataFrame, levels: Sequence[str] = ("genre", "artist"),
                     value: str = "total_streams") -> DataFrame:
    """Totals at every level of a path (sunburst data), without the grand total.

    ``gid`` is Spark's ``grouping_id`` (bit set = level rolled up): 0 for
    leaves, 1 for the first level when there are two levels. ``rollup`` is one
    ``Expand`` + one aggregate, with partial aggregation before the shuffle.
    """
    full = (1 << len(levels)) - 1
    return (df.rollup(*levels)
              .agg(F.sum(value).alias(value), F.grouping_id(*levels).alias("gid"))
              .filter(F.col("gid") != full))


def metric_pick(df: DataFrame, metric: str, key: str = "country") -> DataFrame:
    """One of the measures as ``(key, value)``."""
    return df.select(key, F.col(metric).alias("value"))


def metric_long(df: DataFrame, metrics: Sequence[str], key: str = "country") -> DataFrame:
    """P8, long form: ``(key, metric, value)`` for every measure (``unpivot``)."""
    return df.unpivot([key], list(metrics), "metric", "value")


def metric_labels(df: DataFrame, metrics: Sequence[str], key: str = "country") -> DataFrame:
    """Two-decimal text of each measure (``<metric>_label``)."""
    return df.select(key, *[two_decimals(m).alias(f"{m}_label") for m in metrics])


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a top-k, so the limit is the feature)."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def has_rows(df: DataFrame) -> bool:
    """F8: emptiness test that stays in the DataFrame API (a limit-1 probe)."""
    return not df.isEmpty()


def energy_view(df: DataFrame, country: str | None,
                metric: str = "avg_energy") -> DataFrame:
    """Q12: all countries -> (country, value) of the chosen metric; one country
    -> its two-decimal labels."""
    if country is None or country == ALL_COUNTRIES:
        return metric_pick(df, metric)
    return metric_labels(country_slice(df, country), ["avg_energy", "avg_danceability"])


# --- Q15: view name -> view over the published result tables ----------------

# --- fixed values (must equal the reference's behaviour) -------------------
VIEW_NAMES = ("Top Songs", "Top Artists", "Top Genre", "Energy Map", "Trending Now")
# ---------------------------------------------------------------------------

# In the order of VIEW_NAMES: the table a view serves, and the view.
_VIEWS = dict(zip(VIEW_NAMES, (
    (TOP_SONGS_ALL_TIME, lambda t, country, metric: headline(t, country, "track_name")),
    (TOP_ARTIST_PER_GENRE, lambda t, country, metric: hierarchy_totals(t)),
    (TOP_GENRE_ALL_TIME, lambda t, country, metric: headline(t, country, "genre")),
    (ENERGY_PER_COUNTRY, lambda t, country, metric: energy_view(t, country, metric)),
    (DAILY_CHARTS, lambda t, country, metric: sorted_by_rank(t)),
)))


def dashboard_view(name: str, tables: dict[str, DataFrame], country: str | None = None,
                   metric: str = "avg_energy") -> DataFrame:
    """Dispatch a view name to its DataFrame.

    ``tables`` maps catalog names (``tunelake.schema``) to result frames, e.g.
    ``{n: read_published(spark, root, n) for n in ...}``.
    """
    if name not in _VIEWS:
        raise ValueError(f"unknown view {name!r}; expected one of {VIEW_NAMES}")
    table, view = _VIEWS[name]
    return view(tables[table], country, metric)
