"""Per-job cleaning rules (R2, R4) on literal chart rows."""

from tunelake.plans import jobs
from tunelake.schema import CHART_COLUMNS


def _chart(spark, rows):
    full = [tuple(r.get(c) for c in CHART_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in CHART_COLUMNS))


def test_q2_keeps_null_and_numeric_country_and_nulls_bad_counts(spark):
    df = _chart(spark, [
        dict(country=None, track_name="t", streams="3", release_date="2020-01-01"),
        dict(country="12", track_name="t", streams="n/a", release_date="2020-05-05"),
        dict(country="12", track_name="u", streams="2.9", release_date="2020-05-05"),
        dict(country="FR", track_name="t", streams="9", release_date="2019-01-01"),
    ])
    out = {r.country: (r.track_name, r.total_streams) for r in jobs.top_track_by_year(df, "2020").collect()}
    assert out == {None: ("t", 3), "12": ("u", 2)}


def test_q1_and_q3_reject_numeric_country_and_dirty_counts(spark):
    df = _chart(spark, [
        dict(country="FR", track_name="a", uri="u1", artist_genre="pop", streams="10"),
        dict(country="FR", track_name="b", uri="u2", artist_genre="rock", streams="1e9"),
        dict(country="12", track_name="c", uri="u3", artist_genre="jazz", streams="99"),
        dict(country="FR", track_name="d", uri=None, artist_genre="pop", streams="50"),
    ])
    q1 = [tuple(r) for r in jobs.top_track_all_time(df).collect()]
    q3 = [tuple(r) for r in jobs.top_genre_by_country(df).collect()]
    assert q1 == [("FR", "a", "u1", 10)]
    assert q3 == [("FR", "pop", 60)]


ARTIST_1 = f"{jobs.DEFAULT_ARTIST_PREFIX}:1"


def test_q4_requires_artist_prefix_and_q5_keeps_numeric_country(spark):
    df = _chart(spark, [
        dict(artist_genre="pop", artist_individual="x", artist_id=ARTIST_1, streams="4"),
        dict(artist_genre="pop", artist_individual="y", artist_id="1", streams="40"),
        dict(country="12", danceability="0.5", energy="0.25"),
        dict(country="12", danceability="bad", energy="0.9"),
    ])
    q4 = [tuple(r) for r in jobs.top_artist_by_genre(df).collect()]
    assert q4 == [("pop", "x", ARTIST_1, 4)]
    q5 = [tuple(r) for r in jobs.feature_means_by_country(df).collect()]
    assert q5 == [("12", 0.5, 0.25)]


def test_doubled_quote_escape_keeps_columns_in_place(spark, tmp_path):
    from tunelake.sources.charts import read_chart_csv
    path = tmp_path / "chart.csv"
    path.write_text('country,track_name,streams\nFR,"Say ""hi"", now",12\nDE,plain,7\n')
    rows = {r.country: (r.track_name, r.streams)
            for r in read_chart_csv(spark, str(path), escape='"').collect()}
    assert rows == {"FR": ('Say "hi", now', "12"), "DE": ("plain", "7")}


def test_count_rows_is_a_one_row_frame(spark):
    from tunelake.operators.clean import count_rows
    df = spark.range(0, 1234).selectExpr("cast(id as string) as streams")
    assert [tuple(r) for r in count_rows(df).collect()] == [(1234,)]
    assert [tuple(r) for r in count_rows(df.limit(0)).collect()] == [(0,)]
