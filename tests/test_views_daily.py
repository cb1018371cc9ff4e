"""Serving views (F5, A7, U1, A8, P8, O5, X15, X16) and chart flattening."""

from pyspark.sql import types as T

from tunelake.operators.daily import flatten_chart
from tunelake.operators.views import (
    country_options, headline, hierarchy_totals, metric_labels, metric_long, preview,
)
from tunelake.schema import CHART_DOCUMENT_SCHEMA

TOP = "country string, genre string, total_streams bigint"


def test_country_options_sentinel_first_then_sorted(spark):
    df = spark.createDataFrame([("FR", "a", 1), (None, "b", 2), ("DE", "c", 3), ("FR", "d", 4)], TOP)
    assert [r.country for r in country_options(df).collect()] == ["All Countries", "DE", "FR"]


def test_headline_slice_and_label(spark):
    df = spark.createDataFrame([("FR", "pop", 1234567), ("DE", "rock", 5)], TOP)
    one = headline(df, "FR", "genre").collect()
    assert [tuple(r) for r in one] == [("FR", "pop", 1234567, "1,234,567 streams")]
    assert headline(df, "XX", "genre").count() == 0
    assert headline(df, None, "genre").count() == 2


def test_hierarchy_totals_sum_children(spark):
    df = spark.createDataFrame([("pop", "a", 1), ("pop", "b", 2), ("rock", "c", 5)],
                               "genre string, artist string, total_streams bigint")
    got = {(r.genre, r.artist, r.gid): r.total_streams for r in hierarchy_totals(df).collect()}
    assert got == {("pop", "a", 0): 1, ("pop", "b", 0): 2, ("rock", "c", 0): 5,
                   ("pop", None, 1): 3, ("rock", None, 1): 5}


def test_metric_long_labels_preview(spark):
    df = spark.createDataFrame([("FR", 0.125, 0.5), ("DE", 1.0, 0.25)],
                               "country string, avg_energy double, avg_danceability double")
    assert metric_long(df, ["avg_energy", "avg_danceability"]).count() == 4
    labels = {r.country: r.avg_energy_label for r in metric_labels(df, ["avg_energy"]).collect()}
    assert labels == {"FR": "0.12", "DE": "1.00"}      # as Python prints 0.125 (X16)
    assert [r.country for r in preview(df, ["country"], 1).collect()] == ["DE"]


def test_flatten_first_chart_and_missing_artists(spark):
    doc = {"chartEntryViewResponses": [
        {"entries": [
            {"chartEntryData": {"currentRank": 2},
             "trackMetadata": {"trackName": "B", "artists": [{"name": "x"}, {"name": "y"}]}},
            {"chartEntryData": {"currentRank": 1},
             "trackMetadata": {"trackName": "A", "artists": []}},
        ]},
        {"entries": [{"chartEntryData": {"currentRank": 9},
                      "trackMetadata": {"trackName": "Z", "artists": None}}]},
    ]}
    schema = T.StructType(CHART_DOCUMENT_SCHEMA.fields)
    docs = spark.createDataFrame([doc], schema)
    rows = sorted(tuple(r) for r in flatten_chart(docs, keep=()).collect())
    assert rows == [(1, "", "A"), (2, "x, y", "B")]
    second = [tuple(r) for r in flatten_chart(docs, chart_index=1, keep=()).collect()]
    assert second == [(9, "", "Z")]
    assert flatten_chart(docs, chart_index=5, keep=()).count() == 0


def test_dashboard_dispatch(spark):
    from tunelake.operators.views import dashboard_view, has_rows
    from tunelake import schema as S
    tables = {
        S.TOP_SONGS_ALL_TIME: spark.createDataFrame([("FR", "t", "u", 9)], S.RESULT_SCHEMAS[S.TOP_SONGS_ALL_TIME]),
        S.TOP_GENRE_ALL_TIME: spark.createDataFrame([("FR", "pop", 9)], S.RESULT_SCHEMAS[S.TOP_GENRE_ALL_TIME]),
        S.TOP_ARTIST_PER_GENRE: spark.createDataFrame([("pop", "a", "id", 9)], S.RESULT_SCHEMAS[S.TOP_ARTIST_PER_GENRE]),
        S.ENERGY_PER_COUNTRY: spark.createDataFrame([("FR", 0.5, 0.25)], S.RESULT_SCHEMAS[S.ENERGY_PER_COUNTRY]),
        S.DAILY_CHARTS: spark.createDataFrame([(2, "b", "B"), (1, "a", "A")], S.RESULT_SCHEMAS[S.DAILY_CHARTS]),
    }
    assert dashboard_view("Top Songs", tables, "FR").collect()[0].label == "9 streams"
    assert dashboard_view("Top Genre", tables, "DE").count() == 0
    assert dashboard_view("Top Artists", tables).count() == 2
    assert [tuple(r) for r in dashboard_view("Energy Map", tables, "FR").collect()] == [("FR", "0.25", "0.50")]
    assert [r.Rank for r in dashboard_view("Trending Now", tables).collect()] == [1, 2]
    assert has_rows(tables[S.DAILY_CHARTS]) and not has_rows(tables[S.DAILY_CHARTS].limit(0))


def test_dated_export_spreads_a_hot_day_and_keeps_every_row(spark, tmp_path):
    import glob
    from pyspark.sql import functions as F
    from tunelake.sinks.export import export_dated_csv, read_dated_csv
    rows = [("2024-01-02" if i % 3 else "2024-01-03", i, f"a{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "d string, Rank bigint, Artist string")
    root = str(tmp_path / "hist")
    export_dated_csv(df, root, F.to_date("d"), drop=("d",), replace="all", rows_per_file=50)
    back = read_dated_csv(spark, root, "Rank bigint, Artist string")
    assert sorted((r.dt, r.Rank) for r in back.collect()) == sorted(
        ("02-01-2024" if i % 3 else "03-01-2024", i) for i in range(300))
    assert len(glob.glob(f"{root}/v=*/dt=02-01-2024/*.csv")) > 1


def test_lookup_scan_drops_nulls_and_keeps_duplicates(spark, tmp_path):
    from tunelake.sources.charts import read_lookup
    path = str(tmp_path / "lookup")
    spark.createDataFrame([("a", 1), (None, 2), ("a", 3), ("b", 4)], "track_name string, n int") \
         .write.option("header", True).csv(path)
    assert sorted(r.track_name for r in read_lookup(spark, path).collect()) == ["a", "a", "b"]


def test_dated_export_rerun_replaces_only_its_day(spark, tmp_path):
    """Re-exporting one day swaps that day's file and keeps the history."""
    from pyspark.sql import functions as F
    from tunelake.sinks.export import export_dated_csv, read_dated_csv
    root = str(tmp_path / "hist")
    schema = "d string, Rank bigint, Artist string"
    first = spark.createDataFrame([("2024-01-02", 1, "a"), ("2024-01-03", 1, "b")], schema)
    export_dated_csv(first, root, F.to_date("d"), drop=("d",))
    again = spark.createDataFrame([("2024-01-03", 1, "c"), ("2024-01-03", 2, "d")], schema)
    before = read_dated_csv(spark, root, "Rank bigint, Artist string")
    export_dated_csv(again, root, F.to_date("d"), drop=("d",))

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    back = read_dated_csv(spark, root, "Rank bigint, Artist string")
    assert rows(back) == [(1, "a", "02-01-2024"), (1, "c", "03-01-2024"), (2, "d", "03-01-2024")]
    assert rows(before) == [(1, "a", "02-01-2024"), (1, "b", "03-01-2024")]     # an open reader's files stay
    day = read_dated_csv(spark, root, "Rank bigint, Artist string", days=["03-01-2024", "04-01-2024"])
    assert rows(day) == [(1, "c", "03-01-2024"), (2, "d", "03-01-2024")]


def test_dated_history_is_never_half_replaced(spark, tmp_path, monkeypatch):
    """A reader sees the old history until the commit; an export that dies before it
    changes nothing; of two that overlap, both days are kept; replaced versions go."""
    import os
    import pytest
    from pyspark.sql import functions as F
    from tunelake.sinks import commits, export
    root, schema = str(tmp_path / "hist"), "d string, Rank bigint, Artist string"

    def put(day, artist, **how):
        df = spark.createDataFrame([(f"2024-01-{day:02d}", 1, artist)], schema)
        export.export_dated_csv(df, root, F.to_date("d"), drop=("d",), **how)

    def seen():
        return sorted((r.dt[:2], r.Artist) for r in export.read_dated_csv(
            spark, root, "Rank bigint, Artist string").collect())

    assert seen() == []
    put(1, "a")
    commit = commits.commit
    looks = []

    def looking(session, folder, text):
        looks.append(seen())                   # the new files are written, not committed
        return commit(session, folder, text)

    monkeypatch.setattr(commits, "commit", looking)
    put(1, "b")
    assert looks == [[("01", "a")]] and seen() == [("01", "b")]

    def dying(session, folder, text):
        raise OSError("the driver dies")

    monkeypatch.setattr(commits, "commit", dying)
    with pytest.raises(OSError):
        put(1, "c")
    assert seen() == [("01", "b")]

    def overtaken(session, folder, text):
        monkeypatch.setattr(commits, "commit", commit)
        put(2, "other")
        return commit(session, folder, text)

    monkeypatch.setattr(commits, "commit", overtaken)
    put(3, "mine")
    assert seen() == [("01", "b"), ("02", "other"), ("03", "mine")]
    put(4, "last", replace="all", retain_s=0)
    assert seen() == [("04", "last")]
    assert len([d for d in os.listdir(root) if d.startswith("v=")]) == 2      # the last, and the one that died


def test_chart_documents_keep_every_order(spark):
    """Days of more than 50 orders (sf0.1) become several pages; ranks go on across them."""
    from pyspark.sql import functions as F
    from tunelake.sources.fixtures import chart_documents, read_table
    sf = "/root/testdata/sf0.1"
    docs = chart_documents(spark, sf)
    flat = flatten_chart(docs, keep=("chartDate", "page"))
    days = flat.groupBy("chartDate").agg(F.count("*").alias("n"), F.max("Rank").alias("last"),
                                         F.countDistinct("Rank").alias("ranks"),
                                         F.max("page").alias("page"))
    total, pages = days.agg(F.sum("n"), F.max("page")).first()
    assert total == read_table(spark, sf, "orders").count() == 150_000 and pages >= 1
    assert days.filter("n <> last or n <> ranks").count() == 0
    sizes = docs.select(F.size(docs.chartEntryViewResponses[0].entries).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 50


def _landed(spark, path, pages, landing=None, stated=None, date="2024-03-01"):
    """Land pages (page -> ranks) as Spark writes them: a file a page."""
    import json
    docs = []
    for page, ranks in pages.items():
        entries = [{"chartEntryData": {"currentRank": r},
                    "trackMetadata": {"trackName": f"t{r}", "artists": []}} for r in ranks]
        d = {"chartDate": date, "page": page, "chartEntryViewResponses": [{"entries": entries}]}
        docs.append(json.dumps(d | ({"pages": stated} if stated else {})
                               | ({"landing": landing} if landing else {})))
    spark.createDataFrame([(d,) for d in docs], "value string").repartition(len(docs)).write.mode(
        "append").text(path)


def _ranks(spark, path):
    from tunelake.operators.daily import newest_documents
    from tunelake.sources.charts import read_chart_documents
    flat = flatten_chart(newest_documents(read_chart_documents(spark, path)))
    return sorted(r.Rank for r in flat.collect())


def test_a_shorter_landing_replaces_the_whole_chart(spark, tmp_path):
    path = str(tmp_path / "landing")
    _landed(spark, path, {0: [1, 2], 1: [3, 4]})
    assert _ranks(spark, path) == [1, 2, 3, 4]
    _landed(spark, path, {0: [1, 2]})
    assert _ranks(spark, path) == [1, 2]


def test_an_incomplete_landing_counts_for_nothing(spark, tmp_path):
    path = str(tmp_path / "landing")
    _landed(spark, path, {0: [1, 2], 1: [3, 4]}, landing="a")
    _landed(spark, path, {1: [9]}, landing="b")                        # lacks page 0
    assert _ranks(spark, path) == [1, 2, 3, 4]
    _landed(spark, path, {0: [5], 1: [6]}, landing="c", stated=3)      # states three pages
    assert _ranks(spark, path) == [1, 2, 3, 4]
    _landed(spark, path, {2: [7]}, landing="c", stated=3)              # the third comes later
    assert _ranks(spark, path) == [5, 6, 7]
    _landed(spark, path, {1: [8]}, landing="d", date="2024-03-02")     # a newer date, incomplete
    assert _ranks(spark, path) == [5, 6, 7]
    _landed(spark, path, {0: [8]}, landing="d", date="2024-03-02")
    assert _ranks(spark, path) == [8, 8]


def test_landings_in_folders_and_documents_without_a_landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    _landed(spark, path + "/landing=1", {0: [1], 1: [2]})
    _landed(spark, path + "/landing=2", {0: [3]})
    _landed(spark, path + "/landing=2", {1: [4]})                      # another file of the same landing
    assert _ranks(spark, path) == [3, 4]
    from tunelake.operators.daily import current_documents
    plain = spark.read.json(path).select("chartDate", "chartEntryViewResponses")
    assert current_documents(plain).count() == 1                       # no page, no landing: one document
