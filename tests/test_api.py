"""The README's batch flow through the public API, on fixture-derived files."""

import tunelake as tl
from tunelake.plans import oracle
from tunelake.session import scratch_path
from tunelake.sources.fixtures import chart_documents, chart_view


def test_readme_batch_flow(spark, small_dir):
    csv = scratch_path(spark, "api-chart-csv")
    chart_view(spark, small_dir).write.option("header", True).csv(csv)
    chart = tl.read_chart_csv(spark, csv)
    assert all(t.simpleString() == "string" for t in (f.dataType for f in chart.schema.fields))

    import glob
    from tunelake.session import checkpoint_root
    staged = f"{checkpoint_root(spark).replace('file:', '')}/results-combined-*"
    before = set(glob.glob(staged))
    root = scratch_path(spark, "api-results")
    paths = tl.refresh_results(chart, root, year=oracle.FIXTURE_YEAR,
                               artist_prefix=oracle.FIXTURE_ARTIST_PREFIX)
    assert set(glob.glob(staged)) == before          # the stage was removed after publishing
    assert set(paths) == {"top_songs_all_time", "top_song_2020", "top_genre_all_time",
                          "top_artist_per_genre", "energy_per_country"}

    landing = scratch_path(spark, "api-landing")
    chart_documents(spark, small_dir).write.json(landing)
    tl.save_daily_chart(tl.read_chart_documents(spark, landing), root,
                        scratch_path(spark, "api-history"))

    tables = {n: tl.read_published(spark, root, n) for n in list(paths) + ["daily_charts"]}
    countries = [r.country for r in tl.country_options(tables["top_genre_all_time"]).collect()]
    assert countries[0] == "All Countries" and countries[1:] == sorted(countries[1:])
    one = tl.dashboard_view("Top Genre", tables, countries[1]).collect()
    assert len(one) == 1 and one[0].label.endswith(" streams")
    assert tl.dashboard_view("Top Artists", tables).count() > 0
    assert tl.dashboard_view("Energy Map", tables, "All Countries").count() == \
        tables["energy_per_country"].count()
    ranks = [r.Rank for r in tl.dashboard_view("Trending Now", tables).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1
