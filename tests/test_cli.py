"""The command line runs the reference's jobs end to end (fixture-derived files)."""

from tunelake.cli import run
from tunelake.plans import oracle
from tunelake.schema import NOW_PLAYING
from tunelake.session import scratch_path
from tunelake.sinks.publish import read_published
from tunelake.sources.fixtures import (
    chart_documents, chart_view, event_source_header, event_source_lines,
)
from tunelake.streaming.runner import read_epochs, run_to_end


def test_cli_batch_and_stream_commands(spark, small_dir):
    csv = scratch_path(spark, "cli-chart")
    chart_view(spark, small_dir).write.option("header", True).csv(csv)
    root = scratch_path(spark, "cli-results")
    paths = run(spark, ["refresh", "--chart-csv", csv, "--root", root,
                        "--year", oracle.FIXTURE_YEAR, "--artist-prefix",
                        oracle.FIXTURE_ARTIST_PREFIX])
    assert len(paths) == 5 and read_published(spark, root, "top_genre_all_time").count() == 25

    landing = scratch_path(spark, "cli-landing")
    chart_documents(spark, small_dir).write.json(landing)
    run(spark, ["daily-chart", "--landing", landing, "--root", root,
                "--history", scratch_path(spark, "cli-history")])
    assert read_published(spark, root, "daily_charts").count() > 0

    src = scratch_path(spark, "cli-source")
    (event_source_lines(spark, small_dir).toDF(event_source_header())
        .write.option("header", True).option("sep", "\t").csv(src))
    topic = scratch_path(spark, "cli-topic")
    run(spark, ["encode", "--source-csv", src, "--topic", topic])
    n = spark.read.text(topic).count()
    assert n > 0

    sink = scratch_path(spark, "cli-result")
    run_to_end(run(spark, ["enrich", "--topic", topic, "--sink", sink, "--checkpoint",
                           scratch_path(spark, "cli-ckpt"), "--trigger", "availableNow"]))
    assert read_epochs(spark, sink, fmt="text").count() == n

    run_to_end(run(spark, ["now-playing", "--topic", sink + "/*", "--root", root,
                           "--checkpoint", scratch_path(spark, "cli-ckpt2"),
                           "--trigger", "availableNow"]))
    assert read_published(spark, root, NOW_PLAYING).count() == 1
