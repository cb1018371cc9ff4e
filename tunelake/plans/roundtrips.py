"""Registered queries that go through real files: sources, sinks and publishing.

Each writes what Spark derived from the fixture tables into a fresh folder
under the session's checkpoint root, reads it back with the operator under
test and returns the read-back frame (so the result is compared with the
oracle after a full write/read cycle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.operators.daily import current_documents, flatten_chart, sorted_by_rank
from tunelake.operators.position import positioned
from tunelake.plans import jobs, oracle
from tunelake.schema import RESULT_SCHEMAS, TOP_GENRE_ALL_TIME
from tunelake.session import scratch_path
from tunelake.sinks.export import export_dated_csv, read_dated_csv
from tunelake.sinks.publish import publish, read_published
from tunelake.sources.charts import (
    read_chart_csv, read_chart_documents, read_lenient_csv,
)
from tunelake.sources.fixtures import (
    chart_documents, chart_view, event_source_header, event_source_lines, record_source_files,
    shuffled_source_lines,
)
from tunelake.streaming.events import rename_source_columns
from tunelake.plans.streams import source_fields_sql
from tunelake.schema import EVENT_SOURCE_RENAMES
from tunelake.sources.fixtures import EVENT_NUMBERS


def land_chart_documents(spark: SparkSession, sf_dir: str) -> str:
    """Write the pages of the days' chart documents as JSON lines (the landing folder)."""
    path = scratch_path(spark, "chart-landing")
    chart_documents(spark, sf_dir).write.json(path)
    return path


def daily_chart_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: landed documents -> flat chart rows, by rank."""
    docs = read_chart_documents(spark, land_chart_documents(spark, sf_dir))
    return sorted_by_rank(flatten_chart(docs))


def daily_chart_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: every day's chart after later landings: every third day was landed again with
    fewer entries (that chart counts whole), every fifth day's last landing lacks its first page (the one
    before it stays)."""
    path = scratch_path(spark, "chart-landings")
    docs = chart_documents(spark, sf_dir)
    n = F.datediff(F.col("chartDate").cast("date"), F.lit("1970-01-01"))
    chart = F.col("chartEntryViewResponses")[0]
    short = F.transform("chartEntryViewResponses", lambda c: c.withField(
        "entries", F.slice(c["entries"], 1, 10)))
    docs.write.json(f"{path}/landing=1")
    (docs.filter((n % 3 == 0) & (F.col("page") == 0)).withColumn("chartEntryViewResponses", short)
     .write.json(f"{path}/landing=2"))
    (docs.filter((n % 5 == 0) & (F.size(chart["entries"]) > 0)).withColumn("page", F.col("page") + 1)
     .write.json(f"{path}/landing=3"))
    return sorted_by_rank(flatten_chart(current_documents(read_chart_documents(spark, path))))


def dated_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + X14: each day's chart exported as dated CSV, read back."""
    docs = read_chart_documents(spark, land_chart_documents(spark, sf_dir))
    flat = flatten_chart(docs)
    root = scratch_path(spark, "chart-history")
    export_dated_csv(flat, root, F.to_date("chartDate"), drop=("chartDate",), replace="all")
    back = read_dated_csv(spark, root, "Rank bigint, Artist string, TrackName string")
    return back.select("dt", "Rank", F.coalesce("Artist", F.lit("")).alias("Artist"), "TrackName")


def csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart rows written as CSV, scanned as text, then Q3."""
    path = scratch_path(spark, "chart-csv")
    chart_view(spark, sf_dir).write.option("header", True).csv(path)
    return jobs.top_genre_by_country(read_chart_csv(spark, path))


def csv_lenient_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P7: event source CSV with short and long lines, read leniently."""
    path = scratch_path(spark, "event-source-csv")
    # one column whose name is the header line; tab as the writer's separator
    # so the comma-separated line is written verbatim, header in every file
    (event_source_lines(spark, sf_dir).toDF(event_source_header())
        .write.option("header", True).option("sep", "\t").csv(path))
    return rename_source_columns(read_lenient_csv(spark, path))


def csv_lenient_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P7: fields bound by header name, whatever their order; surplus fields
    counted, also empty ones; texts that mean missing are null."""
    lines, header = shuffled_source_lines(spark, sf_dir)
    path = scratch_path(spark, "event-shuffled-csv")
    (lines.toDF(header).write.option("header", True).option("sep", "\t").option("quote", "\u0000")
          .option("escapeQuotes", False).csv(path))
    return rename_source_columns(read_lenient_csv(spark, path))


def csv_lenient_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P7: records that span lines, blank lines, and files that order the header
    differently."""
    path = scratch_path(spark, "event-records-csv")
    record_source_files(spark, sf_dir, path)
    return rename_source_columns(read_lenient_csv(spark, path))


def daily_chart_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the place of every chart row in the sorted frame."""
    docs = read_chart_documents(spark, land_chart_documents(spark, sf_dir))
    path = scratch_path(spark, "chart-sorted")
    (sorted_by_rank(flatten_chart(docs)).withColumns(
        {"part": F.spark_partition_id(), "n": F.monotonically_increasing_id()})
        .write.parquet(path))
    return positioned(spark.read.parquet(path), ["part", "n"]).select(
        "pos", "chartDate", "Rank", "TrackName")


def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S4: publish Q3 twice (an empty table first), read the newest back."""
    root = scratch_path(spark, "published")
    empty = spark.createDataFrame([], RESULT_SCHEMAS[TOP_GENRE_ALL_TIME])
    publish(empty, root, TOP_GENRE_ALL_TIME)
    publish(jobs.top_genre_by_country(chart_view(
        spark, sf_dir, ("country", "artist_genre", "streams"))), root, TOP_GENRE_ALL_TIME)
    return read_published(spark, root, TOP_GENRE_ALL_TIME)


QUERIES = {
    "daily_chart_flat": daily_chart_flat,
    "daily_chart_landings": daily_chart_landings,
    "dated_export_roundtrip": dated_export_roundtrip,
    "csv_scan_roundtrip": csv_scan_roundtrip,
    "csv_lenient_scan": csv_lenient_scan,
    "csv_lenient_header": csv_lenient_header,
    "csv_lenient_records": csv_lenient_records,
    "daily_chart_order": daily_chart_order,
    "publish_replace": publish_replace,
}


# --- oracle SQL ----------------------------------------------------------------

_CHART_DAYS = """days AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
         row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE)
                            ORDER BY o_totalprice DESC, o_orderkey ASC) AS rnk
  FROM orders
),
artists AS (
  SELECT l.l_orderkey, string_agg(s.s_name, ', ' ORDER BY l.l_linenumber, l.l_suppkey) AS names
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_orderkey IN (SELECT o_orderkey FROM days)
  GROUP BY l.l_orderkey
),
flat AS (
  SELECT CAST(d.day AS VARCHAR) AS chartDate, d.rnk AS Rank,
         coalesce(a.names, '') AS Artist, 'order:' || CAST(d.o_orderkey AS VARCHAR) AS TrackName,
         d.day
  FROM days d LEFT JOIN artists a ON a.l_orderkey = d.o_orderkey
)"""

def _csv_text(source: str) -> str:
    """A source column as it stands in the CSV text, missing texts null."""
    expr = source_fields_sql()[source]
    if source == "energy":
        return "printf('%.2f', value)"
    if source in EVENT_NUMBERS:      # a double's text, NaN is a missing text
        return f"CAST({expr} AS VARCHAR)"
    return expr


def _lenient_sql() -> str:
    """The first five fields of short lines, none of lines with a surplus field."""
    cols = [f"{_csv_text(s)} AS {f}" if i < 5 else
            f"CASE WHEN event_id % 89 <> 0 THEN {_csv_text(s)} END AS {f}"
            for i, (s, f) in enumerate(EVENT_SOURCE_RENAMES)]
    return ("SELECT\n  " + ",\n  ".join(cols)
            + "\nFROM events\nWHERE event_id % 89 = 0 OR event_id % 97 <> 0")


def _header_sql() -> str:
    """Reverse header order, so a short line has ``extra``, ``key`` and ``energy``."""
    cols = []
    for s, f in EVENT_SOURCE_RENAMES:
        expr = {"place": f"CASE WHEN event_id % 73 <> 0 THEN {_csv_text('place')} END",
                "id": "CASE WHEN event_id % 71 <> 0 THEN CAST(event_id AS VARCHAR) END",
                "mode": "CAST(NULL AS VARCHAR)"}.get(s) or _csv_text(s)
        cols.append(f"{expr} AS {f}" if s in ("key", "energy", "mode") else
                    f"CASE WHEN event_id % 89 <> 0 THEN {expr} END AS {f}")
    return ("SELECT\n  " + ",\n  ".join(cols) + "\nFROM events\n"
            "WHERE event_id % 89 = 0 OR (event_id % 97 <> 0 AND event_id % 83 <> 0)")


def _records_sql() -> str:
    """A short record has the first three fields of its file's header."""
    cols, last = [], len(EVENT_SOURCE_RENAMES) - 1
    for i, (s, f) in enumerate(EVENT_SOURCE_RENAMES):
        expr = _csv_text(s)
        if s == "place":
            expr = (f"CASE WHEN event_id % 5 = 0 THEN {expr} || chr(10) || 'row ' || chr(34) || event_id || chr(34) "
                    f"ELSE {expr} END")
        has = ["event_id % 89 <> 0", *["event_id % 2 = 0"] * (i < 3), *["event_id % 2 = 1"] * (i > last - 3)]
        cols.append(f"CASE WHEN {' OR '.join(has)} THEN {expr} END AS {f}")
    return ("SELECT\n  " + ",\n  ".join(cols) + "\nFROM events\nWHERE event_id % 89 = 0 OR event_id % 97 <> 0")


ORACLE = {
    "daily_chart_landings": f"WITH {_CHART_DAYS}\nSELECT chartDate, Rank, Artist, TrackName FROM flat "
                            "WHERE Rank <= 10 OR datediff('day', DATE '1970-01-01', day) % 3 <> 0",
    "csv_lenient_records": _records_sql(),
    "daily_chart_flat": f"WITH {_CHART_DAYS}\nSELECT chartDate, Rank, Artist, TrackName FROM flat",
    "dated_export_roundtrip": f"WITH {_CHART_DAYS}\n"
                              "SELECT strftime(day, '%d-%m-%Y') AS dt, Rank, Artist, TrackName FROM flat",
    "csv_scan_roundtrip": oracle.q3(),
    "csv_lenient_scan": _lenient_sql(),
    "csv_lenient_header": _header_sql(),
    "daily_chart_order": f"WITH {_CHART_DAYS}\nSELECT row_number() OVER (ORDER BY chartDate, Rank) - 1 "
                         "AS pos, chartDate, Rank, TrackName FROM flat",
    "publish_replace": oracle.q3(),
}
