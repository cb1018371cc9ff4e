"""Flatten nested chart documents into chart rows (Q6: X8-X11, O2, R17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
ARTIST_SEPARATOR = ", "
# ---------------------------------------------------------------------------


def flatten_chart(docs: DataFrame, chart_index: int = 0,
                  keep: tuple[str, ...] = ("chartDate",)) -> DataFrame:
    """One row per chart entry: ``Rank``, ``Artist``, ``TrackName``.

    Only chart ``chart_index`` of each document is used (the reference takes
    the first). ``Artist`` joins the entry's artist names with ``", "``; an
    entry without artists gets ``""``. Each document is exploded where it was
    read, so documents spread over all tasks.
    """
    chart = F.try_element_at(F.col("chartEntryViewResponses"), F.lit(chart_index + 1))
    e = (docs.select(*keep, F.explode(chart.getField("entries")).alias("e")))
    return e.select(
        *keep,
        F.col("e.chartEntryData.currentRank").alias("Rank"),
        F.array_join(F.coalesce(F.col("e.trackMetadata.artists.name"), F.array()),
                     ARTIST_SEPARATOR).alias("Artist"),
        F.col("e.trackMetadata.trackName").alias("TrackName"),
    )


def sorted_by_rank(df: DataFrame) -> DataFrame:
    """O2: ascending rank, within the date if there is one; ties by track name. A
    distributed range sort over all these columns, so equal ranks can be split."""
    order = [c for c in ("chartDate", "Rank", "TrackName") if c in df.columns]
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order])


def current_documents(docs: DataFrame, date: str | None = None) -> DataFrame:
    """Q6: for each chart date the documents of its newest complete landing, each page once.

    All pages of a chart come from one landing (column ``landing``, one delivery of the collector): a later,
    shorter landing of a date replaces the whole chart. A landing is complete if it has all
    pages from 0 to the highest, and as many as its documents state in ``pages``; one that lacks pages
    counts for nothing, so the landing before it stays. A landing is as new as its last file
    (``landed``; ties by name). A document without a date gets ``date`` (ISO ``yyyy-MM-dd``), or the day
    of the run, as the reference stamps it; one without a page is page 0. Of several
    documents for one page of a landing the one that landed last stays (ties by file name, then by content).

    Versions and pages are aggregates with a map-side partial step: a row a date and landing, no window.
    """
    day = F.lit(date) if date is not None else F.current_date().cast("string")
    extra = {c: F.lit(None).cast(t) for c, t in
             (("page", "long"), ("pages", "long"), ("landing", "string"), ("landed", "timestamp"),
              ("landed_file", "string")) if c not in docs.columns}
    dated = docs.withColumns(extra).withColumns({
        "chartDate": F.coalesce("chartDate", day), "page": F.coalesce("page", F.lit(0)),
        "landing": F.coalesce("landing", F.lit(""))})
    have = F.count_distinct("page")
    whole = (have == F.max("page") + 1) & (F.min("page") == 0) & (
        F.coalesce(F.max("pages"), have) == have)
    versions = dated.groupBy("chartDate", "landing").agg(
        F.max("landed").alias("landed"), whole.alias("whole")).filter("whole")
    newest = versions.groupBy("chartDate").agg(
        F.max_by("landing", F.struct("landed", "landing")).alias("landing"))
    body = F.struct("chartDate", "landing", "chartEntryViewResponses")
    last = F.struct("landed", "landed_file", F.to_json(body))
    return (dated.join(newest, ["chartDate", "landing"]).groupBy("chartDate", "page")
            .agg(F.max_by(body, last).alias("d")).select("page", "d.*"))


def newest_documents(docs: DataFrame, date: str | None = None) -> DataFrame:
    """Q6: ``current_documents`` of the newest date that has a complete landing."""
    current = current_documents(docs, date)
    return newest_chart(current)


def newest_chart(flat: DataFrame, date_col: str = "chartDate") -> DataFrame:
    """The rows of the newest date of an already flat chart history (``date_col`` must
    order chronologically). The date is a scalar subquery: no collect, no join."""
    return flat.filter(F.col(date_col) == flat.agg(F.max(date_col)).scalar())
