"""Chart-row, lookup and chart-document readers."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.schema import CHART_DOCUMENT_SCHEMA

_RAW_LINE = "_raw_line"


def read_chart_csv(spark: SparkSession, path: str, escape: str | None = None) -> DataFrame:
    """CSV with a header; every column is text, named by the header.

    No ``inferSchema``: it would cost an extra pass over the data and could
    retype dirty text (numbers as ``1.2E7``, ``2020-05`` as a timestamp) before
    the cleaning rules see it. ``escape='"'`` reads files that escape quotes by
    doubling them (R23); by default Spark's escape (``\\``) applies, as in the
    reference, and rows shifted by a stray quote are removed by the jobs' F3
    rule.
    """
    r = spark.read.option("header", True).option("inferSchema", False)
    if escape is not None:
        r = r.option("escape", escape)
    return r.csv(path)


# --- fixed values (must equal the reference's behaviour) -------------------
# Texts that the reference's CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# ---------------------------------------------------------------------------


def _present(c: str) -> Column:
    """The column, null where its text means missing."""
    return F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c))


def _n_fields(record: Column) -> Column:
    """Comma-separated fields of a raw record; commas inside quotes do not count."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, late): the first line of each file below ``path`` that is not blank, and
    whether a line of spaces comes before it."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), F.regexp_replace("value", "^\ufeff", "").alias("header"))
    place = F.struct("block", "n")
    text = F.when(F.col("header").rlike(r"[^ \t]"), place)
    return (lines.filter("header <> ''").groupBy("file")
            .agg(F.min_by("header", text).alias("header"), (F.min(place) < F.min(text)).alias("late"))
            .filter("header is not null"))


def _names(header: str) -> list[str]:
    """Column names of a header line; a repeated name gets a number, an empty one its place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header]))):
        name, k, base = name or f"Unnamed: {i}", 0, name or f"Unnamed: {i}"
        while name in names:
            k += 1
            name = f"{base}.{k}"
        names.append(name)
    return names


def read_lenient_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     multi_line: bool = True, max_headers: int = 1000) -> DataFrame:
    """Like ``pandas.read_csv(on_bad_lines='skip')`` of every file below ``path``.

    A record may span lines (quoted line breaks); quotes are escaped by doubling. Each file's
    columns are named by its own header, its first line that is not blank, so files may order their columns
    differently or lack some (a header is one line; where a line of spaces comes before it, records that
    repeat it are dropped too). A record with more fields than its file's header is skipped, whatever they
    hold; a short one is padded with nulls; blank lines are skipped; texts that mean missing
    are null (X7). ``columns`` selects by name (default: all names, in the order they are met); a name
    that a file's header lacks is null in its rows.

    The headers are a small table, one row a file; only the distinct ones (at most
    ``max_headers``) come to the driver. Files that share one header, the usual case, are read
    without a join. ``multi_line=False`` states that no record spans lines: then large files are split
    among tasks, otherwise a file is one task.
    """
    headers = header_lines(spark, path)
    kinds = [(r.header, r.late) for r in headers.groupBy("header", "late").agg(F.min("file").alias("f"))
             .orderBy("f").limit(max_headers + 1).collect()]
    if len(kinds) > max_headers:
        raise ValueError(f"more than {max_headers} different headers below {path}")
    names = {k: _names(k[0]) for k in kinds}
    wanted = list(columns if columns is not None else dict.fromkeys(n for h in kinds for n in names[h]))
    if not wanted:
        raise ValueError(f"no header below {path}, and no columns are asked for")
    wide = max(map(len, names.values()), default=0)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(wide)]
                          + [T.StructField(_RAW_LINE, T.StringType(), True)])
    # without column pruning: a pruned parser does not count a record's fields
    rows = (spark.read.schema(schema).option("recursiveFileLookup", True)
            .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
            .option("multiLine", multi_line).option("escape", '"').option("maxCharsPerColumn", -1)
            .option("columnNameOfCorruptRecord", _RAW_LINE).option("columnPruning", False)
            .csv(path).withColumn("_file", F.col("_metadata.file_path")))
    # Spark keeps the raw text of every record that is not as wide as the schema
    raw = F.col(_RAW_LINE)
    if len(kinds) > 1:
        rows = rows.join(headers, F.col("_file") == F.col("file"))
    is_kind = [(F.col("header") == h) & (F.col("late") == late) if len(kinds) > 1 else F.lit(True)
               for h, late in kinds]

    def per_kind(pick) -> Column:
        out = F.lit(None).cast("string")
        for test, h in zip(is_kind, kinds):
            out = F.when(test, pick(h)).otherwise(out)
        return out

    width = per_kind(lambda h: F.lit(len(names[h]))).cast("int")
    for test, k in zip(is_kind, kinds):
        if k[1]:       # the line of spaces was taken for the header, which is the first record
            same = [F.col(f"_c{i}").eqNullSafe(n) for i, n in enumerate(names[k])]
            rows = rows.filter(~(test & reduce(Column.__and__, same)))
    fits = (raw.isNull() & (width == wide)) | (_n_fields(raw) <= width)
    spaces = F.coalesce(F.col("_c0").rlike(r"^[ \t]+$"), F.lit(False)) if wide else F.lit(False)
    blank = spaces & F.coalesce(~raw.rlike(r"[^ \t\r\n]"), F.lit(wide == 1))
    return rows.filter(fits & ~blank).select(*[
        per_kind(lambda h, c=c: _present(f"_c{names[h].index(c)}") if c in names[h]
                 else F.lit(None).cast("string")).alias(c) for c in wanted])


def read_lookup(spark: SparkSession, path: str, col: str = "track_name",
                keep: Sequence[str] = ()) -> DataFrame:
    """S3 + F7: one column of a lookup CSV (and those in ``keep``), rows without a value
    dropped (a text that means missing is none), duplicates kept."""
    rows = read_chart_csv(spark, path).select(*keep, col)
    return rows.withColumn(col, _present(col)).dropna(subset=[col])


def read_chart_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Nested chart documents, fixed schema: one JSON object per line, or with
    ``multi_line`` one per file, however it is laid out; folders below ``path`` are read too.

    Beside the document come ``chartDate``, ``page`` and ``pages`` (how many pages its chart has), null
    where the document has none; ``landing``, the delivery that it came with; and ``landed`` (when its
    file was written) and ``landed_file``. The delivery is the document's own ``landing`` or the
    folder ``landing=<name>`` it lies in; without these, the Spark job that wrote its file, or the file.
    """
    schema = T.StructType(CHART_DOCUMENT_SCHEMA.fields + [
        T.StructField("chartDate", T.StringType(), True), T.StructField("page", T.LongType(), True),
        T.StructField("pages", T.LongType(), True), T.StructField("landing", T.StringType(), True)])
    docs = (spark.read.schema(schema).option("multiLine", multi_line)
            .option("recursiveFileLookup", True).json(path))
    file = F.col("_metadata.file_path")
    folder, job = F.regexp_extract(file, "/landing=([^/]+)/", 1), F.regexp_extract(
        file, r"/part-\d+-([0-9a-f-]{36})[^/]*$", 1)
    landing = F.coalesce("landing", F.nullif(folder, F.lit("")), F.nullif(job, F.lit("")), file)
    return docs.select(*[c for c in docs.columns if c != "landing"], landing.alias("landing"),
                       F.col("_metadata.file_modification_time").alias("landed"),
                       file.alias("landed_file"))
