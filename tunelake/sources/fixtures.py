"""Adapters from the driver's star-schema tables to the reference's input shapes.

``chart_view`` builds the string-typed chart rows (one per ``lineitem``) that
the batch jobs expect; the dirty-value rules are the fixture definition and are
repeated, independently, in the DuckDB oracle SQL.

Scale notes
-----------
* Only the joins a caller's columns need are planned. TPC-H keys are
  referentially complete (every foreign key has its row), so dropping an
  unneeded inner join never changes the row set -- the oracle SQL keeps all
  five joins and so checks this on every run.
* ``nation`` is broadcast explicitly: TPC-H fixes it at 25 rows at every scale.
  ``part``, ``supplier`` and ``customer`` grow with the scale factor, so they
  are *not* hinted; Spark broadcasts them only while their measured size is
  below ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime)
  and falls back to a shuffled sort-merge join above it.
* ``orders`` is joined to ``customer``/``nation`` first (orders is 1/4 of
  lineitem), so ``lineitem`` is shuffled once, on the order key, for country.
* For the country, both sides of ``lineitem ⋈ orders`` are hash-partitioned
  on the order key right after the scan. At scale that join is a sort-merge
  join, which needs exactly this exchange, so no shuffle is added; on small
  inputs stored as one row group it spreads the scan's rows over all cores.
  The order key cannot be skewed (it is the orders key, and an order has
  few lines). This stays in the fixture adapter: a hand-made exchange is
  outside AQE's skew split, so library operators never force one. The part and supplier joins are *not* pre-partitioned: a
  single part may carry a third of all lines, and only exchanges that Spark
  inserts itself get AQE's skew-join splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunelake.operators.position import positioned
from tunelake.schema import CHART_COLUMNS

_PART_COLS = {"track_name", "uri", "artist_genre"}
_SUPP_COLS = {"artist_individual", "artist_id"}


# Declared schemas of the fixture tables: a read with a schema plans without
# a footer-inference job per scan (one per table and query otherwise).
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


def _line_exprs() -> dict[str, Column]:
    """Chart columns that need the line itself."""
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    qty = _text(F.col("l_quantity").cast("bigint"))
    return {
        "streams": F.when(ok % 89 == 0, _null())
                    .when(ok % 83 == 0, F.lit("n/a"))
                    .when(ok % 79 == 0, F.lit("-5"))
                    .when(ok % 73 == 0, F.concat(qty, F.lit(".75")))
                    .otherwise(qty),
        "release_date": _text(F.col("l_shipdate").cast("date")),
        "danceability": F.when(pk % 71 == 0, F.lit("bad"))
                         .otherwise(_text(F.round(F.col("l_discount") * 100).cast("bigint"))),
        "energy": F.when(pk % 67 == 0, _null())
                   .otherwise(_text(F.round(F.col("l_tax") * 100).cast("bigint"))),
    }


# Columns derived from one dimension row only. Under the equi-joins the line's
# key equals the dimension's key (l_orderkey = o_orderkey, ...), so the rules on
# the line key are evaluated once per dimension row, on the smaller side, before
# the join -- the same values without building text once per line.

def _order_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    ok = F.col("o_orderkey")
    country = (F.when(ok % 101 == 0, _null())
                .when(ok % 103 == 0, F.lit("12"))
                .otherwise(F.col("n_name")))
    return (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == nation.n_nationkey)
            .select("o_orderkey", country.alias("country")))


def _part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = F.col("p_partkey")
    uri = F.when(pk % 97 == 0, _null()).otherwise(F.concat(F.lit("part:"), _text(pk)))
    return read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("track_name"), uri.alias("uri"),
        F.col("p_type").alias("artist_genre"))


def _supplier_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sk = F.col("s_suppkey")
    artist_id = F.when(sk % 11 == 0, _text(sk)).otherwise(F.concat(F.lit("supplier:"), _text(sk)))
    return read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("artist_individual"), artist_id.alias("artist_id"))


def chart_view(spark: SparkSession, sf_dir: str,
               columns: Sequence[str] = tuple(CHART_COLUMNS)) -> DataFrame:
    """String-typed chart rows with the requested columns (FIXTURES.md §3)."""
    unknown = set(columns) - set(CHART_COLUMNS)
    if unknown:
        raise ValueError(f"unknown chart columns: {sorted(unknown)}")
    need = set(columns)
    df = read_table(spark, sf_dir, "lineitem")
    if "country" in need:
        # co-partitioned on the (skew-free) order key, see module doc
        oc = _order_country(spark, sf_dir)
        df = df.repartition("l_orderkey").join(
            oc.repartition("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    if need & _PART_COLS:
        df = df.join(_part_columns(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    if need & _SUPP_COLS:
        df = df.join(_supplier_columns(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    line = _line_exprs()
    return df.select(*[line[c].alias(c) if c in line else F.col(c) for c in columns])


# --- chart documents (S7 input) ----------------------------------------------

def chart_documents(spark: SparkSession, sf_dir: str, entries: int = 50) -> DataFrame:
    """Nested chart documents per order date (FIXTURES.md §4), in pages.

    Entry ``k`` of a day is its ``k``-th most expensive order (ties by order
    key); the track name is ``order:<key>`` and the artists are the suppliers
    of its lines in line order. A day's orders are all kept: page ``p`` holds
    ranks ``p * entries + 1`` to ``(p + 1) * entries``, so a collected list is at most
    ``entries`` entries, or the lines of one order. A second, empty chart
    follows the real one in every document.

    The rank within a day is a stored global position (range sort by day,
    price, key) less the day's first position: no task orders a whole day.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    placed = positioned(orders, ["day", F.desc("o_totalprice"), "o_orderkey"])
    first = placed.groupBy("day").agg(F.min("pos").alias("first"))
    ranked = placed.join(first, "day").select(
        "o_orderkey", "day", (F.col("pos") - F.col("first") + 1).alias("rank"))
    ranked = ranked.withColumn("page", F.floor((F.col("rank") - 1) / entries))
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    named = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
    artist = F.struct("l_linenumber", "l_suppkey", F.col("s_name").alias("name"))
    artists = (named.groupBy("l_orderkey")
               .agg(F.array_sort(F.collect_list(artist)).alias("a")))
    per_order = (ranked.join(artists, ranked.o_orderkey == artists.l_orderkey, "left")
                    .select("day", "page", "rank", "o_orderkey",
                            F.coalesce("a", F.array().cast(artists.schema["a"].dataType))
                             .alias("a")))
    entry = F.struct(
        F.col("rank").alias("pos"),
        F.struct(F.col("rank").cast("bigint").alias("currentRank")).alias("chartEntryData"),
        F.struct(
            F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("trackName"),
            F.transform("a", lambda x: F.struct(x["name"].alias("name"))).alias("artists"),
        ).alias("trackMetadata"),
    )
    per_page = per_order.groupBy("day", "page").agg(
        F.array_sort(F.collect_list(entry)).alias("es"))
    empty = F.array().cast("array<struct<chartEntryData:struct<currentRank:bigint>,"
                           "trackMetadata:struct<trackName:string,"
                           "artists:array<struct<name:string>>>>>")
    real = F.transform("es", lambda e: e.dropFields("pos"))
    return per_page.select(
        F.col("day").cast("string").alias("chartDate"), "page",
        F.array(F.struct(real.alias("entries")), F.struct(empty.alias("entries")))
         .alias("chartEntryViewResponses"))


# --- event fixtures (S2, S5, T*) ---------------------------------------------

def _ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# Source columns filled by key arithmetic (FIXTURES.md §5): text column -> (prefix,
# modulus); the value is missing where the key is divisible by modulus + 4.
EVENT_TEXTS = {
    "artist_id": ("artist:", 97), "entities": ("e", 31), "user_lang": ("ul", 7),
    "time_zone": ("tz", 24), "coordinates": ("c", 41), "place": ("p", 43), "geo": ("g", 47),
    "mode": ("m", 2), "key": ("k", 12),
}
# Number column -> (modulus, divisor); the divisors are powers of two, so the text
# of every value is exact. Missing where the key is divisible by modulus + 6, NaN
# where by modulus + 10.
EVENT_NUMBERS = {
    "instrumentalness": (3, 4), "liveness": (5, 8), "speechiness": (7, 8), "danceability": (9, 16),
    "valence": (11, 16), "loudness": (13, 2), "tempo": (101, 2), "acousticness": (15, 16),
}


def event_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the simulator's source column names (typed where numeric)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    texts = [F.when(k % (m + 4) != 0, F.concat(F.lit(prefix), (k % m).cast("string"))).alias(c)
             for c, (prefix, m) in EVENT_TEXTS.items()]
    numbers = [F.when(k % (m + 10) == 0, F.lit(float("nan")))
                .when(k % (m + 6) != 0, (k % m) / F.lit(float(d))).alias(c)
               for c, (m, d) in EVENT_NUMBERS.items()]
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("track_id"),
        _ts_text(F.col("ts")).alias("created_at"),
        F.col("event_type").alias("tweet_language"),
        F.col("value").alias("energy"), *texts, *numbers,
    )


def event_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines of the event source with injected bad lines (for S2).

    ``event_id % 89 = 0``: short line (only the first five fields);
    ``event_id % 97 = 0`` (and not short): one surplus field. Returns
    ``(line,)``; the header is the list of source column names.
    """
    from tunelake.functions.format import two_decimals
    from tunelake.schema import EVENT_SOURCE_RENAMES
    src = event_source_rows(spark, sf_dir).withColumn(
        "energy", two_decimals("energy"))
    fields = [F.coalesce(F.col(s).cast("string"), F.lit("")) for s, _ in EVENT_SOURCE_RENAMES]
    eid = F.col("id").cast("bigint")
    line = (F.when(eid % 89 == 0, F.concat_ws(",", *fields[:5]))
             .when(eid % 97 == 0, F.concat_ws(",", *fields, F.lit("x")))
             .otherwise(F.concat_ws(",", *fields)))
    return src.select(line.alias("line"))


def event_source_header() -> str:
    from tunelake.schema import EVENT_SOURCE_RENAMES
    return ",".join(s for s, _ in EVENT_SOURCE_RENAMES)


def shuffled_source_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """(lines, header) of an event source whose header is in reverse order, lacks
    ``mode`` and has an unknown column ``extra`` first (for S2).

    ``event_id % 89 = 0``: only the first three fields; ``% 97``: one empty surplus
    field; ``% 83``: a filled one; ``% 79``: the unknown column quoted, with commas;
    ``% 73``: ``NA`` as ``place``; ``% 71``: ``None`` as the last field, ``id``, with the real
    key kept in ``extra``.
    """
    from tunelake.functions.format import two_decimals
    from tunelake.schema import EVENT_SOURCE_RENAMES
    src = event_source_rows(spark, sf_dir).withColumn("energy", two_decimals("energy"))
    k = F.col("id").cast("bigint")
    names = [s for s, _ in reversed(EVENT_SOURCE_RENAMES) if s != "mode"]
    text = {s: F.coalesce(F.col(s).cast("string"), F.lit("")) for s in names}
    text["place"] = F.when(k % 73 == 0, F.lit("NA")).otherwise(text["place"])
    text["id"] = F.when(k % 71 == 0, F.lit("None")).otherwise(text["id"])
    extra = F.when(k % 79 == 0, F.lit('"a,b,,c"')).otherwise(F.col("id"))
    fields = [extra, *[text[s] for s in names]]
    line = (F.when(k % 89 == 0, F.concat_ws(",", *fields[:3]))
             .when(k % 97 == 0, F.concat_ws(",", *fields, F.lit("")))
             .when(k % 83 == 0, F.concat_ws(",", *fields, F.lit("x")))
             .otherwise(F.concat_ws(",", *fields)))
    return src.select(line.alias("line")), ",".join(["extra", *names])


def record_source_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write an event source whose records span lines, as files below ``path`` (for S2).

    Per 20,000 events one file with the header in source order and one with it reversed.
    ``event_id % 5 = 0``: ``place`` is followed by a line break and the quoted key;
    ``% 7``: a blank line, ``% 11``: a line of spaces, before the record; ``% 89``: only the first three fields;
    ``% 97``: a surplus field.
    """
    from tunelake.functions.format import two_decimals
    from tunelake.schema import EVENT_SOURCE_RENAMES
    src = event_source_rows(spark, sf_dir).withColumn("energy", two_decimals("energy"))
    k = F.col("id").cast("bigint")
    names = [s for s, _ in EVENT_SOURCE_RENAMES]
    text = {s: F.coalesce(F.col(s).cast("string"), F.lit("")) for s in names}
    broken = F.concat(F.lit('"'), "place", F.lit('\nrow ""'), "id", F.lit('"""'))
    text["place"] = F.when((k % 5 == 0) & F.col("place").isNotNull(), broken).otherwise(text["place"])

    def record(order: list[str]) -> Column:
        fields = [text[s] for s in order]
        return (F.when(k % 89 == 0, F.concat_ws(",", *fields[:3]))
                 .when(k % 97 == 0, F.concat_ws(",", *fields, F.lit("")))
                 .otherwise(F.concat_ws(",", *fields)))

    before = F.when(k % 7 == 0, F.lit("\n")).when(k % 11 == 0, F.lit("  \n")).otherwise("")
    line = F.when(k % 2 == 0, record(names)).otherwise(record(names[::-1]))
    rows = src.select((F.floor(k / 20_000) * 2 + k % 2).alias("file"), k.alias("at"),
                      F.concat(before, line).alias("line"))
    heads = rows.select("file").distinct().select(
        "file", F.lit(-1).cast("bigint").alias("at"),
        F.when(F.col("file") % 2 == 0, ",".join(names)).otherwise(",".join(names[::-1])).alias("line"))
    (heads.union(rows).repartition("file").sortWithinPartitions("file", "at").select("file", "line")
     .write.partitionBy("file").text(path))
