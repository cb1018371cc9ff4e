"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the fixture definition and the job semantics, not from the Spark
code: it keeps all five dimension joins, uses DuckDB's own regex engine and
spells out every null ordering. Conventions: ``CAST(SUM(x) AS BIGINT)``
(DuckDB sums BIGINT into HUGEINT); ``trunc`` before the long cast (DuckDB
rounds, Spark truncates); explicit ``NULLS FIRST/LAST``.
"""

from __future__ import annotations

# Parameters used on the fixtures.
FIXTURE_YEAR = "2000"
FIXTURE_ARTIST_PREFIX = "supplier:"

NUM_RE = "'^[0-9]+([.][0-9]+)?$'"

CHART_CTE = """chart AS (
  SELECT
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
         WHEN l.l_orderkey % 103 = 0 THEN '12'
         ELSE n.n_name END AS country,
    p.p_name AS track_name,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL
         ELSE concat('part:', CAST(p.p_partkey AS VARCHAR)) END AS uri,
    CASE WHEN l.l_orderkey % 89 = 0 THEN NULL
         WHEN l.l_orderkey % 83 = 0 THEN 'n/a'
         WHEN l.l_orderkey % 79 = 0 THEN '-5'
         WHEN l.l_orderkey % 73 = 0 THEN concat(CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR), '.75')
         ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS streams,
    CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS release_date,
    p.p_type AS artist_genre,
    s.s_name AS artist_individual,
    CASE WHEN l.l_suppkey % 11 = 0 THEN CAST(s.s_suppkey AS VARCHAR)
         ELSE concat('supplier:', CAST(s.s_suppkey AS VARCHAR)) END AS artist_id,
    CASE WHEN l.l_partkey % 71 = 0 THEN 'bad'
         ELSE CAST(CAST(round(l.l_discount * 100) AS BIGINT) AS VARCHAR) END AS danceability,
    CASE WHEN l.l_partkey % 67 = 0 THEN NULL
         ELSE CAST(CAST(round(l.l_tax * 100) AS BIGINT) AS VARCHAR) END AS energy
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

COUNT = "TRY_CAST(trunc(TRY_CAST(streams AS DOUBLE)) AS BIGINT)"

Q1_ROWS = f"""q1_rows AS (
  SELECT country, track_name, uri, {COUNT} AS streams FROM chart
  WHERE streams IS NOT NULL AND country IS NOT NULL AND track_name IS NOT NULL AND uri IS NOT NULL
    AND regexp_matches(streams, {NUM_RE}) AND NOT regexp_matches(country, {NUM_RE})
)"""

Q2_ROWS = f"""q2_rows AS (
  SELECT country, track_name, {COUNT} AS streams FROM chart
  WHERE starts_with(release_date, '{{year}}') AND streams IS NOT NULL
)"""

Q3_ROWS = f"""q3_rows AS (
  SELECT country, artist_genre AS genre, {COUNT} AS streams FROM chart
  WHERE streams IS NOT NULL AND country IS NOT NULL AND artist_genre IS NOT NULL
    AND regexp_matches(streams, {NUM_RE}) AND NOT regexp_matches(country, {NUM_RE})
)"""

Q4_ROWS = f"""q4_rows AS (
  SELECT artist_genre AS genre, artist_individual AS artist, artist_id, {COUNT} AS streams FROM chart
  WHERE streams IS NOT NULL AND artist_genre IS NOT NULL AND artist_individual IS NOT NULL
    AND artist_id IS NOT NULL AND regexp_matches(streams, {NUM_RE})
    AND starts_with(artist_id, '{{prefix}}')
)"""

Q5_ROWS = f"""q5_rows AS (
  SELECT country, CAST(danceability AS DOUBLE) AS danceability, CAST(energy AS DOUBLE) AS energy
  FROM chart
  WHERE country IS NOT NULL AND danceability IS NOT NULL AND energy IS NOT NULL
    AND regexp_matches(danceability, {NUM_RE}) AND regexp_matches(energy, {NUM_RE})
)"""


def _top(rows: str, keys: list[str], part: list[str], n: int = 1) -> str:
    ties = ", ".join(f"{k} ASC NULLS FIRST" for k in keys if k not in part)
    order = "total_streams DESC NULLS LAST" + (f", {ties}" if ties else "")
    k = ", ".join(keys)
    return f"""SELECT {k}, total_streams FROM (
  SELECT {k}, total_streams,
         row_number() OVER (PARTITION BY {", ".join(part)} ORDER BY {order}) AS rn
  FROM (SELECT {k}, CAST(SUM(streams) AS BIGINT) AS total_streams FROM {rows} GROUP BY {k}) t
) r WHERE rn <= {n}"""


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def q1_ctes(n: int = 1) -> list[str]:
    return [CHART_CTE, Q1_ROWS,
            f"q1 AS ({_top('q1_rows', ['country', 'track_name', 'uri'], ['country'], n)})"]


def q2_ctes(year: str = FIXTURE_YEAR) -> list[str]:
    return [CHART_CTE, Q2_ROWS.format(year=year),
            f"q2 AS ({_top('q2_rows', ['country', 'track_name'], ['country'])})"]


def q3_ctes(n: int = 1) -> list[str]:
    return [CHART_CTE, Q3_ROWS, f"q3 AS ({_top('q3_rows', ['country', 'genre'], ['country'], n)})"]


def q4_ctes(prefix: str = FIXTURE_ARTIST_PREFIX) -> list[str]:
    return [CHART_CTE, Q4_ROWS.format(prefix=prefix),
            """q4_totals AS (
  SELECT genre, artist, artist_id, CAST(SUM(streams) AS BIGINT) AS total_streams
  FROM q4_rows GROUP BY genre, artist, artist_id
)""",
            f"q4 AS ({_top('q4_rows', ['genre', 'artist', 'artist_id'], ['genre'])})"]


def q5_ctes() -> list[str]:
    return [CHART_CTE, Q5_ROWS, """q5 AS (
  SELECT country,
         round(avg(danceability), 6) AS avg_danceability,
         round(avg(energy), 6) AS avg_energy
  FROM q5_rows GROUP BY country
)"""]


def q1(n: int = 1) -> str:
    return sql(q1_ctes(n), "SELECT * FROM q1")


def q2(year: str = FIXTURE_YEAR) -> str:
    return sql(q2_ctes(year), "SELECT * FROM q2")


def q3(n: int = 1) -> str:
    return sql(q3_ctes(n), "SELECT * FROM q3")


def q4(prefix: str = FIXTURE_ARTIST_PREFIX) -> str:
    return sql(q4_ctes(prefix), "SELECT * FROM q4")


def q5() -> str:
    return sql(q5_ctes(), "SELECT * FROM q5")


def clean_rows() -> str:
    return sql([CHART_CTE, Q1_ROWS], "SELECT country, track_name, uri, streams FROM q1_rows")


# --- serving views -----------------------------------------------------------

FIXTURE_COUNTRY = "NATION_7"
ALL_LABEL = "All Countries"


def country_selector() -> str:
    return sql(q3_ctes(), f"""SELECT 0 AS ord, '{ALL_LABEL}' AS country
UNION ALL
SELECT DISTINCT 1 AS ord, country FROM q3 WHERE country IS NOT NULL""")


def _label(col: str) -> str:
    return f"format('{{:,}}', {col}) || ' streams'"


def country_slice(country: str = FIXTURE_COUNTRY) -> str:
    return sql(q1_ctes(), f"""SELECT country, track_name, total_streams,
       {_label('total_streams')} AS label
FROM q1 WHERE country = '{country}'
ORDER BY total_streams DESC NULLS LAST, track_name ASC NULLS FIRST LIMIT 1""")


def country_slice_all() -> str:
    return sql(q3_ctes(), f"""SELECT country, genre, total_streams,
       {_label('total_streams')} AS label FROM q3""")


def _rollup(src: str) -> str:
    return f"""SELECT genre, artist, CAST(SUM(total_streams) AS BIGINT) AS total_streams,
       GROUPING(genre, artist) AS gid
FROM {src} GROUP BY ROLLUP (genre, artist)
HAVING GROUPING(genre, artist) <> 3"""


def genre_artist_totals() -> str:
    return sql(q4_ctes(), _rollup("q4_totals"))


def genre_artist_totals_top1() -> str:
    return sql(q4_ctes(), _rollup("q4"))


def feature_long() -> str:
    return sql(q5_ctes(), """SELECT country, 'avg_energy' AS metric, avg_energy AS value FROM q5
UNION ALL
SELECT country, 'avg_danceability' AS metric, avg_danceability AS value FROM q5""")


def _two_decimals(col: str) -> str:
    """DuckDB's ``printf`` rounds the exact binary value, like Python."""
    return f"printf('%.2f', {col})"


def feature_labels(country: str | None = None) -> str:
    where = f"\nWHERE country = '{country}'" if country is not None else ""
    return sql(q5_ctes(), f"""SELECT country,
  {_two_decimals('avg_energy')} AS avg_energy_label,
  {_two_decimals('avg_danceability')} AS avg_danceability_label
FROM q5{where}""")


def preview_first5() -> str:
    return sql(q3_ctes(), """SELECT * FROM q3
ORDER BY country ASC NULLS FIRST, genre ASC NULLS FIRST LIMIT 5""")


def refresh_summary() -> str:
    ctes = [CHART_CTE, Q1_ROWS, Q2_ROWS.format(year=FIXTURE_YEAR), Q3_ROWS,
            Q4_ROWS.format(prefix=FIXTURE_ARTIST_PREFIX), Q5_ROWS,
            q1_ctes()[-1], q2_ctes()[-1], q3_ctes()[-1], q4_ctes()[-1], q5_ctes()[-1]]
    parts = [f"SELECT '{name}' AS table_name, COUNT(*) AS n, "
             f"CAST(SUM(total_streams) AS BIGINT) AS total FROM {q}"
             for name, q in (("top_songs_all_time", "q1"), ("top_song_2020", "q2"),
                             ("top_genre_all_time", "q3"), ("top_artist_per_genre", "q4"))]
    parts.append("SELECT 'energy_per_country' AS table_name, COUNT(*) AS n, "
                 "CAST(NULL AS BIGINT) AS total FROM q5")
    return sql(ctes, "\nUNION ALL\n".join(parts))


def refresh_rows() -> str:
    ctes = [CHART_CTE, Q1_ROWS, Q2_ROWS.format(year=FIXTURE_YEAR), Q3_ROWS,
            Q4_ROWS.format(prefix=FIXTURE_ARTIST_PREFIX), Q5_ROWS,
            q1_ctes()[-1], q2_ctes()[-1], q3_ctes()[-1], q4_ctes()[-1], q5_ctes()[-1]]
    none = "CAST(NULL AS VARCHAR)"
    parts = [f"SELECT '{name}' AS table_name, {', '.join(f'{(keys + [none] * 3)[i]} AS k{i + 1}' for i in range(3))}, "
             f"total_streams, CAST(NULL AS DOUBLE) AS avg_danceability, CAST(NULL AS DOUBLE) AS avg_energy "
             f"FROM {q}"
             for name, q, keys in (
                 ("top_songs_all_time", "q1", ["country", "track_name", "uri"]),
                 ("top_song_2020", "q2", ["country", "track_name"]),
                 ("top_genre_all_time", "q3", ["country", "genre"]),
                 ("top_artist_per_genre", "q4", ["genre", "artist", "artist_id"]))]
    parts.append(f"SELECT 'energy_per_country', country, {none}, {none}, CAST(NULL AS BIGINT), "
                 "avg_danceability, avg_energy FROM q5")
    return sql(ctes, "\nUNION ALL\n".join(parts))
