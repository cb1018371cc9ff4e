"""DuckDB SQL of the queries that SQL can express; column names as in the queries."""

from __future__ import annotations

from tunelake.llm.quality import RULES, STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    bounds = [f"{r.measure} {op} {b}" for r in RULES
              for op, b in ((">=", r.lowest), ("<=", r.highest)) if b is not None]
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
                  {_WORDS} AS words FROM documents),
l AS (SELECT *, [x FOR x IN string_split(text, chr(10))
                  IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM d),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
      FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
c AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, range(3) t(o) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
             length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT
                 AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
             len([x FOR x IN words IF lower(x) IN ({stop})]) AS n_stop
      FROM l LEFT JOIN c USING (rid)),
x AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             word_chars::DOUBLE / greatest(n_words, 1) AS mean_word_chars,
             n_symbols::DOUBLE / greatest(n_words, 1) AS symbol_ratio,
             n_stop::DOUBLE / greatest(n_words, 1) AS stop_word_ratio,
             n_dup_lines::DOUBLE / greatest(n_lines, 1) AS dup_line_ratio FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(bounds)} AS kept,
       mean_word_chars, symbol_ratio, stop_word_ratio, dup_line_ratio FROM x
"""


SUBSTRINGS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
g AS (SELECT rid, doc_id, i, array_to_string(words[i:i + 12], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS first_id FROM g GROUP BY g),
r AS (SELECT DISTINCT rid, i + o AS j FROM g JOIN f USING (g), range(13) t(o)
      WHERE doc_id > first_id),
w AS (SELECT rid, words[j] AS word, j FROM (SELECT *, unnest(range(1, len(words) + 1)) AS j FROM d)),
k AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept
      FROM w ANTI JOIN r USING (rid, j) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""

_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS words FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
t AS (SELECT rid, doc_id, n, word, count(*) AS tf
      FROM (SELECT rid, doc_id, len(words) AS n, unnest(words) AS word FROM d) GROUP BY ALL),
w AS (SELECT word, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM t, s GROUP BY word, n_docs),
i AS (SELECT iid, item_id, word, count(*) AS uses
      FROM (SELECT row_number() OVER () AS iid, item_id, unnest({_TERMS}) AS word FROM benchmark)
      GROUP BY ALL),
x AS (SELECT iid, item_id, rid, doc_id,
             sum(uses * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))
                 ::BIGINT AS score
      FROM i JOIN t USING (word) JOIN w USING (word), s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INTEGER AS rank
      FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

NEAR_SETS = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words FROM documents),
e AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(words) < 2 THEN words
         ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END)) AS grams FROM d),
s AS (SELECT grams, min(rid) AS sid, min(doc_id) AS least, len(grams) AS n FROM e GROUP BY grams),
g AS (SELECT sid, n, unnest(grams) AS gram FROM s),
p AS (SELECT x.sid AS a, y.sid AS b FROM g x JOIN g y
      ON x.gram = y.gram AND x.sid <> y.sid AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
      GROUP BY x.sid, y.sid, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
c AS (SELECT sid AS a, sid AS b FROM s UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a),
m AS (SELECT c.a AS sid, min(s.least) AS component_id FROM c JOIN s ON s.sid = c.b GROUP BY c.a),
r AS (SELECT doc_id, n AS n_shingles, CASE WHEN n > 0 THEN component_id ELSE doc_id END AS component_id
      FROM e JOIN s USING (grams) JOIN m USING (sid))
SELECT doc_id, n_shingles::BIGINT AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept FROM r
"""

NEGATIVES = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.rid AS aid, a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, x.rid,
             list_inner_product(a.vec, x.vec)::BIGINT AS score
      FROM v a JOIN v x ON a.rid <> x.rid WHERE a.vec_id % 100 = 0),
p AS (SELECT aid, rid AS pid, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.aid, pid ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON p.aid = s.aid AND NOT s.same
           AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE = {"op13_negatives": NEGATIVES, "op11_lexical": LEXICAL, "op12_hyperminhash": NEAR_SETS, "op3_quality": quality_sql(), "op8_substrings": SUBSTRINGS}
