"""Quality rules: a threshold table compiled into one projection.

``RULES`` is a table (measure, lowest, highest); ``compile_rules`` turns it into
one Boolean column over the measures, so the whole operator is a scan and a
projection: no shuffle, no Python. The three-word windows are counted with one
primitive sort per text; equal neighbours are compared as words, not as hashes.

Cases: a null or empty text has zero measures and fails the length rule; texts of
any length are taken whole; repeated rows are judged each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import SPACE_CLASS, text_words

#: Frequent function words of the four corpus languages (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "with", "be", "by",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "nicht", "ein", "auf",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "est", "pour",
    "el", "y", "los", "del", "se", "las", "por", "con", "para",
)


@dataclass(frozen=True)
class Rule:
    measure: str
    lowest: float | None = None
    highest: float | None = None


#: Judged after the base rule; a measure outside its bounds rejects the text.
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2.0, 20.0),
    Rule("symbol_ratio", None, 0.1),         # symbols a word
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.4),       # one of three lines may repeat
)


def compile_rules(rules: tuple[Rule, ...], measures: dict[str, Column]) -> Column:
    """True where every measure lies within its bounds."""
    ok = F.lit(True)
    for r in rules:
        if r.lowest is not None:
            ok = ok & (measures[r.measure] >= r.lowest)
        if r.highest is not None:
            ok = ok & (measures[r.measure] <= r.highest)
    return ok


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda variable is
    bound, where a plain column used inside another lambda is evaluated per element."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    Each window becomes ``hash << 31 | position``; after one sort of longs, equal
    hashes are neighbours. Only those windows are compared word by word, so
    the hash decides nothing.
    """
    def windows(w: Column) -> Column:
        return F.arrays_zip(F.slice(w, 1, F.size(w) - 2).alias("a"),
                            F.slice(w, 2, F.size(w) - 2).alias("b"),
                            F.slice(w, 3, F.size(w) - 2).alias("c"))

    def place(k: Column) -> Column:
        return k.bitwiseAND(F.lit((1 << 31) - 1))

    def code(k: Column) -> Column:
        return F.shiftright(k, 31)

    def neighbours(s: Column) -> Column:
        return F.arrays_zip(s.alias("x"), F.slice(s, 2, F.size(s)).alias("y"))

    def suspects(s: Column) -> Column:
        """Positions whose hash has an equal neighbour in the sorted array."""
        pairs = F.filter(neighbours(s), lambda p: code(p["x"]) == code(p["y"]))
        return F.array_distinct(F.concat(F.transform(pairs, lambda p: place(p["x"])),
                                         F.transform(pairs, lambda p: place(p["y"]))))

    def proven(w: Column, at: Column) -> Column:
        """Sorted positions among ``at`` whose three words occur there twice."""
        three = F.array_sort(F.transform(at, lambda i: F.struct(
            F.concat_ws(" ", w[i.cast("int")], w[(i + 1).cast("int")], w[(i + 2).cast("int")])
             .alias("g"), i.alias("i"))))
        pairs = let(three, lambda t: F.filter(
            F.arrays_zip(t.alias("x"), F.slice(t, 2, F.size(t)).alias("y")),
            lambda p: p["x"]["g"] == p["y"]["g"]))
        return F.array_sort(F.array_distinct(let(pairs, lambda ps: F.concat(
            F.transform(ps, lambda p: p["x"]["i"]), F.transform(ps, lambda p: p["y"]["i"])))))

    def covered(at: Column) -> Column:
        """Words under windows that start at the sorted positions ``at``."""
        gaps = F.transform(F.arrays_zip(at.alias("x"), F.slice(at, 2, F.size(at)).alias("y")),
                           lambda p: F.coalesce(F.least(p["y"] - p["x"], F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def counted(w: Column) -> Column:
        keys = F.sort_array(F.transform(windows(w), lambda x, i: F.shiftleft(
            F.hash(x["a"], x["b"], x["c"]).cast("long"), 31).bitwiseOR(i.cast("long"))))
        return let(keys, lambda s: let(suspects(s), lambda at: F.when(
            F.size(at) == 0, F.lit(0).cast("long")).otherwise(let(proven(w, at), covered))))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(words, counted))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
            stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept`` and the
    measures ``mean_word_chars``, ``symbol_ratio``, ``stop_word_ratio``, ``dup_line_ratio``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        text_words(text).alias("words"), worded.alias("lines"))
    w, lines = F.col("words"), F.col("lines")
    base = parts.select(
        "doc_id", F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*stop_words))).alias("n_stop"))
    n = F.greatest(F.col("n_words"), F.lit(1))
    measures = {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "stop_word_ratio": F.col("n_stop") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compile_rules(rules, measures)).alias("kept"),
        *[c.alias(k) for k, c in measures.items() if k != "n_words"])
