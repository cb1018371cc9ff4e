"""Language-model scores by a subword lattice.

The vocabulary is that of a public subword tokenizer; the weights of its pieces start
from their ranks in the file and are fitted to the corpus: Spark counts the words
of all training documents, tasks add up the expected uses of every piece over all
segmentations of all counted words, and the sums (one per piece) give the next weights.
A text's probability is the product over its words of the probability summed over
all segmentations, and of its end. Nothing is sampled.

Beside it stands a smoothed word unigram (``base_score``). Counts of words that are
frequent in training (at most ``frequent`` of them, by a count threshold taken from a
histogram) are broadcast; the others meet their counts in a join.

Cases: a null or empty text has the end token alone; a null doc_id is neither
training nor held out, but scored; repeated rows count and are scored each; with no
training text the weights stay those of the file; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import map_batches, slices, staged
from tunelake.llm.lattice import Lattice, Vocabulary, vocabulary

_BATCH_CHARS = 1 << 20
_FLUSH = 400_000       # distinct words that a task holds before it passes them on


def _lower_words(text: str | None) -> list[str]:
    """Words with A-Z lowered, as text."""
    raw = (text or "").encode("utf-8").lower()
    return [w.decode("utf-8") for w in raw.split()]


def load_vocabulary(path: str) -> tuple[Vocabulary, np.ndarray]:
    """Pieces of a tokenizer file and their starting log weights: Zipf's law over the
    pieces' ranks, a thousandth of the mass for the bytes."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                   or model.is_unused(i))]
    vocab = vocabulary([model.id_to_piece(i) for i in ids])
    rank = np.argsort(np.argsort([-model.get_score(i) for i in ids], kind="stable")) + 2.7
    p = np.concatenate([0.998 / rank / (1 / rank).sum(), np.full(256, 0.001 / 256), [0.001]])
    return vocab, np.log(p)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts of ``docs``; tasks pass on counts, not words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": list(seen.keys()), "c": list(seen.values())})

        for pdf in batches:
            for text in pdf["text"]:
                seen.update(_lower_words(text))
                if len(seen) > _FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return (map_batches(docs.select("text"), run, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def fit(counts: DataFrame, vocab: Vocabulary, log_p: np.ndarray, ends: int, rounds: int = 3,
        prior: float = 1000.0) -> np.ndarray:
    """Log weights after ``rounds`` of expectation and maximisation; ``prior`` draws
    of the starting weights keep unused pieces possible."""
    start = np.exp(log_p)
    for _ in range(rounds):
        shared = counts.sparkSession.sparkContext.broadcast(Lattice(vocab, log_p))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(vocab_end + 1)
            for pdf in batches:
                total += shared.value.expected(pdf["word"].tolist(), pdf["c"].to_numpy(float))
            used = np.flatnonzero(total)
            yield pd.DataFrame({"id": used, "x": total[used]})

        vocab_end = vocab.end
        sums = map_batches(counts, run, "id int, x double").groupBy("id").agg(F.sum("x").alias("x"))
        use = prior * start
        for r in sums.collect():          # one row a piece, at most
            use[r["id"]] += r["x"]
        use[vocab.end] += ends
        log_p = np.log(use / use.sum())
    return log_p


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of at least a count that at most ``most`` words have."""
    level = F.floor(F.log2("c") * 8)
    steps = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for r in steps:                       # at most 8 * 64 levels
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    return counts.filter(level >= F.lit(least)) if least is not None else counts.limit(0)


def score(docs: DataFrame, vocabulary_path: str, held_out=None, rounds: int = 3,
          frequent: int = 100_000) -> DataFrame:
    """``docs`` (doc_id, text) to one row each: ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities of the text).

    ``held_out`` is a condition over ``doc_id``; none holds out crc32(doc_id) mod 7 = 2.
    """
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    seen = rows.filter(~held_out)
    counts = staged(word_counts(seen), "lm-counts")
    ends = seen.count()
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = words + ends, distinct + (ends > 0)

    vocab, log_p = load_vocabulary(vocabulary_path)
    if ends:
        log_p = fit(counts, vocab, log_p, ends, rounds)
    lattice = Lattice(vocab, log_p)
    top = _frequent(counts, frequent).collect()      # at most ``frequent`` rows
    table = {r["word"]: i for i, r in enumerate(top)}
    base = np.log10((np.array([r["c"] for r in top], float) + 1) / (n + v + 1))
    model = lattice.log_prob(list(table)) / np.log(10) if table else np.empty(0)
    end_base = float(np.log10((ends + 1) / (n + v + 1)))
    end_score = float(log_p[vocab.end] / np.log(10))
    shared = counts.sparkSession.sparkContext.broadcast((lattice, table, base, model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, table, base, model = shared.value
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].astype("Int64")
            for lo, hi in slices([len(t or "") for t in texts], _BATCH_CHARS):
                split = [_lower_words(t) for t in texts[lo:hi]]
                doc = np.repeat(np.arange(hi - lo), [len(ws) for ws in split])
                at, forms = pd.factorize(np.array([w for ws in split for w in ws], object))
                slot = np.array([table.get(w, -1) for w in forms], np.int64)
                new = np.flatnonzero(slot < 0)
                value = np.empty(len(forms))
                value[slot >= 0] = model[slot[slot >= 0]]
                value[new] = lattice.log_prob([forms[i] for i in new]) / np.log(10)
                word_base = np.zeros(len(forms))
                word_base[slot >= 0] = base[slot[slot >= 0]]
                size = hi - lo
                rare_token = slot[at] < 0
                pairs, times = np.unique(doc[rare_token] * max(1, len(forms)) + at[rare_token],
                                         return_counts=True)
                owner, form = np.divmod(pairs, max(1, len(forms)))
                cut = np.searchsorted(owner, np.arange(1, size))
                yield pd.DataFrame({
                    "doc_id": ids.iloc[lo:hi].reset_index(drop=True),
                    "n_tokens": np.bincount(doc, minlength=size) + 1,
                    "n_top": np.bincount(doc[~rare_token], minlength=size) + (end_known > 0),
                    "base_top": np.bincount(doc, word_base[at], size) + end_base,
                    "score": np.bincount(doc, value[at], size) + end_score,
                    "words": np.split(forms[form], cut) if size > 1 else [forms[form]],
                    "times": np.split(times, cut) if size > 1 else [times]})

    end_known = ends
    scored = staged(
        map_batches(rows, run, "doc_id long, n_tokens long, n_top long, base_top double, "
                               "score double, words array<string>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    c = F.coalesce("c", F.lit(0))
    rare = (scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
            .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
            .join(counts, "word", "left")
            .groupBy("row").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_rare"),
                                F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(n + v + 1))))
                                 .alias("base_rare")))
    return scored.drop("words", "times").join(rare, "row", "left").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_top") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"), "score")
