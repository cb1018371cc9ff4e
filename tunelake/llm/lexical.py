"""Ranked lexical search by presence-mask grouping.

For each item (a text) the documents with the highest scores over the item's terms. One
scan counts the items' terms in every document and stores the counts; document
frequencies and lengths are sums over that table. Then every task goes through its
documents in blocks: a block has a bitmap of its documents for each term, and an
item's bitmaps, stacked, give each document a mask of matched terms. Documents are grouped by mask;
a mask's highest possible score is the sum of its terms' weighted highest gains in the
block. Distinct masks are evaluated by descending highest score until it is below the
item's k-th best score so far (an equal one is still evaluated: a smaller id may win), so
no document of a list is missed. A task returns ``k`` documents an item; the lists
are merged in two steps, first within 64 groups of tasks.

The items are the query set. They reach the tasks in blocks of at most ``block_chars`` characters
of text (an item that is longer is a block of its own); each block is one pass over the documents.

Cases: a null or empty text has no terms: such a document counts nowhere and such an item
has no list; a document without an id counts like any other and ranks behind equal
scores that have one; rows that repeat a doc_id are documents of their own; every row of
items is an item of its own, also one that repeats an item_id or has none; texts of any
length are taken whole; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import Scratch, reach_workers, slices, staged

#: Bytes of UTF-8 that are no term characters become spaces, A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
              for c in range(256))
#: Fixed values of the score.
_SLOPE, _UNIT = 25, 1_000_000_000
_CELLS = 1 << 22      # documents x terms of one item held at once
_RESULT = "item_id long, rank int, doc_id long, score long"


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return (raw or b"").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _counted(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf): the number of terms of each document that has one, and the
    ``known`` terms in it with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, ends, term, tf = [], [], [0], [], []
            for i, raw in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = terms(raw)
                if not words:
                    continue
                seen = Counter(words)
                hits = [w for w in seen if w in known]
                term += [known[w] for w in hits]
                tf += [seen[w] for w in hits]
                rows.append(i)
                sizes.append(len(words))
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))],
                names=["doc_id", "n", "term", "tf"])

    reach_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


class _Best:
    """The ``k`` best documents met so far: score, whether the id is null, id."""

    def __init__(self, k: int):
        self.k, self.score = k, np.empty(0, np.int64)
        self.none, self.doc = np.empty(0, bool), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        """A score that a document needs at least."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        keep = score >= self.floor
        score, none, doc = (np.concatenate(x) for x in (
            (self.score, score[keep]), (self.none, none[keep]), (self.doc, doc[keep])))
        top = np.lexsort((doc, none, -score))[:self.k]
        self.score, self.none, self.doc = score[top], none[top], doc[top]


def distinct_masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms x documents) bitmaps: the first document of each distinct mask of terms, and
    the mask number of every document."""
    packed = np.packbits(present, axis=0, bitorder="little")
    words = np.zeros((present.shape[1], -(-len(packed) // 8) * 8), np.uint8)
    words[:, :len(packed)] = packed.T
    masks = words.view(np.uint64)
    masks = masks[:, 0] if masks.shape[1] == 1 else words.view(f"V{words.shape[1]}")[:, 0]
    _, first, number = np.unique(masks, return_index=True, return_inverse=True)
    return first, number.reshape(-1)


def evaluate(gains: np.ndarray, weights: np.ndarray, none: np.ndarray, doc: np.ndarray,
             best: _Best) -> int:
    """Adds to ``best`` what can enter it of a block: ``gains`` (terms x documents) is zero
    where a document lacks a term. Returns the number of documents evaluated."""
    present = gains > 0
    first, number = distinct_masks(present)
    highest = (weights * gains.max(1, initial=0)) @ present[:, first]
    order = np.argsort(-highest, kind="stable")
    by_mask = np.argsort(number, kind="stable")
    size = np.bincount(number, minlength=len(first))
    begin = np.cumsum(size) - size
    done, at, wave = 0, 0, 2 * best.k
    while at < len(order) and highest[order[at]] >= best.floor:
        stop = at + 1 + int(np.searchsorted(np.cumsum(size[order[at:]]), wave))
        chosen = [m for m in order[at:stop].tolist() if highest[m] >= best.floor]
        docs = np.concatenate([by_mask[begin[m]:begin[m] + size[m]] for m in chosen])
        best.add(weights @ gains[:, docs], none[docs], doc[docs])
        done, at, wave = done + len(docs), stop, 4 * wave
    return done


def _lists(counted: DataFrame, items: list[tuple], n_docs: int, n_terms: int, k: int,
           block: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best ``k`` of each task for each of ``items``
    (item_id, ascending terms, weights)."""
    def blocks(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, n = batch.column("doc_id"), batch.column("n").to_numpy()
        none = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        ends = batch.column("term").offsets.to_numpy()
        term = batch.column("term").values.to_numpy()
        tf = batch.column("tf").values.to_numpy()
        for lo, hi in slices([1] * len(n), block):
            part = slice(ends[lo], ends[hi])
            doc = np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))
            m = np.array([100 - _SLOPE + _SLOPE * x * n_docs // n_terms for x in n[lo:hi].tolist()],
                         np.int64)
            gain = _UNIT * tf[part] // (1000 * tf[part] + 12 * m[doc])
            order = np.argsort(term[part], kind="stable")
            at, start = np.unique(term[part][order], return_index=True)
            yield none[lo:hi], ids[lo:hi], at, np.append(start, len(order)), doc[order], gain[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [_Best(k) for _ in items]
        for batch in batches:
            for none, ids, at, start, doc, gain in blocks(batch):
                for best, (_, item_terms, weights) in zip(lists, items):
                    found = np.flatnonzero(np.isin(item_terms, at, assume_unique=True))
                    if not len(found):
                        continue
                    rows = np.searchsorted(at, item_terms[found])
                    size = start[rows + 1] - start[rows]
                    where = np.arange(size.sum()) + np.repeat(start[rows] - np.cumsum(size) + size, size)
                    which, row, col = np.repeat(np.arange(len(found)), size), doc[where], gain[where]
                    step = max(1, _CELLS // len(found))
                    for lo in range(0, len(ids), step):
                        hi = min(len(ids), lo + step)
                        inside = slice(None) if hi - lo == len(ids) else (row >= lo) & (row < hi)
                        gains = np.zeros((len(found), hi - lo), np.int64)
                        gains[which[inside], row[inside] - lo] = col[inside]
                        evaluate(gains, weights[found], none[lo:hi], ids[lo:hi], best)
        size = [len(b.score) for b in lists]
        numbers = np.repeat(np.arange(len(items)), size)
        joined = {c: np.concatenate([getattr(b, c) for b in lists] or [np.empty(0, np.int64)])
                  for c in ("score", "none", "doc")}
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([items[i][0] for i in numbers], pa.int64()),
             pa.array(joined["doc"], pa.int64(), mask=joined["none"].astype(bool)),
             pa.array(joined["score"], pa.int64())], names=["item", "item_id", "doc_id", "score"])

    return counted.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items with their terms, in blocks; the driver holds one partition and one block."""
    block, chars = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.col("text").cast("string").alias("text"))
    for r in rows.toLocalIterator():
        size = len(r.text or "")
        if block and chars + size > block_chars:
            yield block
            block, chars = [], 0
        found = Counter(terms((r.text or "").encode("utf-8")))
        if found:
            block.append((r.item_id, found))
            chars += size
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, k: int = 20, block: int = 4096,
         block_chars: int = 1 << 25) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) its ``k``
    best documents of ``docs`` (doc_id, text) with a score above 0, the best first, equal
    scores by ascending doc_id."""
    spark, out = docs.sparkSession, None
    for some in item_blocks(items, block_chars):
        kept = Scratch(spark)
        known = {w: i for i, w in enumerate(sorted({w for _, found in some for w in found}))}
        counted = kept.put(_counted(docs, known), "lexical-counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(known), np.int64)     # one number a term of the block
        for term, n in counted.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            df[term] = n
        queries = []
        for item_id, found in some:
            at = np.array(sorted(known[w] for w in found), np.int64)
            uses = {known[w]: q for w, q in found.items()}
            w = np.array([uses[t] * weight(n_docs, int(df[t])) for t in at.tolist()], np.int64)
            queries.append((item_id, at[w > 0], w[w > 0]))
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        near = Window.partitionBy("item", "tasks").orderBy(*order)
        whole = Window.partitionBy("item", "item_id").orderBy(*order)
        lists = (_lists(counted, queries, n_docs, n_terms or 1, k, block)
                 .withColumn("tasks", F.spark_partition_id() % 64)
                 .withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
                 .withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
                 .select("item_id", "rank", "doc_id", "score"))
        lists = staged(lists, "lexical-lists")
        kept.drop()
        out = lists if out is None else out.union(lists)
    return spark.createDataFrame([], _RESULT) if out is None else out
