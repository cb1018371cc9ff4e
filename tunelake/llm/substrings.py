"""Repeated word passages by de Bruijn compaction.

Every ``window`` of consecutive words is an edge of a de Bruijn graph. Edges that
follow one another and share the same least k-mer (their seed) form a path piece, so a
document gives about one row per five words instead of one per word. Spark
finds the seeds that occur in several documents. A seed with one context (all
its pieces have the same words) is a nonbranching path: its piece stays compact and
takes its least document as the source. A seed with several contexts branches:
one source piece of each context is opened into single edges at its source
coordinates, edges are matched, and the result returns to the pieces by a join.

Equal pieces are recognised by two 64-bit hashes, of the seed and of the piece's
own UTF-8 bytes; opened edges likewise. Spans find their row again by its id and, where an id has
several texts, by a stored number of the text. All groups are aggregated before they
are shuffled; occurrences meet their group through joins that AQE can split.

Cases: a null or empty text has no words; a null doc_id is neither earlier nor later
than another document, so nothing of it is removed and it removes nothing; rows that
repeat a doc_id count as that document and each is judged by its own text; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import (
    Scratch, byte_words, map_batches, mix64, reach_workers, row_tags, slices, staged,
)

_BATCH_CHARS = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_PIECES = "doc_id long, tag long, seed long, digest long, at long"


class _Words:
    """The words of some texts in one run, with hashes and byte places."""

    def __init__(self, texts: list[str | None], hashed: bool = True):
        import xxhash
        split = [byte_words(t) for t in texts]
        words = [w for ws in split for w in ws]
        self.counts = np.array([len(ws) for ws in split], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.raw = b" ".join(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(lens + 1) - 1
        self.begin = self.end - lens
        if hashed:
            self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def digests(self, start: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Hash of the bytes of ``size`` words from ``start``, salted."""
        import xxhash
        raw, h = self.raw, xxhash.xxh3_64_intdigest
        return np.array([h(raw[a:b], s) for a, b, s in zip(
            self.begin[start].tolist(), self.end[start + size - 1].tolist(), salt.tolist())],
            np.uint64)


def _pieces(words: _Words, window: int, k: int):
    """(document, seed, digest, start, edges) of every path piece."""
    n = len(words.hash)
    n_edges = n - window + 1
    if n_edges < 1:
        return None
    kmers = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        kmers = kmers * np.uint64(_ODD) + words.hash[j:n - k + 1 + j]
    kmers = mix64(kmers)
    least = (np.lib.stride_tricks.sliding_window_view(kmers, window - k + 1)[:n_edges].argmin(1)
             + np.arange(n_edges))
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    inside = doc[:n_edges] == doc[window - 1:]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    start = np.flatnonzero(fresh)
    stops = np.append(np.flatnonzero(fresh | ~inside), n_edges)
    edges = stops[np.searchsorted(stops, start, side="right")] - start
    digest = words.digests(start, edges + window - 1, least[start] - start)
    return doc[start], kmers[least[start]], digest, start, edges


def _scan_pieces(docs: DataFrame, window: int, k: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, tags, texts = (pdf[c].to_numpy() for c in ("doc_id", "tag", "text"))
            for lo, hi in slices([len(t or "") for t in texts], _BATCH_CHARS):
                words = _Words(texts[lo:hi])
                found = _pieces(words, window, k)
                if found:
                    doc, seed, digest, start, edges = found
                    yield pd.DataFrame({
                        "doc_id": ids[lo:hi][doc], "tag": tags[lo:hi][doc],
                        "seed": seed.view(np.int64), "digest": digest.view(np.int64),
                        "at": (start - words.first[doc]) * 16 + edges})

    return map_batches(docs.filter("doc_id is not null"), run, _PIECES)


def _open_edges(docs: DataFrame, sources: DataFrame, window: int) -> DataFrame:
    """(seed, digest, j, edge, least_doc): the single edges of source pieces,
    read at their coordinates (doc_id, tag, at)."""
    wanted = sources.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("seed", "digest", "at")).alias("pieces"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in slices([len(t) for t in texts], _BATCH_CHARS):
                words = _Words(texts[lo:hi], hashed=False)
                part = pdf.iloc[lo:hi]
                pieces = part["at"].map(len).to_numpy()
                doc = np.repeat(np.arange(hi - lo), pieces)
                seed, digest, at = (np.concatenate(part[c].to_list())
                                    for c in ("seed", "digest", "at"))
                n = at & 15
                j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(words.first[doc] + (at >> 4), n) + j
                edge = words.digests(start, np.full(len(start), window), np.zeros(len(start), int))
                yield pd.DataFrame({
                    "seed": np.repeat(seed, n), "digest": np.repeat(digest, n), "j": j,
                    "edge": edge.view(np.int64),
                    "least_doc": np.repeat(part["doc_id"].to_numpy()[doc], n)})

    joined = docs.join(wanted, ["doc_id", "tag"])
    return map_batches(joined.select("doc_id", "text", "pieces.seed", "pieces.digest", "pieces.at"),
                       run, "seed long, digest long, j int, edge long, least_doc long")


def repeated_spans(docs: DataFrame, window: int = 13, k: int = 5) -> DataFrame:
    """(doc_id, tag, at, source_id): pieces of ``docs`` (doc_id, tag, text) whose edges
    all start in a document with a smaller id; ``at`` is start * 16 + number of edges."""
    if not 0 < k <= window <= k + 14:
        raise ValueError("a piece must hold at most 15 edges: k <= window <= k + 14")
    kept = Scratch(docs.sparkSession)
    pieces = kept.put(_scan_pieces(docs, window, k), "edges")
    shared = kept.put(pieces.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                      .filter("lo < hi").select("seed"), "edges-shared")
    hits = kept.put(pieces.join(shared, "seed"), "edges-hits")
    kept.drop("edges", "edges-shared")
    contexts = kept.put(
        hits.groupBy("seed", "digest").agg(F.min(F.struct("doc_id", "tag", "at")).alias("source")),
        "edges-contexts")
    branching = contexts.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    sources = kept.put(contexts.join(branching, "seed").select("seed", "digest", "source.*"),
                       "edges-branching")
    opened = kept.put(_open_edges(docs, sources, window), "edges-opened")
    least = opened.groupBy("seed", "edge").agg(F.min("least_doc").alias("least_doc"))
    per_edge = (opened.select("seed", "digest", "j", "edge").join(least, ["seed", "edge"])
                .groupBy("seed", "digest")
                .agg(F.array_sort(F.collect_list(F.struct("j", "least_doc"))).alias("edges")))
    known = kept.put(contexts.select("seed", "digest", F.col("source.doc_id").alias("source_id"))
                     .join(per_edge, ["seed", "digest"], "left"), "edges-known")
    found = hits.join(known, ["seed", "digest"])
    whole = found.filter(F.col("edges").isNull() & (F.col("source_id") < F.col("doc_id"))).select(
        "doc_id", "tag", "at", "source_id")
    single = (found.filter(F.col("edges").isNotNull())
              .select("doc_id", "tag", "at", F.explode("edges").alias("e"))
              .filter(F.col("e.least_doc") < F.col("doc_id"))
              .select("doc_id", "tag",
                      (F.shiftleft(F.shiftright("at", 4) + F.col("e.j"), 4) + 1).alias("at"),
                      F.col("e.least_doc").alias("source_id")))
    out = staged(whole.union(single), "edges-spans")
    kept.drop()
    return out


_RESULT = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def _remover(window: int, with_text: bool):
    """A pandas function (text, pieces) -> what is left without the pieces' words."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans in batches:
            out = []
            for text, at in zip(texts, spans):
                words = kept = byte_words(text)
                if at is not None and len(at):
                    at = np.asarray(at, np.int64)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at >> 4, 1)
                    np.add.at(edge, (at >> 4) + (at & 15) + window - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                raw = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(raw).hexdigest(),
                            raw.decode() if with_text and len(kept) < len(words) else None))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])

    return F.pandas_udf(run, _RESULT)


def remove_repeats(docs: DataFrame, window: int = 13, k: int = 5,
                   with_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text and others) with a struct column ``repeats``: ``n_words``,
    ``n_removed``, ``kept_sha256`` (of the kept words joined by one space) and, if asked
    for, ``kept_text`` (those words; null if nothing is removed)."""
    own = {"_rep_doc": F.col("doc_id").cast("long"), "_rep_text": F.col("text").cast("string")}
    rows = row_tags(docs.drop("repeats").withColumns(own), "_rep_doc", "_rep_text", "_rep_tag")
    slim = rows.select(F.col("_rep_doc").alias("doc_id"), F.col("_rep_tag").alias("tag"),
                       F.col("_rep_text").alias("text"))
    spans = staged(repeated_spans(slim, window, k).groupBy("doc_id", "tag").agg(
        F.collect_set("at").alias("_rep_at"))
        .select(F.col("doc_id").alias("_rep_doc"), F.col("tag").alias("_rep_tag"), "_rep_at"),
        "edges-by-document")
    reach_workers(docs.sparkSession)
    return (rows.join(spans, ["_rep_doc", "_rep_tag"], "left")
                .withColumn("repeats", _remover(window, with_text)("_rep_text", "_rep_at"))
                .drop("_rep_doc", "_rep_tag", "_rep_text", "_rep_at"))
