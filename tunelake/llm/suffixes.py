"""Repeated byte strings by common-prefix interval trees.

A string of ``length`` bytes contains a seed: its least k-byte string by hash. Neighbouring
strings share seeds, so a text gives about one row per 85 bytes: a piece (all strings
round one seed) with hashes of the seed and of the piece. Pieces whose seed occurs once in
the corpus cannot repeat. Pieces that occur whole at several places are repeats at
once, counted, never expanded. The rest, pieces that share a seed but differ further out, go
through an enhanced suffix array: per seed, the suffixes from the seed on are sorted with
their common-prefix lengths, a stack scan yields the intervals of the common-prefix
tree, and in each interval the left contexts are tested for how far they agree: an interval
whose members differ on the left is a maximal repeat group, kept with all its occurrences.

A seed with more than ``group`` different contexts is not sorted in one task: its strings
of ``length`` bytes are hashed one by one and counted by Spark, which gives the same spans.

Spans find their row again by its id and, where an id (or no id) has several texts, by a
stored number of the text.

Cases: a null or empty text has no bytes; matches never cross rows, and rows that repeat
a document count as places of their own; a null doc_id is a document like any other;
texts of any length are scanned in overlapping blocks; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import (
    Scratch, fan_out, map_batches, mix64, reach_workers, row_tags, slices, staged,
)

_BLOCK = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_PLACE = np.uint64((1 << 24) - 1)     # a block with its overlap is below 2^24 bytes


def _segments(texts: list[str | None], length: int) -> list[tuple[int, int, bytes]]:
    """(document, offset, bytes); long texts in blocks that overlap by length - 1."""
    out = []
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8")
        for lo in range(0, max(1, len(raw) - length + 1), _BLOCK):
            part = raw[lo:lo + _BLOCK + length - 1]
            if len(part) >= length:
                out.append((i, lo, part))
    return out


def _pieces(segments: list[tuple[int, int, bytes]], length: int, k: int):
    """(document, seed, digest, start, offset of the seed, strings) of every piece."""
    import xxhash
    raw = b"".join(s[2] for s in segments)
    h = _BYTE[np.frombuffer(raw, np.uint8)]
    span = 1
    while span < k:
        h = h[:-span] * np.uint64(_ODD + 2 * span) + h[span:]
        span *= 2
    h = mix64(h)
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    width, have = length - k + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:have - width], low[width - have:])
    seed_at = (low & _PLACE).astype(np.int64)
    sizes = np.array([len(s[2]) for s in segments], np.int64)
    first = np.cumsum(sizes) - sizes
    inside = np.zeros(len(seed_at), bool)
    for lo, n in zip(first.tolist(), sizes.tolist()):
        inside[lo:lo + n - length + 1] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (seed_at[1:] != seed_at[:-1])
    start = np.flatnonzero(fresh)
    stops = np.append(np.flatnonzero(fresh | ~inside), len(seed_at))
    n = stops[np.searchsorted(stops, start, side="right")] - start
    offset = seed_at[start] - start
    digest = np.array([xxhash.xxh3_64_intdigest(raw[a:b], s) for a, b, s in zip(
        start.tolist(), (start + n + length - 1).tolist(), offset.tolist())], np.uint64)
    seg = np.searchsorted(first, start, side="right") - 1
    doc = np.array([s[0] for s in segments], np.int64)[seg]
    begin = start - first[seg] + np.array([s[1] for s in segments], np.int64)[seg]
    return doc, h[seed_at[start]], digest, begin, offset, n


def _scan_pieces(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(doc_id, tag, seed, digest, at); ``at`` is start << 16 | offset << 8 | strings."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, tags = pdf["doc_id"].astype("Int64").array, pdf["tag"].to_numpy()
            texts = pdf["text"].tolist()
            for lo, hi in slices([len(t or "") for t in texts], _BLOCK):
                segments = _segments(texts[lo:hi], length)
                for a, b in slices([len(s[2]) for s in segments], 2 * _BLOCK):
                    doc, seed, digest, begin, offset, n = _pieces(segments[a:b], length, k)
                    yield pd.DataFrame({
                        "doc_id": ids[lo + doc], "tag": tags[lo + doc],
                        "seed": seed.view(np.int64), "digest": digest.view(np.int64),
                        "at": (begin << 16) | (offset << 8) | n})

    return map_batches(docs, run, "doc_id long, tag long, seed long, digest long, at long")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the common-prefix tree over
    sorted suffixes; ``lcp[i]`` is what suffixes i and i + 1 share."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > depth:
            d, left = stack.pop()
            yield d, left, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))


def repeat_groups(lefts: list[bytes], rights: list[bytes],
                  least: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``least`` bytes among contexts of one seed, as
    (bytes left of the seed, bytes from the seed on, all occurrences). ``lefts`` are
    reversed. Members of a group agree on just that much: the intervals of the left
    tree differ in their next byte to the left, and a group that agrees further to the
    right is left to the deeper interval."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    rank = {m: i for i, m in enumerate(order)}
    lcp = [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    widest = max(map(len, lefts), default=0)
    for depth, first, last in intervals(lcp):
        if depth + widest < least:
            continue
        members = sorted(order[first:last + 1], key=lefts.__getitem__)
        agree = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for left, lo, hi in intervals(agree):
            if left + depth >= least:
                group = members[lo:hi + 1]
                ends = [rank[m] for m in group]
                if common(rights[order[min(ends)]], rights[order[max(ends)]]) == depth:
                    yield left, depth, group


def widest_repeats(lefts: list[bytes], rights: list[bytes],
                   least: int) -> list[tuple[int, int] | None]:
    """For each context, how far its repeats reach to the left and right of the seed."""
    best: list[tuple[int, int] | None] = [None] * len(rights)
    for left, right, group in repeat_groups(lefts, rights, least):
        for m in group:
            was = best[m] or (0, 0)
            best[m] = max(left, was[0]), max(right, was[1])
    return best


def _contexts(docs: DataFrame, sources: DataFrame, length: int) -> DataFrame:
    """``sources`` with the bytes round their seeds: ``left`` (reversed) and ``right``."""
    wanted = sources.groupBy(F.col("doc_id").alias("w_doc"), F.col("tag").alias("w_tag")).agg(
        F.collect_list(F.struct("seed", "n", "m", "at")).alias("pieces"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in slices([len(t) for t in texts], _BLOCK):
                part = pdf.iloc[lo:hi]
                doc = np.repeat(np.arange(hi - lo), part["at"].map(len).to_numpy())
                seed, n, m, at = (np.concatenate(part[c].to_list()) for c in ("seed", "n", "m", "at"))
                start, middle = at >> 16, (at >> 16) + ((at >> 8) & 255)
                stop = start + (at & 255) + length - 1
                raws = [t.encode("utf-8") for t in texts[lo:hi]]
                yield pd.DataFrame({
                    "seed": seed, "n": n, "m": m, "at": at,
                    "doc_id": part["doc_id"].astype("Int64").array[doc],
                    "tag": part["tag"].to_numpy()[doc],
                    "left": [raws[d][a:b][::-1] for d, a, b in
                             zip(doc.tolist(), start.tolist(), middle.tolist())],
                    "right": [raws[d][a:b] for d, a, b in
                              zip(doc.tolist(), middle.tolist(), stop.tolist())]})

    joined = docs.join(wanted, docs.doc_id.eqNullSafe(F.col("w_doc")) & (docs.tag == F.col("w_tag")))
    parts = [F.col("pieces")[c].alias(c) for c in ("seed", "n", "m", "at")]
    return map_batches(joined.select("doc_id", "tag", "text", *parts), run,
                       "seed long, n long, m long, doc_id long, tag long, at long, left binary, "
                       "right binary")


_SPAN = "doc_id long, tag long, start long, stop long"


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of single contexts, seed by seed; rows of a seed lie together in a task."""
    def of_seed(rows: list[tuple]) -> list[tuple]:
        found = widest_repeats([r[4] for r in rows], [r[5] for r in rows], length)
        out = []
        for (n, doc, tag, at, _, _), repeat in zip(rows, found):
            if repeat and n == 1:
                mid = (at >> 16) + ((at >> 8) & 255)
                out.append((doc, tag, mid - repeat[0], mid + repeat[1]))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", "tag", "start", "stop"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        now, rows = None, []
        for pdf in batches:
            spans = []
            for seed, *row in zip(pdf["seed"], pdf["n"], pdf["doc_id"].astype("Int64"), pdf["tag"],
                                  pdf["at"], pdf["left"], pdf["right"]):
                if seed != now:
                    spans += of_seed(rows)
                    now, rows = seed, []
                rows.append(tuple(row))
            yield frame(spans)
        yield frame(of_seed(rows))

    dealt = contexts.repartition(fan_out(contexts), "seed").sortWithinPartitions("seed")
    return map_batches(dealt.select("seed", "n", "doc_id", "tag", "at", "left", "right"), run, _SPAN)


def _strings(contexts: DataFrame, length: int) -> DataFrame:
    """Every string of ``length`` bytes in ``contexts``, hashed, with its place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        for pdf in batches:
            for i in range(len(pdf)):
                r = pdf.iloc[i]
                raw, n = r["left"][::-1] + r["right"], int(r["at"]) & 255
                j = np.arange(n)
                out = pd.DataFrame({
                    "j": j, "string": np.array([xxhash.xxh3_64_intdigest(raw[x:x + length])
                                                for x in range(n)], np.uint64).view(np.int64)})
                for c in ("seed", "n", "doc_id", "tag", "at"):
                    out[c] = r[c]
                out["place"] = ((int(r["at"]) >> 8) & 255) - j
                yield out

    return map_batches(contexts.drop("m"), run,
                       "seed long, n long, doc_id long, tag long, at long, j long, "
                       "string long, place long")


def _counted_spans(each: DataFrame, length: int) -> DataFrame:
    """Spans of single contexts of crowded seeds: strings counted by Spark."""
    same = ["seed", "place", "string"]
    often = each.groupBy(*same).agg(F.sum("n").alias("all")).filter("all > 1").select(*same)
    start = F.shiftright("at", 16) + F.col("j")
    return each.filter("n = 1").join(often, same).select(
        "doc_id", "tag", start.alias("start"), (start + length).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = 200, k: int = 32,
                   group: int = 50_000) -> DataFrame:
    """(doc_id, tag, start, stop): byte spans of ``docs`` (doc_id, tag, text) made of
    strings of ``length`` bytes that start at two places or more."""
    if not 0 < k < length < k + 255 or k & (k - 1):
        raise ValueError("k must be a power of two below length, at most 254 bytes shorter")
    kept = Scratch(docs.sparkSession)
    pieces = kept.put(_scan_pieces(docs, length, k), "bytes")
    shared = kept.put(pieces.groupBy("seed").count().filter("count > 1").select("seed"),
                      "bytes-shared")
    hits = kept.put(pieces.join(shared, "seed"), "bytes-hits")
    kept.drop("bytes", "bytes-shared")
    contexts = kept.put(
        hits.groupBy("seed", "digest").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "tag", "at")).alias("source")),
        "bytes-contexts")
    whole = hits.join(contexts.filter("n > 1").select("seed", "digest"), ["seed", "digest"]).select(
        "doc_id", "tag", F.shiftright("at", 16).alias("start"),
        (F.shiftright("at", 16) + F.col("at").bitwiseAND(255) + (length - 1)).alias("stop"))
    mixed = (contexts.groupBy("seed").agg(F.count("*").alias("m"), F.min("n").alias("least"))
             .filter("m > 1 and least = 1").select("seed", "m"))
    opened = kept.put(_contexts(docs, contexts.join(mixed, "seed").select(
        "seed", "n", "m", "source.*"), length), "bytes-opened")
    spans = whole.union(_sorted_spans(opened.filter(F.col("m") <= group), length))
    crowded = opened.filter(F.col("m") > group)
    if not crowded.isEmpty():
        each = kept.put(_strings(crowded, length), "bytes-strings")
        spans = spans.union(_counted_spans(each, length))
    out = staged(spans, "bytes-spans")
    kept.drop()
    return out


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remover(with_bytes: bool):
    """A pandas function (text, starts, stops) -> what is left without the spans."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, stops in batches:
            out = []
            for text, start, stop in zip(texts, starts, stops):
                raw = (text or "").encode("utf-8")
                kept, end, runs = [], 0, 0
                if start is not None and len(start):
                    closed = -1
                    for a, b in sorted(zip(start, stop)):
                        if a > closed:
                            runs += 1
                            kept.append(raw[end:a])
                        closed = end = max(closed, b)
                kept.append(raw[end:])
                left = b"".join(kept)
                out.append((len(raw), len(raw) - len(left), runs,
                            hashlib.sha256(left).hexdigest(), left if with_bytes else None))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256",
                                             "kept"])

    return F.pandas_udf(run, _RESULT)


def remove_repeats(docs: DataFrame, length: int = 200, k: int = 32, group: int = 50_000,
                   with_bytes: bool = False) -> DataFrame:
    """``docs`` (doc_id, text and others) with a struct column ``repeats``: ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if asked for,
    ``kept`` (the bytes left)."""
    own = {"_rep_doc": F.col("doc_id").cast("long"), "_rep_text": F.col("text").cast("string")}
    rows = row_tags(docs.drop("repeats").withColumns(own), "_rep_doc", "_rep_text", "_rep_tag")
    slim = rows.select(F.col("_rep_doc").alias("doc_id"), F.col("_rep_tag").alias("tag"),
                       F.col("_rep_text").alias("text"))
    spans = staged(repeated_spans(slim, length, k, group).groupBy(
        F.col("doc_id").alias("_at_doc"), F.col("tag").alias("_at_tag"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("_at")), "bytes-by-document")
    reach_workers(docs.sparkSession)
    return (rows.join(spans, rows["_rep_doc"].eqNullSafe(F.col("_at_doc"))
                      & (rows["_rep_tag"] == F.col("_at_tag")), "left")
                .withColumn("repeats", _remover(with_bytes)(
                    F.col("_rep_text"), F.col("_at.start"), F.col("_at.stop")))
                .drop("_rep_doc", "_rep_text", "_rep_tag", "_at_doc", "_at_tag", "_at"))
