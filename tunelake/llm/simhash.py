"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into segments. Two fingerprints within ``distance``
bits agree, in some segment, up to a radius fixed by the pigeonhole principle;
so each one looks up the Hamming ball of its segments in tables of the others'
segments, and every match is verified on all 64 bits. Links run between distinct
fingerprints: copies meet in one row first, so a group of copies of any size costs
one fingerprint. A bucket with more than ``block`` fingerprints is dealt out in
blocks, and a pair of blocks returns a spanning forest of its links instead of
all of them: components stay exact, no task holds a whole bucket.

Cases: a null or empty text has fingerprint zero and links like any other;
repeated rows get a row each; a null doc_id never names a component (null if no
member has an id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import byte_words, map_batches, staged
from tunelake.llm.components import components

BITS = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half of the shingles' XXH64 (seed 42), as a signed long."""
    import xxhash
    words = byte_words(text, lower=True)
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return int(np.uint64(digest(joined, 42)).astype(np.int64))
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][shingle - 1:]
    votes, n = np.zeros(BITS, np.int64), len(ends)
    for lo in range(0, n, 1 << 15):
        h = np.array([digest(joined[a:b], 42) for a, b in
                      zip(starts[lo:min(n, lo + (1 << 15))], ends[lo:lo + (1 << 15)])], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys..., fp long) of each row; ``keys`` are long columns of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[list(keys)].astype("Int64")
            out["fp"] = np.array([fingerprint(t, shingle) for t in pdf["text"]], np.int64)
            yield out

    schema = ", ".join(f"{k} long" for k in keys) + ", fp long"
    rows = docs.select(*[F.col(k).cast("long").alias(k) for k in keys],
                       F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, schema)


def segment_plan(distance: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """(shift, width, masks) of each segment that must be searched.

    With distance = segments * r + a, it is enough to search a + 1 segments to
    radius r and the others to radius r - 1 (none below zero).
    """
    r, a = divmod(distance, segments)
    plan, shift = [], 0
    for j in range(segments):
        width = (BITS - shift) // (segments - j)
        radius = r if j <= a else r - 1
        masks = [sum(1 << b for b in bits) for k in range(radius + 1)
                 for bits in combinations(range(width), k)]
        if masks:
            plan.append((shift, width, masks))
        shift += width
    return plan


def _hot_links(table: DataFrame, probes: DataFrame, distance: int, block: int) -> DataFrame:
    """Links of large buckets: (key, block of table, block of probes) groups of
    about ``block`` rows a side; each returns a spanning forest of its links."""
    sizes = probes.join(table.select("key", "n").distinct(), "key").groupBy("key").agg(
        F.first("n").alias("n"), F.count("*").alias("np"))
    sizes = staged(sizes.select("key", F.ceil(F.col("n") / block).cast("int").alias("tb"),
                                F.ceil(F.col("np") / block).cast("int").alias("pb")), "mih-hot")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return (rows.select("key", "fp").join(sizes, "key")
                .withColumn(f"i_{own}", F.pmod(F.xxhash64("fp"), own).cast("int"))
                .withColumn(f"i_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("key", "i_tb", "i_pb", "fp"))

    def forest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        t, p = (np.ascontiguousarray(x["fp"].to_numpy(np.int64)) for x in (left, right))
        out, free_t, free_p = [], np.ones(len(t), bool), np.ones(len(p), bool)
        if len(t) and len(p):
            apart = t.view(np.uint64)[:, None] ^ p.view(np.uint64)[None, :]
            near = np.bitwise_count(apart) <= distance
            for seed in range(len(t)):
                wave = [seed] if free_t[seed] else []
                free_t[seed] = False
                while len(wave):
                    hit = near[wave] & free_p
                    new_p = np.flatnonzero(hit.any(0))
                    out += zip(t[np.asarray(wave)[hit[:, new_p].argmax(0)]], p[new_p])
                    free_p[new_p] = False
                    hit = near[:, new_p] & free_t[:, None]
                    wave = np.flatnonzero(hit.any(1))
                    if len(wave):
                        out += zip(t[wave], p[new_p[hit[wave].argmax(1)]])
                        free_t[wave] = False
        return pd.DataFrame([(a, b) for a, b in out if a != b], columns=["a", "b"], dtype="int64")

    by = ["key", "i_tb", "i_pb"]
    return (dealt(table, "tb", "pb").groupBy(*by)
            .cogroup(dealt(probes, "pb", "tb").groupBy(*by))
            .applyInPandas(forest, "a long, b long"))


def links(fps: DataFrame, distance: int, segments: int = 3, block: int = 1024) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps`` (fp) that give the
    same components as all pairs within ``distance`` bits; outside large buckets
    they are all those pairs."""
    plan = segment_plan(distance, segments)

    def entries(masked: bool) -> DataFrame:
        at = [F.struct(F.lit(j << 40).cast("long").alias("tag"), F.lit(shift).alias("shift"),
                       F.lit((1 << width) - 1).cast("long").alias("width"),
                       F.lit(m).cast("long").alias("mask"))
              for j, (shift, width, masks) in enumerate(plan) for m in (masks if masked else [0])]
        return (fps.select("fp", F.explode(F.array(*at)).alias("e"))
                   .select("fp", F.expr("e.tag | ((shiftrightunsigned(fp, e.shift) & e.width) ^ e.mask)")
                           .alias("key")))

    table = entries(False).withColumn("n", F.count("*").over(Window.partitionBy("key")))
    probes = entries(True)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = (table.filter(F.col("n") <= block).select("key", F.col("fp").alias("a"))
             # by sorting: an exploded side is larger than its file's size tells
             .join(probes.select("key", F.col("fp").alias("b")).hint("merge"), "key")
             .filter((F.col("a") < F.col("b")) & near).select("a", "b"))
    hot = staged(table.filter(F.col("n") > block), "mih-table")
    if not hot.isEmpty():
        hot_probes = staged(probes.join(hot.select("key").distinct(), "key", "left_semi"),
                            "mih-probes")
        pairs = pairs.union(_hot_links(hot, hot_probes, distance, block))
    return pairs


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = 3,
                    keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs`` (keys, doc_id, text): the keys, ``fingerprint``
    (16 hex digits), ``component_id`` (smallest doc_id reachable over links of at
    most ``distance`` bits) and ``root`` (the component's own key, never null).

    ``segments`` trades probes for bucket size: 3 suits up to some 10^8 distinct
    fingerprints, 2 more than that; the result is the same.
    """
    keys = tuple(dict.fromkeys((*keys, "doc_id")))
    rows = staged(fingerprints(docs, shingle, keys), "simhash")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), distance, segments))
    of = (nodes.join(roots, F.col("fp") == F.col("node"), "left")
               .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    named = of.join(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    return rows.join(named.select("fp", "root", "component_id"), "fp").select(
        *keys, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")
