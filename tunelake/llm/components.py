"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregations and two joins over the remaining edges; a round's
edges are written to the shared folder, so lineage stays short and lost
executors cost a re-read. The driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import Scratch, staged
from tunelake.sinks.publish import remove_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(low, "a").filter(F.col("b") > F.col("a"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b): comparable ids, a <> b. Returns (node, root): every node
    that is not the smallest of its component, with that smallest node."""
    spark, kept, n = edges.sparkSession, Scratch(edges.sparkSession), 0
    now, before = kept.put(edges.select("a", "b").distinct(), "cc-0"), None
    while True:
        mark = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                             F.expr("sum(xxhash64(a, b) % 1000003)")).first())
        if mark == before or not mark[0]:
            out = staged(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "cc")
            remove_path(spark, kept.paths[f"cc-{n}"])
            return out
        before, n = mark, n + 1
        now = kept.put(_small_star(_large_star(now)), f"cc-{n}")
        remove_path(spark, kept.paths[f"cc-{n - 1}"])
