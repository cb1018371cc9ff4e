"""Dense positions in a total order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import scratch_path

_PART, _N = "_part", "_n"


def positioned(df: DataFrame, order: Sequence[Column | str], column: str = "pos") -> DataFrame:
    """``df`` with each row's 0-based position in ``order``, as a stored table.

    Rows are range-partitioned by ``order``, sorted within partitions and
    written once below the checkpoint root with their partition and place.
    Offsets are taken from that stored table, so every later read sees the same
    positions whatever the optimiser reuses and however often the sampled
    range bounds would change. Only one small row per partition (its row
    count) meets in one task. Rows that tie in ``order`` are numbered in
    any order, once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumns({_PART: F.spark_partition_id(),
                                 _N: F.monotonically_increasing_id()})
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    parts = stored.groupBy(_PART).agg(F.count("*").alias("_c"), F.min(_N).alias("_first"))
    before = F.sum("_c").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(_PART, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_off"))
    return (stored.join(F.broadcast(offsets), _PART)
                  .withColumn(column, F.col(_N) + F.col("_off")).drop(_PART, _N, "_off"))
