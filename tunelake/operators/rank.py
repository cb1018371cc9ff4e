"""Top-n rows per partition of an aggregate.

The winner order is total: measure descending (nulls last), then the remaining
group keys ascending (nulls first). Reruns and repartitions therefore return
the same rows, which the reference's ``row_number`` on the measure alone does
not guarantee.

Physical plan (checked with ``explain``): partial ``HashAggregate`` ->
``Exchange`` on the group keys -> final ``HashAggregate`` -> partial
``WindowGroupLimit`` (n rows per partition key and map task) -> ``Exchange`` on
the partition key -> final ``WindowGroupLimit`` -> ``Window``. Both shuffles
carry pre-reduced data: a hot key (a third of all rows) is collapsed by the
map-side aggregate, and the second exchange moves at most
``n x tasks`` rows per partition key, so no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import shuffle_partitions

_RANK = "_rank"
_SALT = "_salt"
_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def ranking_order(measure: str, tie_keys: Sequence[str]) -> list[Column]:
    return [F.col(measure).desc_nulls_last()] + [F.col(k).asc_nulls_first() for k in tie_keys]


def _first_n(df: DataFrame, partition: Sequence[Column | str], order: list[Column],
             n: int) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) <= n).drop(_RANK)


def top_n(df: DataFrame, partition: Sequence[str], measure: str,
          tie_keys: Sequence[str], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows of every ``partition`` group (W1 + F6 + P5).

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (default 1000)
    Catalyst adds a partial per-task limit before the shuffle. Above it, the
    rows of a partition are first cut to ``n`` within each of ``S`` hash
    buckets of the tie keys (``S`` = shuffle partitions), then to ``n``
    overall: exact, because the order is total and every member of the
    overall top ``n`` is in the top ``n`` of its bucket; a hot partition key
    is spread over ``S`` tasks and the second step sees at most ``n x S`` rows.
    """
    order = ranking_order(measure, tie_keys)
    spark = df.sparkSession
    limit = int(spark.conf.get(_LIMIT_CONF, "1000"))
    if n > limit and not tie_keys:
        raise ValueError(f"n > {limit} needs tie keys: without a total order the rows of a "
                         "partition cannot be cut bucket by bucket")
    if n <= limit:
        return _first_n(df, partition, order, n)
    buckets = shuffle_partitions(spark)
    salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*tie_keys), F.lit(buckets)))
    per_bucket = _first_n(salted, [*partition, _SALT], order, n).drop(_SALT)
    return _first_n(per_bucket, partition, order, n)


def sum_by(df: DataFrame, keys: Sequence[str], value: str,
           name: str = "total_streams") -> DataFrame:
    """A1-A4: ``sum(value)`` per group; null keys form their own group.

    ``sum`` (not ``try_sum``) so that a long overflow fails the job loudly.
    """
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def top_n_per_group(df: DataFrame, keys: Sequence[str], partition: Sequence[str],
                    value: str = "streams", n: int = 1,
                    name: str = "total_streams") -> DataFrame:
    """O1: sum ``value`` per ``keys``, keep the best ``n`` groups per ``partition``.

    ``partition`` must be a subset of ``keys``; the other keys break ties.
    """
    missing = [p for p in partition if p not in keys]
    if missing:
        raise ValueError(f"partition columns {missing} are not group keys")
    ties = [k for k in keys if k not in partition]
    totals = sum_by(df, keys, value, name)
    return top_n(totals, partition, name, ties, n).select(*keys, name)
