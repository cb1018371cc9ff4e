"""Per-group feature means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
            prefix: str = "avg_", digits: int | None = None) -> DataFrame:
    """``avg`` of each column per group, named ``<prefix><col>``.

    ``avg`` keeps a (sum, count) buffer, so the map-side partial aggregate
    shrinks each task's rows to one per key before the shuffle. ``digits``
    rounds the result (used where two engines must print the same number).
    """
    aggs = []
    for c in cols:
        m = F.avg(c)
        if digits is not None:
            m = F.round(m, digits)
        aggs.append(m.alias(f"{prefix}{c}"))
    return df.groupBy(*keys).agg(*aggs)
