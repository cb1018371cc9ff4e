"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.session import scratch_path
from tunelake.sinks.publish import remove_path

#: A word is a run of characters outside these six ASCII characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Within it, every table that operators stage for a result that is read later is noted; on leaving, the
    results must have been read or stored, and these tables are removed. Without it they stay
    (a result may be read at any time) until the scratch folder is cleared."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            remove_path(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: a
    lineage cut that survives lost executors. For what a result reads lazily; see ``staging``."""
    path = scratch_path(df.sparkSession, name)
    for paths in _scopes.get()[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables staged by one call of an operator, removed once its result is stored."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove these tables, or all; nothing may read them any more. The shuffle files
        of the steps that made them go when the driver's garbage is collected."""
        for name in names or tuple(self.paths):
            remove_path(self.spark, self.paths.pop(name))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def row_tags(rows: DataFrame, doc: str, text: str, tag: str) -> DataFrame:
    """``rows`` with a column ``tag`` such that (doc, tag) names a row up to rows with equal doc and text.

    It is 0 where an id has one text, the usual case; the texts of an id (or of no id) that has
    several are numbered once, in a stored table of their 128-bit hashes, that ``rows`` are joined to.
    """
    keys = {"_k1": F.xxhash64(F.lit(1), text), "_k2": F.xxhash64(F.lit(2), text)}
    texts = rows.select(F.col(doc).alias("_doc"), *[k.alias(n) for n, k in keys.items()]).distinct()
    several = texts.groupBy("_doc").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("_doc").alias("_many"))
    numbered = staged(texts.join(several, F.col("_doc").eqNullSafe(F.col("_many"))).drop("_many")
                      .withColumn("_number", F.monotonically_increasing_id() + 1), "row-tags")
    if numbered.isEmpty():
        return rows.withColumn(tag, F.lit(0).cast("long"))
    numbered = numbered.withColumnsRenamed({"_k1": "_n1", "_k2": "_n2"})
    same = F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("_k1") == F.col("_n1")) & (
        F.col("_k2") == F.col("_n2"))
    return (rows.withColumns(keys).join(numbered, same, "left")
            .withColumn(tag, F.coalesce("_number", F.lit(0).cast("long")))
            .drop("_k1", "_k2", "_doc", "_n1", "_n2", "_number"))


def reach_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (a
    source tree that is on a shared path, as in tests); an installed package is
    found either way."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInPandas`` with this package within reach of the workers."""
    reach_workers(df.sparkSession)
    return df.mapInPandas(run, schema)


def fan_out(df: DataFrame) -> int:
    """Partitions for a shuffle on a key that the caller deals out itself."""
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return int(n) if n.isdigit() else 200


def text_words(text: Column) -> Column:
    """The words of a text as an array (native); empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six
    ASCII characters of ``SPACE_CLASS``, ``bytes.lower`` changes A-Z only."""
    raw = (text or "").encode("utf-8")
    return (raw.lower() if lower else raw).split()


def slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to at most ``most`` (a single
    larger item gets a range of its own): bounds the memory of a batch."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
