"""The corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that
its predecessor kept, and is written and reread in between. The first four return
the columns of documents, the last the packed pieces.

Cases: a row without an id stays a row of its own (it is kept unless another row
of its near-duplicate group has an id or comes first); empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import langid, mixing, packing, simhash, substrings
from tunelake.llm.common import Scratch, read, staging
from tunelake.llm.queries import tokenizer_path

#: Words of a kept text are on average at least as clearly of one known language, each of its own.
MIN_CERTAINTY = 0.5
_USED = ("doc_id", "text", "lang", "source")


def _lean(docs: DataFrame) -> DataFrame:
    """What operators use, and the other columns out of their way in ``_rest``."""
    rest = [F.col(c) for c in docs.columns if c not in _USED]
    filler = "_" * (1 + max(map(len, docs.columns)))      # a struct needs a field; no column has this name
    return docs.select(*_USED, F.struct(*rest, F.lit(1).alias(filler)).alias("_rest"))


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``docs``."""
    return rows.select(*[F.col(c) if c in _USED else F.col("_rest")[c].alias(c)
                         for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a letter whose words known languages explain, be it one or several."""
    known = langid.identify(_lean(docs)).filter(
        (F.col("language.lang_pred") != langid.UNKNOWN)
        & (F.col("language.certainty") >= MIN_CERTAINTY))
    return _back(known, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the least id (rows without
    an id come last, then the least hash of the row; rows equal in every column are one)."""
    lean = _lean(docs)
    keys = {f"_h{i}": F.xxhash64(F.lit(i), *lean.columns) for i in (1, 2)}
    rows = lean.withColumns(keys)
    groups = simhash.near_duplicates(rows, keys=tuple(keys))
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *keys)).alias("first"))
    stay = first.select(*[F.col("first")[k].alias(k) for k in keys])
    return _back(rows.join(stay, list(keys)).dropDuplicates(list(keys)), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of passages that start in an earlier document; a text that
    loses none is left as it is."""
    rows = substrings.remove_repeats(_lean(docs), with_text=True)
    if "n_chars" in docs.columns:
        size = F.length("repeats.kept_text").cast(docs.schema["n_chars"].dataType)
        size = F.coalesce(size, F.col("_rest.n_chars"))
        rows = rows.withColumn("_rest", F.col("_rest").withField("n_chars", size))
    return _back(rows.withColumn("text", F.coalesce("repeats.kept_text", "text")), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their weights."""
    return _back(mixing.mix(_lean(docs)), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents left."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mixture),
    ("packing", sequences),
]

#: SQL has neither the language model nor XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = read(spark, sf_dir, "documents"), Scratch(spark)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with staging(spark):
            docs = kept.put(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            kept.drop(f"stage-{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
