"""Approximate nearest neighbours by cross-polytope hashing.

A table applies a fast pseudo-rotation (three rounds of random signs and a Hadamard
transform) and assigns a vector to the nearest signed axis. A query looks into the buckets of its
``probes`` nearest axes in each of ``tables`` tables; every vector found there is ranked
by its exact inner product. ``turns=2`` combines two rotations to one bucket, with ``_WIDER`` times
as many nearest pairs of axes to look into; that is the caller's choice and never made by the
size of the table.

Equal vectors are one index entry, whatever their number: each keeps its ``k`` + 1
smallest ids, which is all that a list of ``k`` can need. Buckets are dealt out in
blocks of at most about ``block`` vectors and ``block`` queries, so none meets a task
whole. Vectors of different lengths are turned into a search by angle with one more
coordinate (sqrt(M^2 - |x|^2), M the greatest norm).

Cases: vectors that are null, empty, zero, of another dimension than the commonest
(the larger on a tie), or with a null or non-finite component, and rows without an
id take no part; ties go to the smaller id; rows that repeat an id with an equal vector
count once; fewer candidates give shorter lists; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import fan_out, map_batches, staged

#: Probes with two rotations for each with one: by measured recall (README).
_WIDER = 32
_COSTS = 1 << 21     # bucket costs held at once while probing


def _rotation(x: np.ndarray, table: int, turn: int, seed: int) -> np.ndarray:
    """Rows of ``x`` (dimension a power of two) rotated; the same for every caller."""
    rng = np.random.default_rng([seed, table, turn])
    size = x.shape[1]
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], size)
        half = 1
        while half < size:
            x = x.reshape(-1, size // (2 * half), 2, half)
            x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], 2)
            half *= 2
        x = x.reshape(-1, size) / np.sqrt(size)
    return x


def _buckets(x: np.ndarray, table: int, turns: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` best buckets of each row, best first: combinations of signed axes
    with the least squared distance below the best axis, summed over the turns."""
    cost, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
    for turn in range(turns):
        y = _rotation(x, table, turn, seed)
        axes = np.concatenate([y, -y], 1)
        n = min(probes, axes.shape[1])
        best = np.argsort(-axes, axis=1, kind="stable")[:, :n]
        miss = (axes.max(1, keepdims=True) - np.take_along_axis(axes, best, 1)) ** 2
        cost = (cost[:, :, None] + miss[:, None, :]).reshape(len(x), -1)
        code = (code[:, :, None] * axes.shape[1] + best[:, None, :]).reshape(len(x), -1)
        if cost.shape[1] > probes:
            keep = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
            cost, code = np.take_along_axis(cost, keep, 1), np.take_along_axis(code, keep, 1)
        keep = np.argsort(cost, axis=1, kind="stable")
        cost, code = np.take_along_axis(cost, keep, 1), np.take_along_axis(code, keep, 1)
    return code


def probes_for(turns: int, dim: int, probes: int) -> int:
    """Buckets a query looks into in each table of ``turns`` rotations."""
    return min(probes * _WIDER ** (turns - 1), (2 * dim) ** turns)


def _hashed(rows: DataFrame, top: float, lift: bool, size: int, tables: int, turns: int,
            probes: int, seed: int, kind: str) -> DataFrame:
    """(vec_id, raw, buckets): the vector's bytes (of type ``kind``) and, table by table, ``probes``
    buckets."""
    pairs = min(probes, 2 * size) ** min(turns, 2)
    rows_at_once = max(1, min(2048, _COSTS // pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), rows_at_once):
                part = pdf.iloc[lo:lo + rows_at_once]
                x = np.stack(part["vec"].to_list()).astype(kind)
                wide = np.zeros((len(x), size))
                wide[:, :x.shape[1]] = x / top
                if lift and probes == 1:     # an index entry; a query has 0 here
                    wide[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (wide ** 2).sum(1)))
                wide /= np.sqrt((wide ** 2).sum(1, keepdims=True))
                b = np.stack([_buckets(wide, t, turns, probes, seed) for t in range(tables)], 1)
                yield pd.DataFrame({"vec_id": part["vec_id"], "raw": [v.tobytes() for v in x],
                                    "buckets": list(b.reshape(len(x), -1))})

    return map_batches(rows.select("vec_id", "vec"), run,
                       "vec_id long, raw binary, buckets array<long>")


_KINDS = {"<f4": "float", "<f8": "double"}


def _kind(vectors: DataFrame, vec_col: str) -> str:
    """Components are kept as they are: floats as floats, all other numbers as doubles."""
    return "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast(f"array<{_KINDS[_kind(vectors, vec_col)]}>").alias("vec"))
    return rows.filter("vec_id is not null and size(vec) > 0").filter(
        F.exists("vec", lambda c: c != 0) & F.forall("vec", lambda c: c.isNotNull()
                                                      & ~F.isnan(c) & (F.abs(c) != float("inf"))))


def search(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = 8, probes: int = 16,
           block: int = 4096, seed: int = 11, id_col: str = "vec_id",
           vec_col: str = "embedding", turns: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable row of ``vectors`` for which
    ``is_query`` (over ``vec_id``) holds, its ``k`` nearest other ids. ``probes`` is for
    one rotation; ``turns`` rotations (1 or 2) are combined."""
    if turns not in (1, 2):
        raise ValueError("turns must be 1 or 2")
    kind = _kind(vectors, vec_col)
    rows = usable(vectors, id_col, vec_col)
    dims = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    common = dims.first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = common["d"]
    rows = rows.filter(F.size("vec") == dim)

    # one entry for equal vectors, with the k + 1 smallest of their ids
    least = Window.partitionBy("vec").orderBy("vec_id")
    entries = staged(
        rows.groupBy("vec", "vec_id").count().drop("count")
            .withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
            .groupBy("vec").agg(F.min("vec_id").alias("vec_id"),
                                F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-entries")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, c: a + c.cast("double") * c))
    lo, top = entries.agg(F.min(norm), F.max(norm)).first()
    lift = lo < top * 0.999
    size = 1 << (dim + lift - 1).bit_length() if dim + lift > 1 else 1
    probes = probes_for(turns, size, probes)

    def placed(hashed: DataFrame, per: int) -> DataFrame:
        return hashed.select("vec_id", "raw", F.posexplode("buckets").alias("at", "bucket")).select(
            "vec_id", "raw", F.floor(F.col("at") / per).cast("int").alias("table"), "bucket")

    index = staged(_hashed(entries, top, lift, size, tables, turns, 1, seed, kind), "ann-index")
    asked = (rows.filter(is_query).select("vec_id", "vec").distinct()
             .withColumnRenamed("vec_id", "query_id"))
    query_of = staged(asked.join(entries.select("vec", "vec_id"), "vec").select("query_id", "vec_id"),
                      "ann-queries")
    wanted = entries.join(query_of.select("vec_id").distinct(), "vec_id", "left_semi")
    probing = staged(_hashed(wanted, top, lift, size, tables, turns, probes, seed, kind), "ann-probes")
    by = ["table", "bucket"]
    stored, sent = placed(index, 1), placed(probing, probes)
    blocks = staged(stored.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("ni"))
                    .join(sent.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("nq")),
                          by), "ann-blocks")

    def dealt(side: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        cell = F.concat_ws(":", *by, "ni_i", "nq_i")
        return (side.join(blocks, by)
                .withColumn(f"{own}_i", F.pmod(F.xxhash64("vec_id"), own))
                .withColumn(f"{other}_i", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select(cell.alias("cell"), F.lit(asks).alias("asks"), "vec_id", "raw"))

    def rank(x_id: np.ndarray, x: np.ndarray, q_id: np.ndarray, q: np.ndarray) -> pd.DataFrame:
        order = np.argsort(x_id)
        x, x_id = x[order], x_id[order]
        most = min(k + 1, len(x))
        parts = []
        for s in range(0, len(q), 512):
            rough = q[s:s + 512] @ x.T
            best = np.argsort(-rough, axis=1, kind="stable")[:, :most]
            exact = (q[s:s + 512, None, :] * x[best]).sum(2)
            parts.append((np.repeat(q_id[s:s + 512], most), x_id[best].ravel(), exact.ravel()))
        return pd.DataFrame(dict(zip(("q", "c", "score"), map(np.concatenate, zip(*parts)))))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by cell: a cell is ranked once the next one begins, so a
        task holds one cell and one batch."""
        def ranked(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            key = rows["cell"].to_numpy()
            cut = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(rows)]
            asks, ids = rows["asks"].to_numpy(bool), rows["vec_id"].to_numpy()
            x = np.frombuffer(b"".join(rows["raw"]), kind).reshape(-1, dim).astype(np.float64)
            for lo, hi in zip(cut, cut[1:]):
                ask = asks[lo:hi]
                if ask.any() and not ask.all():
                    yield rank(ids[lo:hi][~ask], x[lo:hi][~ask], ids[lo:hi][ask], x[lo:hi][ask])

        rest = None
        for pdf in batches:
            rows = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            open_at = int((rows["cell"].to_numpy() != rows["cell"].iloc[-1]).sum()) if len(rows) else 0
            if open_at:
                yield from ranked(rows.iloc[:open_at])
            rest = rows.iloc[open_at:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from ranked(rest)

    both = dealt(stored, "ni", "nq", False).union(dealt(sent, "nq", "ni", True))
    pairs = map_batches(both.repartition(fan_out(vectors), "cell").sortWithinPartitions("cell"),
                        cells, "q long, c long, score double")
    near = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    lists = (pairs.groupBy("q", "c").agg(F.max("score").alias("score"))
             .withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
             .join(entries.select(F.col("vec_id").alias("c"), "ids"), "c")
             .groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("found")))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (query_of.withColumnRenamed("vec_id", "q").join(lists, "q")
            .select("query_id", F.explode("found").alias("f"))
            .select("query_id", F.col("f.score").alias("score"), F.explode("f.ids").alias("vec_id"))
            .filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
