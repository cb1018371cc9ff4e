"""Hard negatives by an inverted multi-index.

Two codebooks, one for each half of a vector, are fitted on a bounded sample; every row lies in the
cell of its nearest codeword pair. A codeword's radius is the greatest distance of any
row's half to it, over all rows. An anchor's inner product with a row of a cell is at
most the sum of two half bounds: the anchor's half times the codeword, plus the half's
length times the radius (and at least the same with the radius taken away).

Each anchor visits cells in descending order of that sum: a multi-sequence heap over the two
sorted lists of half bounds. The first visit takes cells until they hold ``first`` rows; its k-th best
score is a floor, and the second visit takes every further cell whose bound reaches the
floor, until the heap's next sum is below it: then no cell left can hold a better row, and the list is
certified. This runs for the positives (best rows of the same label), whose scores
give the windows, and then for the negatives, where a cell also counts only if
it can hold scores inside the anchor's windows.

Cells are dealt out in blocks of at most about ``block`` rows and anchors, so a cell of any size
(a third of all rows may be one vector) never meets a task whole; a block returns at
most as many rows an anchor as its lists need. Vectors reach a cell once, anchors once for each
cell they visit. How many that is depends on the data: vectors spread evenly in many
dimensions leave most bounds above every floor, and then nearly all cells are visited.

Cases: rows with a null id or label, or a vector that is null, empty, of another dimension than the
commonest (the larger on a tie), or with a null, non-finite or too large component
(floor(scale * x) beyond 2^31 / dimension) take no part; rows that repeat an id or a vector are
rows of their own, only an anchor's own row is not its candidate; ties go to the smaller
id; fewer rows give shorter lists, no positive gives no rows; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import Scratch, fan_out, map_batches, staged

_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")


def usable(vectors: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """(row, id, label, vec) of the rows that take part, components scaled and floored, and their
    dimension (0: no row)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("raw")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("raw") > 0)
        & F.forall("raw", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    common = (rows.groupBy(F.size("raw").alias("d")).count()
              .orderBy(F.desc("count"), F.desc("d")).first())
    if common is None:
        return rows, 0
    most = (1 << 31) // common["d"]
    fits = F.forall("raw", lambda c: F.abs(c) < most / scale)
    return (rows.filter((F.size("raw") == common["d"]) & fits)
            .select(F.monotonically_increasing_id().alias("row"), "id", "label",
                    F.transform("raw", lambda c: F.floor(c * scale)).alias("vec")), common["d"])


def codebook(halves: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """``size`` codewords of the rows of ``halves`` by Lloyd's rounds (fewer rows: the rows)."""
    words = np.unique(halves, axis=0)
    words = words[np.random.default_rng(7).permutation(len(words))[:size]].astype(np.float64)
    for _ in range(rounds):
        near = nearest(halves, words)
        count = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, halves)
        words[count > 0] = total[count > 0] / count[count > 0, None]
    return words


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words ** 2).sum(1) - 2 * (x @ words.T)).argmin(1)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :x.shape[1] // 2], x[:, x.shape[1] // 2:]


def _indexed(rows: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``rows`` with raw (the components as bytes), the cell (i, j) and both distances."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["vec"].to_list()).astype(np.float64)
            out = pdf[["row", "id", "label"]].copy()
            out["raw"] = [v.tobytes() for v in x.astype("<i4")]
            for half, words, code, away in zip(_halves(x), books, "ij", "rs"):
                out[code] = at = nearest(half, words)
                out[away] = np.sqrt(((half - words[at]) ** 2).sum(1))
            yield out

    return map_batches(rows, run, "row long, id long, label long, raw binary, i int, r double, "
                                  "j int, s double")


def multi_sequence(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) over all pairs of two lists by descending sum, from a heap of the pairs
    next to those given."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap = [(-(left[a[0]] + right[b[0]]), 0, 0)] if len(a) and len(b) else []
    while heap:
        total, x, y = heapq.heappop(heap)
        yield -total, int(a[x]), int(b[y])
        if y + 1 < len(b):
            heapq.heappush(heap, (-(left[a[x]] + right[b[y + 1]]), x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (-(left[a[x + 1]] + right[b[0]]), x + 1, 0))


class Index:
    """Codebooks, radii and cell sizes: bounded by the number of codewords."""

    def __init__(self, books, radii, sizes: np.ndarray):
        self.books, self.radii, self.sizes = books, radii, sizes

    def bounds(self, anchor: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Highest and lowest products with the rows of each codeword, for both halves.
        A little slack covers rounding; scores are whole numbers."""
        high, low = [], []
        for half, words, radius in zip(_halves(anchor[None]), self.books, self.radii):
            middle, reach = words @ half[0], np.sqrt((half ** 2).sum()) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            high.append(middle + reach + slack)
            low.append(middle - reach - slack)
        return high, low

    def visit(self, anchor: np.ndarray, floor: float, roof: float, rows: int | None,
              skip: set) -> list[tuple[int, int]]:
        """The cells to visit, best first: all whose bound reaches ``floor`` and whose scores may
        lie below ``roof``, or, with ``rows``, the first that hold so many rows."""
        (a, b), (c, d) = self.bounds(anchor)
        out, held = [], 0
        for high, i, j in multi_sequence(a, b):
            if high < floor or rows is not None and held >= rows:
                break
            if self.sizes[i, j] and c[i] + d[j] <= roof and (i, j) not in skip:
                out.append((i, j))
                held += int(self.sizes[i, j])
        return out


def _asked(anchors: DataFrame, index: Index, rows: int | None) -> DataFrame:
    """(row, cell): the cells each of ``anchors`` (row, raw, floor, roof, seen) visits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = index.sizes.shape[1]
        for pdf in batches:
            out = []
            for row, raw, floor, roof, seen in zip(*(pdf[c] for c in ("row", "raw", "floor", "roof", "seen"))):
                x = np.frombuffer(raw, "<i4").astype(np.float64)
                skip = {divmod(int(c), width) for c in seen}
                floor = -np.inf if np.isnan(floor) else floor
                out += [(row, i * width + j) for i, j in index.visit(x, floor, roof, rows, skip)]
            yield pd.DataFrame(out, columns=["row", "cell"], dtype="int64")

    return map_batches(anchors.select("row", "raw", F.col("floor").cast("double").alias("floor"),
                                      F.col("roof").cast("double").alias("roof"), "seen"),
                       run, "row long, cell long")


def first_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, best first."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        among = np.flatnonzero(score >= least)
        return among[np.lexsort((ids[among], -score[among]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _scored(rows: DataFrame, anchors: DataFrame, asked: DataFrame, positive: bool, k: int, block: int,
            kept: Scratch, name: str) -> DataFrame:
    """(anchor, id, score): for every visited cell block, each anchor's ``k`` best rows of its own
    label, or of other labels below each of its windows' upper ends."""
    stored = rows.select("cell", "row", "id", "label", "raw", F.lit(None).cast("array<long>").alias("tops"))
    sent = asked.join(anchors.select("row", "id", "label", "raw", "tops"), "row").select(*stored.columns)
    sizes = kept.put(
        stored.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("nx"))
        .join(asked.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("nq")), "cell"),
        f"{name}-blocks")

    def dealt(side: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        return (side.join(sizes, "cell").withColumn(f"{own}_i", F.pmod(F.xxhash64("row"), own))
                .withColumn(f"{other}_i", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select(F.concat_ws(":", "cell", "nx_i", "nq_i").alias("cell"), F.lit(asks).alias("asks"),
                        "row", "id", "label", "raw", "tops"))

    def best(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        asks = part["asks"].to_numpy(bool)
        if asks.all() or not asks.any():
            return
        x, q = part[~asks], part[asks]
        ids, rows_, labels = (x[c].to_numpy() for c in ("id", "row", "label"))
        vx, vq = (np.frombuffer(b"".join(s["raw"]), "<i4").reshape(len(s), -1).astype(np.float64)
                  for s in (x, q))
        exact = np.abs(vx).max() * np.abs(vq).max() * vx.shape[1] < 2 ** 53
        if not exact:
            vx, vq = vx.astype(np.int64), vq.astype(np.int64)
        for lo in range(0, len(q), 256):
            score = (vq[lo:lo + 256] @ vx.T).astype(np.int64)
            found: list[tuple] = []
            for n, (row, label, tops) in enumerate(zip(q["row"][lo:lo + 256], q["label"][lo:lo + 256],
                                                       q["tops"][lo:lo + 256])):
                if positive:
                    at = np.flatnonzero((labels == label) & (rows_ != row))
                    at = at[first_of(score[n, at], ids[at], k)]
                else:
                    other, mine = np.flatnonzero(labels != label), []
                    for top in sorted(set(tops)):
                        under = other[score[n, other] <= top]
                        mine.append(under[first_of(score[n, under], ids[under], k)])
                    at = np.unique(np.concatenate(mine)) if mine else other[:0]
                found.append((np.full(len(at), row), rows_[at], ids[at], score[n, at]))
            yield pd.DataFrame(dict(zip(("anchor", "row", "id", "score"),
                                        map(np.concatenate, zip(*found)))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            now = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            cell = now["cell"].to_numpy()
            cut = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()]
            for lo, hi in zip(cut, cut[1:]):
                yield from best(now.iloc[lo:hi])
            rest = now.iloc[cut[-1]:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from best(rest)

    both = dealt(stored, "nx", "nq", False).union(dealt(sent, "nq", "nx", True))
    cells = both.repartition(fan_out(rows), "cell").sortWithinPartitions("cell")
    return map_batches(cells, run, "anchor long, row long, id long, score long")


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    near = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 10, low: int = 30,
         high: int = 90, scale: int = 256, sample: int = 8192, per_cell: int = 1024,
         most_words: int = 256, first: int = 2048, block: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of
    ``vectors`` (vec_id, label, embedding) for which ``is_anchor`` (over ``id``) holds, its ``positives``
    best other rows of its label, and for each of these the first ``k`` rows of other labels whose
    score is between ``low`` and ``high`` percent (0 <= low <= high) of the positive's.

    The codebooks are fitted on at most about ``sample`` rows, chosen by hash; every row is indexed.
    A codebook has sqrt(rows / ``per_cell``) words, at most ``most_words``."""
    spark, kept = vectors.sparkSession, Scratch(vectors.sparkSession)
    rows, dim = usable(vectors, scale)
    if not dim:
        return spark.createDataFrame([], _RESULT)
    rows = kept.put(rows, "mine-rows")
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    chosen = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < int(share * (1 << 40))).select("vec")
    fit = np.array([r.vec for r in chosen.limit(2 * sample).collect()], np.float64).reshape(-1, dim)
    words = max(1, min(most_words, round((n / per_cell) ** 0.5)))
    books = tuple(codebook(h, words) if h.shape[1] and len(h) else np.zeros((1, h.shape[1]))
                  for h in _halves(fit))
    width = len(books[1])
    placed = kept.put(_indexed(rows, books).withColumn(
        "cell", (F.col("i") * width + F.col("j")).cast("long")), "mine-index")
    kept.drop("mine-rows")
    sizes, radii = np.zeros((len(books[0]), width), np.int64), [np.zeros(len(b)) for b in books]
    for c in placed.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("r").alias("r"),
                                          F.max("s").alias("s")).collect():
        sizes[c.i, c.j] = c.n                          # at most most_words^2 rows
        radii[0][c.i] = max(radii[0][c.i], c.r)
        radii[1][c.j] = max(radii[1][c.j], c.s)
    index = Index(books, radii, sizes)
    everything = placed.select("cell", "row", "id", "label", "raw")
    anchors = kept.put(placed.filter(is_anchor).select("row", "id", "label", "raw"), "mine-anchors")
    none = F.array().cast("array<long>")

    def lists(asking: DataFrame, positive: bool, count: int, name: str, merge) -> DataFrame:
        """``merge`` of all rows found on both visits; the second asks what the first's floor leaves open."""
        asked = kept.put(_asked(asking.withColumns({"floor": F.col("least").cast("double"), "seen": none}),
                                index, first), f"{name}-cells-1")
        got = kept.put(_scored(everything, asking, asked, positive, count, block, kept, f"{name}-1"),
                       f"{name}-found-1")
        floor = merge(got).groupBy("anchor").agg(F.max("floor").alias("floor"))
        seen = asked.groupBy("row").agg(F.collect_list("cell").alias("seen"))
        again = (asking.join(floor.withColumnRenamed("anchor", "row"), "row", "left").join(seen, "row", "left")
                 .withColumns({"floor": F.greatest("floor", "least"), "seen": F.coalesce("seen", none)}))
        more = kept.put(_asked(again, index, None), f"{name}-cells-2")
        also = kept.put(_scored(everything, asking, more, positive, count, block, kept, f"{name}-2"),
                        f"{name}-found-2")
        return merge(got.union(also))

    def best_positives(found: DataFrame) -> DataFrame:
        top = _top(found, ["anchor"], positives)
        return top.withColumn("floor", F.when(F.col("rank") == positives, F.col("score")))

    asking = anchors.withColumns({"least": F.lit(None).cast("long"), "roof": F.lit(float("inf")), "tops": none})
    near = kept.put(lists(asking, True, positives, "mine-positives", best_positives)
                    .select("anchor", F.col("row").alias("p_row"), F.col("id").alias("positive_id"),
                            F.col("score").alias("positive_score"), "rank"), "mine-near")
    # whole scores s with low * p <= 100 * s <= high * p; there are none for a negative p
    windows = kept.put(near.drop("rank").filter("positive_score >= 0").withColumns({
        "bottom": F.expr(f"({low} * positive_score + 99) div 100"),
        "top": F.expr(f"({high} * positive_score) div 100")}).filter("bottom <= top"), "mine-windows")
    ends = windows.groupBy(F.col("anchor").alias("row")).agg(
        F.min("bottom").alias("least"), F.max("top").cast("double").alias("roof"),
        F.collect_set("top").alias("tops"))
    asking = kept.put(anchors.join(ends, "row"), "mine-asking")

    def best_negatives(found: DataFrame) -> DataFrame:
        inside = (windows.join(found, "anchor").filter("score between bottom and top"))
        top = _top(inside, ["anchor", "p_row"], k)
        # an anchor's floor: the lowest that one of its windows still needs
        need = top.groupBy("anchor", "p_row").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("s"))
        need = windows.join(need, ["anchor", "p_row"], "left").groupBy("anchor").agg(
            F.min(F.coalesce("s", "bottom")).alias("floor"))
        return top.join(need, "anchor")

    found = lists(asking, False, k, "mine-negatives", best_negatives)
    out = staged(found.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
                 .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score")), "mine-result")
    kept.drop()
    return out
