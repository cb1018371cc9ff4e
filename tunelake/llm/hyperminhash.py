"""Near-duplicates by HyperMinHash: compressed registers, banded, estimated, verified.

A document's set is its distinct word shingles. The shingles' hashes are dealt out to
``bands * width`` buckets, and a bucket keeps only its least value, as a 16-bit register: the
number of leading zeros and ten mantissa bits. An empty bucket takes over the register
of the first filled bucket in an order of its own, so registers of two sets agree with the
sets' Jaccard similarity, however small the sets are. ``width`` registers make a band; sets
that agree in a band are candidates. A candidate pair is estimated from all
registers, corrected for registers that agree by chance, and pairs not clearly below the
threshold are verified on their full sets.

Equal sets meet in one row first, so copies cost one set. Within a band's bucket pairs
are not listed: every member is compared with one centre, links join members to
components, and only buckets that still hold several components are looked at again, first
with other centres, then for all pairs across components, in blocks of ``block`` members. So
every pair that shares a band is either compared or already in one component. That last
step compares inside the task, first registers, then samples (the ``sample`` least hashes of a
set: the whole set if it has no more), each pair in the first band that it shares, and
returns only pairs whose samples agree; they are verified like the others.

Chances, for a pair just at a similarity of 0.8: to share no band (1 - 0.8^5)^40 = 1.2e-7; to be
estimated ``margin`` = 5 standard errors too low 3e-7, by registers and, for larger sets, by samples.
Links are never wrong.

Cases: a null or empty text, or one without words, has the empty set and links with
nothing (its component is itself); with fewer words than a shingle the whole sequence is the
one shingle; rows that repeat a text or a doc_id are rows of their own; a null doc_id never
names a component (null if no member has an id); texts of any length are taken whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import Scratch, fan_out, map_batches, mix64, reach_workers, staged
from tunelake.llm.components import components

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MANTISSA, _VALUE = 10, 53      # bits: of a register's mantissa, of a value
_ROWS = "row long, doc_id long, n long, digest binary, sketch binary, text string"


def shingles(raw: bytes | None, size: int) -> np.ndarray:
    """The distinct shingles of a UTF-8 text as ascending 64-bit hashes."""
    import xxhash
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        out = mix64(out * _ODD + h[j:len(h) - size + 1 + j])
    return np.unique(out)


def register(value: np.ndarray) -> np.ndarray:
    """The leading zeros and the mantissa of the upper 53 bits of 64-bit values."""
    top = value >> np.uint64(64 - _VALUE)
    zeros = _VALUE - np.frexp(top.astype(np.float64))[1]
    mantissa = (top << zeros.astype(np.uint64)) >> np.uint64(_VALUE - 1 - _MANTISSA)
    low = mantissa & np.uint64((1 << _MANTISSA) - 1)
    return (zeros.astype(np.uint16) << _MANTISSA) | low.astype(np.uint16)


def donors(registers: int) -> np.ndarray:
    """Row i: the order in which bucket i, if empty, looks for a filled one."""
    return np.random.default_rng(registers).random((registers, registers)).argsort(1).astype(np.int16)


def sketch(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The registers of a non-empty ascending set."""
    k = len(order)
    bucket = ((values >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    at = bucket[start].astype(np.int64)
    out, filled = np.zeros(k, np.uint16), np.zeros(k, bool)
    out[at] = register(np.minimum.reduceat(mix64(values ^ _ODD), start))
    filled[at] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        out[empty] = out[order[empty, filled[order[empty]].argmax(1)]]
    return out


def chance(n: np.ndarray, m: np.ndarray, registers: int) -> np.ndarray:
    """How often the registers of two unrelated sets of ``n`` and ``m`` elements agree."""
    zeros = np.arange(_VALUE)
    edge = 0.5 ** zeros[:, None]
    a, b = np.maximum(n, registers) / registers, np.maximum(m, registers) / registers

    def share(x):       # of values with just so many leading zeros, the least of x values
        return (1 - edge / 2) ** x - np.where(zeros[:, None] > 0, (1 - edge) ** x, 0)

    return (share(a) * share(b)).sum(0) / (1 << _MANTISSA)


def similarity(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sets from their registers (rows) and sizes."""
    by_chance = chance(n, m, x.shape[1])
    return ((x == y).mean(1) - by_chance) / (1 - by_chance)


def _scan(docs: DataFrame, shingle: int, registers: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        order = donors(registers)
        for batch in batches:
            n, digest, marks = [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(raw, shingle)
                n.append(len(found))
                digest.append(xxhash.xxh3_128_digest(found) if len(found) else None)
                marks.append(sketch(found, order).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), pa.array(marks, pa.binary()), batch.column("text")],
                names=["row", "doc_id", "n", "digest", "sketch", "text"])

    reach_workers(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _ROWS)


#: Words of 64 bits in the bitmap of wanted rows: the bound of what ``_sieved`` broadcasts.
_WORDS = 1 << 18


def _sieved(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``table`` without most of the rows whose ``key`` is not among ``wanted`` (node): those whose bit is not
    set in a bitmap of at most ``_WORDS`` rows. So a join that follows shuffles little more than it keeps;
    with very many wanted rows the bitmap fills up and lets more pass."""
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(_WORDS * 64))

    bits = wanted.select(place("node").alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_at & 63 as int)))").alias("_bits"))
    keyed = table.withColumn("_at", place(key)).withColumn("_word", F.shiftright("_at", 6))
    return (keyed.join(F.broadcast(bits), "_word")
            .filter("(shiftrightunsigned(_bits, cast(_at & 63 as int)) & 1) = 1")
            .drop("_word", "_bits", "_at"))


def _near_size(n, m, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


class _Search:
    """Candidates, estimates and verified links between the distinct sets of one call."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, shingle: int, percent: int, bands: int,
                 width: int, margin: float, block: int, sample: int, kept: Scratch):
        self.rows, self.nodes, self.kept, self.block, self.sample = rows, nodes, kept, block, sample
        self.shingle, self.percent, self.width, self.registers = shingle, percent, width, bands * width
        share = percent / 100
        self.least, self.least_sampled = (share - margin * (share * (1 - share) / k) ** 0.5
                                          for k in (self.registers, sample))
        # different sets: of n elements at least percent * n / 100 are shared, and not all
        small = F.col("n") * (100 - percent) < percent
        keys = [F.xxhash64(F.lit(j), F.substring("sketch", 1 + 2 * width * j, 2 * width))
                for j in range(bands)]
        each = nodes.filter(~small).select("node", "n", F.posexplode(F.array(*keys)).alias("band", "key"))
        shared = each.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
        self.members = kept.put(each.join(shared, "key"), "hmh-members")

    def _centred(self, members: DataFrame, turn: int) -> DataFrame:
        """(a, b): each member of a bucket with the bucket's centre."""
        rank = F.col("node") if turn == 0 else F.xxhash64(F.lit(turn), "key", "node")
        centre = members.groupBy("key").agg(F.min(F.struct(rank.alias("r"), "node", "n")).alias("c"))
        return (members.join(centre, "key").filter(F.col("node") != F.col("c.node"))
                .filter(_near_size(F.col("n"), F.col("c.n"), self.percent))
                .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"))
                .distinct())

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        registers = self.registers

        @F.pandas_udf("double")
        def estimate(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
            a, b = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, registers) for s in (x, y))
            return pd.Series(similarity(a, b, n.to_numpy(), m.to_numpy()))

        def side(name):
            mine = _sieved(self.nodes.select("node", "n", "sketch"), "node",
                           pairs.select(F.col(name).alias("node")))
            return mine.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                               F.col("sketch").alias(f"s_{name}"))

        reach_workers(self.rows.sparkSession)
        pairs = self.kept.put(pairs, "hmh-centred")
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        return both.filter(estimate("s_a", "s_b", "n_a", "n_b") >= self.least).select("a", "b")

    def _sets(self, wanted: DataFrame, most: int | None = None) -> DataFrame:
        """(node, elements): the sets of ``wanted`` (node), or their ``most`` least elements."""
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raws = batch.column("text").cast(pa.binary())
                for i in range(len(raws)):
                    found = shingles(raws[i].as_py(), shingle)[:most].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("node").slice(i, 1),
                         pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))],
                        names=["node", "elements"])

        wanted = wanted.distinct()
        # an inner join: Spark would move a semi join before the sieve
        texts = _sieved(self.rows.select(F.col("row").alias("node"), "text"), "node", wanted).join(
            wanted, "node")
        return texts.mapInArrow(run, "node long, elements array<long>")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b): the pairs whose full sets are similar enough."""
        pairs = self.kept.put(pairs, "hmh-pairs")
        sets = self.kept.put(self._sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b"))),
                             "hmh-sets")
        a, b = (sets.select(F.col("node").alias(x), F.col("elements").alias(f"e_{x}")) for x in "ab")
        common = F.size(F.array_intersect("e_a", "e_b"))
        linked = common * 100 >= (F.size("e_a") + F.size("e_b") - common) * self.percent
        links = staged(pairs.join(a, "a").join(b, "b").filter(linked).select("a", "b"), "hmh-links")
        self.kept.drop(*[x for x in ("hmh-centred", "hmh-pairs", "hmh-sets") if x in self.kept.paths])
        return links

    def _open(self, roots: DataFrame) -> DataFrame:
        """Members, with their roots, of the buckets that hold several components (a bucket
        of two has been compared)."""
        named = (self.members.filter("m > 2").join(roots, "node", "left")
                 .select("band", "key", "node", "n", "m", F.coalesce("root", "node").alias("root")))
        several = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(
            "lo < hi").select("key")
        return named.join(several, "key")

    def _across(self, members: DataFrame) -> DataFrame:
        """(a, b): all pairs of one bucket and different roots that neither the registers nor
        the samples rule out. A bucket is dealt out in pairs of blocks."""
        block, registers, width, percent, most = (
            self.block, self.registers, self.width, self.percent, self.sample)
        least, least_sampled = self.least, self.least_sampled
        samples = self.kept.put(self._sets(members.select("node"), most), "hmh-samples")
        parts = F.ceil(F.col("m") / block).cast("int")
        dealt = (members.withColumn("p", parts).withColumn("own", F.pmod(F.xxhash64("node"), "p"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
                 .select(F.concat_ws(":", "key", F.least("own", "other"), F.greatest("own", "other"))
                         .alias("cell"), "band", "own", "node", "n", "root")
                 .join(self.nodes.select("node", "sketch").join(samples, "node"), "node"))

        def sampled(a: np.ndarray, b: np.ndarray) -> float:
            """Similarity of two sets of which at least one is larger than its sample."""
            both = np.union1d(a, b)[:most]
            return float((np.isin(both, a) & np.isin(both, b)).mean())

        def compare(rows: pd.DataFrame) -> pd.DataFrame:
            node, root, own, n = (rows[c].to_numpy() for c in ("node", "root", "own", "n"))
            names, place = np.unique(root, return_inverse=True)
            found = []
            if len(names) > 1:
                x = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(-1, registers)
                elements = rows["elements"].to_list()
                size = np.array([len(e) for e in elements])
                start = np.cumsum(size) - size
                values, ids = np.unique(np.concatenate(elements), return_inverse=True)
                band, marked = int(rows["band"].iloc[0]), np.zeros(len(values), bool)
                most_common = np.bincount(place).argmax()      # pairs are met from the smaller components
                two_blocks = own.min() < own.max()
                for i in np.flatnonzero(place != most_common).tolist():
                    ok = (place != place[i]) & ((place == most_common) | (node > node[i]))
                    if two_blocks:
                        ok &= own != own[i]
                    ok &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
                    j = np.flatnonzero(ok)
                    if len(j):
                        first = (x[j] == x[i]).reshape(len(j), -1, width).all(2).argmax(1)
                        j = j[first == band]       # the pair's other bands leave it to this one
                        j = j[similarity(x[j], x[i:i + 1], n[j], n[i:i + 1]) >= least]
                    if not len(j):
                        continue
                    marked[ids[start[i]:start[i] + size[i]]] = True
                    common = np.add.reduceat(marked[ids].astype(np.int64), start)[j]
                    marked[:] = False
                    large = np.maximum(n[j], n[i]) > most
                    near = 100 * common >= percent * (n[j] + n[i] - common)
                    for at in np.flatnonzero(large).tolist():
                        near[at] = sampled(elements[i].view(np.uint64),
                                           elements[j[at]].view(np.uint64)) >= least_sampled
                    found += [(min(node[i], b), max(node[i], b)) for b in node[j[near]].tolist()]
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rest = None
            for pdf in batches:
                rows = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
                cell = rows["cell"].to_numpy()
                cut = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()]
                for lo, hi in zip(cut, cut[1:]):
                    yield compare(rows.iloc[lo:hi])
                rest = rows.iloc[cut[-1]:].reset_index(drop=True)
            if rest is not None and len(rest):
                yield compare(rest)

        cells = dealt.repartition(fan_out(dealt), "cell").sortWithinPartitions("cell")
        return map_batches(cells, run, "a long, b long").distinct()

    def roots(self, turns: int = 2) -> DataFrame:
        """(node, root) of every set that is not the least of its component."""
        links = self._verified(self._estimated(self._centred(self.members, 0)))
        for turn in range(1, turns + 1):
            members = self.kept.put(self._open(components(links)), "hmh-open")
            if members.isEmpty():
                break
            pairs = self._across(members) if turn == turns else self._estimated(self._centred(members, turn))
            links = links.union(self._verified(pairs))
            self.kept.drop(*[x for x in ("hmh-open", "hmh-samples") if x in self.kept.paths])
        return components(links)


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, bands: int = 40, width: int = 5,
                    margin: float = 5, block: int = 1024, sample: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, ``n_shingles`` (size of its set),
    ``component_id`` (smallest doc_id reachable over links of a Jaccard similarity of at
    least ``percent`` / 100) and ``kept`` (doc_id = component_id)."""
    kept = Scratch(docs.sparkSession)
    rows = kept.put(_scan(docs, shingle, bands * width), "hmh-rows")
    sets = rows.filter("n > 0").groupBy("digest").agg(
        F.min(F.struct("row", "n", "sketch")).alias("first"), F.min("doc_id").alias("least_id"))
    nodes = kept.put(sets.select("digest", F.col("first.row").alias("node"), "first.n", "first.sketch",
                                 "least_id"), "hmh-nodes")
    roots = _Search(rows, nodes, shingle, percent, bands, width, margin, block,
                    sample, kept).roots()
    of = (nodes.select("digest", "node", "least_id").join(roots, "node", "left")
          .withColumn("root", F.coalesce("root", "node")))
    named = of.join(of.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    own = rows.select("doc_id", "n", "digest").join(
        named.select("digest", "component_id"), "digest", "left")
    group = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = staged(own.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"),
                            F.col("doc_id").eqNullSafe(group).alias("kept")), "hmh-result")
    kept.drop()
    return out
