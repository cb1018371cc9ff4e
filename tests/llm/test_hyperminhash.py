"""HyperMinHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tunelake.llm import hyperminhash as hmh
from tunelake.llm.common import Scratch, staged


def key(row):
    return tuple((x is None, x) for x in row)


def check(out, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in out]
    assert sorted(got, key=key) == sorted(brute.jaccard_components(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_messy_rows(spark, messy, messy_docs, no_docs):
    check(hmh.near_duplicates(messy_docs).collect(), [r[:2] for r in messy])
    assert hmh.near_duplicates(no_docs).count() == 0


def drifting(n, seed=1):
    """Texts in a chain: each is the one before with some words changed, so that links
    run along the chain and its ends share little; plus small and unrelated texts."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    rows = []
    for i in range(n):
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(120)] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    five = "a b c d e f"
    rows += [(n, five), (n + 1, "a b c d e"), (n + 2, "b c d e f g"), (n + 3, "x"), (n + 4, "X"), (n + 5, "x y")]
    return rows + [(n + 10 + i, " ".join(f"u{rng.randrange(50)}" for _ in range(30))) for i in range(40)]


@pytest.mark.parametrize("block", [1024, 8])
def test_chains_and_crowded_buckets(spark, block):
    rows = drifting(90)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(hmh.near_duplicates(docs, block=block).collect(), rows)


@pytest.mark.parametrize("block,sample", [(1024, 1024), (8, 100)])
def test_pairs_across_components_are_all_met(spark, block, sample):
    """The last step alone, from single sets as components, finds every pair that shares a band."""
    rows = drifting(60, 2)
    kept = Scratch(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scanned = staged(hmh._scan(docs, 2, 200), "t")
    nodes = staged(scanned.filter("n > 0").selectExpr("digest", "row as node", "n", "sketch")
                   .dropDuplicates(["digest"]), "t")
    search = hmh._Search(scanned, nodes, 2, 80, 40, 5, 5, block, sample, kept)
    alone = spark.createDataFrame([], "node long, root long")
    pairs = search._across(search._open(alone)).union(search._centred(search.members.filter("m = 2"), 0))
    found = {(r.a, r.b) for r in search._verified(pairs.distinct()).collect()}
    doc = {r.row: r.doc_id for r in scanned.collect()}
    sets = dict(zip([r[0] for r in rows], brute.shingle_sets(rows)))
    nodes = [r.node for r in nodes.collect()]
    want = {(a, b) for a in nodes for b in nodes if a < b and
            100 * len(sets[doc[a]] & sets[doc[b]]) >= 80 * len(sets[doc[a]] | sets[doc[b]])}
    assert found == want and len(want) > 50
    kept.drop()


def test_registers():
    v = np.array([0, 1 << 63, (1 << 64) - 1, 1 << 62, 3 << 61, 1 << 11], np.uint64)
    zeros, mantissa = hmh.register(v) >> 10, hmh.register(v) & 1023
    assert zeros.tolist() == [53, 0, 0, 1, 1, 52] and mantissa.tolist() == [0, 0, 1023, 0, 512, 0]
    rng = np.random.default_rng(0)
    order = hmh.donors(200)
    for n, shared in ((5, 4), (60, 30), (3000, 2400), (3000, 0)):
        est = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 2 * n - shared).astype(np.uint64) * np.uint64(2)
            a, b = np.unique(x[:n]), np.unique(x[n - shared:])
            est.append(hmh.similarity(hmh.sketch(a, order)[None], hmh.sketch(b, order)[None],
                                      np.array([n]), np.array([n]))[0])
        assert abs(np.mean(est) - shared / (2 * n - shared)) < 0.03


def test_agreement_by_chance():
    rng = np.random.default_rng(1)
    for n, m in ((2000, 2000), (20_000, 300)):
        x, y = (rng.integers(0, 1 << 63, (20_000, k // 100)).astype(np.uint64).min(1) * np.uint64(2)
                for k in (n, m))
        hits = (hmh.register(x)[:, None] == hmh.register(y)[None, :]).mean()
        assert abs(hits / hmh.chance(np.array([n]), np.array([m]), 100)[0] - 1) < 0.15


def test_the_sieve_keeps_what_is_wanted(spark, monkeypatch):
    rows = spark.range(5000).select((F.col("id") * 7919 - 9_000_000).alias("row"))
    wanted = rows.filter("row % 50 = 0").select(F.col("row").alias("node"))
    for words in (1 << 18, 1):
        monkeypatch.setattr(hmh, "_WORDS", words)
        got = hmh._sieved(rows, "row", wanted)
        assert got.columns == ["row"] and got.filter("row % 50 = 0").count() == wanted.count()
        assert got.count() <= (wanted.count() + 10 if words > 1 else 5000)
