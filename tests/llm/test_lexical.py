"""Ranked lexical search against a plain version."""

import numpy as np
import pytest

import brute
from tunelake.llm import lexical

ITEMS = "item_id long, text string, rank int, n long, term string"


def key(row):
    return tuple((x is None, x) for x in row)


def plain_items(messy):
    texts = [(i, messy[i][1]) for i in range(0, 60, 7)]
    long = " ".join(f"w{i} the" for i in range(90)) + " " + " ".join(str(r[1])[:99] for r in messy[:40])
    return texts + [(1000, "the THE the of"), (1001, None), (1002, ""), (1003, "?! ..."), (1004, "nowhere"),
                    (1000, "der die"), (None, "the"), (1005, "漢字 é the"), (1006, long)]


@pytest.mark.parametrize("block,block_chars,cells", [(4096, 1 << 25, 1 << 22), (7, 300, 64)])
def test_lists_match_a_plain_version(spark, messy, messy_docs, monkeypatch, block, block_chars, cells):
    monkeypatch.setattr(lexical, "_CELLS", cells)
    items = plain_items(messy)
    df = spark.createDataFrame([r + (1, 2, "t") for r in items], ITEMS)
    got = lexical.rank(messy_docs, df, k=5, block=block, block_chars=block_chars).collect()
    want = brute.ranked([r[:2] for r in messy], items, 5)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len(lexical.distinct_masks(np.ones((70, 3), bool))[0]) == 1


def test_pruning_evaluates_less_and_loses_nothing():
    rng = np.random.default_rng(3)
    gains = rng.integers(1, 1000, (90, 3000)) * (rng.random((90, 3000)) < np.linspace(0.9, 0.01, 90)[:, None])
    weights = np.arange(90) ** 3
    best = lexical._Best(20)
    done = lexical.evaluate(gains, weights, np.zeros(3000, bool), np.arange(3000), best)
    want = np.lexsort((np.arange(3000), -(weights @ gains)))[:20]
    assert best.doc.tolist() == want.tolist() and 20 <= done < 1500


def test_ties_and_a_crowd_of_copies(spark):
    rows = [(i, "red fox") for i in range(500, 0, -1)] + [(1000 + i, "blue") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "fox red red")], "item_id long, text string")
    got = lexical.rank(docs, items, block=16).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 21)) and len({r.score for r in got}) == 1


def test_empty_tables(spark, messy_docs, no_docs):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.rank(no_docs, items).count() == 0
    assert lexical.rank(messy_docs, items.limit(0)).count() == 0
