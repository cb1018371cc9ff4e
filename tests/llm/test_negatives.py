"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunelake.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, cell long, rank int, score long"


def table(spark, rows):
    return spark.createDataFrame([r + (1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)


def plain(rows, every, positives=5, k=10):
    dim = 4
    ok = [(i, lab, [math.floor(256 * c) for c in v]) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and len(v) == dim
          and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 21 for c in v)]
    out = []
    for a, (aid, alab, av) in enumerate(ok):
        if aid % every:
            continue
        score = [sum(x * y for x, y in zip(av, v)) for _, _, v in ok]
        order = sorted((j for j in range(len(ok)) if j != a), key=lambda j: (-score[j], ok[j][0]))
        for p in [j for j in order if ok[j][1] == alab][:positives]:
            inside = [j for j in order if ok[j][1] != alab and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(aid, ok[p][0], r + 1, ok[j][0], score[p], score[j]) for r, j in enumerate(inside[:k])]
    return sorted(out)


def messy(seed, n=400, crowd=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, 4))
    rows = [(i, (middle[i % 9] + 0.4 * rng.normal(size=4)).tolist(), int(rng.integers(-2, 5))) for i in range(n)]
    rows += [(n + i, [1.0, 0.5, 0.25, 0.0], i % 3) for i in range(crowd)]
    rows += [(3, rows[3][1], rows[3][2]), (20, rows[20][1], rows[20][2]), (40, [0.1, 0.2, 0.3, 0.4], 1)]
    rows += [(None, rows[1][1], 1), (2000, None, 1), (2020, rows[0][1], None), (2040, [], 1), (2060, [1.0], 1),
             (2080, [1.0, None, 0.0, 0.0], 1), (2100, [float("nan"), 0.0, 0.0, 0.0], 1),
             (2120, [float("inf"), 0.0, 0.0, 0.0], 1), (2140, [1e30, 0.0, 0.0, 0.0], 1),
             (2160, [0.0, 0.0, 0.0, 0.0], 1), (2180, [900.0, 1.0, 0.0, -5.0], 2), (2200, [1.0, 0.5, 0.25, 0.0], 77)]
    return rows


def mined(df, every, **how):
    out = negatives.mine(df, F.col("id") % every == 0, **how)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in out.collect())


@pytest.mark.parametrize("how", [{}, {"per_cell": 4, "first": 16, "block": 5, "sample": 100}])
def test_messy_rows(spark, how):
    rows = messy(1)
    want = plain(rows, 20)
    assert len(want) > 300 and mined(table(spark, rows), 20, **how) == want


def test_a_third_of_the_rows_is_one_vector(spark):
    rows = messy(2, 200, crowd=100)
    assert mined(table(spark, rows), 20, per_cell=16, first=8, block=7) == plain(rows, 20)


def test_empty_tables(spark):
    assert mined(table(spark, messy(1)).limit(0), 20) == []
    assert mined(table(spark, messy(1)).filter("vec_id % 20 = 1"), 20) == []


def test_cells_come_by_descending_sum():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=7), rng.normal(size=5)
    got = list(negatives.multi_sequence(a, b))
    assert len({(i, j) for _, i, j in got}) == 35
    assert all(abs(s - a[i] - b[j]) < 1e-12 for s, i, j in got)
    assert [s for s, _, _ in got] == sorted((s for s, _, _ in got), reverse=True)


def test_certified_visit_leaves_out_cells_but_no_rows():
    """On clustered vectors the visit stops early, and no row at the floor is left out."""
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(20, 8)) * 200
    x = np.round(middle[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 8)
    books = tuple(negatives.codebook(h, 16) for h in negatives._halves(x))
    at = [negatives.nearest(h, w) for h, w in zip(negatives._halves(x), books)]
    radii = [np.array([np.sqrt(((h[c == i] - w[i]) ** 2).sum(1)).max(initial=0) for i in range(len(w))])
             for h, w, c in zip(negatives._halves(x), books, at)]
    sizes = np.zeros((16, 16), int)
    np.add.at(sizes, tuple(at), 1)
    index = negatives.Index(books, radii, sizes)
    for q in x[:20]:
        score = x @ q
        floor = np.sort(score)[-10]
        cells = index.visit(q, floor, np.inf, None, set())
        inside = {(i, j) for i, j in zip(at[0][score >= floor], at[1][score >= floor])}
        assert inside <= set(cells) and len(cells) < (sizes > 0).sum()
        roof = np.median(score)
        cells = index.visit(q, roof - 1000, roof, None, set())
        between = (score >= roof - 1000) & (score <= roof)
        assert set(zip(at[0][between], at[1][between])) <= set(cells)
