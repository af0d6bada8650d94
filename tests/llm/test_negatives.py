"""Hard negatives against plain Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import negatives


def brute(rows, every=100, positives=5, most=10, low=30, high=90):
    """rows: (id, label, integers)."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None
            and all(x is not None for x in r[2])]
    out = []

    def key(entry):
        score, id_ = entry
        return (-score, id_ is None, id_ or 0)

    for i, (anchor, label, own) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        met = [(sum(x * y for x, y in zip(own, v)), id_, lab)
               for j, (id_, lab, v) in enumerate(rows) if j != i]
        same = sorted(((s, d) for s, d, lab in met if lab == label), key=key)[:positives]
        for score, positive in same:
            near = sorted(((s, d) for s, d, lab in met if lab != label
                           and low * score <= 100 * s <= high * score), key=key)[:most]
            out += [(anchor, positive, n + 1, d, score, s) for n, (s, d) in enumerate(near)]
    return order(out)


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "vec_id long, label int, vector array<long>, id string, row int").repartition(3)


def vectors(n, width, seed, size=40, labels=3):
    rnd = random.Random(seed)
    return [(i, rnd.randrange(labels), [rnd.randint(-size // 4, size) for _ in range(width)])
            for i in range(n)]


ODD = [(None, 1, [9] * 8), (None, None, [9] * 8), (5, None, [9] * 8), (7, 1, None),
       (8, 1, [1, None, 2]), (0, 0, [3] * 8), (0, 0, [3] * 8), (0, 1, [4] * 8), (11, 2, []),
       (20, 0, [7, 7]), (40, 1, []), (-20, 2, [-5] * 8), (13, 0, [3] * 8)]


def test_against_brute_force(spark, monkeypatch):
    rows = vectors(300, 8, 1) + ODD
    want = brute(rows, every=20)
    assert len(want) > 100
    for cells, tile, piece in ((2 ** 21, 256, 2048), (24, 2, 7)):
        monkeypatch.setattr(negatives, "BLOCK_CELLS", cells)
        monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", tile)
        monkeypatch.setattr(negatives, "ROWS_AT_ONCE", piece)
        got = negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0)
        assert order(got.collect()) == want


def test_ties_and_hot_label(spark):
    rows = [(i, int(i % 50 == 0), [1, 0, i % 2]) for i in range(400)]
    rows += [(i, 2, [1, 1, 0]) for i in range(400, 420)]
    assert order(negatives.mine(frame(spark, rows), F.col("vec_id") % 40 == 0)
                 .collect()) == brute(rows, every=40)


def test_no_rows_and_no_anchors(spark):
    assert negatives.mine(frame(spark, []), F.lit(True)).collect() == []
    assert negatives.mine(frame(spark, vectors(9, 4, 2)), F.lit(False)).collect() == []


@pytest.mark.parametrize("width,size", [(1, 3), (64, 300), (300, 2 ** 20), (700, 2 ** 24)])
def test_scores_are_exact(width, size):
    rnd = np.random.default_rng(width)
    a, b = rnd.integers(-size, size + 1, (5, width)), rnd.integers(-size, size + 1, (6, width))
    a[0], b[0], b[1] = size, size, -size
    primes = negatives.primes_for(width * size * size)
    assert len(primes) >= 2 and math.prod(primes) > 2 * width * size * size
    got = negatives.scores(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert got.tolist() == want
    half = negatives.LARGEST_PRIME // 2
    assert negatives.COLUMNS_AT_ONCE * half ** 2 < 2 ** 24


def test_scores_past_64_bits_are_an_error(spark):
    rows = [(0, 1, [2 ** 40] * 4), (1, 1, [2 ** 40] * 4)]
    with pytest.raises(ArithmeticError):
        negatives.mine(frame(spark, rows), F.col("vec_id") == 0)


def test_quantised(spark):
    df = spark.createDataFrame(
        [([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None, 1.0],), (None,), ([],)],
        "e array<float>")
    got = [r[0] for r in df.select(negatives.quantised("e", 256)).collect()]
    assert got == [[128, -1], None, None, None, None, []]
