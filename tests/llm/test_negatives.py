import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score string, rank int, block string, lows string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


def slow(rows, positives=5, count=3, every=50):
    kept = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[2])]
    length = max((len(r[2]) for r in kept), default=0)
    vectors = [[math.floor(256 * float(np.float32(x))) for x in r[2]] + [0] * (length - len(r[2])) for r in kept]
    out, anchors = [], {}
    for (i, label, _), v in zip(kept, vectors):
        if i % every == 0:
            anchors.setdefault(i, []).append((label, v))
    for anchor, (label, v) in ((i, min(found)) for i, found in anchors.items()):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for (j, other, _), w in zip(kept, vectors) if j != anchor)
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and -50 * score <= -100 * s[0] <= -95 * score][:count]
            out += [(anchor, j, rank, n, -score, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, **more)
    return sorted(tuple(r) for r in got.drop("positive_rank").collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (64, 64, 64), (33, 70, 129), (100, 1, 100), (65, 130, 40)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m * k + n)
    for most in (300, 1 << 28):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        for leaf in (2, 8, 32):
            assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 37)
    monkeypatch.setattr(negatives, "BLOCKS_A_TASK", 3)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 20))
    rows = []
    for i in range(900):
        # A third of all rows have one label, and few distinct vectors so that scores tie.
        label = 0 if i % 3 == 0 else int(rng.integers(1, 6))
        rows.append((i, label, [float(x) for x in np.round(centres[rng.integers(0, 6)] + rng.integers(-1, 2, 20) / 4, 2)]))
    want = slow(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_rows_that_take_no_part_repeats_and_lengths(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(150, None, [1.0] * 6), (200, 1, None), (None, 1, [1.0] * 6), (250, 1, [1.0, None]), (300, 2, [float("nan")] * 6)]
    rows += [(350, 1, [float("inf")] + [0.0] * 5), (400, 1, []), (401, 2, [3.0] * 3), (50, 2, [2.0] * 6), (7, 1, rows[7][2]), (8, 2, rows[8][2])]
    assert mined(spark, rows) == slow(rows)


def test_negative_scores_give_an_empty_window_and_zero_a_single_one(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [-0.7, 0.0]), (50, 3, [0.0, 1.0]), (51, 3, [1.0, 0.0]), (52, 4, [1.0, 0.0])]
    assert mined(spark, rows) == slow(rows) == [(50, 51, 1, 0, 0, 0), (50, 51, 2, 1, 0, 0), (50, 51, 3, 2, 0, 0)]


def test_tables_without_anchors_partners_or_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    assert mined(spark, [(50, 1, [1.0])]) == []
    assert mined(spark, [(50, 1, [1.0]), (51, 1, [1.0])]) == []
