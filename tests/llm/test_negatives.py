"""Hard negatives against all pairs, and the scan's windows against whole scores."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from placeloom.llm import negatives, queries

SCHEMA = "id long, label int, v array<double>, block string, kind int, positives int"


def all_pairs(rows, anchor, positives=5, negatives=3):
    """rows: (id, label, ints), one for each id."""
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, label, v in rows:
        if not anchor(i):
            continue
        scored = sorted((-dot(v, w), j, other) for j, other, w in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            s = -s
            inside = [x for x in scored if x[2] != label and 50 * s <= -100 * x[0] <= 95 * s][:negatives]
            out |= {(i, j, k, x[1], s, -x[0]) for k, x in enumerate(inside, 1)}
    return out


def mined(df, n=50):
    got = negatives.mine(df.select("id", "label", negatives.quantised(F.col("v")).alias("v")), F.col("id") % n == 0).collect()
    out = {tuple(r) for r in got}
    assert len(out) == len(got)
    return out


def whole(rows):
    return [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]


def test_equals_all_pairs_with_ties_and_a_hot_label(spark):
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 0.3) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(900):
        c = rnd.choice(centres)
        rows.append((i, rnd.choice([0, 0, 0, 1, 2, 3]), [round(x + rnd.gauss(0, 0.05), 1) for x in c]))
    df = spark.createDataFrame([(*r, "b", 7, 7) for r in rows], SCHEMA)
    want = all_pairs(whole(rows), lambda i: i % 10 == 0)
    assert want and mined(df, 10) == want


def test_several_blocks_give_the_same(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([0, 0, 1, 2]), [rnd.gauss(0, 1) for _ in range(8)]) for i in range(500)]
    df = spark.createDataFrame([(*r, "b", 7, 7) for r in rows], SCHEMA)
    monkeypatch.setattr(negatives, "BLOCK", 8 * 40)
    assert mined(df, 5) == all_pairs(whole(rows), lambda i: i % 5 == 0)


def test_awkward_rows(spark):
    """Nulls take no part, repeated rows count once, short vectors end in zeros, huge scores stay exact, one label only has no negatives."""
    inf, nan = float("inf"), float("nan")
    good = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 0.5]), (3, 2, [2.0]), (4, 3, []), (50, 1, [3e6, 2e6]), (51, 1, [2e6, 2e6]), (52, 2, [2e6, 1e6]), (100, 2, [0.0, 0.0])]
    bad = [(5, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (6, 2, None), (7, 2, [1.0, None]), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (0, 1, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "b", 7, 7) for r in good + bad], SCHEMA)
    assert mined(df) == all_pairs(whole(good), lambda i: i % 50 == 0)
    assert mined(df.limit(0)) == set()
    assert mined(df.where("label = 1")) == set()


def test_scores_beyond_a_double_are_exact(spark):
    rows = [(i, i % 2, [float(2**24 + 3 * i), float(2**24 - 5 * i)]) for i in range(20)]
    df = spark.createDataFrame([(*r, "b", 7, 7) for r in rows], SCHEMA)
    assert mined(df, 5) == all_pairs(whole(rows), lambda i: i % 5 == 0)


def test_scan_drops_only_what_cannot_be_asked_for():
    rng = np.random.default_rng(1)
    x = rng.integers(-9, 9, (400, 16)).astype(float)
    block = negatives.Block(np.arange(400), np.zeros(400), np.ascontiguousarray(x.T))
    for q in rng.integers(-9, 9, (40, 16)).astype(float):
        scores = x @ q
        lows, highs = [-300, 0, 50], [0, 100, 60]
        for (found, got), lo, hi in zip(block.scan(q, np.arange(400), lows, highs, 3), lows, highs, strict=True):
            inside = sorted((-s, i) for i, s in enumerate(scores) if lo <= s <= hi)[:3]
            assert [(-s, i) for s, i in zip(got, found, strict=True)] == inside


def test_query_has_anchors_by_fifty(spark, sf):
    got = queries.op11_hard_negatives(spark, sf).collect()
    assert got and all(r.anchor_id % 50 == 0 for r in got)
