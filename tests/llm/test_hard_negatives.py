"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidegauge.llm import entry, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10):
    """rows: (vec_id, vector, label), labels as they are compared; vectors of any length."""
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, label, [math.floor(256 * float(x)) for x in v]))
    out = []
    for i in {i for i, _, _ in kept if i % 100 == 0}:
        _, label, v = min(r for r in kept if r[0] == i)
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in kept]
        best = sorted((s, j) for s, j, other in scored if j != i and other == label)[:positives]
        for s, j in best:
            p = -s
            fit = sorted((t, k) for t, k, other in scored if other != label and 30 * p <= -100 * t <= 90 * p)[:negatives]
            out += [(i, j, n + 1, k, p, -t) for n, (t, k) in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def mined(spark, rows, **k):
    return hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit("r"), "id": F.lit(1), "v": F.lit(2)}), F.col("vec_id") % 100 == 0, **k)


def vectors(seed, n, width=8):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [np.float32(x + draw.gauss(0, 0.6)).item() for x in draw.choice(centres)]
        if draw.random() < 0.3:
            v = [np.float32(x).item() for x in centres[0]]  # many ties
        rows.append((i, v, draw.randrange(3)))
    return rows


def test_query_matches_sql(spark):
    oracle.same(spark, entry.op11_hard_negatives, entry.oracle_sql()["op11_hard_negatives"], oracle.connection())


@pytest.mark.parametrize(("anchors", "tile", "small"), [(4096, 512, 32), (3, 7, 1)])
def test_equals_brute_force(spark, monkeypatch, anchors, tile, small):
    for name, value in (("ANCHORS", anchors), ("TILE", tile), ("SMALL", small)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(anchors, 900)
    assert found(mined(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 230) + [
        (None, [1.0] * 8, 1), (900, None, 1), (901, [1.0] * 8, None), (1000, [nan] * 8, 1), (902, [1.0, None], 2), (903, [inf] + [0.0] * 7, 0),
        (300, [], 1), (400, [1.0, 2.0], 2), (500, [0.5] * 20, 0), (501, [0.5] * 20, 1), (502, [0.25] * 30, 1),
        (5, [1.0] * 8, 1), (5, [1.0] * 8, 1), (600, [1.0] * 8, 2), (600, [1.0] * 8, 2), (600, [2.0] * 8, 1), (-100, [0.1] * 8, 1),
    ]
    assert found(mined(spark, rows)) == brute(rows)
    assert found(mined(spark, [])) == found(mined(spark, [(1, [1.0], 1)])) == found(mined(spark, [(100, [], 1), (1, [], 1)])) == []
    assert found(mined(spark, [(100, [], 1), (1, [1.0], 1), (2, [1.0], 2)])) == [(100, 1, 1, 2, 0, 0)]


def test_fewer_than_asked(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.95, 0.0], 2), (4, [0.1, 0.0], 3)]
    assert found(mined(spark, rows)) == brute(rows) == [(0, 1, 1, 2, 65536, 32768)]
    assert found(mined(spark, rows, low=0, high=100)) == [(0, 1, 1, 3, 65536, 62208), (0, 1, 2, 2, 65536, 32768), (0, 1, 3, 4, 65536, 6400)]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (65, 33, 129), (200, 64, 300)])
def test_strassen_is_exact(shape, monkeypatch):
    n, k, m = shape
    monkeypatch.setattr(hard_negatives, "SMALL", 4)
    draw = np.random.default_rng(n)
    a, b = draw.integers(-(2**27), 2**27, (n, k)), draw.integers(-(2**27), 2**27, (k, m))
    expected = a.astype(object) @ b.astype(object)
    assert (hard_negatives.strassen(a, b).astype(object) == expected).all()


def test_sums_on_the_way_may_wrap_around(monkeypatch):
    monkeypatch.setattr(hard_negatives, "SMALL", 1)
    a = np.array([[2**62, 1], [2**62, -1]])
    b = np.array([[1, 0], [0, 1]])
    assert (hard_negatives.strassen(a, b) == a).all()


def test_heaps_merge_in_any_order():
    draw = random.Random(2)
    rows = [(draw.randrange(3), draw.randrange(6), i) for i in range(200)]
    for size in (1, 17, 200):
        draw.shuffle(rows)
        heaps = hard_negatives.Heaps.empty(3, 4)
        for at in range(0, len(rows), size):
            k, s, i = (np.array(x) for x in zip(*rows[at : at + size], strict=True))
            fits = heaps.open(k, s, i)
            heaps.push(k[fits], s[fits], i[fits])
        best = [sorted((-s, i) for k, s, i in rows if k == key)[:4] for key in range(3)]
        assert sorted(zip(heaps.keys.tolist(), heaps.scores.tolist(), heaps.ids.tolist(), strict=True)) == sorted((key, -s, i) for key in range(3) for s, i in best[key])
