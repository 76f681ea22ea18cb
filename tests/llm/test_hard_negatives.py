import numpy as np
import pytest

from lastmile.llm import hard_negatives as hn
from lastmile.llm import vector_packs as vp
from lastmile.llm.vector_packs import Rows

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, q long, place int"


def brute(rows, every=100, k=5, least=80, scale=256):
    own = [(i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, label, *_ in rows
           if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, label, v in own:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in own if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            hard = [x for x in scored if x[2] != label and least * -s <= 100 * -x[0] <= 100 * -s][:k]
            out |= {(i, j, rank, n, -s, -t) for rank, (t, n, _) in enumerate(hard, 1)}
    return out


def mined(frame, every=100, **how):
    return {tuple(r) for r in hn.mine(frame, frame.where(f"vec_id % {every} = 0"), **how).collect()}


def vectors(n, width=8, seed=0, clusters=0, lengths=False):
    random = np.random.default_rng(seed)
    points = random.normal(size=(n, width))
    if clusters:
        points = random.normal(size=(clusters, width))[random.integers(0, clusters, n)] + 0.1 * points
    if lengths:
        points = points * random.exponential(size=(n, 1))
    labels = random.integers(0, 4, n)
    return [(i, [float(x) for x in v], int(y), 1, 2, 3) for i, (v, y) in enumerate(zip(points, labels))]


@pytest.mark.parametrize("how", [{}, {"clusters": 6}, {"lengths": True}])
def test_equals_brute_force(spark, how, monkeypatch):
    monkeypatch.setattr(vp, "ROWS", 64)
    monkeypatch.setattr(vp, "QUERIES", 4)
    rows = vectors(1200, **how)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_hot_vector_and_hot_label(spark):
    rows = vectors(500)
    rows = [(i, rows[100][1] if i % 3 == 0 else v, 0 if i % 2 else label, *rest) for i, v, label, *rest in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_edges(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA)).count() == 0
    nan, inf = float("nan"), float("inf")
    rest = (1, 2, 3)
    rows = [(0, [1.0, -2.0], 1, *rest), (100, [0.0, 0.0], 1, *rest), (1, [1.0, 1.0], 1, *rest), (2, [1.0, -1.9], 2, *rest), (3, [1.0, -2.0], 1, *rest),
            (4, [None, 1.0], 1, *rest), (5, [nan, 1.0], 1, *rest), (6, [inf, 1.0], 2, *rest), (7, [], 1, *rest), (8, None, 1, *rest), (None, [1.0, 1.0], 1, *rest),
            (9, [1.0, -2.0], None, *rest), (200, [-1.0, 0.0], 2, *rest), (10, [0.0, 3.0], 2, *rest), (11, [1.0, 2.0, 3.0], 2, *rest)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_ranges_keep_every_row_that_reaches_the_floor():
    random = np.random.default_rng(3)
    matrix = (random.normal(size=(400, 6)) * 100 * random.exponential(size=(400, 1))).astype(np.int32)
    matrix = matrix[np.argsort(-(matrix.astype(float) ** 2).sum(1), kind="stable")]
    bucket = hn.Bucket(Rows(np.arange(400), np.zeros(400, np.int64), matrix), np.float64)
    fewer = 0
    for _ in range(100):
        anchor = random.normal(size=6)
        length = np.sqrt((anchor**2).sum())
        scores = matrix @ anchor
        floor = np.quantile(scores, 0.99)
        found = set(bucket.candidates(anchor / length, length, floor))
        assert set(np.flatnonzero(scores >= floor)) <= found
        fewer += len(found)
    assert fewer < 100 * 400 / 3  # the lists do prune


def test_exact_copy_of_the_anchor_is_kept():
    matrix = np.array([[3, 4], [3, 4], [4, 3]], np.int32)
    bucket = hn.Bucket(Rows(np.arange(3), np.zeros(3, np.int64), matrix), np.float64)
    assert {0, 1} <= set(bucket.candidates(np.array([0.6, 0.8]), 5.0, 25.0))
