import numpy as np
import pytest

from lastmile.llm import max_score as ms
from lastmile.llm import vector_packs as vp
from lastmile.llm.vector_packs import Rows

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score long, q long"


def usable(rows, scale):
    out = []
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            out.append((i, [int(np.floor(scale * x)) for x in v]))
    return out


def brute(rows, k=10, every=100, scale=1024):
    found = {}
    candidates = usable(rows, scale)
    for i, v in {(i, tuple(v)) for i, v in candidates if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in candidates if j != i and len(w) == len(v))
        found.setdefault(i, []).append([(j, -s) for s, j in scored[:k]])
    return {i: sorted(lists) for i, lists in found.items()}


def answers(frame, every=100, **how):
    got = {}
    for r in ms.search(frame, frame.where(f"vec_id % {every} = 0"), **how).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {i: [[best[n] for n in sorted(best)]] for i, best in got.items()}


def vectors(n, width=8, seed=0, clusters=0):
    random = np.random.default_rng(seed)
    points = random.normal(size=(n, width))
    if clusters:
        points = random.normal(size=(clusters, width))[random.integers(0, clusters, n)] + 0.1 * points
    return [(i, [float(x) for x in v], 1, 2, 3, 4) for i, v in enumerate(points)]


@pytest.mark.parametrize("clusters", [0, 5])
def test_equals_brute_force(spark, clusters, monkeypatch):
    monkeypatch.setattr(vp, "ROWS", 64)
    monkeypatch.setattr(vp, "QUERIES", 4)
    rows = vectors(1500, clusters=clusters)
    assert answers(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_hot_vector_and_ties(spark):
    """A third of the rows hold one vector: ties go to the smaller ids."""
    rows = vectors(600)
    rows = [(i, rows[100][1] if i % 3 == 0 else v, *rest) for i, v, *rest in rows]
    assert answers(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_edges(spark):
    assert ms.search(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA)).count() == 0
    nan, inf = float("nan"), float("inf")
    rest = (1, 2, 3, 4)
    rows = [(0, [1.0, -2.0], *rest), (100, [0.0, 0.0], *rest), (1, [1.0, 1.0], *rest), (2, [-3.0, 1.0], *rest), (2, [-3.0, 1.0], *rest), (3, None, *rest),
            (4, [None, 1.0], *rest), (5, [nan, 1.0], *rest), (6, [inf, 1.0], *rest), (7, [], *rest), (8, [1.0, 2.0, 3.0], *rest), (None, [1.0, 1.0], *rest),
            (9, [1e300, 1.0], *rest), (200, [1e6, -1e6], *rest), (200, [1e6, -1e6], *rest), (300, [1.0, 2.0, 3.0], *rest)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert answers(frame) == brute([r for r in rows if r[0] != 9])


def test_few_candidates_give_all(spark):
    rows = vectors(6)
    got = answers(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and len(got[0][0]) == 5


def test_long_vectors_stay_exact(spark):
    """Beyond 2^26 scores are summed as 64-bit integers."""
    rows = [(i, [float(1e5 + i), -3e4 * i, 1.0], 1, 2, 3, 4) for i in range(30)]
    assert answers(spark.createDataFrame(rows, SCHEMA), every=10) == brute(rows, every=10)


def test_terms_are_split_by_their_bounds():
    """Rows that only non-essential terms hold are never looked at."""
    matrix = np.zeros((50, 3), np.int32)
    matrix[:, 2] = 1
    matrix[7] = [9, 0, 1]
    postings = ms.Postings(Rows(np.arange(50), np.zeros(50, np.int64), matrix), np.float64)
    looked = []
    values = postings.values
    postings.values = type("Spy", (), {"__getitem__": lambda self, at: looked.append(at) or values[at], "dtype": values.dtype})()
    ids, scores = postings.search(np.array([10.0, 5.0, 2.0]), 99, 3, 20.0)
    assert ids.tolist() == [7] and scores.tolist() == [92.0]
    assert all(len(np.atleast_1d(np.ravel(at[0]))) == 1 for at in looked if isinstance(at, tuple))
