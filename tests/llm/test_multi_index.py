import numpy as np

from lastmile.llm import multi_index as mi

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


def brute(rows, k=5):
    """Nearest rows of every fiftieth id by exact cosine, ties to the smaller id."""
    found = {}
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    usable = {i: v for i, v in usable.items() if len(v) == 8}
    ids = np.array(sorted(usable))
    vectors = np.array([usable[i] for i in ids])
    size = np.sqrt((vectors**2).sum(1))
    for i in ids[ids % 50 == 0]:
        score = (vectors * usable[i]).sum(1) / (size * np.sqrt((usable[i] ** 2).sum()))
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        found[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return found


def answers(frame, **how):
    out = {}
    for r in sorted(mi.search(frame, frame.where("vec_id % 50 = 0"), **how).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / max(1, len(want[q])) for q in want if want[q]])


def make(n, seed=0, groups=None):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups or 1, 8)) * (3 if groups else 0)
    return [(i, (centre[i % len(centre)] + rng.normal(size=8)).astype(np.float32).tolist()) for i in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 9) for i, v in rows], SCHEMA)


def test_recall_on_random_and_clustered_vectors(spark):
    for rows in (make(3000), make(3000, 1, 20)):
        got, want = answers(frame_of(spark, rows)), brute(rows)
        assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
        assert recall(got, want) >= 0.9


def test_visiting_every_cell_is_exact(spark, monkeypatch):
    monkeypatch.setattr(mi, "BLOCK", 100)  # several blocks and deals a centroid
    rows = make(1500, 2) + [(5000 + i, [1.0] * 8) for i in range(40)] + [(6000 + i, [2.0] * 8) for i in range(0, 110, 10)]
    got, want = answers(frame_of(spark, rows), share=1.0, cells=4), brute(rows)
    assert {q: [v for v, _ in a] for q, a in got.items() if q < 5000} == {q: [v for v, _ in a] for q, a in want.items() if q < 5000}
    # equal vectors: ties go to the smaller id, the query itself is left out
    assert [v for v, _ in got[5000]] == [5001, 5002, 5003, 5004, 5005]
    for q in got:
        for (_, a), (_, b) in zip(got[q], want[q]):
            assert abs(a - b) < 1e-12


def test_cells_grow_with_the_table(spark):
    assert [mi.cells_for(n) for n in (0, 2_000, 65_536, 10**6, 10**7, 10**9, 10**11)] == [32, 32, 32, 64, 128, 256, 256]
    rows = make(4000, 3, 40)
    for cells in (8, 128):  # bitmaps of one byte and of sixteen
        assert recall(answers(frame_of(spark, rows), cells=cells), brute(rows)) >= 0.9


def test_doubles_are_scored_as_doubles(spark):
    """Angles that differ by less than a float can hold."""
    rows = [(0, [1.0, 0.0]), (10, [1.0, 0.1 + 2e-9]), (20, [1.0, 0.1 + 1e-9]), (30, [1.0, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [v for v, _ in answers(frame)[0]] == [30, 20, 10]


def test_contract_query_recall(spark):
    got = {}
    for r in mi.op5_multi_index(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = []
    for q in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[q]
        near[q] = -2
        hits.append(len({int(ids[j]) for j in np.argsort(-near)[:5]} & {v for v, _ in got[int(ids[q])]}) / 5)
    assert np.mean(hits) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    odd = make(120, 4) + [(200, None), (250, [0.0] * 8), (300, [nan] * 8), (350, [inf] + [1.0] * 7), (400, [None] + [1.0] * 7), (450, [1.0] * 3), (None, [1.0] * 8), (500, []), (50, None)]
    odd = [(i, v) for i, v in odd if not (i == 50 and v is not None)] + [(0, odd[0][1])]
    got, want = answers(frame_of(spark, odd), share=1.0), brute(odd)
    assert got.keys() == want.keys() == {0, 100}
    assert {q: [v for v, _ in a] for q, a in got.items()} == {q: [v for v, _ in a] for q, a in want.items()}
    few = answers(frame_of(spark, make(3)))
    assert {q: len(a) for q, a in few.items()} == {0: 2}
    assert answers(frame_of(spark, [(0, [1.0, 2.0])])) == {}
    assert mi.search(frame_of(spark, make(1)).limit(0), frame_of(spark, make(1)).limit(0)).count() == 0
    one = answers(spark.createDataFrame([(0, [1.0], 0, 0), (50, [-2.0], 0, 0), (3, [5.0], 0, 0)], SCHEMA))
    assert one == {0: [(3, 1.0), (50, -1.0)], 50: [(0, -1.0), (3, -1.0)]}


def test_traversal_is_in_order_of_distance():
    rng = np.random.default_rng(1)
    first, second = rng.random(6), rng.random(5)
    counts = rng.integers(0, 4, (6, 5))
    pairs = mi.traverse(first, second, counts, 10**9)
    sums = [first[i] + second[j] for i, j in pairs]
    assert sums == sorted(sums) and set(pairs) == {(i, j) for i in range(6) for j in range(5) if counts[i, j]}
    some = mi.traverse(first, second, counts, 9)
    assert some == pairs[: len(some)] and sum(counts[p] for p in some) >= 9 > sum(counts[p] for p in some[:-1])
