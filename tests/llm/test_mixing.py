import hashlib
import math
import random

from lastmile.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, weights=(5, 2, 1), share=1.5, most=2):
    size = lambda t: len([w for w in __import__("re").findall(r"[^\x20\x09-\x0d]+", t or "")])
    total = {}
    for _, t, _, s, _ in rows:
        total[s] = total.get(s, 0) + size(t)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(total.values()), set(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > most * total[s]}
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = float(most * total[s])
            left -= target[s]
        free -= over
    return total, target


def rows_of(n=400, seed=1):
    rng = random.Random(seed)
    return [(i, "w " * rng.randint(0, 50), "en", rng.choice([None, "a", "b", "c", "d", "hot", "hot", "hot"]), 0) for i in range(n)]


def test_targets_and_taken_words(spark):
    rows = rows_of()
    total, target = brute(rows)
    got = [tuple(r) for r in mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken").collect()]
    assert len(got) == len(rows)
    taken = {}
    for _, source, size, source_size, goal, words in got:
        assert source_size == total[source] and math.isclose(goal, target[source], rel_tol=1e-12)
        assert 0 <= words <= 2 * size
        taken[source] = taken.get(source, 0) + words
    assert all(taken[s] == math.floor(target[s]) for s in taken)


def test_reruns_agree_and_partitioning_does_not_matter(spark):
    rows = rows_of()
    plans = [mixing.mix_plan(spark.createDataFrame(r, SCHEMA).repartition(n)).select("doc.doc_id", "taken") for r, n in ((rows, 1), (rows[::-1], 7))]
    assert sorted(map(tuple, plans[0].collect())) == sorted(map(tuple, plans[1].collect()))


def test_mix_emits_what_the_plan_takes(spark):
    docs = spark.createDataFrame(rows_of(80), SCHEMA)
    plan = {r.doc_id: r.taken for r in mixing.mix_plan(docs).select("doc.doc_id", "taken").collect()}
    out = mixing.mix(docs).collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        if r.n_chars:
            assert r.n_chars == len(r.text)
    assert words == {k: v for k, v in plan.items() if v}


def test_copies_are_served_in_order_of_finish_time_until_the_budget_ends(spark):
    """Against the queues played out by hand."""
    rows = rows_of(120, 3)
    total, target = brute(rows)
    order = sorted(total, key=lambda s: (s is None, s or ""))
    queue = []
    for s in order:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: hashlib.md5(f"mix/{r[0]}".encode()).hexdigest())
        ahead = 0
        for turn in range(2):
            for r in own:
                size = len((r[1] or "").split())
                first = max(0, min(size, math.floor(target[s]) - ahead))
                queue += [((ahead + n) / target[s], order.index(s), ahead, part, r[0], words) for part, (n, words) in enumerate(((first, first), (size, size - first))) if words]
                ahead += size
    left, taken = sum(math.floor(t) for t in target.values()), {}
    for *_, doc, words in sorted(queue):
        taken[doc] = taken.get(doc, 0) + min(words, left)
        left -= min(words, left)
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "source")):
        got = {r.doc_id: r.taken for r in mixing.mix_plan(docs).select("doc.doc_id", "taken").collect()}
        assert {d: w for d, w in got.items() if w} == {d: w for d, w in taken.items() if w}


def test_edges(spark):
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = [(None, "a b", None, None, None), (1, None, None, "x", None), (2, "", None, "x", None), (3, "a b c", "en", "y", 5), (3, "a b c", "en", "y", 5), (4, "long " * 30_000, None, None, 1)]
    docs = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 as size", "'t' as target", "2 as taken", "3 as doc", "4 as bucket")
    plan = mixing.mix_plan(docs).select("doc.doc_id", "size", "taken", "source_size").collect()
    assert len(plan) == len(odd)
    assert all(r.taken == 0 for r in plan if r.size == 0)
    assert mixing.mix(docs).columns == docs.columns
    mixing.mix(docs).collect()
    nothing = spark.createDataFrame([(1, None, None, "x", None)], SCHEMA)
    assert [r.taken for r in mixing.mix_plan(nothing).collect()] == [0]


def test_shuffle_key_is_public_md5(spark):
    docs = spark.createDataFrame([(5, "a", None, "s", None)], SCHEMA)
    assert mixing.mix_plan(docs).count() == 1
    assert len(hashlib.md5(b"mix/5").hexdigest()) == 32
