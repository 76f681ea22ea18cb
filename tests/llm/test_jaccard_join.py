import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lastmile.llm import jaccard_join as jj
from lastmile.llm import words
from lastmile.llm.components import components

SCHEMA = "doc_id long, text string, source string, n long"


def shingle_set(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < width else (tuple(w[k : k + width]) for k in range(len(w) - width + 1)))


def brute(texts, width=4, num=85, den=100):
    sets = {d: shingle_set(t, width) for d, t in texts.items()}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for e, common in Counter(y for x in s for y in holders[x] if y > d).items():
            if den * common >= num * (len(s) + len(sets[e]) - common):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def result(frame, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(frame, **how).collect()}


def near_copies(n, seed, length=60, words_changed=4):
    """A base text and copies with a few words changed: overlaps around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, words_changed)):
            text[rng.randrange(length)] = f"x{rng.randint(0, 5000)}"
        out.append(" ".join(text))
    return out


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(docs) == brute({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("run,frequent", [(64, 16), (3, 16), (64, 1), (3, 1)])
def test_near_copies_around_the_threshold(spark, monkeypatch, run, frequent):
    # forces long runs into blocks, and every token into the frequent class
    monkeypatch.setattr(jj, "RUN", run)
    monkeypatch.setattr(jj, "FREQUENT", frequent)
    monkeypatch.setattr(jj, "BLOCK_DOCS", 20)
    texts = near_copies(90, 1) + near_copies(40, 2, 12, 1) + near_copies(30, 3, 200, 12)
    rng = random.Random(4)
    line = " ".join(f"common{k}" for k in range(30))
    texts += [f"{line} " + " ".join(f"y{rng.randint(0, 900)}" for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rng.shuffle(texts)
    texts = dict(enumerate(texts))
    assert result(spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA)) == brute(texts)


def test_tokens_of_long_runs_are_signed_again(spark, monkeypatch):
    # saturated counters take every token for rare: passages that many unlinked texts share
    # make long runs, which the second signatures dissolve into few pairs and small clusters
    rng = random.Random(6)
    passages = [" ".join(f"p{k}_{j}" for j in range(12)) for k in range(3)]
    own = [" ".join(f"u{k}_{j}" for j in range(45)) for k in range(150)]
    texts = [f"{passages[k % 3]} {text} {passages[(k + 1) % 3]}" for k, text in enumerate(own)] + near_copies(40, 7, 60, 3)
    rng.shuffle(texts)
    texts = dict(enumerate(texts))
    frame = spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA)
    monkeypatch.setattr(jj, "RUN", 8)
    monkeypatch.setattr(jj, "token_levels", lambda docs, width: np.zeros(1 << jj.COUNTER_BITS, np.uint8))
    seen = []
    clustered = jj._cluster_links
    monkeypatch.setattr(jj, "_cluster_links", lambda sets, clusters, num, den: seen.append(clusters) or clustered(sets, clusters, num, den))
    assert result(frame) == brute(texts)
    copies = {d for d, t in texts.items() if "p0_0" not in t and "p1_0" not in t}
    largest = Counter(r.cluster for r in seen[0].collect()).most_common(1)
    assert not largest or largest[0][1] <= len(copies)


def test_clusters_in_bands_of_sizes(spark, monkeypatch):
    # one token list cut at all lengths: a chain of links through many bands and blocks
    monkeypatch.setattr(jj, "RUN", 2)
    monkeypatch.setattr(jj, "BLOCK_DOCS", 4)
    full = [f"w{k}" for k in range(140)]
    texts = {d: " ".join(full[:n]) for d, n in enumerate(list(range(5, 140, 3)) + [4, 5, 6, 7, 8, 9])}
    frame = spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA)
    assert result(frame) == brute(texts)
    assert result(frame, num=100, den=100) == brute(texts, 4, 100, 100)


def test_other_width_and_threshold(spark):
    texts = dict(enumerate(near_copies(60, 5, 30, 6)))
    frame = spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA)
    assert result(frame, width=2, num=60, den=100) == brute(texts, 2, 60, 100)


def test_edges(spark):
    long = " ".join(f"q{k}" for k in range(30_000))
    texts = {0: None, 1: "", 2: " \n ", 3: "one", 4: "One", 5: "one two three", 6: "ONE two three", 7: long, 8: long + " end", 9: "a\xa0b c d e", 10: "É é É é É", 11: "é é é é é"}
    frame = spark.createDataFrame([(d, t, None, 3) for d, t in texts.items()], SCHEMA).selectExpr("*", "1 as sig", "2 as c1")
    got = result(frame)
    assert got == brute(texts) and got[8][1] == 7 and got[0] == (0, 0) and got[6][1] == 5
    assert jj.jaccard_components(frame.limit(0)).count() == 0
    odd = spark.createDataFrame([(5, "a b c d e", None, None), (5, "a b c d e", None, None), (None, "a b c d e", None, None), (None, None, None, None), (9, "A B C D E", None, None)], SCHEMA)
    rows = sorted((tuple(r) for r in jj.jaccard_components(odd).collect()), key=str)
    assert rows == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 0, None), (9, 2, 5)], key=str)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, 1000 + k) for k in range(50)] + [(5, 1049)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {1000 + k: 5 for k in range(50)} | {7: 5, 5: 5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_of_links_has_exchanges_on_both_sides(spark):
    from lastmile.llm import components as module

    links = spark.range(1, 3000).selectExpr("id as a", "if(id % 3 = 0, 0L, id - 1) as b").where("a > b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for both in (True, False):
            plan = module._star(links, both)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "rebalance" in plan.lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.component for r in components(links).collect()} == {0}


def test_words_and_shingles_against_regular_expressions(monkeypatch):
    monkeypatch.setattr(words, "SPAN", 300)
    rng = random.Random(1)
    texts = [None, "", "  ", "a", "A b", "a b c", "a b c d", "x\x0by\x0cz w\tq"] + ["".join(rng.choice(" ab\nAé") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    seen, names = defaultdict(list), {}
    for span in words.spans(pa.array(["skip"] + texts + ["tail"])[1:-1]):
        for x, row in zip(*words.shingles(span.hashes(), span.doc, 4)):
            seen[int(row)].append(int(x))
    for row, text in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
        want = [tuple(w)] if 0 < len(w) < 4 else [tuple(w[k : k + 4]) for k in range(len(w) - 3)]
        assert len(want) == len(seen[row])
        for name, x in zip(want, seen[row]):
            assert names.setdefault(x, name) == name
    assert len(set(names.values())) == len(names)


def test_block_links_against_brute_force():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(60, 40 + k % 3, replace=False)) for k in range(80)]
    frame = pd.DataFrame({"node": np.arange(80) * 10, "tokens": sets, "side": [k % 2 for k in range(80)]})
    links = jj.block_links(frame, 70, 100)
    want = set()
    for a in range(0, 80, 2):
        for b in range(1, 80, 2):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both):
                want.add((a * 10, b * 10))
    assert set(zip(links.a, links.b)) <= want

    def parts(edges):
        root = {}
        for a, b in edges:
            root.setdefault(a, a), root.setdefault(b, b)
        changed = True
        while changed:
            changed = False
            for a, b in edges:
                low = min(root[a], root[b])
                changed |= root[a] != low or root[b] != low
                root[a] = root[b] = low
        return root

    assert parts(want) == parts(list(zip(links.a, links.b)))
