import random
import re
from collections import Counter

import numpy as np

from lastmile.llm import divergence as dv

SCHEMA = "text string, lang string, source string, term string, n long, p long, slab int"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", WORD.findall(lower(text or ""))) for text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(w for _, _, words in own for w in set(words))
        kept = {w for w, n in held.items() if n >= min_docs}
        groups = {None: Counter(), **{s: Counter() for _, s, _ in own}}
        for _, s, words in own:
            for w in words:
                if w in kept:
                    groups[s][w] += 1
                    groups[None][w] += 1
        total = {g: sum(c.values()) for g, c in groups.items()}

        def p(g, w):
            return 1 + 10**9 * (groups[g][w] + 1) // (total[g] + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        for s in groups:
            if s is None:
                continue
            pairs = [(sum(f(p(s, w), p(o, w)) for w in kept), o) for o in groups if o is not None and o != s]
            terms = [(f(p(s, w), p(None, w)), w) for w in kept if groups[s][w] and p(s, w) > p(None, w)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def audited(frame, **how):
    return sorted(map(tuple, dv.audit(frame, **how).collect()))


def documents(n=300, seed=0):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10] * (1 + i // 10)}" for i in range(60)] + ["Été", "naïve", "Über", "日本", "x1y"]
    return [(" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 40))) + rng.choice(["", ".", " A-B "]),
             rng.choice(["en", "en", "en", "fr", None]), rng.choice(["hot", "hot", "a", "b", None, "c"]), "t", 1, 2, 3) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = documents()
    assert audited(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_blocks_slabs_and_spans_do_not_matter(spark, monkeypatch):
    rows = documents(200, 1)
    monkeypatch.setattr(dv, "SLAB", 7)
    monkeypatch.setattr(dv, "GROUPS", 2)
    monkeypatch.setattr(dv, "SPAN", 300)
    assert audited(spark.createDataFrame(rows, SCHEMA), top=5) == brute(rows, top=5)


def test_edges(spark):
    assert audited(spark.createDataFrame([], SCHEMA)) == []
    rest = ("t", 1, 2, 3)
    odd = [(None, None, None, *rest), ("", "en", "a", *rest), ("0 1 2", "en", "b", *rest), ("only here", "de", "one", *rest), ("word " * 50_000, "fr", "x", *rest),
           ("Word", "fr", "x", *rest), ("word", "fr", "y", *rest), ("word", "fr", "y", *rest), ("a\x00b\x7fc\u0080d", "fr", "z", *rest)]
    rows = odd + odd
    assert audited(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_equal_node_pairs_are_priced_once():
    """Over a million ids with few different counts, few pairs are left of a walk."""
    counts = np.zeros((2, 1 << 16), np.int64)
    counts[0, :100], counts[1, 50:90] = 5, 3
    forest = dv.Forest(counts)
    assert sum(len(left) for left, _ in forest.levels) < 200  # shared nodes
    place, a, b, often = forest.meetings(0, np.array([1]))
    assert len(place) == 3 and often.sum() == 1 << 16
    met = {(forest.counts[x], forest.counts[y]): n for x, y, n in zip(a, b, often)}
    assert met == {(5, 0): 60, (5, 3): 40, (0, 0): (1 << 16) - 100}


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 10**10, 3 * 10**12], np.int64)
    assert dv.shares(counts, 4 * 10**12, 7).tolist() == [1 + 10**9 * (c + 1) // (4 * 10**12 + 7) for c in counts.tolist()]
