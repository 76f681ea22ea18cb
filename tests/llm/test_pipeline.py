import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline as cp
from lastmile.llm import mixing, packing, pii, quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Rows after every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs.collect()))
    return dict(out)


def test_columns_stay_until_the_last_stage(staged):
    for name in ("quality", "near_duplicates", "private_data", "mixing"):
        assert staged[name][0].__fields__ == COLUMNS


def test_quality_keeps_what_the_operator_keeps(spark, staged):
    scored = quality.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert {r.doc_id for r in staged["quality"]} == {r.doc_id for r in scored if r.score >= 0.3}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in staged["quality"]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in bad) <= 0.1 * len(bad)


def test_one_document_of_each_group_stays(staged):
    sets = {}
    for r in staged["quality"]:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k : k + 5]) for k in range(len(w) - 4)))
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
            if 100 * common >= 80 * (len(s) + len(sets[e]) - common):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    assert {r.doc_id for r in staged["near_duplicates"]} == {d for d in sets if find(d) == d}


def test_private_data_is_replaced_and_the_rest_stays(staged):
    before = {r.doc_id: r for r in staged["near_duplicates"]}
    assert {r.doc_id for r in staged["private_data"]} == set(before)
    for r in staged["private_data"]:
        old = before[r.doc_id]
        mentions = pii.find(old.text or "")
        assert (r.text == old.text) == (not mentions) and r.n_chars == len(r.text)
        assert all(old.text[m.start : m.end] not in r.text for m in mentions)


def test_mixing_follows_the_plan(spark, staged):
    docs = spark.createDataFrame(staged["private_data"], "doc_id long, text string, lang string, source string, n_chars long")
    plan = {r.doc_id: r.taken for r in mixing.mix_plan(docs).select("doc.doc_id", "taken").collect()}
    words = Counter()
    for r in staged["mixing"]:
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0d]+", r.text))
    assert words == Counter({d: n for d, n in plan.items() if n})


def test_packing_holds_every_mixed_document(staged):
    encode = packing._encoder(None, None)
    want = Counter((r.doc_id, len(encode(r.text or "")) + 1) for r in staged["mixing"])
    got = Counter()
    for r in staged["packing"]:
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == Counter({k: n * k[1] for k, n in want.items()})


def test_run_gives_the_last_stage(spark, staged):
    rows = cp.run(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, staged["packing"]))
    assert __spark_entry__.queries()["pipeline"] is cp.run and cp.ORACLE_SQL is None


def test_edges(spark, tmp_path):
    odd = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (None, "a b c d e f", None, "s", None, 1), (3, "one two three " * 20_000, "en", "s", 9, 1), (4, "a b c d e f", "en", "t", 9, 1), (4, "a b c d e f", "en", "t", 9, 1)]
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, score int").withColumn("gone", F.lit(1)).withColumn("doc", F.lit("d"))
    for empty in (False, True):
        docs = frame.limit(0) if empty else frame
        for k, (name, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < 4:
                assert out.columns == frame.columns
            out.write.parquet(f"{tmp_path}/{empty}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{empty}-{name}")
        assert (docs.count() == 0) == empty


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    same, near = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "a b c d e f g h i j k l m n o p q r s t u v w x y zz"
    null, alone = "one two three four five six seven", "un deux trois quatre cinq six sept"
    data = [(1, same, "s"), (1, same, "s"), (1, near, "s"), (None, same, "s"), (2, near, "s"), (None, null, "s"), (None, null, "s"), (2, alone, "s"), (3, "", "s"), (None, None, "s")]
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in data], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.near_duplicates_stage(spark, docs.repartition(4), SF).collect()
    assert kept[0].__fields__ == COLUMNS
    got = Counter((r.doc_id, r.text) for r in kept)
    first = [(1, t) for t in (same, near) if got[1, t]]
    assert len(first) == 1 and got == Counter([*first, (None, null), (2, alone), (3, ""), (None, None)])
