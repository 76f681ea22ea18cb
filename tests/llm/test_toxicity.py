import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lastmile.llm import toxicity as tx
from lastmile.llm import words

DOCS = "doc_id long, text string, source string, score string"
LABELS = "doc_id long, quality int, toxic int"
ENGLISH = "you are a stupid idiot and a pathetic loser the worthless clown is disgusting this is the time of the day when people read stupid things idiot clown loser"


@pytest.fixture(scope="module")
def costs():
    counts = np.zeros(tx.TRIGRAMS, np.uint64)
    for span in words.spans(pa.array([ENGLISH * 20])):
        s = tx._SYMBOL[words.LOWER[span.data]].astype(np.int32)
        counts += np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=tx.TRIGRAMS).astype(np.uint64)
    return tx.language_model(counts)


def test_decoding(costs):
    for seen, meant in ((b"st0pid", b"stopid"), (b"$tup1d", b"stupid"), (b"stuuuupid", b"stupid"), (b"1d10t", b"idiot"), (b"L0SER", b"loser"), (b"cl0wn", b"clown"), (b"dis*gust#ing", b"disgusting")):
        assert tx.decode(seen, costs) == meant
    assert tx.restore("You s t u p i d 1D10T the loser", costs) == "you stupid idiot the loser"


def test_viterbi_against_all_paths(costs):
    """Every path of a short lattice, scored by hand."""
    for word in (b"l0ss3r", b"1d1o", b"aa4", b"t|m3"):
        options = []
        run, before = 0, None
        for byte in word:
            run = run + 1 if byte == before else 1
            before = byte
            if chr(byte).isalpha():
                options.append([(chr(byte), 0.0)] + ([("", tx.MERGE_RUN if run > 2 else tx.MERGE)] if run > 1 else []))
            else:
                options.append([(c, tx.READ) for c in tx.STANDS_FOR[chr(byte)]] + [("", tx.DROP)])

        def total(path):
            text = "".join(c for c, _ in path)
            ids = [0, 0] + [int(tx._SYMBOL[ord(c)]) for c in text] + [0]
            return sum(p for _, p in path) + sum(float(costs[a, b, c]) for a, b, c in zip(ids, ids[1:], ids[2:])), text.encode()

        best = min(total(path) for path in itertools.product(*options))
        found = tx.decode(word, costs)
        assert math.isclose(min(t for t in map(total, itertools.product(*options)) if t[1] == found)[0], best[0], rel_tol=1e-6)


def obfuscated(word, rng):
    return rng.choice([
        word, word.upper(), word.replace("o", "0").replace("i", "1").replace("e", "3").replace("s", "$"), " ".join(word), "".join(c * (3 if k == 2 else 1) for k, c in enumerate(word)), ".".join(word)])


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    clean = "the time of day when people read things and walk home with old friends near river".split()
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(clean) for _ in range(rng.randint(8, 60))]
        bad = rng.random() < 0.4
        for _ in range(2 * bad):
            text.insert(rng.randrange(len(text)), obfuscated(rng.choice(["stupid", "idiot", "loser", "pathetic"]), rng))
        rows.append((i, " ".join(text), "s", None))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_obfuscated_words_are_scored_like_plain_ones(spark):
    rows, labels = corpus()
    truth = {i: t for i, _, t in labels}
    out = tx.score_toxicity(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in held]) > 0.95


def test_contract_query(spark):
    rows = tx.op6_toxicity(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_counts_cover_every_text(spark):
    rows, _ = corpus(50)
    counts = tx.trigram_counts(spark.createDataFrame(rows, DOCS).repartition(7))
    by_hand = 0
    for _, text, _, _ in rows:
        by_hand += max(0, len(text) - 2)
    # texts of a batch lie side by side, so a few trigrams span two of them
    assert by_hand <= counts.sum() <= by_hand + 2 * len(rows)


def test_edges(spark):
    rows, labels = corpus(60)
    odd = rows + [(1000, None, None, "x"), (1001, "", None, "x"), (None, "1 $ *", None, None), (1002, "x" * 100_000 + " 1d10t" * 1000, None, None), (1003, "a " * 5000, None, None), (3, rows[3][1], "s", None), (1004, "4", None, None)]
    docs, marked = spark.createDataFrame(odd, DOCS), spark.createDataFrame(labels, LABELS)
    out = tx.score_toxicity(docs, marked).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in tx.score_toxicity(docs, marked.limit(0)).collect()} == {0.5}
    assert tx.score_toxicity(docs.limit(0), marked).count() == 0


def spaced(text):
    return " ".join(text.replace(" ", ""))


def test_long_runs_of_single_letters_are_scored(spark, costs):
    long = "you are a stupid idiot and a pathetic loser the worthless clown"
    assert {"stupid", "idiot", "pathetic", "loser", "clown"} <= set(tx.restore(spaced(long), costs).split())
    rows, labels = corpus()
    clean = "the time of day when people read things and walk home with old friends near river"
    bad = "the time of day when stupid people read idiot things and walk home loser pathetic"
    extra = [(1000, spaced(clean), "s", None), (1001, spaced(bad), "s", None), (1002, spaced(bad * 200), "s", None), (1003, "", "s", None)]
    out = {r.doc_id: r.score for r in tx.score_toxicity(spark.createDataFrame(rows + extra, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert min(out[1001], out[1002]) >= 0.5 > out[1000] and out[1001] != out[1003]


def test_runs_hold_signs_and_keep_boundaries(spark, costs):
    for seen, meant in (("such a s t u p i d thing", "such a stupid thing"), ("such s t u p 1 d thing", "such stupid thing"), ("$ t u p i d", "stupid"),
                        ("s t u p i d i d i o t", "stupid idiot"), ("5 7 u p 1 d 1 d 1 0 t", "stupid idiot"), ("т у п о й", "тупой"), ("1 2 3 4 5", "1 2 3 4 5")):
        assert tx.restore(seen, costs) == meant
    rows, labels = corpus()
    base = "the time of day when people read things and walk home with "
    bad = [base + x for x in ("a s t u p i d", "s t u p 1 d", "$ t u p i d", "s t u p i d i d i o t")]
    extra = [(1000 + k, x, "s", None) for k, x in enumerate([base, *bad])]
    out = {r.doc_id: r.score for r in tx.score_toxicity(spark.createDataFrame(rows + extra, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert out[1000] < 0.5 and all(out[1001 + k] >= 0.5 for k in range(len(bad)))


def test_heavily_disguised_words_are_decoded():
    counts = np.zeros(tx.TRIGRAMS, np.uint64)
    for span in words.spans(pa.array([(ENGLISH + " shit asshole bitch -- 1999 2000 12, ") * 20])):
        s = tx._SYMBOL[words.LOWER[span.data]].astype(np.int32)
        counts += np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=tx.TRIGRAMS).astype(np.uint64)
    found = tx.language_model(counts)
    for seen, meant in (("5h17", "shit"), ("1d107,", "idiot"), ("4$$h0l3", "asshole"), ("@$$h0l3!!", "asshole"), ("b!+ch", "bitch"), ("st" + "u" * 60 + "pid", "stupid"), ("100,000", "100,000"), ("stupid!", "stupid!")):
        assert tx.restore(seen, found) == meant
    # signs that no likely word explains stay out, as in the plain form
    assert tx.decoded_or_plain(b"clown1999", found) == b"clown" and tx.decoded_or_plain(b"qxq7777", found) == b"qxq"
    dimensions = [tx.quality.text_features(pa.array([t]), lambda span: tx.restored_features(span, found))[0].tolist() for t in ("the 5h17 1d107", "the shit idiot")]
    assert dimensions[0] == dimensions[1]
