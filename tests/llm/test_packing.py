import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lastmile.llm import packing

SCHEMA = "doc_id long, text string, source string, n_chars long"


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, texts, reference):
    """Every id of every document in exactly one piece; sequences without gaps."""
    ids = {d: reference(t) for d, t in texts.items()}
    at = {d: 0 for d in texts}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        at[r.doc_id] += r.length
    assert at == {d: len(i) for d, i in ids.items()}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded))
    for parts in sequences.values():
        parts.sort()
        end = 0
        for offset, length, _ in parts:
            assert offset == end
            end += length
        assert end <= 2048 and all(p == (end if end & (end - 1) == 0 else 2048) for _, _, p in parts)
    return sum(parts[0][2] for parts in sequences.values()), sum(map(len, ids.values()))


def test_small_table(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    padded, tokens = check_pieces(packing.op1_packing(spark, "/root/testdata/sf0.001").collect(), {r.doc_id: r.text for r in docs.collect()}, reference)
    assert padded < 1.05 * tokens


def test_added_tokens_are_read_as_the_vocabulary_says(reference):
    encode = packing._encoder(None, None)
    for text in ("<|endoftext|>", "<|endoftext|> hi", "a<|endoftext|><|endoftext|>\n", "<|endoftext", "x" * 3000 + "<|endoftext|>"):
        assert encode(text).tolist() == reference(text)[:-1]
    assert encode("<|endoftext|>").tolist() == [50256]


def test_edges(spark, reference):
    texts = {1: None, 2: "", 3: "x" * 30_000, 4: "<|endoftext|> é中\U0001f600\r\n\t ", 5: " " * 5000, 6: "word " * 9000, 7: "word " * 9000}
    docs = spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA).selectExpr("*", "1 as start", "2 as class", "3 as rank")
    check_pieces(packing.pack(docs).collect(), texts, reference)
    assert packing.pack(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b", None, None), (1, "a b", None, None), (None, "c", None, None)], SCHEMA)
    rows = packing.pack(twice).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_sequences_hold_the_ids(spark, reference):
    texts = {i: "token soup " * n for i, n in enumerate((0, 1, 5, 700, 1500, 300, 40))}
    docs = spark.createDataFrame([(d, t, None, None) for d, t in texts.items()], SCHEMA)
    packed = packing.pack(docs)
    pieces = packed.collect()
    ids = {r.sequence_id: list(r.ids) for r in packing.token_sequences(docs, packed).collect()}
    for r in pieces:
        assert len(ids[r.sequence_id]) == r.padded
        assert ids[r.sequence_id][r.offset : r.offset + r.length] == reference(texts[r.doc_id])[r.start : r.start + r.length]


def test_fast_and_reference_encoders_agree(reference):
    encode = packing._encoder(None, None)
    rng = random.Random(2)
    alphabet = " \t\n\r\x0b\x0c\x85\xa0 　aZé中'’0.9!s​\x00\U0001f600"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in itertools.chain(range(0x3000), range(0x10000, 0x10400))]
    texts += ["<|endoftext|>", "a" * 1999, "a" * 2000, "\n" * 4000]
    for t in texts:
        assert encode(t).tolist() + [1] == reference(t)


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(1, 13), 4, replace=False))
        prices = rng.random(4)
        value, pattern = packing.best_pattern(sizes, prices, 12)
        best = max(np.dot(c, prices) for c in itertools.product(range(13), repeat=4) if np.dot(c, sizes) <= 12)
        assert abs(value - best) < 1e-9 and abs(pattern @ prices - best) < 1e-9 and pattern @ sizes <= 12


def test_patterns_hold_every_piece_with_little_waste():
    rng = np.random.default_rng(4)
    for n in (1, 7, 300, 20_000):
        sizes, counts = np.unique(rng.integers(1, 257, n), return_counts=True)
        demand = dict(zip(sizes.tolist(), counts.tolist()))
        held, bins = {}, 0
        for pattern, times in packing.whole_patterns(demand, 256):
            assert sum(c * k for c, k in pattern.items()) <= 256
            bins += times
            for c, k in pattern.items():
                held[c] = held.get(c, 0) + k * times
        assert held == demand
        # large pieces bound what any packing can do
        least = max(-(-int((sizes * counts).sum()) // 256), int(counts[sizes > 128].sum()))
        assert bins <= 1.02 * least + 3
