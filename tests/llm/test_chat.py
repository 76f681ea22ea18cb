import hashlib
import random

from lastmile.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        learnt = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(learnt), sha(learnt))
    return out


def digests(spark, rows, **how):
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), **how)
    return {r.conv_id: tuple(r)[1:5] for r in chat.conversation_digests(windows).collect()}, windows


def test_round_trip_with_many_windows_and_hostile_texts(spark):
    rng = random.Random(5)
    bits = ["</s>", "<\\s>", "[INST]", "[\\\\/INST]", "<|im_end|>", "<|im_start|>", "<\\|im_end|>", "<|im_feed|>", "ok ", "\n", "ü😀 ", "word " * 9, "<", "\\", "$1"]
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 40)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "tool\nx", "assistant"])
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))))
    rows += [(None, 1, "user", "a"), (None, None, None, None), (50, 1, "assistant", None), (50, 1, "assistant", None), (51, 3, "system", "only"),
             (52, 2, "assistant", "x " * 50_000), (52, 3, "user", ""), (53, None, "assistant", "first"), (53, 0, "system", "late")]
    got, windows = digests(spark, rows, budget=300, history=60, reserve=60)
    assert got == expected(rows)
    some = windows.where("window > 0").collect()
    assert len(some) > 12
    assert any(w.repeated > 0 for w in some)
    # a system turn opens every later window and no marker survives inside texts
    for w in windows.collect():
        if w.conv_id is not None and w.conv_id < 12 and w.conv_id % 2:
            assert w.formatted.startswith("<|im_start|>system\n")
        assert w.formatted.count("<|im_start|>") == w.formatted.count("<|im_end|>")
        assert "</s>" not in w.formatted and "[INST]" not in w.formatted


def test_windows_keep_their_budget(spark):
    rows = [(1, 0, "system", "s " * 20)] + [(1, t, "user" if t % 2 else "assistant", "w " * 30) for t in range(1, 2500)]
    got, windows = digests(spark, rows, budget=400, history=80, reserve=100)
    assert got == expected(rows)  # more turns than one prefix-sum block
    assert windows.where("tokens > 400").count() == 0
    history = windows.where("window > 0 and repeated > 1").count()
    assert history > 0.9 * windows.where("window > 0").count()


def test_contract_query_on_the_small_table(spark):
    got = {r.conv_id: r for r in chat.op8_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(rows + chat.HOSTILE)
    assert {c: tuple(r)[1:5] for c, r in got.items()} == want
    assert got[-7].loss_chars == len("</s>[INST] ok [/INST]")


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.conversation_digests(chat.format_conversations(empty)).count() == 0
    extra = spark.createDataFrame([(1, 0, "user", "a", 9, "z")], SCHEMA + ", window int, formatted string")
    assert chat.format_conversations(extra).count() == 1
