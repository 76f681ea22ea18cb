"""Operator 1: packing documents into training sequences, as a cutting-stock problem.

1. Tokens. Every document is encoded (byte-level BPE) and gets an end id. Full
   ``size``-token pieces are cut off; what remains (1 .. size-1 ids) stays whole.
2. Histogram. Pieces are counted by length class (``grid`` tokens a class, at
   most ``size / grid`` classes: a bounded table, whatever the corpus).
3. Column generation on the driver over that histogram. The restricted master
   is the linear program "fewest sequences whose patterns hold every class's
   demand", kept as a revised simplex basis; a knapsack dynamic program over
   the duals prices the best new pattern, until none improves the program.
4. Rounding. Every pattern is used the whole number of times below its LP
   value; the few pieces left over (less than one sequence a pattern) are packed
   first-fit decreasing over their histogram.
5. Assignment. Pieces are ranked within their class and the ranks are mapped to
   (pattern, repetition) by binary search, so no task sees more than its rows.

Classes are rounded up to the grid, so a sequence is padded by less than
``grid`` tokens a piece. A sequence of exactly a power of two is not padded.

Scale. Texts are read once and never shuffled; pieces (a few numbers each) are
frozen in the checkpoint folder and shuffled twice. Ranks come from counts per
(class, bucket) and a window inside each (class, bucket), so a class with a
third of all pieces is spread over ``BUCKETS`` keys. The driver gets at most
``size / grid`` rows.

Ids come from ``tiktoken`` with the rank file of the vocabulary; a text with
an unbroken run of over ``LONG_RUN`` characters goes through ``tokenizers``,
whose merge is not quadratic. Both give the same ids (tested over every code
point).

Defined results: null text is empty (one piece: the end id); a null
``doc_id`` stays null; repeated rows are packed as often as they occur; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import frozen, table, trimmed

SIZE = 2048
GRID = 8
END_ID = 1
BUCKETS = 1024
LONG_RUN = 2000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=1)
def _quick(vocabulary: str, ranks: str):
    """The rank file's encoding, with the vocabulary's added tokens."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    with open(ranks, "rb") as lines:
        table_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_of, special_tokens=added)


def _encoder(vocabulary: str | None, ranks: str | None):
    """Function from a text to its ids, an array of unsigned 32-bit numbers.

    Texts with a long unbroken run go to the second encoder, which is loaded for
    the first of them and lives no longer than the task."""
    import public_tokenizers
    from tokenizers import Tokenizer

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    quick = _quick(vocabulary, ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    run = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
    steady: list = []

    def encode(text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and run.search(text):
            if not steady:
                steady.append(Tokenizer.from_file(vocabulary))
            return np.array(steady[0].encode(text, add_special_tokens=False).ids, "<u4")
        return quick.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    return encode


def token_pieces(docs: DataFrame, size=SIZE, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of every document: ``size`` ids each, the last one shorter."""

    def cut(batches):
        encode = _encoder(vocabulary, ranks)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                raw, total = ids.tobytes(), len(ids)
                for start in range(0, total, size):
                    part = raw[4 * start : 4 * (start + size)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(cut), PIECES)


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of most price."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = np.searchsorted(sizes, room, side="right")
        value[room] = value[room - 1]
        if n:
            gain = value[room - sizes[:n]] + prices[:n]
            k = int(gain.argmax())
            if gain[k] > value[room] + 1e-12:
                value[room], choice[room] = gain[k], k
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), pattern


def linear_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses them (column generation)."""
    m = len(sizes)
    columns = [np.where(np.arange(m) == k, capacity // sizes[k], 0).astype(float) for k in range(m)]
    cost = np.ones(m)
    inverse = np.diag([1.0 / columns[k][k] for k in range(m)])
    used = inverse @ demand
    for _ in range(60 * m):  # a stop, never reached in practice; any basis is feasible
        prices = cost @ inverse
        low = int(prices.argmin())
        if prices[low] < -1e-9:  # more than the demand of a class may be held
            entering, entering_cost = -np.eye(m)[low], 0.0
        else:
            value, entering = best_pattern(sizes, prices, capacity)
            if value <= 1 + 1e-7:
                break
            entering_cost = 1.0
        change = inverse @ entering
        able = change > 1e-9
        if not able.any():
            break
        ratio = np.where(able, used / np.where(able, change, 1), np.inf)
        row = int(ratio.argmin())
        step = ratio[row]
        used = np.maximum(used - step * change, 0)
        used[row] = step
        pivot = inverse[row] / change[row]
        inverse -= np.outer(change, pivot)
        inverse[row] = pivot
        columns[row], cost[row] = entering, entering_cost
    return [(columns[k], used[k]) for k in range(m) if cost[k] and used[k] > 0]


def whole_patterns(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (class -> copies) and how often each is used; they hold every piece."""
    sizes = np.array(sorted(c for c, n in demand.items() if n), int)
    if not len(sizes):
        return []
    left = np.array([demand[c] for c in sizes], np.int64)
    plan = []

    def use(pattern: np.ndarray, most: int) -> None:
        inside = pattern > 0
        times = min(most, int((left[inside] // pattern[inside]).min()))
        if times > 0:
            left[inside] -= times * pattern[inside]
            plan.append(({int(sizes[k]): int(pattern[k]) for k in np.flatnonzero(inside)}, times))

    found = linear_patterns(sizes, left.astype(float), capacity)
    for pattern, times in sorted(found, key=lambda f: -f[1]):
        use(pattern.astype(np.int64), int(times + 1e-6))
    while left.any():  # first fit, decreasing, over what rounding left
        room, pattern = capacity, np.zeros(len(sizes), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            pattern[k] = min(left[k], room // sizes[k])
            room -= pattern[k] * sizes[k]
        use(pattern, 1 << 62)
    return plan


def slot_table(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (class, first rank, copies, first sequence) sorted by class and rank."""
    rows, next_rank, sequence = [], {}, 0
    for pattern, times in plan:
        for c, copies in pattern.items():
            rank = next_rank.get(c, 0)
            rows.append((c, rank, copies, sequence))
            next_rank[c] = rank + copies * times
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def assign(pieces: DataFrame, size=SIZE, grid=GRID) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset`` and ``padded`` (the sequence's length)."""
    capacity = size // grid
    known = pieces.withColumns({
        "class": F.ceil(F.col("length") / grid).cast("int"),
        "bucket": F.pmod(F.xxhash64("doc_id", "start", F.lit("rank")), F.lit(BUCKETS)).cast("int")})
    counts = frozen(known.groupBy("class", "bucket").agg(F.count("*").alias("n")))
    demand = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # one row a class
    slots = slot_table(whole_patterns(demand, capacity))
    key = (slots[:, 0] << 48) + slots[:, 1]

    def place(classes: pd.Series, ranks: pd.Series) -> pd.Series:
        at = np.searchsorted(key, (classes.to_numpy(np.int64) << 48) + ranks.to_numpy(np.int64), side="right") - 1
        return pd.Series(slots[at, 3] + (ranks.to_numpy(np.int64) - slots[at, 1]) // slots[at, 2])

    along = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("class", "bucket", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("ranks_before"))
    inside = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = known.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["class", "bucket"])
    placed = ranked.withColumn("sequence_id", F.pandas_udf(place, "long")(F.col("class"), F.col("rank") + F.col("ranks_before")))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank")
    total = F.sum("length").over(Window.partitionBy("sequence_id"))
    return placed.select(
        *pieces.columns, "sequence_id",
        F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.when(total.bitwiseAND(total - 1) == 0, total).otherwise(size).alias("padded"))


def pack(docs: DataFrame, size=SIZE, grid=GRID, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row a piece: where it lies in its document and in its sequence."""
    return assign(frozen(token_pieces(docs, size, vocabulary, ranks)), size, grid)


def token_sequences(docs: DataFrame, packed: DataFrame, size=SIZE, pad_id=0, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` (padded) and ``doc_ids``.

    For documents with unique ids. Ids are encoded again where a document's
    text is read and travel with the pieces to their sequence."""

    def cut(batches):
        encode = _encoder(vocabulary, ranks)
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = np.append(encode(text or ""), END_ID)
                rows += [(doc_id, start, ids[start : start + size].tolist()) for start in range(0, len(ids), size)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "ids"])

    ids = docs.select("doc_id", "text").mapInPandas(cut, "doc_id long, start long, ids array<int>")
    joined = packed.select("doc_id", "start", "sequence_id", "offset", "padded").join(ids, ["doc_id", "start"])
    grouped = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"), F.first("padded").alias("padded"))
    flat = F.flatten(F.col("parts.ids"))
    return grouped.select(
        "sequence_id", F.concat(flat, F.array_repeat(F.lit(pad_id), (F.col("padded") - F.size(flat)).cast("int"))).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def op1_packing(spark, sf_dir) -> DataFrame:
    """Contract query: every piece of every document and its place."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded")
