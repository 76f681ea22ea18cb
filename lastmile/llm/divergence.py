"""Operator 12: source divergence audit by hash-consed segment trees.

Within a language, how far does each source's use of words lie from every other
source's, and which words make up its distance to the language as a whole? Of the
words that at least ``min_docs`` documents of the language hold, a group (a source
of a language, or the language) with ``N`` occurrences of ``V`` kept words gives each the
share ``p = 1 + floor(10^9 (count + 1) / (N + V))``; a word's price against shares ``q`` is
``floor((p - q)^2 / q)``. All arithmetic is in integers.

1. Counting. Arrow batches are cut into words as byte ranges and encoded by an
   exact dictionary, so Python sees no single word; each batch hands on a count and a
   number of documents for each (language, source, word), added up by Spark.
2. Trees. A language's words are dealt into slabs of about ``SLAB`` term ids; within
   a slab ids go by falling frequency, so that words with like counts (the many rare
   ones above all) are neighbours. A group's counts over a slab are the leaves of
   a segment tree. Nodes are hash-consed: leaves with equal counts are one node, and so
   are nodes with equal children, across positions and groups.
3. Traversal. Two groups' trees are walked together, level by level: the frontier
   holds the distinct pairs of nodes with the number of places where they meet.
   A pair is expanded, and at the leaves priced, once for all of them.
4. The slabs' sums are added up by Spark, and ranked by group.

Scale. A slab's groups are dealt into blocks of at most ``GROUPS``, and each pair of
blocks is one group of rows: at most ``2 * GROUPS * SLAB`` counts, whatever the
vocabulary and the number of sources. Frequent words and large sources cost a row
a batch before counting. Words that divide a group from its language are ranked
by a window that keeps ``top`` rows a group before it shuffles. The result holds one row a
pair of sources, as the audit asks for.

Defined results: null ``text``, ``lang`` and ``source`` are read as ''; rows repeated in
full are documents of their own; a group without words has count 0 for each kept
word; with no kept word all pairs have value 0; a language with one source has no
pairs; ties go to the smaller item in UTF-8; empty tables give no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import scratch, table, trimmed
from lastmile.llm.words import LOWER

#: Bytes of text that are counted at once, term ids of a slab, groups of a block.
SPAN, SLAB, GROUPS = 4 << 20, 2048, 64
SCALE = 1_000_000_000
COUNTS = "lang string, source string, term string, n long, docs long"

#: Bytes that a word may hold: ASCII letters and all of other code points.
_WORD = np.zeros(256, bool)
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, A-Z lower-cased, as one array, and the text each is of."""
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8)[bounds[0] : bounds[-1]] if values is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]])
    first, end = np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))
    kept = LOWER[data[inside[:-1]]]
    ends = np.concatenate([[0], np.cumsum(end - first)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(kept))
    return words, np.searchsorted(bounds, first, side="right") - 1


def _count_span(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences and documents of each (language, source, word) of a batch."""
    words, of = _pieces(batch.column("text").cast(pa.large_string()))
    names = [pc.dictionary_encode(batch.column(c).cast(pa.string())) for c in ("lang", "source")]
    coded = pc.dictionary_encode(words)
    terms, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(terms))
    in_doc, n = np.unique(of * size + codes, return_counts=True)
    doc, code = in_doc // size, in_doc % size
    group = names[0].indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(names[1].dictionary)) + names[1].indices.to_numpy(zero_copy_only=False)
    keys, at, docs = np.unique(group[doc] * size + code, return_inverse=True, return_counts=True)
    total = np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)
    sources = max(1, len(names[1].dictionary))
    return pa.RecordBatch.from_arrays(
        [names[0].dictionary.take(pa.array(keys // size // sources)), names[1].dictionary.take(pa.array(keys // size % sources)),
         terms.take(pa.array(keys % size)).cast(pa.string()), pa.array(total), pa.array(docs.astype(np.int64))],
        names=["lang", "source", "term", "n", "docs"])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``COUNTS`` of batches (lang, source, text), in spans of about ``SPAN`` bytes."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)) if len(batch) else np.zeros(0, np.int64)
        begin = 0
        while begin < len(batch):
            done = size[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(size, done + SPAN, side="right")))
            yield _count_span(batch.slice(begin, stop - begin))
            begin = stop


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``p`` of counts in a group with ``total`` occurrences of ``kept`` words, exact."""
    if len(counts) and int(counts.max()) >= 9 * 10**9 - 1:  # beyond a 64-bit product
        return np.array([1 + SCALE * (int(c) + 1) // (total + kept) for c in counts], np.int64)
    return 1 + SCALE * (counts.astype(np.int64) + 1) // (total + kept)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Forest:
    """Hash-consed segment trees of several groups over the same term ids.

    ``counts``: a row a group. Leaves of equal counts are one node; the last one,
    ``absent``, fills up to a power of two and costs nothing. ``levels``: for each
    level above the leaves the (left, right) children of its nodes."""

    def __init__(self, counts: np.ndarray):
        groups, width = counts.shape
        self.counts, nodes = np.unique(counts, return_inverse=True)
        self.absent = len(self.counts)
        full = 1 << max(0, int(width - 1).bit_length())
        row = np.full((groups, full), self.absent, np.int64)
        row[:, :width] = nodes.reshape(groups, width)
        self.levels = []
        while row.shape[1] > 1:
            pairs, nodes = np.unique(row[:, 0::2] << 32 | row[:, 1::2], return_inverse=True)
            self.levels.append((pairs >> 32, pairs & 0xFFFFFFFF))
            row = nodes.reshape(groups, -1)
        self.roots = row[:, 0]

    def meetings(self, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of leaves at which the tree of group ``one`` meets those of
        ``others``: the other's place, both leaves and how often they meet."""
        place, a, b, often = np.arange(len(others)), np.full(len(others), self.roots[one]), self.roots[others], np.ones(len(others), np.int64)
        for left, right in reversed(self.levels):
            place, often = np.concatenate([place, place]), np.concatenate([often, often])
            a, b = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
            # a pair of nodes that meets in several places goes on as one
            n_a, n_b = int(a.max()) + 1, int(b.max()) + 1
            keys, at = np.unique((place * n_a + a) * n_b + b, return_inverse=True)
            often = np.bincount(at, weights=often, minlength=len(keys)).astype(np.int64)
            place, a, b = keys // n_b // n_a, keys // n_b % n_a, keys % n_b
        return place, a, b, often


def divergence_of_slab(key: tuple, counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sum of prices over a slab's terms, for each ordered pair of a block pair's groups."""
    lang, _, first, second = key
    groups = groups.sort_values("source")
    names = list(groups["source"])
    rows = {name: r for r, name in enumerate(names)}
    by_term = counts.groupby("term")["n"].sum().sort_values(ascending=False, kind="stable")
    matrix = np.zeros((len(names), int(groups["width"].iloc[0])), np.int64)  # the last ids: words of other blocks alone
    ids = pd.Series(np.arange(len(by_term)), index=by_term.index)
    matrix[counts["source"].map(rows).to_numpy(np.int64), ids.loc[counts["term"]].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    kept = groups["kept"].to_numpy()
    here = np.flatnonzero(groups["block"].to_numpy() == first), np.flatnonzero(groups["block"].to_numpy() == second)
    out = {"source": [], "item": [], "value": []}
    forest = Forest(matrix) if matrix.shape[1] else None
    table_ = np.array([shares(forest.counts, int(n), int(v)) for n, v in zip(groups["total"], kept)]) if forest else None
    for one in here[0]:
        others = here[1][here[1] != one]
        value = np.zeros(len(others), np.int64)
        if forest and len(others):
            place, a, b, often = forest.meetings(one, others)
            real = (a != forest.absent) & (b != forest.absent)
            place, a, b, often = place[real], a[real], b[real], often[real]
            np.add.at(value, place, price(table_[one][a], table_[others[place], b]) * often)
        out["source"] += [names[one]] * len(others)
        out["item"] += [names[o] for o in others]
        out["value"] += value.tolist()
    texts = {c: np.array(out[c], object) for c in ("source", "item")}
    return pd.DataFrame({"lang": np.full(len(out["value"]), lang, object), **texts, "value": np.array(out["value"], np.int64)})


def audit(docs: DataFrame, min_docs=3, top=200) -> DataFrame:
    """The audit of ``docs`` (text, lang, source): ``lang``, ``source``, ``part``, ``item``,
    ``value``, ``rank``. Part ``pair``: every other source of the language; part ``term``:
    the ``top`` words that a source uses more than its language."""
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    path = scratch(spark, "words")
    read.mapInArrow(trimmed(count_words), COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).write.parquet(f"{path}/all")
    every = spark.read.schema(COUNTS).parquet(f"{path}/all")
    every.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs").write.parquet(f"{path}/terms")
    terms = spark.read.schema("lang string, term string, lang_n long").parquet(f"{path}/terms")
    every.drop("docs").join(terms, ["lang", "term"]).write.parquet(f"{path}/kept")
    counts = spark.read.schema("lang string, term string, source string, n long, lang_n long").parquet(f"{path}/kept")

    # one row a group: its occurrences, its language's, and the words kept there
    named = read.select("lang", "source").distinct()
    totals = named.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    numbered = totals.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = numbered.join(sizes, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
    groups = groups.withColumns({"block": F.floor(F.col("at") / GROUPS).cast("int"), "slabs": F.greatest(F.lit(1), F.ceil(F.col("kept") / SLAB)).cast("int")})
    groups.withColumn("blocks", F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1) / GROUPS + 1).cast("int")).drop("at").write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")

    # every pair of blocks that a group belongs to, in every slab of its language
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = F.array_distinct(F.array(F.struct(F.col("block").alias("first"), F.col("other").alias("second")), F.struct(F.col("other").alias("first"), F.col("block").alias("second"))))

    def in_blocks(frame: DataFrame) -> DataFrame:
        return frame.withColumn("other", other).withColumn("pair", F.explode(pairs)).withColumns({"first": F.col("pair.first"), "second": F.col("pair.second")}).drop("other", "pair")

    slab = F.pmod(F.xxhash64("term"), F.col("slabs")).cast("int")
    of_lang = groups.select("lang", "slabs").distinct()
    widths = terms.join(of_lang, "lang").groupBy("lang", slab.alias("slab")).agg(F.count(F.lit(1)).alias("width"))
    every_slab = groups.withColumn("slab", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)))
    placed = in_blocks(every_slab.join(widths, ["lang", "slab"], "left").fillna(0, ["width"]))
    slabs = in_blocks(counts.join(groups.select("lang", "source", "block", "blocks", "slabs"), ["lang", "source"]).withColumn("slab", slab))
    keys = ("lang", "slab", "first", "second")
    sums = slabs.select(*keys, "source", "term", "n").groupBy(*keys).cogroup(placed.select(*keys, "source", "block", "total", "kept", "width").groupBy(*keys)).applyInPandas(
        divergence_of_slab, "lang string, source string, item string, value long")
    pair = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    def share(n: str, total: str):
        return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(19,0)) div cast({total} + kept as decimal(19,0))")

    priced = counts.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("lang_n", "lang_total")})
    term = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"), F.lit("term").alias("part"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top), pair.withColumn("rank", F.row_number().over(best))]
    return ranked[1].unionByName(ranked[0]).select("lang", "source", "part", "item", "value", "rank")


def op12_divergence(spark, sf_dir) -> DataFrame:
    """Contract query: the audit of all ``documents``."""
    return audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP12_SQL = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), words as (
  select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term, count(*) as n from words group by lang, term having count(distinct row) >= 3
), sizes as (
  select lang, count(*) as v, sum(n) as total from kept group by lang
), groups as (
  select distinct lang, source from docs
), counted as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term
), totals as (
  select lang, source, coalesce(sum(n), 0) as total from groups left join counted using (lang, source) group by lang, source
), shares as (
  select lang, source, term, coalesce(counted.n, 0) as n,
         1 + cast(1000000000 as hugeint) * (coalesce(counted.n, 0) + 1) // (totals.total + v) as p,
         1 + cast(1000000000 as hugeint) * (kept.n + 1) // (sizes.total + v) as q
  from totals join sizes using (lang) join kept using (lang) left join counted using (lang, source, term)
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every_pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
), terms as (
  select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // q as bigint) as value from shares where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from (select * from every_pair union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""
