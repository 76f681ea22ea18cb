"""Operator 9: exact n-gram Jaccard self-join by token-combination prefixes.

A document's tokens are its distinct ``width``-word shingles (64-bit hashes).
Documents with equal sets form a class; one node a class takes part in the join.

Order and classes of tokens. Occurrences are counted over all documents in
2^22 hashed counters. A token's level is the logarithm of its counter's excess
over the usual one; tokens are ordered by level, then hash, so rare ones come
first. Tokens from ``FREQUENT`` on form the frequent class.

Signatures. If ``x`` is linked with any other set, it keeps at least
``need = ceil(t |x|)`` of its tokens, so it can lose ``|x| - need``. A rare token is
a signature by itself; frequent tokens are dealt into small partitions by hash
and every pair of them in a partition is one. A prefix is extended until its
rare tokens plus, for each partition, its frequent tokens less one come to
``|x| - need + 1``: two linked sets then share a signature. Partitions follow
the band of sizes (powers of two); a set that may be linked into the next band
gets that band's signatures too.

Candidates. The nodes of a signature are ordered by size and cut into runs
wherever sizes are too different to be linked. Runs up to ``RUN`` nodes give
their pairs (bounded), made distinct. The counters are of fixed size, so in a
large corpus they can take a token for rare that many sets hold; its run tells:
two sets that no shorter run pairs share a long one. The nodes of long runs are
therefore signed again, the tokens that more than ``RUN`` of them hold, counted
exactly, now in the frequent class (a bitmap that marks too many only makes more
combinations): no single token makes a long run any more. Runs that stay long
(large groups of near copies) never give pairs as rows: their nodes are clustered,
clusters are split into bands of sizes, as sets two bands apart cannot be linked,
and bands into blocks bounded in documents and tokens; each pair of blocks of one
band or two neighbours is one group in which a matrix product counts all overlaps
at once and returns at most one link a node. Pairs inside a cluster are left to it.

Verification. Pairs first meet an exact upper bound: a bitmap of about one bit
a token, where ``|x and y| <= common bits + tokens of x beyond its bits``. The sets
of what remains are computed again from the texts of the nodes concerned (a
bounded bitmap of ids prunes the scan) and intersected. No text is shuffled.

Components follow from the links by star contraction.

Defined results: null and empty texts have 0 shingles and are linked with
nothing (their component is their own id); rows repeated in full, or with
equal sets, share a component; rows that share a ``doc_id`` are one document for
linking; a null ``doc_id`` is never a component's name, it only joins one;
empty tables give no rows; columns other than the two named ones are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lastmile.llm import counters, words
from lastmile.llm.common import frozen, table, trimmed
from lastmile.llm.components import components

#: Bits of the hashed token counters.
COUNTER_BITS = 22
#: Level (twice the binary logarithm of the excess) from which a token is frequent.
FREQUENT = 16
#: Nodes of a run up to which its pairs become rows.
RUN = 64
#: Documents and tokens of a block.
BLOCK_DOCS, BLOCK_TOKENS = 512, 500_000
#: Bits of the filters: of ids before texts are read again, of tokens to be taken for frequent.
FILTER_BITS = 23
#: A block's number in its band, below the band's number, in one long.
BAND_SHIFT = 32

SIGNED = "doc_id long, n long, c1 long, c2 long, sigs array<long>, sketch array<long>"


def _tokens(texts: pa.Array, width: int):
    """For each span of texts: its rows, and (token, row) pairs, repeats included."""
    for span in words.spans(texts):
        yield span, *words.shingles(span.hashes(), span.doc, width)


def token_levels(docs: DataFrame, width: int) -> np.ndarray:
    """Level of each counter (one byte each, 4 MB): all documents are counted."""

    def count(batches):
        counts = np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in batches:
            for _, token, _ in _tokens(batch.column(0), width):
                np.add.at(counts, (token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), np.uint32(1))
        yield counters.parts_of(counts)

    totals = counters.total(docs.select("text").mapInArrow(trimmed(count), counters.SCHEMA), 1 << COUNTER_BITS)
    usual = np.median(totals)
    excess = np.maximum(0, totals - (usual + 3 * np.sqrt(usual)))
    return np.floor(2 * np.log2(1 + excess)).astype(np.uint8)


def _ordered(token: np.ndarray, doc: np.ndarray, levels: np.ndarray):
    """Distinct tokens of each document, in order of level and hash."""
    level = levels[(token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    order = np.lexsort((token, level, doc))
    token, level, doc = token[order], level[order], doc[order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    return token[keep], level[keep], doc[keep]


def need(n, num: int, den: int):
    """Fewest tokens that a set of ``n`` shares with any set it is linked with."""
    return -(-num * n // den)


def combinations(token: np.ndarray, level: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of one set with frequent tokens in its prefix (tokens in order)."""
    n = len(token)
    lose = n - int(need(n, num, den))
    band = n.bit_length() - 1
    out = set()
    for b in (band, band + 1):
        if b > band and num * (1 << b) > den * n:
            break  # no larger partner reaches that band
        partitions = max(1, (1 << b) * (den - num) // (2 * den))
        held: dict[int, list[int]] = {}
        credit = 0
        for x, rank in zip(token.tolist(), level.tolist()):
            if credit > lose:
                break
            if rank < FREQUENT:
                out.add(x)
                credit += 1
                continue
            part = held.setdefault((x >> 7) % partitions, [])
            for y in part:
                out.add(_pair(y, x, b))
            credit += bool(part)
            part.append(x)
    return np.array(sorted(out), np.uint64)


def _pair(a: int, b: int, band: int) -> int:
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + band) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return x ^ x >> 27


def sketch(token: np.ndarray) -> np.ndarray:
    """Bitmap of a set: a power of two of bits, about one a token, 64 at least."""
    bits = 1 << max(6, len(token).bit_length() - 1)
    at = np.unique(token & np.uint64(bits - 1))
    out = np.zeros(bits >> 6, np.uint64)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def signatures(token: np.ndarray, level: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of one set (tokens in order)."""
    take = len(token) - int(need(len(token), num, den)) + 1
    return token[:take] if level[take - 1] < FREQUENT else combinations(token, level, num, den)


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(flat)))


def _sets(texts: pa.Array, width: int, levels: np.ndarray):
    """(row, tokens, levels) of each text that has any."""
    for _, token, doc in _tokens(texts, width):
        if not len(token):
            continue
        token, level, doc = _ordered(token, doc, levels)
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        for at, end in zip(first, np.append(first[1:], len(doc))):
            yield int(doc[at]), token[at:end], level[at:end]


def _class_of(token: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set, whatever the order."""
    return tuple(int(x) for x in _signed([words.mixed(token).sum(dtype=np.uint64), words.mixed(token ^ np.uint64(words.BASE)).sum(dtype=np.uint64)]))


def signed_documents(docs: DataFrame, levels: np.ndarray, width: int, num: int, den: int) -> DataFrame:
    """Size, class, signatures and bitmap of every document."""
    packed = zlib.compress(levels.tobytes(), 1)

    def sign(batches):
        level_of = np.frombuffer(zlib.decompress(packed), np.uint8)
        for batch in batches:
            rows = batch.num_rows
            n, c1, c2 = (np.zeros(rows, np.int64) for _ in range(3))
            none = np.zeros(0, np.uint64)
            sigs, maps = [none] * rows, [none] * rows
            for row, token, level in _sets(batch.column(1), width, level_of):
                n[row] = len(token)
                c1[row], c2[row] = _class_of(token)
                maps[row] = sketch(token)
                sigs[row] = signatures(token, level, num, den)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(c1), pa.array(c2), _lists(sigs), _lists(maps)],
                names=["doc_id", "n", "c1", "c2", "sigs", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(sign), SIGNED)


def _linkable(a: str, b: str, num: int, den: int):
    """Sizes that allow a link."""
    return F.least(a, b) * den >= F.greatest(a, b) * num


def _runs(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(run key, node, n, run size) of all runs with more than one node."""
    signs = nodes.select(F.explode("sigs").alias("sig"), "node", "n")
    order = Window.partitionBy("sig").orderBy("n", "node")
    cut = (F.col("n") * num > F.lag("n").over(order) * den).cast("int")
    cut = signs.withColumn("cut", F.coalesce(cut, F.lit(0)))
    numbered = cut.withColumn("run", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    of = Window.partitionBy("sig", "run")
    sized = numbered.withColumns({"size": F.count("*").over(of), "pivot": F.min("node").over(of)})
    return sized.where("size > 1").select("sig", "run", "node", "n", "size", "pivot")


def _folded(x, y):
    """Bitmap ``x``, folded to the length of ``y`` where it is longer."""

    def word(_, i):
        layers = F.sequence(F.lit(0), (F.size(x) / F.size(y)).cast("int") - 1)
        return F.aggregate(layers, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseOR(F.get(x, i + k * F.size(y))))

    return F.when(F.size(x) > F.size(y), F.transform(F.slice(x, F.lit(1), F.size(y)), word)).otherwise(x)


def _bound(a, b, na, nb):
    """Upper bound of the overlap of two sets from their bitmaps."""
    fa, fb = _folded(a, b), _folded(b, a)

    def ones(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda total, bits: total + F.bit_count(bits))

    both = ones(F.zip_with(fa, fb, lambda x, y: x.bitwiseAND(y)))
    return both + F.least(na - ones(fa), nb - ones(fb))


def _filter(hashes: DataFrame) -> np.ndarray:
    """Bitmap of the last ``FILTER_BITS`` bits of a column ``hash`` (1 MB): what it lacks is surely not there."""
    at = F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    rows = hashes.select(F.shiftright(at, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    held = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most 2^17 rows
        held[r.word] = r.bits
    return held.view(np.uint64)


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the hashes (unsigned)."""
    at = hashes & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _node_sets(docs: DataFrame, wanted: DataFrame, nodes: DataFrame, levels: np.ndarray, width: int) -> DataFrame:
    """Token sets of the wanted nodes, from their documents' texts."""
    held = zlib.compress(_filter(wanted.select(F.xxhash64("node").alias("hash"))).tobytes(), 1)

    def read(batches):
        bits = np.frombuffer(zlib.decompress(held), np.uint64)
        plain = np.zeros(1 << COUNTER_BITS, np.uint8)
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            some = batch.take(pa.array(np.flatnonzero(_held(bits, at))))
            found = list(_sets(some.column(1), width, plain))
            c = [_class_of(t) for _, t, _ in found]
            yield pa.RecordBatch.from_arrays(
                [some.column(0).take(pa.array([r for r, _, _ in found], pa.int64())), pa.array([x for x, _ in c], pa.int64()), pa.array([x for _, x in c], pa.int64()), _lists([t for _, t, _ in found])],
                names=["node", "c1", "c2", "tokens"])

    read_back = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("doc_id").alias("at")).mapInArrow(trimmed(read), "node long, c1 long, c2 long, tokens array<long>")
    named = nodes.select("node", "c1", "c2").join(wanted.select("node").distinct(), "node", "left_semi")
    return frozen(read_back.join(named, ["node", "c1", "c2"], "left_semi"))


def signed_again(sets: DataFrame, levels: np.ndarray, num: int, den: int) -> DataFrame:
    """Signatures of nodes with the tokens that more than ``RUN`` of them hold in the frequent class."""
    packed = zlib.compress(levels.tobytes(), 1)
    usual = sets.select(F.explode("tokens").alias("hash")).groupBy("hash").count().where(F.col("count") > RUN)
    crowded = zlib.compress(_filter(usual).tobytes(), 1)

    def sign(batches):
        level_of = np.frombuffer(zlib.decompress(packed), np.uint8)
        bits = np.frombuffer(zlib.decompress(crowded), np.uint64)
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
            sigs = []
            for at, end in zip(ends[:-1], ends[1:]):
                token = flat[at:end]
                level = level_of[(token >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                level = np.where(_held(bits, token), np.maximum(level, FREQUENT), level)
                order = np.lexsort((token, level))
                sigs.append(signatures(token[order], level[order], num, den))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int64)), _lists(sigs)], names=["node", "n", "sigs"])

    return sets.select("node", "tokens").mapInArrow(trimmed(sign), "node long, n long, sigs array<long>")


def block_links(frame: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links between the documents of two blocks that suffice to connect them.

    Overlaps are products of 0/1 matrices over the tokens that at least two of
    the documents hold, some columns at a time."""
    frame = frame.drop_duplicates("node").reset_index(drop=True)
    sets = [np.asarray(t, np.int64) for t in frame["tokens"]]
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    left = np.flatnonzero(frame["side"].to_numpy() == 0)
    right = np.flatnonzero(frame["side"].to_numpy() == 1)
    right = right if len(right) else left
    overlap = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [begin, begin + width]))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[at], column[at] - begin] = 1
        overlap += held[left] @ held[right].T
    linked = den * overlap >= num * (n[left][:, None] + n[right][None, :] - overlap)
    root = np.arange(len(sets))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(linked)):
        x, y = find(left[i]), find(right[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((frame["node"][left[i]], frame["node"][right[j]]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _cluster_links(sets: DataFrame, clusters: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside the clusters of long runs, block pair by block pair.

    Sizes of linked sets are within a factor of ``den / num``, so they lie in the same
    band or in neighbours (bands are a little wider than that, against rounding)."""
    band = F.floor(F.log(F.col("n").cast("double")) / (math.log(den / num) * (1 + 1e-9))) if num < den else F.col("n")
    counted = clusters.join(sets.select("node", F.size("tokens").alias("n")), "node").withColumn("band", band.cast("long"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("long")
    sizes = counted.groupBy("cluster", "band").agg(blocks.alias("blocks"))
    near = sizes.select("cluster", F.col("band").alias("beside"), F.col("blocks").alias("many"))
    around = sizes.select("cluster", "band", "blocks", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("beside")).join(near, ["cluster", "beside"])
    partners = around.groupBy("cluster", "band", "blocks").agg(*[
        F.coalesce(F.max(F.when(F.col("beside") == F.col("band") + k, F.col("many"))), F.lit(0)).alias(f"many{k + 1}") for k in (-1, 0, 1)])

    def codes(k):
        first = F.shiftleft(F.col("band") + k, BAND_SHIFT)
        many = F.col(f"many{k + 1}")
        return F.when(many > 0, F.sequence(first, first + many - 1)).otherwise(F.array().cast("array<long>"))

    # nodes learn the numbers of blocks without their sets, which are only dealt by node
    named = counted.drop("n").join(partners, ["cluster", "band"])
    block = F.shiftleft(F.col("band"), BAND_SHIFT) + F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = sets.join(named, "node").withColumn("block", block)
    partner = dealt.withColumn("other", F.explode(F.concat(codes(-1), codes(0), codes(1))))
    grouped = partner.select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "tokens")
    return grouped.groupBy("cluster", "i", "j").applyInPandas(
        lambda frame: block_links(frame, num, den), "a long, b long")


def _pairs(runs: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs of nodes (a, b, sizes na, nb) of the short runs."""
    short = runs.where(F.col("size") <= RUN)
    left, right = (short.select("sig", "run", F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    joined = left.join(right, ["sig", "run"]).where(F.col("a") < F.col("b")).where(_linkable("na", "nb", num, den))
    return joined.select("a", "b").distinct()


def jaccard_links(docs: DataFrame, width=4, num=85, den=100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every document's size and class, its nodes, and links that connect them.

    ``(signed, nodes, links)``: ``signed`` has a row a document (doc_id, n, c1,
    c2), ``nodes`` a row a class (node: smallest doc_id), ``links`` verified
    pairs of nodes, enough of them to connect all that are linked."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = token_levels(docs, width)
    signed = frozen(signed_documents(docs, levels, width, num, den))
    classes = signed.where("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("node")).where("node is not null")
    nodes = signed.withColumnRenamed("doc_id", "node").join(classes, ["c1", "c2", "node"], "left_semi").where("n > 0")
    runs = frozen(_runs(nodes, num, den))
    pairs = _pairs(runs, num, den)
    maps = nodes.select("node", "n", "sketch")
    for x in "ab":
        pairs = pairs.join(maps.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"m{x}")), x)
    most = F.least(_bound(F.col("ma"), F.col("mb"), F.col("na"), F.col("nb")), F.col("na"), F.col("nb"))
    pairs = frozen(pairs.where(most * den >= (F.col("na") + F.col("nb") - most) * num).select("a", "b").distinct())
    crowded = frozen(runs.where(F.col("size") > RUN).select("node").distinct())
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(crowded)
    sets = _node_sets(docs, wanted, nodes, levels, width)
    again = frozen(_runs(signed_again(sets.join(crowded, "node", "left_semi"), levels, num, den), num, den))
    clusters = frozen(components(again.where(F.col("size") > RUN).select(F.col("node").alias("a"), F.col("pivot").alias("b"))).withColumnRenamed("component", "cluster"))
    checked = pairs.unionByName(_pairs(again, num, den)).distinct()
    for x in "ab":
        checked = checked.join(clusters.select(F.col("node").alias(x), F.col("cluster").alias(f"c{x}")), x, "left")
    checked = checked.where("ca is null or cb is null or ca <> cb").select("a", "b")
    for x in "ab":
        checked = checked.join(sets.select(F.col("node").alias(x), F.col("tokens").alias(f"t{x}")), x)
    common = F.size(F.array_intersect("ta", "tb"))
    checked = checked.where(common * den >= (F.size("ta") + F.size("tb") - common) * num).select("a", "b")
    return signed, nodes, checked.unionByName(_cluster_links(sets, clusters, num, den))


def jaccard_components(docs: DataFrame, width=4, num=85, den=100) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document."""
    signed, _, links = jaccard_links(docs, width, num, den)
    labels = components(links)
    classes = signed.where("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("node"))
    named = classes.join(labels, "node", "left").select(
        F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.coalesce("component", "node").alias("component_id"))
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "c1", "c2")
    joined = rows.join(named, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: component of every document at 85 % of 4-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"))
