"""Operator 5: approximate nearest neighbours by an inverted multi-index.

1. Codebooks. Unit vectors are cut in two halves; k-means on a bounded sample
   (``SAMPLE`` rows by smallest hash of their ids) gives ``cells`` centroids a half. Pairs
   of them grow with the square root of the table's rows, from 1,024 to 65,536.
   Every row is indexed under its pair of nearest centroids.
2. Traversal. For each query a heap yields centroid pairs by growing sum of the
   two squared distances (the multi-sequence algorithm) until the pairs hold
   ``share`` of all rows. The share is fitted on the sample, the smallest at which
   ``recall`` of true neighbours there are reached: clustered data need little,
   directionless data much. Neighbours in the whole table lie nearer than in a
   sample, so the fitted share is on the safe side.
3. Reranking. Pairs are visited block by block: matrix products over the
   candidates of a block, then the exact cosine (double precision, original
   vectors) of the best ones, then the best of all blocks.

Ties. Equal vectors have equal cosines, so of each distinct vector only the
``k + 1`` smallest ids can be an answer; others leave before the index (a rank
limit that runs before the shuffle), which also disarms a very common vector.
Equal query vectors are searched once.

Scale. The index is dealt by first centroid and a hash of the id into blocks of
at most ``BLOCK`` rows; the queries that visit a centroid are dealt into blocks
too, so neither side of a group grows with the table. A row is copied once for every
``BLOCK`` queries that visit its centroid, a query once for every ``BLOCK`` rows of one:
that is the cost of vectors without directions, where the fitted share is large and a set of
queries that grows with the table costs its product with the rows, in blocks. The cells
that a query visits travel as bitmaps (8 KB a query at most). The driver gets the
sample (2 MB) and a count for each pair of centroids (at most 65,536 rows).

Defined results: vectors that are null, of another length than most, zero, or
that hold null or non-finite components take no part, nor do rows with a null
``vec_id``; rows repeated in full count once; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import table

SAMPLE = 8192
#: Fewest and most centroids a half; at the most, a centroid has 32 vectors of the sample.
FEWEST_CELLS, MOST_CELLS = 32, 256
BLOCK = 8192
PROBES = 512


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part (floats stay floats, other
    numbers become doubles)."""
    kind = "float" if embeddings.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    numbers = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = numbers.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    most = usable.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).select("length")
    return usable.join(F.broadcast(most), F.size("embedding") == F.col("length"), "left_semi")  # one row


def cells_for(rows: int) -> int:
    """Centroids a half for a table of ``rows`` rows: a power of two, its square about
    four times the square root of ``rows``."""
    cells = FEWEST_CELLS
    while cells < MOST_CELLS and cells**4 < 16 * rows:
        cells *= 2
    return cells


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(values) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in values], np.float64)


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0, (vectors**2).sum(1)[:, None] - 2 * vectors @ centroids.T + (centroids**2).sum(1)[None, :])


def k_means(vectors: np.ndarray, k: int, rounds=12, seed=0) -> np.ndarray:
    random = np.random.default_rng(seed)
    centroids = vectors[random.choice(len(vectors), min(k, len(vectors)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(vectors, centroids).argmin(1)
        for c in range(len(centroids)):
            own = nearest == c
            if own.any():
                centroids[c] = vectors[own].mean(0)
    return centroids


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Centroid pairs by growing ``first[i] + second[j]`` until they hold ``wanted`` rows."""
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, held, out = [(first[one[0]] + second[two[0]], 0, 0)], {(0, 0)}, 0, []
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        pair = (int(one[i]), int(two[j]))
        if counts[pair]:
            out.append(pair)
            held += counts[pair]
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[one[a]] + second[two[b]], a, b))
    return out


def fitted_share(sample: np.ndarray, codebooks, k: int, recall: float) -> float:
    """Smallest share of rows whose cells hold ``recall`` of the sample's true neighbours."""
    half = sample.shape[1] // 2
    first, second = _distances(sample[:, :half], codebooks[0]), _distances(sample[:, half:], codebooks[1])
    cell = first.argmin(1) * second.shape[1] + second.argmin(1)
    counts = np.bincount(cell, minlength=first.shape[1] * second.shape[1])
    probes = np.arange(min(PROBES, len(sample)))
    near = sample[probes] @ sample.T
    near[probes, probes] = -np.inf
    best = np.argsort(-near, axis=1, kind="stable")[:, :k]
    needed = []
    for q in probes:
        order = np.argsort((first[q][:, None] + second[q][None, :]).ravel(), kind="stable")
        before = np.empty(len(order))
        before[order] = np.cumsum(counts[order])
        needed += list(before[cell[best[q]]])
    return float(np.quantile(needed, recall) / len(sample)) if needed else 1.0


def nearest_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best ``k + 1`` rows of a block for each of its queries, exact cosines."""
    out = {"qid": [], "vec_id": [], "score": []}
    if len(queries) and len(rows):
        vectors, ids = _matrix(rows["embedding"]), rows["vec_id"].to_numpy()
        units, cell = _unit(vectors), rows["c2"].to_numpy()
        size = np.sqrt((vectors * vectors).sum(axis=1))
        for begin in range(0, len(queries), 256):
            part = queries.iloc[begin : begin + 256]
            asked = _matrix(part["embedding"])
            near = _unit(asked) @ units.T
            for r, cells in enumerate(part["cells"]):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(cells, np.uint8))[cell])
                take = min(len(at), 4 * (k + 1))
                if not take:
                    continue
                at = at[np.argpartition(-near[r, at], take - 1)[:take]]
                dot = (vectors[at] * asked[r]).sum(axis=1)
                score = dot / (np.sqrt((asked[r] * asked[r]).sum()) * size[at])
                best = np.lexsort((ids[at], -score))[: k + 1]
                out["qid"] += [part["qid"].iloc[r]] * len(best)
                out["vec_id"] += ids[at][best].tolist()
                out["score"] += score[best].tolist()
    return pd.DataFrame(out).astype({"qid": "int64", "vec_id": "int64", "score": "float64"})


def search(embeddings: DataFrame, queries: DataFrame, k=5, cells: int | None = None, recall=0.97, share: float | None = None) -> DataFrame:
    """The ``k`` nearest rows found of each row of ``queries`` (vec_id, embedding),
    other than itself: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    vectors = usable_vectors(embeddings)
    asked = usable_vectors(queries).distinct()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = [r.embedding for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()]
    if not sample:
        return empty
    points = _unit(_matrix(sample))
    half = points.shape[1] // 2
    cells = cells or cells_for(vectors.count())
    codebooks = k_means(points[:, :half], cells), k_means(points[:, half:], cells)
    width = len(codebooks[1])
    visited = share if share is not None else fitted_share(points, codebooks, k, recall)

    def cell_of(batch: pa.Array) -> pa.Array:
        units = _unit(_matrix(batch.to_pylist())) if len(batch) else np.zeros((0, points.shape[1]))
        return pa.array((_distances(units[:, :half], codebooks[0]).argmin(1) * width + _distances(units[:, half:], codebooks[1]).argmin(1)).astype(np.int32), pa.int32())

    same = Window.partitionBy("embedding").orderBy("vec_id")
    distinct = vectors.withColumn("copy", F.dense_rank().over(same)).where(F.col("copy") <= k + 1).select("embedding", "vec_id").distinct()
    cell = F.arrow_udf(cell_of, "int")(F.col("embedding"))
    index = distinct.withColumn("cell", cell).withColumns({"c1": F.floor(F.col("cell") / width).cast("int"), "c2": F.col("cell") % width})
    counts = np.zeros((len(codebooks[0]), width), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():  # at most cells * cells rows
        counts[r.c1, r.c2] = r["count"]
    wanted = max(64 * k, visited * counts.sum())

    def pairs(batch: pa.Array) -> pa.Array:
        out = []
        for vector in batch.to_pylist():
            unit = _unit(_matrix([vector]))
            visits = np.zeros(counts.shape, bool)
            for pair in traverse(_distances(unit[:, :half], codebooks[0])[0], _distances(unit[:, half:], codebooks[1])[0], counts, wanted):
                visits[pair] = True
            maps = np.packbits(visits, axis=1)
            out.append([{"c1": int(i), "cells": maps[i].tobytes()} for i in np.flatnonzero(visits.any(axis=1))])
        return pa.array(out, pa.list_(pa.struct([("c1", pa.int32()), ("cells", pa.binary())])))

    once = asked.groupBy("embedding").agg(F.min("vec_id").alias("qid"))
    probes = once.withColumn("pair", F.explode(F.arrow_udf(pairs, "array<struct<c1:int,cells:binary>>")(F.col("embedding"))))
    probes = probes.select("qid", "embedding", F.col("pair.c1").alias("c1"), F.col("pair.cells").alias("cells"))
    rows_of = counts.sum(1)
    blocks = F.element_at(F.array(*[F.lit(int(max(1, -(-n // BLOCK)))) for n in rows_of]), F.col("c1") + 1)
    deals = {r.c1: -(-r["count"] // BLOCK) for r in probes.groupBy("c1").count().collect()}  # one row a centroid
    query_blocks = F.element_at(F.array(*[F.lit(int(deals.get(c, 1))) for c in range(len(rows_of))]), F.col("c1") + 1)
    dealt_rows = index.withColumns({"block": F.pmod(F.xxhash64("vec_id"), blocks).cast("int"), "deal": F.explode(F.sequence(F.lit(0), query_blocks - 1))})
    dealt_probes = probes.withColumns({"deal": F.pmod(F.xxhash64("qid"), query_blocks).cast("int"), "block": F.explode(F.sequence(F.lit(0), blocks - 1))})
    keys = ("c1", "block", "deal")
    found = dealt_probes.groupBy(*keys).cogroup(dealt_rows.groupBy(*keys)).applyInPandas(
        lambda asked_here, rows: nearest_in_block(asked_here, rows, k), "qid long, vec_id long, score double")
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = best.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))  # k + 1 entries
    members = asked.withColumnRenamed("vec_id", "query_id").join(once, "embedding").select("query_id", "qid")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    answers = members.join(lists, "qid").select("query_id", F.posexplode(others).alias("at", "hit"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def op5_multi_index(spark, sf_dir) -> DataFrame:
    """Contract query: 5 nearest of every row whose id is divisible by 50."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(embeddings, embeddings.where(F.col("vec_id") % 50 == 0))
