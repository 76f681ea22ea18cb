"""Operator 13: exact top-k inner-product search by MaxScore over shards.

A vector's component ``x`` becomes ``floor(scale * x)``. Every coordinate gives
two terms, one for positive and one for negative components; a term's postings
list the rows of a pack with such a component and its size (the impact). A query
uses, of each coordinate, the term of its own sign, weighted by its component:
that term adds to a score, the coordinate's other term takes away.

1. Bounds. A term adds at most ``weight * largest impact in the pack``.
2. Split. Terms are ordered by that bound. Those whose bounds together stay below
   the threshold (the k-th best score known) are non-essential: a row in
   none of the others' postings cannot be an answer.
3. Traversal. The essential terms' postings are added up; rows that cannot reach
   the threshold with all other bounds leave, then the essential coordinates'
   deductions are taken from the rest.
4. Probing. Non-essential coordinates are looked up one after the other, largest
   bound first, for the rows that still compete; what is left has its exact score.
5. Merging. A shard's packs hand the threshold on; the shards' best are
   merged by a window that keeps ``k`` rows a query before it shuffles.

The first threshold of a query is its k-th best score among ``SEEDS`` rows of the
table, which bounds the answer from below wherever a shard lies. Rows are dropped
only below a threshold, never at it, so ties are complete and results exact.

Scale. Packing, shards and query blocks: see ``vector_packs``. Queries are
searched against all rows in blocks, so the work is their product at worst;
thresholds cut it by what the bounds allow. Vectors without common directions
have near equal bounds and are pruned late, clustered ones early.

Defined results: as in ``vector_packs``; scores tie to the smaller ``vec_id``; a
query's own id is never its answer; fewer than ``k`` candidates give all of them;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import table
from lastmile.llm.vector_packs import Rows, asked_rows, best, meet, number_type, packs, seeds


class Postings:
    """Postings of a pack: for each coordinate and sign the rows and their impacts."""

    def __init__(self, rows: Rows, number: type):
        self.ids, self.values = rows.ids, rows.matrix.astype(number)
        self.lists = [[(at, np.abs(column[at])) for at in (np.flatnonzero(column > 0), np.flatnonzero(column < 0))] for column in self.values.T]
        zero = np.zeros(self.values.shape[1], number)
        self.most = np.array([self.values.max(axis=0, initial=0), -self.values.min(axis=0, initial=0)]) if len(self.values) else np.array([zero, zero])
        #: Bounds are sums of doubles; beyond 2^52 they may be off by rounding.
        self.slack = 0.0 if number is np.float64 else 4096.0

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows with a score of at least ``floor``."""
        sign = (query < 0).astype(int)
        bound = np.abs(query).astype(np.float64) * self.most[sign, np.arange(len(query))] * (1 + 1e-12)
        order = np.argsort(bound, kind="stable")
        together = np.cumsum(bound[order])
        floor -= self.slack
        split = int(np.searchsorted(together, floor, side="left")) if floor > 0 else 0
        if split == len(order):
            return self.ids[:0], self.values[:0, 0]
        essential, others = order[split:], order[:split][::-1]
        rest = together[split - 1] if split else 0.0
        score = np.zeros(len(self.ids), self.values.dtype)
        for t in essential:
            at, impact = self.lists[t][sign[t]]
            score[at] += abs(query[t]) * impact
        alive = np.flatnonzero((score + rest >= floor) & (self.ids != own)) if floor > 0 else np.flatnonzero(self.ids != own)
        if len(alive):
            score = score[alive] + np.minimum(self.values[np.ix_(alive, essential)] * query[essential], 0).sum(axis=1)
            for t in others:
                stay = score + rest >= floor
                alive, score = alive[stay], score[stay]
                score = score + self.values[alive, t] * query[t]
                rest = max(0.0, rest - bound[t] * (1 - 1e-9))
            stay = score >= floor
            alive, score = alive[stay], score[stay]
        else:
            score = score[:0]
        top = best(self.ids[alive], score, k)
        return self.ids[alive][top], score[top]


def first_floor(scores: np.ndarray, k: int) -> float:
    """The k-th best of the scores known; minus infinity with fewer."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def search_block(queries: pd.DataFrame, held: list[tuple[int, Rows]], known: dict[int, Rows], k: int) -> pd.DataFrame:
    """Each query's best ``k`` rows of a shard's packs (those that may count at all)."""
    out = {"q": [], "query_id": [], "vec_id": [], "score": []}
    for width, asked in Rows.of_rows(queries).items() if len(queries) else ():
        number = number_type(asked.matrix, *(rows.matrix for w, rows in held if w == width))
        q = queries["q"].to_numpy()[queries["width"].to_numpy() == width]
        values = asked.matrix.astype(number)
        seed = known.get(width)
        first = values @ seed.matrix.astype(number).T if seed else None
        floors = [first_floor(first[r][seed.ids != asked.ids[r]], k) if seed else -np.inf for r in range(len(q))]
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, number))] * len(q)
        for w, rows in held:
            if w != width:
                continue
            postings = Postings(rows, number)
            for r in range(len(q)):
                ids, scores = postings.search(values[r], asked.ids[r], k, floors[r])
                if len(ids):
                    ids, scores = np.concatenate([found[r][0], ids]), np.concatenate([found[r][1], scores])
                    top = best(ids, scores, k)
                    found[r] = ids[top], scores[top]
                    if len(top) == k:
                        floors[r] = max(floors[r], float(scores[top][-1]))
        for r, (ids, scores) in enumerate(found):
            out["q"] += [q[r]] * len(ids)
            out["query_id"] += [asked.ids[r]] * len(ids)
            out["vec_id"] += ids.tolist()
            out["score"] += scores.astype(np.int64).tolist()
    return pd.DataFrame(out).astype("int64")


def search(embeddings: DataFrame, queries: DataFrame, k=10, scale=1024) -> DataFrame:
    """The ``k`` rows of ``embeddings`` (vec_id, embedding) with the largest integer inner
    products with each row of ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    known = seeds(embeddings, scale)
    found = meet(asked_rows(queries, scale), packs(embeddings, scale), lambda asked, held: search_block(asked, held, known, k),
                 "q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op13_max_score(spark, sf_dir) -> DataFrame:
    """Contract query: the 10 best of every row whose id is divisible by 100."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))


OP13_SQL = """
with vectors as (
  select vec_id, [floor(1024 * cast(x as double)) for x in embedding] as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from (select * from vectors where vec_id % 100 = 0) q join vectors c on c.vec_id <> q.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= 10
"""
