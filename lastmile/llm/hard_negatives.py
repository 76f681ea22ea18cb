"""Operator 11: hard-negative mining by coordinate pruning in length buckets.

For each anchor its positives are the rows of its label with the largest inner
products; a hard negative of a positive is a row of another label whose product
lies from ``least`` percent of the positive's up to it. Both are searches for
large products, which two prunings make cheap, after LEMP (large entries in a
matrix product):

1. Length buckets. Rows are cut into packs by length, longest first. To reach a
   product ``floor`` with an anchor of length ``a``, a row of a bucket whose longest
   has length ``b`` needs a cosine of ``t = floor / (a b)``: over 1, the bucket is
   skipped; and rows shorter than ``floor / a`` are.
2. Coordinate lists. A bucket keeps, for every coordinate, its unit vectors'
   values in order. A unit vector with cosine ``t`` or more to the anchor's ``u`` has
   on each coordinate ``f`` a value in ``u_f t -+ sqrt((1 - u_f^2)(1 - t^2))``. For the
   anchor's ``FOCUS`` largest coordinates that range is cut from the sorted list
   by binary search, and the ranges' rows are intersected.
3. Verification. Candidates are scored in exact integer arithmetic. The
   floor rises to the last score that still counts, bucket after bucket.

Positives take one pass, negatives a second: there one candidate search serves
all positives of an anchor, at the lowest of their floors. First floors come from
``SEEDS`` rows of the table and are never above the answer's.

Scale. Packing, shards and blocks: see ``vector_packs``; shards are merged by
windows that keep ``k`` rows a group before they shuffle. At low cosines
(directionless vectors) coordinate ranges are wide and most rows are verified.

Defined results: rows with a null label take no part, otherwise as in
``vector_packs``; ties fall to the smaller ``vec_id``; rows that share the anchor's id
are neither positives nor negatives; positives with a negative score have no
negatives, those with score 0 the rows with score 0; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.common import frozen, table
from lastmile.llm.max_score import first_floor
from lastmile.llm.vector_packs import Rows, asked_rows, best, meet, number_type, packs, seeds

#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
#: What rounding may take from a bound of unit vectors.
SLACK = 1e-9


class Bucket:
    """A pack with its sorted coordinate lists."""

    def __init__(self, rows: Rows, number: type):
        self.ids, self.labels, self.values = rows.ids, rows.labels, rows.matrix.astype(number)
        self.lengths = np.sqrt((rows.matrix.astype(np.float64) ** 2).sum(axis=1))  # longest first
        unit = rows.matrix / np.maximum(self.lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T.copy()
        self.lists = np.take_along_axis(unit, self.order.T, axis=0).T.copy()

    def candidates(self, unit: np.ndarray, length: float, floor: float) -> np.ndarray:
        """Rows that may have a product of at least ``floor`` with ``length * unit``."""
        n = len(self.ids)
        if floor <= 0 or not n:
            return np.arange(n)
        if not length or floor > length * self.lengths[0] * (1 + SLACK):
            return np.arange(0)
        t = min(1.0, floor / (length * self.lengths[0]) * (1 - SLACK))
        long_enough = int(np.searchsorted(-self.lengths, -floor / length * (1 - SLACK), side="right"))
        hits, lists = np.zeros(n, np.int8), 0
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            half = np.sqrt(max(0.0, (1 - unit[f] ** 2) * (1 - t * t))) + SLACK
            low = unit[f] * t - half if unit[f] > -t else -2.0
            high = unit[f] * t + half if unit[f] < t else 2.0
            begin, end = np.searchsorted(self.lists[f], low, side="left"), np.searchsorted(self.lists[f], high, side="right")
            if end - begin < n:
                hits[self.order[f][begin:end]] += 1
                lists += 1
        return np.flatnonzero(hits[:long_enough] == lists)


class Anchors:
    """Queries of one width with the seeds' scores."""

    def __init__(self, frame: pd.DataFrame, width: int, rows: Rows, held: list[tuple[int, Rows]], known: dict[int, Rows]):
        self.buckets = sorted((r for w, r in held if w == width), key=lambda r: -float((r.matrix[:1].astype(np.float64) ** 2).sum()))
        self.number = number_type(rows.matrix, *(r.matrix for r in self.buckets))
        self.frame = frame[frame["width"] == width]
        self.ids, self.labels, self.values = rows.ids, rows.labels, rows.matrix.astype(self.number)
        self.lengths = np.sqrt((rows.matrix.astype(np.float64) ** 2).sum(axis=1))
        self.units = rows.matrix / np.maximum(self.lengths, 1e-300)[:, None]
        self.seed = known.get(width)
        self.first = self.values @ self.seed.matrix.astype(self.number).T if self.seed else np.zeros((len(self.ids), 0))

    def seed_scores(self, r: int, same: bool) -> np.ndarray:
        if not self.seed:
            return self.first[r]
        return self.first[r][(self.seed.ids != self.ids[r]) & ((self.seed.labels == self.labels[r]) == same)]

    def verified(self, bucket: Bucket, r: int, floor: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of a bucket's candidates of the anchor's label, or of others."""
        at = bucket.candidates(self.units[r], self.lengths[r], floor)
        at = at[((bucket.labels[at] == self.labels[r]) == same) & (bucket.ids[at] != self.ids[r])]
        return bucket.ids[at], bucket.values[at] @ self.values[r]


def _anchors(frame, held, known):
    return [Anchors(frame, w, rows, held, known) for w, rows in Rows.of_rows(frame).items()] if len(frame) else []


def positives_of_block(frame: pd.DataFrame, held: list[tuple[int, Rows]], known: dict[int, Rows], k: int) -> pd.DataFrame:
    """The best ``k`` rows of each anchor's label in a shard."""
    out = {"q": [], "vec_id": [], "score": []}
    for anchors in _anchors(frame, held, known):
        floors = [first_floor(anchors.seed_scores(r, True), k) for r in range(len(anchors.ids))]
        found = [(np.zeros(0, np.int64), np.zeros(0, anchors.number))] * len(floors)
        for bucket in (Bucket(rows, anchors.number) for rows in anchors.buckets):
            for r, floor in enumerate(floors):
                ids, scores = anchors.verified(bucket, r, floor, True)
                ids, scores = np.concatenate([found[r][0], ids]), np.concatenate([found[r][1], scores])
                top = best(ids, scores, k)
                found[r] = ids[top], scores[top]
                if len(top) == k:
                    floors[r] = max(floor, float(scores[top][-1]))
        for q, (ids, scores) in zip(anchors.frame["q"], found):
            out["q"] += [q] * len(ids)
            out["vec_id"] += ids.tolist()
            out["score"] += scores.astype(np.int64).tolist()
    return pd.DataFrame(out).astype("int64")


def negatives_of_block(frame: pd.DataFrame, held: list[tuple[int, Rows]], known: dict[int, Rows], k: int, least: int) -> pd.DataFrame:
    """For each positive (``scores`` of an anchor) its first ``k`` hard negatives in a shard."""
    out = {"q": [], "place": [], "vec_id": [], "score": []}

    def hard(ids, scores, limit):
        """Of rows, those in a positive's range."""
        exact = scores.astype(np.int64)
        at = np.flatnonzero((exact <= limit) & (exact >= -(-least * limit // 100)))
        return ids[at], scores[at]

    for anchors in _anchors(frame, held, known):
        jobs = []  # of an anchor: a positive's place, score, floor, what is found
        for r, limits in enumerate(anchors.frame["scores"]):
            sample = anchors.seed_scores(r, False)
            jobs.append([[place, int(limit), max(float(-(-least * int(limit) // 100)), first_floor(hard(sample, sample, int(limit))[1], k)),
                          (np.zeros(0, np.int64), np.zeros(0, anchors.number))] for place, limit in enumerate(limits) if limit >= 0])
        for bucket in (Bucket(rows, anchors.number) for rows in anchors.buckets):
            for r, own in enumerate(jobs):
                if not own:
                    continue
                ids, scores = anchors.verified(bucket, r, min(job[2] for job in own), False)
                for job in own:
                    more = hard(ids, scores, job[1])
                    if len(more[0]):
                        ids_, scores_ = np.concatenate([job[3][0], more[0]]), np.concatenate([job[3][1], more[1]])
                        top = best(ids_, scores_, k)
                        job[3] = ids_[top], scores_[top]
                        if len(top) == k:
                            job[2] = max(job[2], float(scores_[top][-1]))
        for q, own in zip(anchors.frame["q"], jobs):
            for place, _, _, (ids, scores) in own:
                out["q"] += [q] * len(ids)
                out["place"] += [place] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.astype(np.int64).tolist()
    return pd.DataFrame(out).astype("int64")


def mine(rows: DataFrame, anchors: DataFrame, positives=5, negatives=5, least=80, scale=256) -> DataFrame:
    """Hard negatives from ``rows`` (vec_id, embedding, label) for the rows ``anchors``.

    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``; scores are products of the vectors ``floor(scale * x)``."""
    known = seeds(rows, scale, "label")
    held = packs(rows, scale, "label")
    asked = asked_rows(anchors, scale, "label")
    near = meet(asked, held, lambda frame, packed: positives_of_block(frame, packed, known, positives), "q long, vec_id long, score long")
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    kept = near.withColumn("at", F.row_number().over(by_score)).where(F.col("at") <= positives)
    lists = kept.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("found"))  # ``positives`` entries
    wanted = frozen(asked.join(lists, "q").select("q", "vec_id", "label", "width", "vector", F.col("found.vec_id").alias("positive_ids"), F.col("found.score").alias("scores")))
    hard = meet(wanted.drop("positive_ids"), held, lambda frame, packed: negatives_of_block(frame, packed, known, negatives, least),
                "q long, place int, vec_id long, score long")
    by_place = Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id")
    ranked = hard.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= negatives)
    named = wanted.select("q", F.col("vec_id").alias("anchor_id"), "positive_ids", "scores")
    return ranked.join(named, "q").select(
        "anchor_id", F.get("positive_ids", F.col("place")).alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.get("scores", F.col("place")).alias("positive_score"), F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir) -> DataFrame:
    """Contract query: hard negatives of every row whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


OP11_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_dot_product(a.v, c.v) as bigint) as score
  from (select * from vectors where vec_id % 100 = 0) a join vectors c on c.vec_id <> a.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""
