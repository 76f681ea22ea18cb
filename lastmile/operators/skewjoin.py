"""Equi-joins with a dimension when a few keys hold much of the facts.

Adaptive execution splits a hot key only above a size threshold and only between
two exchanges. Here hot keys are found first, and the join itself is dealt: a
hot key's fact rows get a salt, and its dimension row is copied once a salt, so
every (key, salt) is an ordinary key. All other keys keep salt 0 and one copy.

Hot keys come from a mergeable summary: rows are counted by key with partial
aggregation (one row a key and task), and those above ``share`` of all rows, at most
``1 / share`` of them, are kept with their counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of all rows from which a key is hot: at most a thousand keys are.
HOT_SHARE = 0.001
#: Most salts of a key, which bounds the copies of a dimension row.
MOST_SALTS = 4096


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """Keys (null aside) with more than ``share`` of all rows: key -> its share."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total")).first()["total"]
    found = counts.where(F.col(key).isNotNull() & (F.col("n") > F.lit(share * total))).collect()  # at most 1 / share rows
    return {r[key]: r["n"] / total for r in found}


def salts_of(hot: dict, share: float = HOT_SHARE, most: int = MOST_SALTS) -> dict:
    """Number of salts of each hot key, so that a salt holds about ``share`` of all rows."""
    return {k: min(most, int(-(-part // share))) for k, part in hot.items()}


def salted_join(facts: DataFrame, dimension: DataFrame, key: str, salts: dict, deal_by: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """``facts`` joined to ``dimension`` on ``key`` (one key column kept), hot keys dealt over their salts.

    ``deal_by``: fact columns whose hash deals a hot key's rows; rows equal in
    all of them stay together. ``how``: inner, left, left_semi or left_anti."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a copied dimension would add rows to a {how} join")
    if not salts:
        return facts.join(dimension, [key], how)
    of_key = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])
    count = lambda: F.coalesce(F.try_element_at(of_key, F.col(key)), F.lit(1))
    deal = F.xxhash64(*[F.col(c) for c in (deal_by or facts.columns)])
    dealt = facts.withColumn("_salt", F.pmod(deal, count()).cast("int"))
    copied = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), (count() - 1).cast("int"))))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
