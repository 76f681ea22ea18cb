"""Foreign-key checks between shipments and couriers.

Joins are written without broadcast hints: the courier dimension grows with
the business, so Spark decides from its measured size (broadcast below the
threshold, sort-merge join above it). Adaptive execution splits a hot courier id
only if an exchange stands right below the join on both sides; the clean
courier table is rebalanced for that, and aggregates run before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.operators.clean import weight_in_range


def orphans(shipments: DataFrame, couriers: DataFrame, key: str = "courier_id") -> DataFrame:
    """Shipments whose courier is unknown; a null courier id is an orphan too."""
    dim = couriers.select(F.col(key).alias("_dim_key"))
    return shipments.join(dim, shipments[key] == dim["_dim_key"], "left_anti")


def orphan_ids(shipments: DataFrame, couriers: DataFrame, key: str = "courier_id") -> DataFrame:
    """Distinct unknown courier ids (null included when present)."""
    # distinct first: the join then sees one row per id, however hot it is
    return orphans(shipments.select(key).distinct(), couriers, key)


def mark_orphans(shipments: DataFrame, couriers: DataFrame, key: str = "courier_id",
                 flag: str = "is_orphan") -> DataFrame:
    """Keep every shipment and add ``flag`` (true when the courier is unknown).

    ``couriers`` must hold each key once (the clean courier table does).
    """
    dim = couriers.select(F.col(key).alias("_dim_key"), F.lit(True).alias("_known"))
    return (shipments.join(dim, shipments[key] == dim["_dim_key"], "left")
            .withColumn(flag, F.col("_known").isNull())
            .drop("_dim_key", "_known"))


def quarantine(normalized: DataFrame, couriers: DataFrame, key: str = "courier_id") -> DataFrame:
    """Rows the silver stage drops, each with the reason.

    ``weight_out_of_range`` for the range filter, ``orphan_courier`` for an
    unknown courier (checked on rows that passed the range filter). The input
    is read once.
    """
    marked = mark_orphans(normalized, couriers, key, "_orphan")
    reason = (F.when(~weight_in_range(F.col("weight")), F.lit("weight_out_of_range"))
              .when(F.col("_orphan"), F.lit("orphan_courier")))
    return marked.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_orphan")


def join_reconciliation(shipments: DataFrame, couriers: DataFrame, key: str = "courier_id") -> DataFrame:
    """One row: rows before and after the enrichment join, orphans, and whether
    ``pre - post == orphans`` can hold (the dimension key must be unique).

    Computed as one left join with a per-key match count and one aggregate,
    instead of counting the two sides and the anti join separately.
    """
    dim = couriers.groupBy(F.col(key).alias("_dim_key")).agg(F.count(F.lit(1)).alias("_matches")).hint("rebalance")
    joined = shipments.join(dim, shipments[key] == dim["_dim_key"], "left")
    return joined.agg(
        F.count(F.lit(1)).alias("pre_join_rows"),
        F.coalesce(F.sum("_matches"), F.lit(0)).cast("bigint").alias("post_join_rows"),
        F.count_if(F.col("_matches").isNull()).alias("orphan_rows"),
        F.coalesce(F.max("_matches") <= 1, F.lit(True)).alias("dimension_key_unique"),
    ).withColumn("reconciled", F.col("pre_join_rows") - F.col("post_join_rows") == F.col("orphan_rows"))
