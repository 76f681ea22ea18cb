"""Enrichment join and derived shipment columns (clean shipments -> silver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.functions import on_time_flag, transit_hours
from lastmile.operators.clean import clean_shipments
from lastmile.operators.skewjoin import salted_join


def courier_dimension(couriers: DataFrame) -> DataFrame:
    """The six courier columns carried into shipments; names renamed to avoid clashes."""
    return couriers.select(*[F.col(src).alias(dst) for src, dst in schemas.COURIER_DIMENSION.items()])


def enrich_with_courier(shipments: DataFrame, couriers: DataFrame, key: str = "courier_id", salts: dict | None = None) -> DataFrame:
    """Inner join on the courier id (USING form: one key column kept).

    Orphans and null keys drop out here; Spark adds the ``isnotnull`` filter
    on both sides and chooses broadcast or sort-merge from the measured size.
    ``salts`` (``skewjoin.salts_of``) deals the shipments of hot couriers.
    """
    dimension = courier_dimension(couriers)
    if salts:
        return salted_join(shipments.where(F.col(key).isNotNull()), dimension, key, salts, [c for c in ("tracking_id", "pickup", "amount") if c in shipments.columns])
    return shipments.join(dimension, [key], "inner")


def with_delivery_measures(df: DataFrame, sla_seconds: int = fixed.SLA_SECONDS,
                           delivered: str = fixed.STATUS_DELIVERED) -> DataFrame:
    """Add ``transit_hours`` (null unless delivered) and the 0/1 ``on_time`` flag."""
    return df.withColumns({
        "transit_hours": transit_hours(F.col("pickup"), F.col("delivery")),
        "on_time": on_time_flag(F.col("status"), F.col("pickup"), F.col("delivery"), sla_seconds, delivered),
    })


def silver_projection(enriched: DataFrame, audit: bool = False) -> DataFrame:
    """Final column order of the silver shipment table."""
    cols = [F.col(c) for c in schemas.SILVER_SHIPMENT_COLUMNS]
    if audit:
        cols += [F.col("ingestion_timestamp").alias("bronze_ingestion_ts"),
                 F.current_timestamp().alias("silver_processed_ts")]
    return enriched.select(*cols)


def silver_shipments(raw_shipments: DataFrame, clean_couriers: DataFrame, median_method: str = "exact",
                     audit: bool = False, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """Raw shipments + clean couriers -> clean, enriched shipments (17 or 19 columns)."""
    keys = list(fixed.SHIPMENT_KEY_COLUMNS)
    shipments = clean_shipments(raw_shipments, median_method, keys)
    if audit:
        shipments = shipments.select(*keys, "ingestion_timestamp")
    else:
        shipments = shipments.select(*keys)
    return silver_of_clean(shipments, clean_couriers, audit, vocab)


def silver_of_clean(shipments: DataFrame, clean_couriers: DataFrame, audit: bool = False,
                    vocab: fixed.Vocabulary = fixed.ENGLISH, salts: dict | None = None) -> DataFrame:
    """Silver from clean shipments and clean couriers."""
    return (enrich_with_courier(shipments, clean_couriers, salts=salts)
            .transform(lambda d: with_delivery_measures(d, delivered=vocab.delivered))
            .transform(lambda d: silver_projection(d, audit)))
