"""Gold KPIs over the silver shipment table.

All aggregates are partial + final hash aggregates; ranks use the
distributed histogram rank (no single-partition window over the couriers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.functions import count_where, mean_rounded, money_sum, ratio_pct, with_time_dimensions
from lastmile.operators.enrich import enrich_with_courier
from lastmile.operators.ranking import composite_score, global_ranks, top_k
from lastmile.session import materialize


def _status(value: str) -> Column:
    return count_where(F.col("status") == F.lit(value))


def shipment_measures(vocab: fixed.Vocabulary = fixed.ENGLISH) -> list[Column]:
    """Volume, status split, SLA %, incident %, mean transit and revenue of a group."""
    total = F.count("tracking_id")
    return [
        total.alias("total_shipments"),
        _status(vocab.delivered).alias("delivered"),
        _status(vocab.incident).alias("incidents"),
        _status(vocab.returned).alias("returned"),
        ratio_pct(F.sum("on_time"), total).alias("sla_pct"),
        ratio_pct(_status(vocab.incident), total).alias("incident_pct"),
        mean_rounded(F.col("transit_hours")).alias("avg_transit_h"),
        money_sum(F.col("amount")).alias("revenue"),
    ]


def kpi_daily_city(silver: DataFrame, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """One row per pickup day and city (null day / city form their own group)."""
    return (with_time_dimensions(silver, "pickup")
            .groupBy("day", "year", "month", "city")
            .agg(*shipment_measures(vocab))
            .orderBy("day", "city"))


def _courier_measures(vocab: fixed.Vocabulary) -> list[Column]:
    total = F.count("tracking_id")
    return [
        total.alias("shipments"),
        _status(vocab.delivered).alias("delivered"),
        _status(vocab.incident).alias("incidents"),
        ratio_pct(F.sum("on_time"), total).alias("sla_pct"),
        mean_rounded(F.col("transit_hours")).alias("avg_transit_h"),
        money_sum(F.col("amount")).alias("revenue"),
    ]


def courier_aggregates(silver: DataFrame, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """One row per courier of the written silver table."""
    return silver.groupBy(*schemas.COURIER_KEYS).agg(*_courier_measures(vocab))


def courier_aggregates_before_join(shipments: DataFrame, couriers: DataFrame,
                                   vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """The same from clean shipments (with their delivery measures) and couriers.

    Shipments are aggregated by courier id first (combined on the map side),
    so the join sees one row per courier and no hot one."""
    per_id = shipments.where(F.col("courier_id").isNotNull()).groupBy("courier_id").agg(*_courier_measures(vocab))
    joined = enrich_with_courier(per_id, couriers)
    return joined.select(*schemas.COURIER_KEYS, *[c for c in per_id.columns if c != "courier_id"])


KPI_COURIER_COLUMNS = (
    *schemas.COURIER_KEYS, "shipments", "delivered", "incidents", "sla_pct", "avg_transit_h",
    "revenue", "volume_rank", "quality_rank", "score",
)


def kpi_courier(silver: DataFrame, min_shipments: int = fixed.MIN_SHIPMENTS_FOR_RANKING,
                vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """Courier KPIs with volume and quality ranks and their mean as score.

    The threshold applies before ranking; ranks are SQL ``rank()`` over the
    shipments count and over the rounded SLA %, both descending.
    """
    return rank_couriers(courier_aggregates(silver, vocab), min_shipments)


def rank_couriers(aggregates: DataFrame, min_shipments: int = fixed.MIN_SHIPMENTS_FOR_RANKING) -> DataFrame:
    """Ranks and score of courier aggregates, couriers below the threshold left out."""
    # One row per courier, read by both ranks and the join back: computed once.
    agg = materialize(aggregates.where(F.col("shipments") >= F.lit(min_shipments)))
    ranked = global_ranks(agg, [("shipments", "volume_rank", True), ("sla_pct", "quality_rank", True)])
    return (ranked.withColumn("score", composite_score(F.col("volume_rank"), F.col("quality_rank")))
            .select(*KPI_COURIER_COLUMNS)
            .orderBy("score", "courier_id"))


def executive_summary(silver: DataFrame, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """Headline KPIs over all shipments, with the status shares."""
    total = F.count("tracking_id")
    return silver.agg(
        total.alias("total_shipments"),
        _status(vocab.delivered).alias("delivered"),
        _status(vocab.incident).alias("incidents"),
        _status(vocab.returned).alias("returned"),
        ratio_pct(F.sum("on_time"), total).alias("sla_pct"),
        mean_rounded(F.col("transit_hours")).alias("avg_transit_h"),
        money_sum(F.col("amount")).alias("revenue"),
        ratio_pct(_status(vocab.delivered), total).alias("delivered_pct"),
        ratio_pct(_status(vocab.incident), total).alias("incident_pct"),
        ratio_pct(_status(vocab.returned), total).alias("returned_pct"),
    )


def city_volume(silver: DataFrame) -> DataFrame:
    """Shipments per city."""
    return silver.groupBy("city").agg(F.count(F.lit(1)).alias("shipments"))


def top_cities(silver: DataFrame, k: int = fixed.TOP_CITIES) -> DataFrame:
    """The ``k`` busiest cities (ties broken by name)."""
    return top_k(city_volume(silver), k, F.col("shipments").desc(), F.col("city").asc_nulls_first())


def top_couriers(courier_kpis: DataFrame, k: int = fixed.TOP_COURIERS) -> DataFrame:
    """Best ``k`` couriers by score (ties broken by courier id)."""
    return top_k(courier_kpis.select("courier_id", "courier_first_name", "courier_last_name",
                                     "assigned_city", "shipments", "sla_pct", "score"),
                 k, F.col("score").asc(), F.col("courier_id").asc())


def monthly_sla_city(silver: DataFrame) -> DataFrame:
    """SLA % per year, month and city, from the shipment rows (not from daily %)."""
    total = F.count("tracking_id")
    return (with_time_dimensions(silver, "pickup")
            .groupBy("year", "month", "city")
            .agg(total.alias("total_shipments"), F.sum("on_time").alias("on_time"),
                 ratio_pct(F.sum("on_time"), total).alias("sla_pct")))


def kpi_by(silver: DataFrame, dimension: str, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """The shipment measures per value of one dimension (contract, vehicle, ...)."""
    return silver.groupBy(dimension).agg(*shipment_measures(vocab))


def by_contract(silver: DataFrame, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return kpi_by(silver, "contract", vocab)


def by_vehicle(silver: DataFrame, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return kpi_by(silver, "vehicle", vocab)


def filter_gold(gold: DataFrame, city: str | None = None, contract: str | None = None,
                city_column: str = "city") -> DataFrame:
    """Slicer filters of the dashboard: by city and/or by contract type."""
    out = gold
    if city is not None:
        out = out.where(F.col(city_column) == F.lit(city))
    if contract is not None:
        out = out.where(F.col("contract") == F.lit(contract))
    return out


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Sorted list of the distinct values of one column (e.g. the cities after cleaning)."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first())
