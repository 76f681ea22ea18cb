"""Mergeable delivery states: sums from which every gold table is finished.

A group's state holds counts and exact decimal sums only, so states of parts of
the shipments add up to the state of the whole, and shipments that are taken
back are subtracted. One pass over the shipments gives the states by day, city
and courier (``delivery_states``); each gold table is a sum of those, finished into
percentages, means and ranks. Hot couriers and cities cost a row a task, as every
step is an aggregate that is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.functions import money_limbs, money_of, ratio_pct, round2, with_time_dimensions
from lastmile.operators import kpi

DAY = ("day", "year", "month", "city")
#: Counts, then exact sums with the number of values in them.
COUNTS = ("rows", "tracked", "delivered", "incidents", "returned", "on_time", "transit_n", "revenue_n")
SUMS = ("transit_sum", "revenue_high", "revenue_low")
STATES = (*COUNTS, *SUMS)
KINDS = {"transit_sum": "decimal(38,2)", "revenue_high": "decimal(38,0)", "revenue_low": "decimal(38,6)"}
STATE_SCHEMA = ", ".join(f"{c} {KINDS.get(c, 'bigint')}" for c in STATES)


def _added(*names: str) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).cast(KINDS.get(c, "bigint")).alias(c) for c in names]


def delivery_states(rows: DataFrame, by: Sequence[str], vocab: fixed.Vocabulary = fixed.ENGLISH, sign: str | None = None) -> DataFrame:
    """States by ``by`` (time dimensions of ``pickup`` among them) of shipments with delivery measures.

    ``sign``: a column that is 1 for rows that come and -1 for rows that go."""
    times = F.col(sign) if sign else F.lit(1)
    one = lambda cond: F.when(cond, times).otherwise(F.lit(0))
    signed = lambda x: F.when(times < 0, -x).otherwise(x)
    high, low = money_limbs(F.col("amount"))
    transit = F.col("transit_hours").cast("decimal(18,2)")
    status = F.col("status")
    values = {
        "rows": times, "tracked": one(F.col("tracking_id").isNotNull()),
        "delivered": one(status == vocab.delivered), "incidents": one(status == vocab.incident), "returned": one(status == vocab.returned),
        "on_time": F.col("on_time") * times, "transit_n": one(transit.isNotNull()), "revenue_n": one(low.isNotNull()),
        "transit_sum": signed(transit), "revenue_high": signed(high), "revenue_low": signed(low)}
    timed = with_time_dimensions(rows, "pickup")
    return timed.select(*by, *[x.alias(c) for c, x in values.items()]).groupBy(*by).agg(*_added(*STATES))


def merge_states(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """One state a group; groups that no row is left of go."""
    return states.groupBy(*by).agg(*_added(*STATES)).where(F.col("rows") != 0)


def changed(states: DataFrame) -> DataFrame:
    """States that change anything when they are added."""
    any_ = F.lit(False)
    for c in STATES:
        any_ = any_ | (F.col(c) != 0)
    return states.where(any_)


def _finished(name: str) -> Column:
    """A measure of a group from its states."""
    total = F.sum("tracked")
    return {
        "sla_pct": ratio_pct(F.sum("on_time"), total),
        "incident_pct": ratio_pct(F.sum("incidents"), total),
        "delivered_pct": ratio_pct(F.sum("delivered"), total),
        "returned_pct": ratio_pct(F.sum("returned"), total),
        "avg_transit_h": round2(F.try_divide(F.sum("transit_sum").cast("double"), F.sum("transit_n"))),
        "revenue": F.when(F.sum("revenue_n") > 0, money_of(F.sum("revenue_high"), F.sum("revenue_low"))),
    }.get(name, F.sum("tracked") if name in ("total_shipments", "shipments") else F.coalesce(F.sum(name), F.lit(0)))


def measures(*names: str) -> list[Column]:
    return [_finished(c).alias(c) for c in names]


SHIPMENT_MEASURES = ("total_shipments", "delivered", "incidents", "returned", "sla_pct", "incident_pct", "avg_transit_h", "revenue")


def _finished_by(cube: DataFrame, by: Sequence[str], *columns: Column) -> DataFrame:
    """``columns`` of each group that rows are left of; states taken back may leave none."""
    return cube.groupBy(*by).agg(*columns, F.sum("rows").alias("_rows")).where(F.col("_rows") != 0).drop("_rows")


def kpi_daily_city(cube: DataFrame) -> DataFrame:
    return _finished_by(cube, DAY, *measures(*SHIPMENT_MEASURES)).orderBy("day", "city")


def kpi_courier(cube: DataFrame, min_shipments: int = fixed.MIN_SHIPMENTS_FOR_RANKING) -> DataFrame:
    own = ("shipments", "delivered", "incidents", "sla_pct", "avg_transit_h", "revenue")
    return kpi.rank_couriers(_finished_by(cube, schemas.COURIER_KEYS, *measures(*own)), min_shipments)


def executive_summary(cube: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("tracked"), F.lit(0)).alias("total_shipments")
    return cube.agg(total, *measures("delivered", "incidents", "returned", "sla_pct", "avg_transit_h", "revenue", "delivered_pct", "incident_pct", "returned_pct"))


def monthly_sla_city(cube: DataFrame) -> DataFrame:
    return _finished_by(cube, ("year", "month", "city"), *measures("total_shipments", "on_time", "sla_pct"))


def city_volume(cube: DataFrame) -> DataFrame:
    return _finished_by(cube, ("city",), F.sum("rows").alias("shipments"))


def kpi_by(cube: DataFrame, dimension: str) -> DataFrame:
    return _finished_by(cube, (dimension,), *measures(*SHIPMENT_MEASURES))


def gold_tables(cube: DataFrame) -> dict[str, DataFrame]:
    """Every gold table from one cube by day, city and courier."""
    return {
        "kpi_daily_city": kpi_daily_city(cube), "kpi_courier": kpi_courier(cube), "executive_summary": executive_summary(cube),
        "monthly_sla_city": monthly_sla_city(cube), "city_volume": city_volume(cube),
        "by_contract": kpi_by(cube, "contract"), "by_vehicle": kpi_by(cube, "vehicle"),
    }
