"""Cleaning operators for the raw shipment and courier feeds.

Each function is DataFrame -> DataFrame and can be chained with
``df.transform``. The order of the shipment steps matters and is kept by
:func:`clean_shipments`: normalise -> cast -> range filter -> median
imputation -> exact-duplicate removal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.functions import (
    canonical_city, canonical_contract, fix_decimal_comma, pad_zip, parse_date,
    parse_mixed_timestamp, to_double,
)
from lastmile.operators.ranking import quantile_value


def normalize_shipments(raw: DataFrame, formats: Sequence[str] = fixed.TIMESTAMP_FORMATS,
                        zip_width: int = fixed.ZIP_WIDTH, zip_pad: str = fixed.ZIP_PAD) -> DataFrame:
    """Parse both timestamps, canonical city, padded zip, numeric weight and amount.

    One projection; the raw text columns are kept next to the typed ones so
    data-quality checks can compare both.
    """
    return raw.withColumns({
        "pickup": parse_mixed_timestamp(F.col("pickup_raw"), formats),
        "delivery": parse_mixed_timestamp(F.col("delivery_raw"), formats),
        "city": canonical_city(F.col("city")),
        "zip": pad_zip(F.col("zip"), zip_width, zip_pad),
        "weight": to_double(fix_decimal_comma(F.col("weight_raw"))),
        "amount": to_double(F.col("amount_raw")),
    })


def weight_in_range(weight: F.Column, low: float = fixed.WEIGHT_MIN_EXCLUSIVE,
                    high: float = fixed.WEIGHT_MAX_INCLUSIVE) -> F.Column:
    """Null is kept (imputed later); otherwise ``low < w <= high``."""
    return weight.isNull() | ((weight > F.lit(low)) & (weight <= F.lit(high)))


def filter_weight_range(df: DataFrame, column: str = "weight",
                        low: float = fixed.WEIGHT_MIN_EXCLUSIVE,
                        high: float = fixed.WEIGHT_MAX_INCLUSIVE) -> DataFrame:
    return df.where(weight_in_range(F.col(column), low, high))


def median_value(df: DataFrame, column: str = "weight", method: str = "exact",
                 relative_error: float = fixed.MEDIAN_RELATIVE_ERROR, q: float = fixed.MEDIAN_QUANTILE, weight: str | None = None):
    """Median of the non-null values of ``column``; null without values.

    ``exact`` (default): ``percentile_disc`` semantics. ``approx``: a value of the data
    whose rank error is within the relative error given. Either is the same at
    every run, without collecting the distinct values into one task.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown median method: {method}")
    return quantile_value(df, column, q, relative_error if method == "approx" else 0.0, weight)


def median_frame(df: DataFrame, column: str = "weight", method: str = "exact",
                 relative_error: float = fixed.MEDIAN_RELATIVE_ERROR,
                 q: float = fixed.MEDIAN_QUANTILE) -> DataFrame:
    """One-row frame ``median`` with :func:`median_value`."""
    found = median_value(df, column, method, relative_error, q)
    return df.sparkSession.createDataFrame([(found,)], f"median {df.schema[column].dataType.simpleString()}")


def impute_median(df: DataFrame, column: str = "weight", method: str = "exact",
                  relative_error: float = fixed.MEDIAN_RELATIVE_ERROR) -> DataFrame:
    """Replace nulls of ``column`` by its median, one number used as a literal."""
    found = median_value(df, column, method, relative_error)
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(found).cast(df.schema[column].dataType)))


def fill_and_merge(groups: DataFrame, median, keys: Sequence[str], sums: Sequence[str] = (), column: str = "weight", rest: Sequence[str] = ()) -> DataFrame:
    """Distinct rows by ``keys`` with the nulls of ``column`` filled, distinct again.

    Only rows without a value can become equal to another row, and only to one that
    has the median: those two kinds are grouped once more (``sums`` added up, the smallest of
    ``rest``), all others pass as they are."""
    filled = F.coalesce(F.col(column), F.lit(median).cast("double"))
    open_ = F.col(column).isNull() | (F.col(column) == F.lit(median).cast("double"))
    meet = groups.where(F.coalesce(open_, F.lit(False))).withColumn(column, filled)
    merged = meet.groupBy(*keys).agg(F.count(F.lit(1)).alias("_met"), *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in rest])
    others = groups.where(~F.coalesce(open_, F.lit(False)))
    return others.select(*keys, *sums, *rest).unionByName(merged.select(*keys, *sums, *rest))


def distinct_in_range(raw: DataFrame, keys: Sequence[str] = fixed.SHIPMENT_KEY_COLUMNS) -> DataFrame:
    """Clean shipments before imputation: normalised, in range, exact duplicates once with
    their number ``n``, missing weights null. Written once, it gives the median (weighted by
    ``n``) and, filled, the clean shipments: the raw rows are read a single time."""
    in_range = filter_weight_range(normalize_shipments(raw))
    return in_range.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def clean_from_distinct(distinct: DataFrame, median_method: str = "exact", keys: Sequence[str] = fixed.SHIPMENT_KEY_COLUMNS) -> DataFrame:
    """Clean shipments (``keys``) from the written result of :func:`distinct_in_range`."""
    return fill_and_merge(distinct, median_value(distinct, "weight", median_method, weight="n"), keys)


def drop_exact_duplicates(df: DataFrame, keys: Sequence[str] = fixed.SHIPMENT_KEY_COLUMNS) -> DataFrame:
    """Keep one row per combination of the business columns (nulls equal).

    Planned as a partial + final hash aggregate: copies collapse on the map
    side before the shuffle.
    """
    return df.dropDuplicates(list(keys))


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest row by the remaining columns (deterministic).

    ``min(struct(...))`` is an aggregate, so it is combined on the map side
    and a hot key never gathers all its rows in one task.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    return (df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in others])
            .select(*df.columns))


def clean_shipments(raw: DataFrame, median_method: str = "exact",
                    keys: Sequence[str] = fixed.SHIPMENT_KEY_COLUMNS) -> DataFrame:
    """normalise -> range filter -> impute weight -> drop exact duplicates."""
    return (raw.transform(normalize_shipments)
            .transform(filter_weight_range)
            .transform(lambda d: impute_median(d, "weight", median_method))
            .transform(lambda d: drop_exact_duplicates(d, keys)))


def clean_couriers(raw: DataFrame, canon: Mapping[str, Sequence[str]] = fixed.CONTRACT_CANON,
                   date_format: str = fixed.HIRE_DATE_FORMAT) -> DataFrame:
    """Contract canon -> one row per courier id -> trimmed names/city -> hire date.

    The result is rebalanced: without an exchange between the aggregation by
    courier id and a join on it, adaptive execution could not split the
    shipments of a hot courier."""
    return (raw.withColumn("contract", canonical_contract(F.col("contract"), canon))
            .transform(lambda d: dedup_by_key(d, ["courier_id"]))
            .withColumns({
                "first_name": F.trim(F.col("first_name")),
                "last_name": F.trim(F.col("last_name")),
                "assigned_city": F.trim(F.col("assigned_city")),
                "hire_date": parse_date(F.col("hire_date"), date_format),
            })
            .hint("rebalance"))
