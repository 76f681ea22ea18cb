"""Data-quality metrics, row funnel and layer counts as DataFrames.

Instead of one ``count()`` action per step (each re-running the lineage), the
counts of a stage are conditional aggregates of a single pass:

* shipments: one pass groups the rows like the dedup step, carrying copy counts
  and per-row check sums (:func:`checked_groups`); the written groups give the median,
  are marked against the courier table and folded into one row (:func:`shipment_counts`);
* couriers: two small aggregates joined in as scalar subqueries.

The result is reshaped to one row per check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.functions import count_where, pad_zip, ratio_pct, summable
from lastmile.operators.clean import fill_and_merge, median_value, normalize_shipments, weight_in_range
from lastmile.operators.integrity import mark_orphans


def _raw_flags(norm: DataFrame) -> dict[str, F.Column]:
    """Per-row checks on the raw text next to its normalised value."""
    iso = F.try_to_timestamp(F.col("pickup_raw"), F.lit(fixed.TIMESTAMP_FORMATS[0]))
    return {
        "unparsed_pickup": F.col("pickup").isNull() & F.col("pickup_raw").isNotNull(),
        "unparsed_delivery": F.col("delivery").isNull() & F.col("delivery_raw").isNotNull(),
        "european_pickup": iso.isNull() & F.col("pickup").isNotNull(),
        "city_fixed": F.col("city_raw") != F.col("city"),
        "short_zip_padded": F.length(F.col("zip_raw")) < F.lit(fixed.ZIP_WIDTH),
        "bad_zip_length": F.length(pad_zip(F.col("zip_raw"))) != F.lit(fixed.ZIP_WIDTH),
        "decimal_comma_weight": F.instr(F.col("weight_raw"), ",") > 0,
        "amount_not_summable": F.col("amount_raw").isNotNull() & ~summable(F.col("amount")),
        "null_weight_imputed": weight_in_range(F.col("weight")) & F.col("weight").isNull(),
    }


def checked_groups(raw_shipments: DataFrame, stamped: bool = False) -> DataFrame:
    """The raw rows grouped by the 10 cleaned business columns, in one pass.

    Each group carries its number of raw copies ``n`` and the sums of the per-row
    checks; missing weights are still null. Out-of-range rows are groups too (their
    weight is never null and never in range, so a group is wholly in or out).
    Written once, it gives the median and every count. ``stamped``: with the first
    ingestion time of each group."""
    keys = list(fixed.SHIPMENT_KEY_COLUMNS)
    norm = normalize_shipments(raw_shipments.withColumns({"city_raw": F.col("city"), "zip_raw": F.col("zip")}))
    flags = _raw_flags(norm)
    times = ["ingestion_timestamp"] if stamped else []
    rows = norm.select(*keys, *times, *[F.coalesce(cond, F.lit(False)).cast("int").alias(name) for name, cond in flags.items()])
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in flags], *[F.min(t).alias(t) for t in times])


def group_counts(groups: DataFrame) -> DataFrame:
    """One row: the counts of written groups that need neither the median nor the couriers."""
    flags = [c for c in groups.columns if c not in (*fixed.SHIPMENT_KEY_COLUMNS, "n", "ingestion_timestamp")]
    zero = lambda x: F.coalesce(x, F.lit(0))
    return groups.agg(zero(F.sum("n")).alias("raw_rows"), zero(F.sum(F.when(~weight_in_range(F.col("weight")), F.col("n")))).alias("weight_out_of_range"),
                      *[zero(F.sum(c)).alias(c) for c in flags])


def shipment_counts(groups: DataFrame, clean_couriers: DataFrame, median_method: str = "exact") -> DataFrame:
    """Every shipment count of the silver stage from the written :func:`checked_groups`.

    Groups that imputation makes equal are merged, all are marked against the courier table
    and folded into one row. The raw rows are not read again."""
    keys = list(fixed.SHIPMENT_KEY_COLUMNS)
    flags = [c for c in groups.columns if c not in (*keys, "n")]
    in_range = weight_in_range(F.col("weight"))
    median = median_value(groups.where(in_range), "weight", median_method, weight="n")
    # the median is in range, so merging never mixes rows in and out of range
    filled = fill_and_merge(groups.withColumn("_in_range", in_range), median, keys, ("n", *flags), rest=("_in_range",))
    marked = mark_orphans(filled, clean_couriers)
    kept = F.col("_in_range")
    return marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("in_range_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("n"))), F.lit(0)).alias("weight_out_of_range"),
        count_where(kept).alias("dedup_rows"),
        count_where(kept & F.col("is_orphan")).alias("orphan_shipments"),
        count_where(kept & F.col("weight").isNull()).alias("null_weight_left"),
        count_where(kept & F.col("delivery").isNull()).alias("null_delivery_kept"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags])


def _stage_couriers(raw_couriers: DataFrame, clean_couriers: DataFrame,
                    canonical: tuple = tuple(fixed.CONTRACT_CANON)) -> tuple[DataFrame, DataFrame]:
    raw = raw_couriers.agg(F.struct(
        F.count(F.lit(1)).alias("courier_raw_rows"),
        count_where(F.col("contract").isNotNull() & ~F.col("contract").isin(*list(canonical)))
        .alias("contract_variants_fixed"),
    ).alias("s"))
    clean = clean_couriers.agg(F.struct(
        F.count(F.lit(1)).alias("courier_rows"),
        count_where(F.col("phone").isNull()).alias("null_phone_kept"),
    ).alias("s"))
    return raw, clean


def pipeline_counts(raw_shipments: DataFrame, raw_couriers: DataFrame, clean_couriers: DataFrame,
                    median_method: str = "exact", vocab: fixed.Vocabulary = fixed.ENGLISH,
                    groups: DataFrame | None = None) -> DataFrame:
    """One row with every count of the silver stage (shipments and couriers).

    ``groups``: the written :func:`checked_groups` of the raw shipments, which then are not
    read again."""
    groups = checked_groups(raw_shipments) if groups is None else groups
    c_raw, c_clean = _stage_couriers(raw_couriers, clean_couriers, vocab.canonical_contracts)
    # each subquery bound to one column first, so it runs once for both of its fields
    return shipment_counts(groups, clean_couriers, median_method).select(
        "*", c_raw.scalar().alias("_craw"), c_clean.scalar().alias("_cclean"),
    ).select(
        "*",
        F.col("_craw.courier_raw_rows").alias("courier_raw_rows"),
        F.col("_craw.contract_variants_fixed").alias("contract_variants_fixed"),
        F.col("_cclean.courier_rows").alias("courier_rows"),
        F.col("_cclean.null_phone_kept").alias("null_phone_kept"),
    ).drop("_craw", "_cclean").select(
        "*",
        (F.col("in_range_rows") - F.col("dedup_rows")).alias("duplicates_removed"),
        (F.col("dedup_rows") - F.col("orphan_shipments")).alias("silver_rows"),
        (F.col("courier_raw_rows") - F.col("courier_rows")).alias("courier_duplicates_removed"),
    )


QUALITY_CHECKS = (
    "raw_rows", "unparsed_pickup", "unparsed_delivery", "european_pickup", "city_fixed",
    "short_zip_padded", "bad_zip_length", "decimal_comma_weight", "amount_not_summable", "weight_out_of_range",
    "null_weight_imputed", "duplicates_removed", "orphan_shipments", "null_weight_left",
    "null_delivery_kept", "silver_rows", "courier_raw_rows", "courier_duplicates_removed",
    "contract_variants_fixed", "null_phone_kept", "courier_rows",
)


def quality_metrics(counts: DataFrame) -> DataFrame:
    """One row per check: ``check``, ``value``."""
    return counts.select(*[F.col(c).cast("bigint").alias(c) for c in QUALITY_CHECKS]).unpivot(
        [], list(QUALITY_CHECKS), "check", "value")


def lineage_funnel(counts: DataFrame) -> DataFrame:
    """Rows after each silver step and rows removed by it."""
    steps = [
        (1, "raw", "raw_rows", None),
        (2, "weight_range", "in_range_rows", "raw_rows"),
        (3, "impute_weight", "in_range_rows", "in_range_rows"),
        (4, "drop_duplicates", "dedup_rows", "in_range_rows"),
        (5, "courier_join", "silver_rows", "dedup_rows"),
    ]
    rows = F.array(*[
        F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"),
                 F.col(after).cast("bigint").alias("rows"),
                 (F.lit(0).cast("bigint") if before is None else (F.col(before) - F.col(after)).cast("bigint"))
                 .alias("removed"))
        for no, name, after, before in steps])
    return counts.select(F.inline(rows))


def yield_rate(counts: DataFrame) -> DataFrame:
    """Silver rows as a percentage of raw rows."""
    return counts.select(
        F.col("raw_rows").cast("bigint").alias("raw_rows"),
        F.col("silver_rows").cast("bigint").alias("silver_rows"),
        ratio_pct(F.col("silver_rows"), F.col("raw_rows")).alias("yield_pct"))


def layer_row_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """``layer``, ``table_name``, ``rows`` for each (layer, table) -> DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows")
             for (layer, name), df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
