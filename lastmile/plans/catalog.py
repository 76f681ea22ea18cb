"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the test tables: the dirty shipment and courier feeds
are derived from them in the same plan, so the work grows with the tables.
Queries whose result depends on written files (round trips, inventories)
write under the session's checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.operators import clean, cube, enrich, integrity, kpi, quality, skewjoin
from lastmile.operators.merge import latest_per_key, upsert
from lastmile.session import ensure_checkpoint_dir, shuffles_freed
from lastmile.sources import files, layers, rejects
from lastmile.sources.feed import broken_courier_lines, broken_shipment_lines, courier_feed, shipment_feed
from lastmile.functions import parse_mixed_timestamp, with_time_dimensions
from lastmile.streaming import maintain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEYS = list(fixed.SHIPMENT_KEY_COLUMNS)


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# --- shared stages ------------------------------------------------------------

def _normalized(spark, sf_dir) -> DataFrame:
    raw = shipment_feed(spark, sf_dir)
    return clean.normalize_shipments(raw.withColumns({"city_raw": F.col("city"), "zip_raw": F.col("zip")}))


def _couriers(spark, sf_dir) -> DataFrame:
    return clean.clean_couriers(courier_feed(spark, sf_dir))


def _in_range(spark, sf_dir) -> DataFrame:
    return clean.filter_weight_range(clean.normalize_shipments(shipment_feed(spark, sf_dir)))


def _imputed(spark, sf_dir, method="exact") -> DataFrame:
    """Shipments in range, filled. The feed runs once: its rows are written, give the median and are read back."""
    path = _scratch(spark, "in-range-shipments")
    _write_scratch(_in_range(spark, sf_dir).select(*KEYS), path)
    return clean.impute_median(spark.read.parquet(path), "weight", method)


def _dedup(spark, sf_dir, median_method="exact", path=None) -> DataFrame:
    """Clean shipments. The feed, with its join of line items and orders, runs once: its
    distinct rows are written (to ``path``), give the median, and are read back filled."""
    path = path or _scratch(spark, "distinct-shipments")
    _write_scratch(clean.distinct_in_range(shipment_feed(spark, sf_dir)), path)
    return clean.clean_from_distinct(spark.read.parquet(path), median_method)


def silver(spark, sf_dir, median_method="exact", path=None) -> DataFrame:
    return enrich.silver_of_clean(_dedup(spark, sf_dir, median_method, path), _couriers(spark, sf_dir))


def _courier_kpis(spark, sf_dir) -> DataFrame:
    """Courier KPIs from the clean shipments, aggregated before they meet the couriers."""
    measured = enrich.with_delivery_measures(_dedup(spark, sf_dir))
    return kpi.rank_couriers(kpi.courier_aggregates_before_join(measured, _couriers(spark, sf_dir)))


def _counts(spark, sf_dir) -> DataFrame:
    path, raw = _scratch(spark, "checked-shipments"), shipment_feed(spark, sf_dir)
    _write_scratch(quality.checked_groups(raw), path)
    return quality.pipeline_counts(raw, courier_feed(spark, sf_dir), _couriers(spark, sf_dir), groups=spark.read.parquet(path))


def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder beside the checkpoints; its files go when the session ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def _write_scratch(df: DataFrame, path: str) -> None:
    """Rows that are read back: packed well, without the shuffle files that they came from."""
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


# --- raw feeds ----------------------------------------------------------------

@query("raw_shipments")
def q_raw_shipments(spark, sf_dir):
    return shipment_feed(spark, sf_dir)


@query("raw_couriers")
def q_raw_couriers(spark, sf_dir):
    return courier_feed(spark, sf_dir)


# --- cleaning -----------------------------------------------------------------

@query("parse_mixed_ts")
def q_parse_mixed_ts(spark, sf_dir):
    return _normalized(spark, sf_dir).select("tracking_id", "pickup_raw", "pickup", "delivery_raw", "delivery")


@query("canonical_city")
def q_canonical_city(spark, sf_dir):
    return _normalized(spark, sf_dir).select("tracking_id", "city_raw", "city")


@query("pad_zip")
def q_pad_zip(spark, sf_dir):
    return _normalized(spark, sf_dir).select("tracking_id", "zip_raw", "zip")


@query("decimal_comma")
def q_decimal_comma(spark, sf_dir):
    return _normalized(spark, sf_dir).select("tracking_id", "weight_raw", "weight")


@query("weight_range")
def q_weight_range(spark, sf_dir):
    return _in_range(spark, sf_dir).select(*KEYS)


@query("contract_canon")
def q_contract_canon(spark, sf_dir):
    from lastmile.functions import canonical_contract
    raw = courier_feed(spark, sf_dir)
    return raw.select("courier_id", F.col("contract").alias("contract_raw"),
                      canonical_contract(F.col("contract")).alias("contract"))


@query("couriers_clean")
def q_couriers_clean(spark, sf_dir):
    return _couriers(spark, sf_dir)


@query("median_weight_exact")
def q_median_weight_exact(spark, sf_dir):
    return clean.median_frame(_in_range(spark, sf_dir), "weight", "exact")


@query("median_weight_approx")
def q_median_weight_approx(spark, sf_dir):
    """The median within the relative error: of these weights, the median itself."""
    return clean.median_frame(_in_range(spark, sf_dir), "weight", "approx")


@query("impute_median_exact")
def q_impute_median_exact(spark, sf_dir):
    return _imputed(spark, sf_dir, "exact").select(*KEYS)


@query("impute_median_approx")
def q_impute_median_approx(spark, sf_dir):
    """Imputation by the approximate median, the imputed weights included."""
    return _imputed(spark, sf_dir, "approx").select(*KEYS)


@query("dedup_shipments")
def q_dedup_shipments(spark, sf_dir):
    return _dedup(spark, sf_dir)


# --- integrity and enrichment -------------------------------------------------

@query("orphans")
def q_orphans(spark, sf_dir):
    return integrity.orphans(_dedup(spark, sf_dir), _couriers(spark, sf_dir))


@query("orphan_ids")
def q_orphan_ids(spark, sf_dir):
    return integrity.orphan_ids(_dedup(spark, sf_dir), _couriers(spark, sf_dir))


@query("orphan_marked")
def q_orphan_marked(spark, sf_dir):
    return integrity.mark_orphans(_dedup(spark, sf_dir), _couriers(spark, sf_dir))


@query("quarantine")
def q_quarantine(spark, sf_dir):
    return integrity.quarantine(clean.normalize_shipments(shipment_feed(spark, sf_dir)), _couriers(spark, sf_dir))


@query("join_reconciliation")
def q_join_reconciliation(spark, sf_dir):
    return integrity.join_reconciliation(_dedup(spark, sf_dir), _couriers(spark, sf_dir))


@query("enriched")
def q_enriched(spark, sf_dir):
    return enrich.enrich_with_courier(_dedup(spark, sf_dir), _couriers(spark, sf_dir))


@query("enriched_hot_couriers")
def q_enriched_hot_couriers(spark, sf_dir):
    """The enrichment join with the shipments of hot couriers dealt over salts."""
    shipments = _dedup(spark, sf_dir)
    hot = skewjoin.hot_keys(shipments.select("courier_id"), "courier_id")
    return enrich.enrich_with_courier(shipments, _couriers(spark, sf_dir), salts=skewjoin.salts_of(hot))


@query("silver")
def q_silver(spark, sf_dir):
    return silver(spark, sf_dir)


@query("transit_hours")
def q_transit_hours(spark, sf_dir):
    """Hours from pickup to delivery of every clean shipment (null when not delivered)."""
    return silver(spark, sf_dir).select("tracking_id", "courier_id", "status", "pickup", "delivery",
                                        "transit_hours")


@query("on_time")
def q_on_time(spark, sf_dir):
    """SLA flag of every clean shipment: delivered within 24 h (bound included)."""
    return silver(spark, sf_dir).select("tracking_id", "courier_id", "status", "pickup", "delivery", "on_time")


@query("silver_approx_median")
def q_silver_approx(spark, sf_dir):
    """Silver by the approximate median."""
    return silver(spark, sf_dir, median_method="approx")


@query("time_dims")
def q_time_dims(spark, sf_dir):
    return with_time_dimensions(silver(spark, sf_dir), "pickup").select(
        "tracking_id", "courier_id", "pickup", "day", "year", "month", "weekday", "hour")


@query("silver_cities")
def q_silver_cities(spark, sf_dir):
    """Distinct cities after cleaning, sorted (the expected-value check of the city rule)."""
    return kpi.distinct_sorted(clean.normalize_shipments(shipment_feed(spark, sf_dir)), "city")


@query("contract_values")
def q_contract_values(spark, sf_dir):
    """Distinct contract values of the clean courier table."""
    return kpi.distinct_sorted(_couriers(spark, sf_dir), "contract")


# --- gold ---------------------------------------------------------------------

@query("kpi_daily")
def q_kpi_daily(spark, sf_dir):
    return kpi.kpi_daily_city(silver(spark, sf_dir))


@query("kpi_courier")
def q_kpi_courier(spark, sf_dir):
    return _courier_kpis(spark, sf_dir)


@query("summary")
def q_summary(spark, sf_dir):
    return kpi.executive_summary(silver(spark, sf_dir))


@query("city_volume")
def q_city_volume(spark, sf_dir):
    return kpi.city_volume(silver(spark, sf_dir))


@query("top_cities")
def q_top_cities(spark, sf_dir):
    return kpi.top_cities(silver(spark, sf_dir))


@query("top_couriers")
def q_top_couriers(spark, sf_dir):
    return kpi.top_couriers(_courier_kpis(spark, sf_dir))


@query("monthly_sla_city")
def q_monthly_sla_city(spark, sf_dir):
    return kpi.monthly_sla_city(silver(spark, sf_dir))


@query("by_contract")
def q_by_contract(spark, sf_dir):
    return kpi.by_contract(silver(spark, sf_dir))


@query("by_vehicle")
def q_by_vehicle(spark, sf_dir):
    return kpi.by_vehicle(silver(spark, sf_dir))


# --- quality ------------------------------------------------------------------

@query("quality")
def q_quality(spark, sf_dir):
    return quality.quality_metrics(_counts(spark, sf_dir))


@query("funnel")
def q_funnel(spark, sf_dir):
    return quality.lineage_funnel(_counts(spark, sf_dir))


@query("yield_rate")
def q_yield_rate(spark, sf_dir):
    return quality.yield_rate(_counts(spark, sf_dir))


# --- sources, sinks and layers ------------------------------------------------

@query("bronze_shipments")
def q_bronze_shipments(spark, sf_dir):
    """Audit stamp of the raw feed (the ingestion time is left out: it is per run)."""
    stamped = files.audit_stamp(shipment_feed(spark, sf_dir), fixed.SHIPMENTS_SOURCE_SYSTEM,
                                fixed.SHIPMENTS_SOURCE_FILE)
    return stamped.drop("ingestion_timestamp")


def _stamped(df: DataFrame, pattern: str) -> DataFrame:
    """Without the ingestion time, which is per run; the file name as a check."""
    return df.drop("ingestion_timestamp").withColumn("source_file", F.col("source_file").rlike(pattern))


@query("ingest_shipments")
def q_ingest_shipments(spark, sf_dir):
    """Raw shipments landed as CSV, read by header name with sub-folders, stamped."""
    path = _scratch(spark, "ingest-shipments")
    files.write_shipments_csv(shipment_feed(spark, sf_dir), f"{path}/batch-1")
    return _stamped(files.ingest_shipments(spark, path), r"^part-.*\.csv$")


@query("ingest_couriers")
def q_ingest_couriers(spark, sf_dir):
    """Raw couriers landed as JSON Lines, read with sub-folders, stamped."""
    path = _scratch(spark, "ingest-couriers")
    files.write_couriers_json(courier_feed(spark, sf_dir), f"{path}/batch-1")
    return _stamped(files.ingest_couriers(spark, path), r"^part-.*\.json$")


def _broken_landing(spark, sf_dir) -> tuple[str, str]:
    """Folders of landed shipments and couriers with broken lines among the records."""
    shipments, couriers = _scratch(spark, "broken-shipments"), _scratch(spark, "broken-couriers")
    feed, records = shipment_feed(spark, sf_dir), courier_feed(spark, sf_dir)
    files.write_shipments_csv(feed, f"{shipments}/batch-1")
    files.write_lines(broken_shipment_lines(feed).select("line"), f"{shipments}/batch-2", ",".join(fixed.SHIPMENT_FIELDS))
    files.write_couriers_json(records, f"{couriers}/batch-1")
    broken_courier_lines(records).select("line").write.text(f"{couriers}/batch-2")
    return shipments, couriers


@query("rejected_shipments")
def q_rejected_shipments(spark, sf_dir):
    """CSV lines that are no shipments, with the reason (short, long, unclosed quote)."""
    return _stamped(files.rejected_shipments(spark, _broken_landing(spark, sf_dir)[0]), r"^part-.*\.csv$")


@query("rejected_couriers")
def q_rejected_couriers(spark, sf_dir):
    """JSON lines that are no couriers, with the reason (broken, no object, no key)."""
    return _stamped(files.rejected_couriers(spark, _broken_landing(spark, sf_dir)[1]), r"^part-.*\.txt$")


@query("landing_quality")
def q_landing_quality(spark, sf_dir):
    """Lines of a landing folder by outcome: accepted, or why not."""
    shipments, couriers = _broken_landing(spark, sf_dir)
    return rejects.line_counts(files.marked_lines(spark, shipments, "shipments"), "shipments").unionByName(
        rejects.line_counts(files.marked_lines(spark, couriers, "couriers"), "couriers"))


@query("ingest_among_broken_lines")
def q_ingest_among_broken_lines(spark, sf_dir):
    """The shipments of a folder with broken lines: all of them, and nothing else."""
    return files.read_shipments_csv(spark, _broken_landing(spark, sf_dir)[0])


@query("layer_roundtrip")
def q_layer_roundtrip(spark, sf_dir):
    """Silver published over an earlier version, and read back through the current one."""
    path = _scratch(spark, "layer-silver")
    layers.publish(shipment_feed(spark, sf_dir).select("tracking_id"), path)
    layers.publish(silver(spark, sf_dir), path)
    return layers.read_layer(spark, path)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Raw shipments landed as CSV and read back with the explicit string schema."""
    path = _scratch(spark, "landing-shipments")
    files.write_shipments_csv(shipment_feed(spark, sf_dir), path)
    return files.read_shipments_csv(spark, path)


@query("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    """Raw couriers landed as JSON Lines and read back with the explicit schema."""
    path = _scratch(spark, "landing-couriers")
    files.write_couriers_json(courier_feed(spark, sf_dir), path)
    return files.read_couriers_json(spark, path)


@query("export_kpi_courier")
def q_export_kpi_courier(spark, sf_dir):
    """Courier KPIs exported as sorted CSV and read back (schema from the gold table)."""
    gold = _courier_kpis(spark, sf_dir)
    path = _scratch(spark, "export-kpi-courier")
    layers.export_csv(gold, path, [F.col("score"), F.col("courier_id")])
    return spark.read.schema(gold.schema).option("header", True).csv(path)


@query("preview_silver")
def q_preview_silver(spark, sf_dir):
    return layers.preview(silver(spark, sf_dir), fixed.PREVIEW_ROWS, KEYS)


@query("latest_per_tracking_id")
def q_latest_per_tracking_id(spark, sf_dir):
    """Merge form of the feed: one row per tracking id, the latest pickup time wins."""
    parsed = shipment_feed(spark, sf_dir).withColumn("pickup", parse_mixed_timestamp(F.col("pickup_raw")))
    return latest_per_key(parsed, ["tracking_id"], order_by=["pickup"])


@query("upsert_resent")
def q_upsert_resent(spark, sf_dir):
    """Merge of the feed with a resent part: shipments whose amount has 7 (or 14)
    characters come again as returned, a day later in the first and a day earlier in the second half of the cities."""
    parsed = shipment_feed(spark, sf_dir).withColumn("pickup", parse_mixed_timestamp(F.col("pickup_raw")))
    later = F.upper(F.trim(F.col("city"))) < F.lit("F")
    day = F.expr("interval 1 day")
    again = parsed.where(F.length("amount_raw") % 7 == 0).withColumns({
        "status": F.lit("RETURNED"), "pickup": F.when(later, F.col("pickup") + day).otherwise(F.col("pickup") - day)})
    return upsert(parsed, again, ["tracking_id"], order_by=["pickup"])


def _maintained(spark, sf_dir) -> str:
    """Root of a store that took the feed in two batches.

    The second brings a third of the tracking ids, sends a ninth of the first batch
    again as it was, brings every fifth courier for the first time and corrects
    the vehicle of others."""
    root = _scratch(spark, "store")
    third, ninth = F.pmod(F.crc32("tracking_id"), F.lit(3)), F.pmod(F.crc32("tracking_id"), F.lit(9))
    number = F.crc32("courier_id")
    feed, couriers = shipment_feed(spark, sf_dir), courier_feed(spark, sf_dir)

    def stamped(rows, name, at):
        return rows.select("*", F.lit(at).cast("timestamp").alias("ingestion_timestamp"), F.lit(name).alias("source_file"), F.lit("feed").alias("source_system"))

    early = couriers.where(number % 5 != 0).withColumn("vehicle", F.when(number % 5 == 1, F.lit("BIKE")).otherwise(F.col("vehicle")))
    maintain.apply_batch(spark, root, stamped(feed.where(third != 0), "s1", "2024-01-01 00:00:00"), stamped(early, "c1", "2024-01-01 00:00:00"), batch_id=0)
    late = couriers.where(number % 5 <= 1)
    maintain.apply_batch(spark, root, stamped(feed.where((third == 0) | (ninth == 1)), "s2", "2024-01-02 00:00:00"), stamped(late, "c2", "2024-01-02 00:00:00"), batch_id=1)
    return root


@query("incremental_equals_rebuild")
def q_incremental_equals_rebuild(spark, sf_dir):
    """Daily KPIs from the states of a store that took the feed in two batches, with a resend."""
    return cube.kpi_daily_city(maintain.read_cube(spark, _maintained(spark, sf_dir)))


@query("incremental_kpi_courier")
def q_incremental_kpi_courier(spark, sf_dir):
    """Courier KPIs from the same states."""
    return cube.kpi_courier(maintain.read_cube(spark, _maintained(spark, sf_dir)))


@query("incremental_silver")
def q_incremental_silver(spark, sf_dir):
    """Silver of that store: its median and its couriers are those of both batches."""
    return maintain.read_silver(spark, _maintained(spark, sf_dir))


@query("layer_counts")
def q_layer_counts(spark, sf_dir):
    # silver feeds three of the counts: written once as the pipeline does, then read back
    path, distinct = _scratch(spark, "silver-shipments"), _scratch(spark, "distinct-shipments")
    layers.write_layer(silver(spark, sf_dir, path=distinct), path)
    layers.remove(spark, distinct)
    s = layers.read_layer(spark, path)
    return quality.layer_row_counts({
        ("bronze", "shipments"): shipment_feed(spark, sf_dir),
        ("bronze", "couriers"): courier_feed(spark, sf_dir),
        ("silver", "shipments"): s,
        ("silver", "couriers"): _couriers(spark, sf_dir),
        ("gold", "kpi_daily_city"): kpi.kpi_daily_city(s),
        ("gold", "kpi_courier"): kpi.kpi_courier(s),
    })


@query("kpi_daily_one_city")
def q_kpi_daily_one_city(spark, sf_dir):
    """Dashboard slicer: daily KPIs of one city."""
    return kpi.filter_gold(kpi.kpi_daily_city(silver(spark, sf_dir)), city="Automobile")


@query("kpi_courier_employees")
def q_kpi_courier_employees(spark, sf_dir):
    """Dashboard slicer: courier KPIs of employed couriers."""
    return kpi.filter_gold(_courier_kpis(spark, sf_dir), contract="EMPLOYEE")


def queries() -> dict[str, Query]:
    return dict(QUERIES)
