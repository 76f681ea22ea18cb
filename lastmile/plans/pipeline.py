"""Bronze -> silver -> gold -> export on paths.

Each layer is written once (a new version of its table, parquet) and the next layer reads
it back, which also cuts the lineage between stages. Step counts come from the
written tables, instead of one ``count()`` action per step over the raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.functions import count_where
from lastmile.operators import clean, cube, enrich, kpi, quality, skewjoin
from lastmile.operators.merge import latest_per_key
from lastmile.sources import files, layers
from lastmile.streaming import maintain
from lastmile.streaming.incremental import current_bronze, ingest_available
from lastmile.sources.feed import courier_feed, shipment_feed


@dataclass(frozen=True)
class Layout:
    """Folder layout of one pipeline root (a shared folder on a cluster).

    With ``register`` every written table is also exposed in the session
    catalog as ``<layer>.<table>`` (external parquet table on the folder).
    """

    root: str
    register: bool = False

    def path(self, layer: str, table: str) -> str:
        return layers.layer_path(self.root, layer, table)

    def write(self, df: DataFrame, layer: str, table: str) -> None:
        path = self.path(layer, table)
        layers.publish(df, path)
        if self.register:
            layers.register_layer(df.sparkSession, layer, table, path)

    @property
    def landing_shipments(self) -> str:
        return self.path("landing", "shipments")

    @property
    def landing_couriers(self) -> str:
        return self.path("landing", "couriers")


def land_feed(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    """Write the dirty feeds derived from the test tables as raw files (CSV, JSON Lines)."""
    files.write_shipments_csv(shipment_feed(spark, sf_dir), layout.landing_shipments)
    files.write_couriers_json(courier_feed(spark, sf_dir), layout.landing_couriers)


def run_bronze(spark: SparkSession, layout: Layout, vocab: fixed.Vocabulary = fixed.ENGLISH) -> dict[str, int]:
    """Raw files -> bronze tables (no business change, audit columns added).

    Lines that are no records go to ``bronze/<kind>_rejected``. Returns the rows of the
    written tables."""
    counts = {}
    landings = {"shipments": layout.landing_shipments, "couriers": layout.landing_couriers}
    for name in landings:
        path = layout.path("bronze", name)
        if layers.is_stream_table(spark, path):
            raise ValueError(f"{path} is appended by the incremental job; rebuild it in a root of its own")
    for name, landing in landings.items():
        marked = files.marked_lines(spark, landing, name, vocab)
        layout.write(files.stamped_records(marked, name, vocab), "bronze", name)
        layout.write(files.stamped_rejects(marked, name, vocab), "bronze", f"{name}_rejected")
        counts[name] = layers.row_count(spark, layout.path("bronze", name))
    return counts


def run_bronze_incremental(spark: SparkSession, layout: Layout,
                           vocab: fixed.Vocabulary = fixed.ENGLISH) -> dict[str, int]:
    """Append the landing files not ingested yet to bronze (Structured Streaming,
    ``availableNow``): each file is ingested exactly once across runs, the stream
    checkpoints live under the pipeline root."""
    counts = {}
    for kind, landing in (("shipments", layout.landing_shipments), ("couriers", layout.landing_couriers)):
        counts[kind] = ingest_available(
            spark, landing, layout.path("bronze", kind), layout.path("_checkpoints", f"bronze_{kind}"),
            kind=kind, vocab=vocab)
        rejected = f"{kind}_rejected"
        ingest_available(spark, landing, layout.path("bronze", rejected), layout.path("_checkpoints", f"bronze_{rejected}"),
                         kind=kind, vocab=vocab, rejected=True)
        if layout.register:
            for name in (kind, rejected):
                layers.register_layer(spark, "bronze", name, layout.path("bronze", name))
    return counts


def run_silver(spark: SparkSession, layout: Layout, median_method: str = "exact",
               vocab: fixed.Vocabulary = fixed.ENGLISH, appended: bool = False) -> dict[str, int | float]:
    """Bronze -> clean couriers and clean, enriched shipments, with the step counts.

    ``appended``: bronze was appended over several runs, so a courier sent
    again keeps its most recently ingested record and a resent shipment file
    counts once. Bronze is read once, into ``silver/shipments_checked`` (distinct cleaned rows
    with their copies and the sums of the per-row checks). The median, silver and all
    counts come from that table and the tables written after it: counts belong to
    committed files, so a task that runs twice counts once.
    """
    bronze_ship = (current_bronze(spark, layout.path("bronze", "shipments")) if appended
                   else layers.read_layer(spark, layout.path("bronze", "shipments")))
    bronze_cour = layers.read_layer(spark, layout.path("bronze", "couriers"))
    if appended:
        bronze_cour = latest_per_key(bronze_cour, ["courier_id"], ["ingestion_timestamp"])

    layout.write(clean.clean_couriers(bronze_cour, vocab.contract_canon), "silver", "couriers")
    couriers = layers.read_layer(spark, layout.path("silver", "couriers"))
    layout.write(quality.checked_groups(bronze_ship, stamped=True), "silver", "shipments_checked")
    checked = layers.read_layer(spark, layout.path("silver", "shipments_checked"))

    in_range = clean.filter_weight_range(checked)
    median = clean.median_value(in_range, "weight", median_method, weight="n")
    # of exact copies the first ingestion counts, whatever the order of tasks
    dedup = clean.fill_and_merge(in_range, median, fixed.SHIPMENT_KEY_COLUMNS, rest=("ingestion_timestamp",))
    salts = skewjoin.salts_of(skewjoin.hot_keys(checked.select("courier_id"), "courier_id"))
    silver = enrich.silver_of_clean(dedup, couriers, audit=True, vocab=vocab, salts=salts)
    layout.write(silver, "silver", "shipments")

    metrics: dict[str, int | float] = {"median_weight": median}
    metrics |= quality.group_counts(checked).first().asDict()
    metrics["dedup_rows"] = dedup.count()
    metrics["silver_rows"] = layers.row_count(spark, layout.path("silver", "shipments"))
    metrics["in_range_rows"] = metrics["raw_rows"] - metrics["weight_out_of_range"]
    metrics["duplicates_removed"] = metrics["in_range_rows"] - metrics["dedup_rows"]
    metrics["orphan_shipments"] = metrics["dedup_rows"] - metrics["silver_rows"]
    kept = couriers.agg(F.count(F.lit(1)).alias("rows"), count_where(F.col("phone").isNull()).alias("null_phone")).first()
    metrics["courier_rows"], metrics["null_phone_kept"] = kept["rows"], kept["null_phone"]
    for kind in ("shipments", "couriers"):
        metrics[f"rejected_{kind}"] = layers.row_count(spark, layout.path("bronze", f"{kind}_rejected"))
    metrics["yield_pct"] = round(100.0 * metrics["silver_rows"] / metrics["raw_rows"], 2) if metrics["raw_rows"] else 0.0
    # A fixed, small set of numbers: stored next to the layers as a quality report.
    report = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in metrics.items()], "check string, value double")
    layout.write(report.coalesce(1), "gold", "silver_quality")
    return metrics


#: States by day, city and courier, from which the gold tables are finished.
CUBE = "delivery_cube"


def _publish_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    tables = cube.gold_tables(layers.read_layer(spark, layout.path("gold", CUBE)))
    for name, df in tables.items():
        layout.write(df, "gold", name)
    return {name: layers.read_layer(spark, layout.path("gold", name)) for name in tables}


def run_gold(spark: SparkSession, layout: Layout, vocab: fixed.Vocabulary = fixed.ENGLISH) -> dict[str, DataFrame]:
    """Silver -> daily KPIs by city, courier KPIs with ranks, executive summary, monthly SLA.

    Each table is aggregated from the columns of silver that it needs. States by day, city
    and courier hardly have fewer rows than the shipments where couriers carry few a day; they
    pay where shipments are not to be read again (:func:`run_maintained`)."""
    silver = layers.read_layer(spark, layout.path("silver", "shipments"))
    tables = {
        "kpi_daily_city": kpi.kpi_daily_city(silver, vocab),
        "kpi_courier": kpi.kpi_courier(silver, vocab=vocab),
        "executive_summary": kpi.executive_summary(silver, vocab),
        "monthly_sla_city": kpi.monthly_sla_city(silver),
    }
    for name, df in tables.items():
        layout.write(df, "gold", name)
    return {name: layers.read_layer(spark, layout.path("gold", name)) for name in tables}


def run_maintained(spark: SparkSession, root: str, vocab: fixed.Vocabulary = fixed.ENGLISH, register: bool = False) -> dict:
    """Landing -> bronze (appended) -> store -> gold, where each step takes only what is new.

    The store (``ROOT/store``) merges the appended rows into the buckets that they touch;
    gold is finished from its states. Silver is read from the store
    (``maintain.read_silver``); no step reads all shipments."""
    layout = Layout(root, register)
    bronze = run_bronze_incremental(spark, layout, vocab)
    store = layout.path("store", "delivery")
    merged = {kind: maintain.maintain_available(spark, layout.path("bronze", kind), kind, store, layout.path("_checkpoints", f"store_{kind}"), vocab)
              for kind in ("couriers", "shipments")}
    states = maintain.read_cube(spark, store, vocab)
    layout.write(cube.merge_states(states, [c for c in states.columns if c not in cube.STATES]), "gold", CUBE)
    _publish_gold(spark, layout)
    run_export(spark, layout)
    return {"bronze": bronze, "merged_batches": merged}


def run_export(spark: SparkSession, layout: Layout) -> None:
    """CSV exports of the gold tables for BI tools (sorted, header, UTF-8, LF)."""
    couriers = layers.read_layer(spark, layout.path("gold", "kpi_courier"))
    layers.export_csv(couriers, layout.path("export", "kpi_courier"), [F.col("score"), F.col("courier_id")])
    daily = layers.read_layer(spark, layout.path("gold", "kpi_daily_city"))
    layers.export_csv(daily, layout.path("export", "kpi_daily_city"), [F.col("day"), F.col("city")])


def layer_inventory(spark: SparkSession, layout: Layout) -> DataFrame:
    """Row count of every written table (parquet footers make the counts cheap)."""
    from lastmile.operators.quality import layer_row_counts
    tables = {(layer, name): layers.read_layer(spark, layout.path(layer, name))
              for layer, name in (("bronze", "shipments"), ("bronze", "couriers"),
                                  ("silver", "shipments"), ("silver", "couriers"),
                                  ("gold", "kpi_daily_city"), ("gold", "kpi_courier"))}
    return layer_row_counts(tables)


def run_layers(spark: SparkSession, root: str, median_method: str = "exact",
               vocab: fixed.Vocabulary = fixed.ENGLISH, register: bool = False,
               incremental: bool = False) -> dict:
    """Bronze -> silver -> gold -> export for files already in ``root``/landing.

    ``incremental``: bronze is appended with the landing files not seen before
    (the rows returned are the rows appended by this run) instead of rebuilt;
    silver and gold are rebuilt from the whole bronze either way.
    """
    layout = Layout(root, register)
    bronze = run_bronze_incremental(spark, layout, vocab) if incremental else run_bronze(spark, layout, vocab)
    silver = run_silver(spark, layout, median_method, vocab, appended=incremental)
    run_gold(spark, layout, vocab)
    run_export(spark, layout)
    return {"bronze": bronze, "silver": silver}


def run_all(spark: SparkSession, sf_dir: str, root: str, median_method: str = "exact",
            register: bool = False) -> dict:
    """Land the feed derived from the test tables, then run every layer."""
    land_feed(spark, sf_dir, Layout(root))
    return run_layers(spark, root, median_method, register=register)
