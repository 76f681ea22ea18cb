import time

import pytest

from lastmile.plans import catalog
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables_read(spark, query, table="lineitem.parquet"):
    """How often the jobs of a query scan a table: the plans of all tables that it writes, and its own."""
    from pyspark.sql import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def noted(self, path, *rest, **more):
        plans.append(_plan(self._df))
        return write(self, path, *rest, **more)

    DataFrameWriter.parquet = noted
    try:
        plans.append(_plan(catalog.QUERIES[query](spark, SF_SMALL)))
    finally:
        DataFrameWriter.parquet = write
    return plans


def test_scan_reads_only_needed_columns(spark):
    plan = "".join(_tables_read(spark, "summary"))
    assert "l_comment" not in plan and "l_tax" not in plan and "l_discount" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_fact_join_is_sort_merge_and_dimension_join_is_sized_by_spark(spark):
    plans = _tables_read(spark, "silver")
    assert any("SortMergeJoin" in plan for plan in plans)
    assert "BroadcastHashJoin" in plans[-1]       # courier dimension is small here (size-checked by Spark)


@pytest.mark.parametrize("name", ["silver", "kpi_daily", "summary", "kpi_courier", "top_cities", "monthly_sla_city", "quality"])
def test_facts_are_scanned_and_joined_once(spark, name):
    """Median and clean rows come from one pass over line items and orders."""
    plans = _tables_read(spark, name)
    assert sum(plan.count("lineitem.parquet") for plan in plans) == 1
    assert sum(plan.count("orders.parquet") for plan in plans) == 1
    assert sum("SortMergeJoin" in plan for plan in plans) == 1


def test_ranks_share_one_range_exchange(spark, monkeypatch):
    from lastmile.operators import ranking
    frozen, made = ranking.materialize, []
    monkeypatch.setattr(ranking, "materialize", lambda df: made.append(_plan(df)) or frozen(df))
    catalog.QUERIES["kpi_courier"](spark, SF_SMALL)
    assert sum(plan.count("rangepartitioning") for plan in made) == 1


def test_courier_ranking_has_no_window_over_the_courier_rows(spark):
    df = catalog.QUERIES["kpi_courier"](spark, SF_SMALL)
    plan = _plan(df)
    # ranks come from a histogram joined back on the value: no rank() window in the plan
    assert "rank(" not in plan.lower()


def test_dedup_is_partial_aggregate(spark):
    plan = _plan(catalog.QUERIES["dedup_shipments"](spark, SF_SMALL))
    # map-side (partial) aggregate before the shuffle, final aggregate after it
    assert plan.count("HashAggregate") >= 2


def _single_partition_children(plan: str) -> list[str]:
    """The operator right below each ``Exchange SinglePartition`` of a plan string."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            out.append(lines[i + 1].strip(" :+-"))
    return out


def _bounded(child: str) -> bool:
    """A partial global aggregate (one row per task) or bucket totals (one row per bucket)."""
    return child.startswith(("HashAggregate(keys=[], functions=[partial_", "HashAggregate(keys=[_bucket#"))


def test_no_single_partition_exchange_over_courier_rows(spark):
    plan = _plan(catalog.QUERIES["kpi_courier"](spark, SF_SMALL))
    children = _single_partition_children(plan)
    assert children is not None, "expected bounded single-partition steps (global aggregates, histogram windows)"
    for child in children:
        assert _bounded(child), child


WRITES_FILES = {"csv_roundtrip", "json_roundtrip", "ingest_shipments", "ingest_couriers", "layer_roundtrip", "export_kpi_courier"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - WRITES_FILES))
def test_every_query_has_only_bounded_single_partition_steps(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    for child in _single_partition_children(plan):
        assert _bounded(child), (name, child)


def test_quarantine_reads_the_fact_table_once(spark):
    assert _plan(catalog.QUERIES["quarantine"](spark, SF_SMALL)).count("lineitem.parquet") == 1


def test_layer_counts_checkpoint_no_fact_table(spark):
    """Silver is written and read back as parquet: no checkpointed rows of its width."""
    plan = _plan(catalog.QUERIES["layer_counts"](spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "Scan ExistingRDD[" in line]
    assert all("tracking_id" not in line for line in scans)


def test_imputation_runs_the_feed_once(spark):
    """The rows in range are written and give the median: the result reads no line item."""
    assert "lineitem.parquet" not in _plan(catalog.QUERIES["impute_median_approx"](spark, SF_SMALL))


def test_layer_counts_keeps_neither_distinct_rows_nor_shuffles(spark):
    """What silver is made of goes as soon as silver is written."""
    from lastmile.session import ensure_checkpoint_dir
    from lastmile.sources import layers
    folder = ensure_checkpoint_dir(spark)
    before, blocks = set(layers.names_in(spark, folder)), _shuffled_bytes(spark)
    catalog.QUERIES["layer_counts"](spark, SF_SMALL)
    made = {n.rsplit("-", 1)[0] for n in set(layers.names_in(spark, folder)) - before}
    assert "silver-shipments" in made and "distinct-shipments" not in made
    for _ in range(50):
        if _shuffled_bytes(spark) - blocks < 300_000:
            break
        time.sleep(0.2)
    assert _shuffled_bytes(spark) - blocks < 300_000  # the feed alone shuffles more


def _shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_"))
