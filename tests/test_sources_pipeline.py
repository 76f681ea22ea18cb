import os
import uuid

from pyspark.sql import functions as F

from lastmile.operators.merge import upsert
from lastmile.plans import pipeline
from lastmile.sources import files, layers
from lastmile.sources.feed import courier_feed, shipment_feed
from lastmile.streaming.incremental import current_bronze, ingest_available
from conftest import SF_SMALL, rows


def _dir(base, name):
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}")


def test_csv_and_json_roundtrip_keep_dirt(spark, scratch_dir):
    ship_path, cour_path = _dir(scratch_dir, "ship"), _dir(scratch_dir, "cour")
    feed = shipment_feed(spark, SF_SMALL)
    files.write_shipments_csv(feed, ship_path)
    back = files.read_shipments_csv(spark, ship_path)
    assert back.exceptAll(feed).count() == 0 and feed.exceptAll(back).count() == 0
    cour = courier_feed(spark, SF_SMALL)
    files.write_couriers_json(cour, cour_path)
    assert sorted(rows(files.read_couriers_json(spark, cour_path))) == sorted(rows(cour))


def test_audit_stamp_uses_file_name(spark, scratch_dir):
    path = _dir(scratch_dir, "land")
    files.write_couriers_json(courier_feed(spark, SF_SMALL), path)
    stamped = files.ingest_couriers(spark, path)
    assert {"ingestion_timestamp", "source_file", "source_system"} <= set(stamped.columns)
    names = {r[0] for r in stamped.select("source_file").distinct().collect()}
    assert all(n.endswith(".json") for n in names)


def test_table_detail_and_inventory(spark, scratch_dir):
    path = _dir(scratch_dir, "table")
    layers.write_layer(courier_feed(spark, SF_SMALL), path)
    detail = layers.table_detail(spark, path, "parquet", "couriers").first()
    on_disk = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert detail.num_files == len(on_disk)
    assert detail.size_in_bytes == sum(os.path.getsize(os.path.join(path, f)) for f in on_disk)
    inv = layers.landing_inventory(spark, path, "*.parquet")
    assert inv.count() == len(on_disk)


def test_export_csv_sorted_with_header(spark, scratch_dir):
    path = _dir(scratch_dir, "export")
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "score int, name string")
    layers.export_csv(df, path, [F.col("score")], single_file=True)
    part = [f for f in os.listdir(path) if f.startswith("part-")][0]
    with open(os.path.join(path, part)) as fh:
        assert fh.read() == "score,name\n1,a\n2,b\n3,c\n"


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("k1", 1, "a"), ("k2", 1, "b")], "k string, v int, x string")
    new = spark.createDataFrame([("k1", 2, "z"), ("k3", 1, "c")], "k string, v int, x string")
    once = upsert(old, new, ["k"], ["v"])
    twice = upsert(once, new, ["k"], ["v"])
    assert sorted(rows(once)) == sorted(rows(twice)) == [("k1", 2, "z"), ("k2", 1, "b"), ("k3", 1, "c")]


def test_streaming_ingest_appends_each_file_once(spark, scratch_dir):
    landing, bronze, ckpt = (_dir(scratch_dir, n) for n in ("landing", "bronze", "ckpt"))
    feed = shipment_feed(spark, SF_SMALL)
    first = feed.where(F.col("status") == "DELIVERED")
    files.write_shipments_csv(first, os.path.join(landing, "batch1"))
    assert ingest_available(spark, landing + "/*", bronze, ckpt) == first.count()
    assert ingest_available(spark, landing + "/*", bronze, ckpt) == 0          # nothing new: no duplicates
    second = feed.where(F.col("status") != "DELIVERED")
    files.write_shipments_csv(second.repartition(3), os.path.join(landing, "batch2"))
    assert ingest_available(spark, landing + "/*", bronze, ckpt, max_files_per_trigger=1) == second.count()
    total = layers.read_layer(spark, bronze)
    assert total.count() == feed.count()
    current = current_bronze(spark, bronze).count()
    assert feed.dropDuplicates().count() <= current <= feed.count()
    # the first batch is resent: appended, but counted once
    files.write_shipments_csv(first.coalesce(1), os.path.join(landing, "batch3"))
    assert ingest_available(spark, landing + "/*", bronze, ckpt) == first.count()
    assert layers.read_layer(spark, bronze).count() == feed.count() + first.count()
    resent = current_bronze(spark, bronze)
    assert resent.where(F.col("status") == "DELIVERED").count() == first.count()
    assert resent.columns == total.columns


def test_pipeline_end_to_end(spark, scratch_dir):
    root = _dir(scratch_dir, "lake")
    result = pipeline.run_all(spark, SF_SMALL, root, median_method="exact", register=True)
    assert result["bronze"] == {"shipments": 6119, "couriers": 10}
    s = result["silver"]
    assert (s["raw_rows"], s["in_range_rows"], s["dedup_rows"], s["silver_rows"]) == (6119, 6089, 5973, 5915)
    assert s["median_weight"] == 13.0 and s["orphan_shipments"] == 58
    layout = pipeline.Layout(root)
    silver = layers.read_layer(spark, layout.path("silver", "shipments"))
    assert len(silver.columns) == 19
    inv = dict(((r.layer, r.table_name), r.rows) for r in pipeline.layer_inventory(spark, layout).collect())
    assert inv[("silver", "shipments")] == 5915 and inv[("gold", "kpi_courier")] == 10
    exported = spark.read.option("header", True).csv(layout.path("export", "kpi_courier"))
    assert exported.count() == 10
    # layers are also reachable by name, like catalog tables
    assert spark.table("silver.shipments").count() == 5915
    assert {r.tableName for r in spark.sql("SHOW TABLES IN gold").collect()} >= {"kpi_courier", "kpi_daily_city"}
    report = dict(layers.read_layer(spark, layout.path("gold", "silver_quality")).collect())
    assert report["silver_rows"] == 5915.0 and report["duplicates_removed"] == 116.0


def test_incremental_pipeline_appends_new_files_once(spark, scratch_dir):
    root = _dir(scratch_dir, "inc")
    layout = pipeline.Layout(root)
    feed = shipment_feed(spark, SF_SMALL)
    files.write_shipments_csv(feed.where(F.col("status") == "DELIVERED"), os.path.join(layout.landing_shipments, "b1"))
    files.write_couriers_json(courier_feed(spark, SF_SMALL), os.path.join(layout.landing_couriers, "b1"))
    first = pipeline.run_layers(spark, root, "exact", incremental=True)
    n_delivered = feed.where(F.col("status") == "DELIVERED").count()
    assert first["bronze"] == {"shipments": n_delivered, "couriers": 10}
    again = pipeline.run_layers(spark, root, "exact", incremental=True)
    assert again["bronze"] == {"shipments": 0, "couriers": 0}      # nothing new, nothing appended
    assert again["silver"]["raw_rows"] == n_delivered
    files.write_shipments_csv(feed.where(F.col("status") != "DELIVERED"), os.path.join(layout.landing_shipments, "b2"))
    last = pipeline.run_layers(spark, root, "exact", incremental=True)
    assert last["silver"]["raw_rows"] == 6119 and last["silver"]["silver_rows"] == 5915


def test_incremental_pipeline_keeps_the_latest_courier_record(spark, scratch_dir):
    root = _dir(scratch_dir, "inc-couriers")
    layout = pipeline.Layout(root)
    couriers = courier_feed(spark, SF_SMALL)
    files.write_shipments_csv(shipment_feed(spark, SF_SMALL), os.path.join(layout.landing_shipments, "b1"))
    files.write_couriers_json(couriers, os.path.join(layout.landing_couriers, "b1"))
    pipeline.run_layers(spark, root, "exact", incremental=True)
    changed = couriers.where(F.col("courier_id") == "REP-00001").withColumn("vehicle", F.lit("E-BIKE"))
    files.write_couriers_json(changed, os.path.join(layout.landing_couriers, "b2"))
    result = pipeline.run_layers(spark, root, "exact", incremental=True)
    assert result["bronze"]["couriers"] == 1
    silver_couriers = layers.read_layer(spark, layout.path("silver", "couriers"))
    assert silver_couriers.count() == 10
    assert silver_couriers.where(F.col("courier_id") == "REP-00001").first().vehicle == "E-BIKE"
    assert result["silver"]["silver_rows"] == 5915
