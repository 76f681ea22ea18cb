"""Landing folders: header names, sub-folders, one writer per table, row counts."""

import os

import pytest
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.plans import pipeline
from lastmile.sources import files, layers
from lastmile.sources.feed import courier_feed, shipment_feed
from lastmile.streaming.incremental import ingest_available
from conftest import SF_SMALL


def _csv(folder, name, header, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(",".join(header) + "\n" + "".join(",".join(r) + "\n" for r in rows))


ROW = dict(zip(fixed.SHIPMENT_FIELDS, ("T1", "2024-01-01 08:00:00", "", "Madrid", "28001", "2,5", "DELIVERED", "REP-1", "PERSON", "9.5")))


def _record(header):
    return [f'"{ROW.get(c, "extra")}"' if ROW.get(c, "extra") else "" for c in header]


def test_columns_come_by_header_name(spark, tmp_path):
    header = ["zip", "more", "city", *[c for c in fixed.SHIPMENT_FIELDS if c not in ("zip", "city")]]
    _csv(f"{tmp_path}/in/d1/d2", "a.csv", header, [_record(header)] * 3)
    got = files.read_shipments_csv(spark, f"{tmp_path}/in")
    assert got.columns == list(schemas.RAW_SHIPMENT_COLUMNS) and got.count() == 3
    row = got.first()
    assert (row.city, row.zip, row.weight_raw, row.delivery_raw) == ("Madrid", "28001", "2,5", None)
    # another order in another file is an error, never swapped columns
    other = list(reversed(header))
    _csv(f"{tmp_path}/in/d3", "b.csv", other, [_record(other)])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_shipments_csv(spark, f"{tmp_path}/in").collect()
    with pytest.raises(ValueError, match="lacks"):
        _csv(f"{tmp_path}/bad", "a.csv", header[1:], [_record(header[1:])])
        files.read_shipments_csv(spark, f"{tmp_path}/bad")


def test_spanish_names_and_source_systems(spark, tmp_path):
    to_english = dict(zip(fixed.SPANISH_SHIPMENT_FIELDS, fixed.SHIPMENT_FIELDS))
    header = sorted(fixed.SPANISH_SHIPMENT_FIELDS)
    _csv(f"{tmp_path}/in", "a.csv", header, [[f'"{ROW[to_english[c]]}"' for c in header]])
    row = files.ingest_shipments(spark, f"{tmp_path}/in", vocab=fixed.SPANISH).first()
    assert (row.tracking_id, row.city, row.amount_raw, row.source_system, row.source_file) == ("T1", "Madrid", "9.5", "sistema_tracking_v1", "a.csv")


def test_batch_reads_sub_folders_and_refuses_an_empty_landing(spark, tmp_path):
    layout = pipeline.Layout(f"{tmp_path}/lake")
    files.write_shipments_csv(shipment_feed(spark, SF_SMALL), f"{layout.landing_shipments}/d1")
    files.write_couriers_json(courier_feed(spark, SF_SMALL), f"{layout.landing_couriers}/d1/d2")
    assert pipeline.run_bronze(spark, layout) == {"shipments": 6119, "couriers": 10}
    empty = pipeline.Layout(f"{tmp_path}/empty")
    os.makedirs(empty.landing_shipments)
    os.makedirs(empty.landing_couriers)
    with pytest.raises(Exception):
        pipeline.run_bronze(spark, empty)
    assert not os.path.exists(empty.path("bronze", "shipments"))


def test_batch_and_incremental_do_not_share_a_table(spark, tmp_path):
    layout = pipeline.Layout(f"{tmp_path}/lake")
    files.write_shipments_csv(shipment_feed(spark, SF_SMALL).limit(20), layout.landing_shipments)
    files.write_couriers_json(courier_feed(spark, SF_SMALL), layout.landing_couriers)
    assert pipeline.run_bronze_incremental(spark, layout)["shipments"] == 20
    with pytest.raises(ValueError, match="incremental"):
        pipeline.run_bronze(spark, layout)
    other = pipeline.Layout(f"{tmp_path}/other")
    files.write_shipments_csv(shipment_feed(spark, SF_SMALL).limit(20), other.landing_shipments)
    files.write_couriers_json(courier_feed(spark, SF_SMALL), other.landing_couriers)
    pipeline.run_bronze(spark, other)
    with pytest.raises(ValueError, match="batch"):
        pipeline.run_bronze_incremental(spark, other)
    assert layers.row_count(spark, other.path("bronze", "shipments")) == 20


def test_every_micro_batch_is_counted(spark, tmp_path):
    header = list(fixed.SHIPMENT_FIELDS)
    for k in range(110):  # progress reports are kept for the last 100 batches only
        _csv(f"{tmp_path}/in", f"f{k}.csv", header, [_record(header)])
    counted = ingest_available(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/ckpt", max_files_per_trigger=1)
    assert counted == 110 == layers.read_layer(spark, f"{tmp_path}/bronze").count()


def test_ingestion_time_is_stamped(spark, tmp_path):
    files.write_couriers_json(courier_feed(spark, SF_SMALL), f"{tmp_path}/in")
    stamped = files.ingest_couriers(spark, f"{tmp_path}/in")
    row = stamped.select(F.countDistinct("ingestion_timestamp").alias("n"), F.max(F.abs(F.unix_timestamp() - F.unix_timestamp("ingestion_timestamp"))).alias("age")).first()
    assert row.n == 1 and row.age < 600
    silver = pipeline.run_all(spark, SF_SMALL, f"{tmp_path}/lake")["silver"]
    again = pipeline.run_layers(spark, f"{tmp_path}/lake")["silver"]
    assert silver == again  # the default median is reproducible
    table = layers.read_layer(spark, f"{tmp_path}/lake/silver/shipments")
    assert table.where("silver_processed_ts >= bronze_ingestion_ts").count() == table.count()


def test_dirty_amounts_neither_stop_gold_nor_vanish(spark):
    from lastmile.operators import clean, kpi, quality
    from lastmile.operators.clean import normalize_shipments
    rows = [(f"T{k}", "2024-01-01 08:00:00", "2024-01-01 10:00:00", "Madrid", "28001", "2.0", "DELIVERED", "REP-1", "PERSON", a)
            for k, a in enumerate(["10.0", "1e30", "NaN", "Infinity", "-Infinity", "x", None, "2.5"])]
    raw = spark.createDataFrame(rows, schemas.RAW_SHIPMENTS)
    norm = normalize_shipments(raw).withColumns({"transit_hours": F.lit(1.0), "on_time": F.lit(1)})
    row = kpi.executive_summary(norm).first()
    assert row.revenue == 1e30 and row.total_shipments == 8  # 12.5 is less than the last bit
    couriers = clean.clean_couriers(spark.createDataFrame([("REP-1", "a", "b", "2020-01-01", "EMP", "Madrid", "VAN", None)], schemas.RAW_COURIERS))
    counts = quality.pipeline_counts(raw, couriers.select(*schemas.RAW_COURIER_COLUMNS), couriers)
    assert {r.check: r.value for r in quality.quality_metrics(counts).collect()}["amount_not_summable"] == 4


def test_large_amounts_are_summed_exactly(spark):
    from lastmile.functions import money_sum
    from lastmile.operators import cube
    amounts = [1e18, 1e30, -1e30, 3.0e35, -3.0e35, 9.99e17, 0.01, 0.02, -1e18, 123456789012345678.0, 2.5]
    want = sum(int(a) if abs(a) >= 2**53 else 0 for a in amounts) + 2.53
    for order in (amounts, amounts[::-1]):
        frame = spark.createDataFrame([(float(a),) for a in order], "amount double").repartition(3)
        assert frame.agg(money_sum(F.col("amount")).alias("s")).first().s == float(want)
    twice = spark.createDataFrame([(1e30,)] * 1000, "amount double")
    assert twice.agg(money_sum(F.col("amount")).alias("s")).first().s == pytest.approx(1e33, rel=1e-15)
    nothing = spark.createDataFrame([(None,), (float("nan"),), (1e300,)], "amount double")
    assert nothing.agg(money_sum(F.col("amount")).alias("s")).first().s is None
    rows = spark.createDataFrame([("T", "DELIVERED", 1, 1.0, float(a), None) for a in amounts], "tracking_id string, status string, on_time int, transit_hours double, amount double, city string")
    states = cube.delivery_states(rows.withColumn("pickup", F.lit("2024-01-01").cast("timestamp")), cube.DAY)
    assert cube.executive_summary(states).first().revenue == float(want)


def test_rounding_beyond_the_decimal_range(spark):
    from lastmile.functions import round2
    got = spark.createDataFrame([(1.005,), (1e12 + 0.126,), (float("inf"),), (None,)], "x double").select(round2(F.col("x")).alias("r")).collect()
    assert [r.r for r in got] == [1.01, 1000000000000.13, float("inf"), None]


def test_single_file_export_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "SINGLE_FILE_ROWS", 5)
    layers.export_csv(spark.range(5), f"{tmp_path}/a", single_file=True)
    with pytest.raises(ValueError, match="more than 5"):
        layers.export_csv(spark.range(6), f"{tmp_path}/b", single_file=True)
