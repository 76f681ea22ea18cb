"""A store that takes batches holds what a rebuild from all of them holds."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lastmile import schemas, session
from lastmile.operators import clean, cube, enrich, kpi
from lastmile.plans import pipeline
from lastmile.sources import files, layers
from lastmile.sources.feed import courier_feed, shipment_feed
from lastmile.streaming import maintain
from conftest import SF_SMALL, rows

COURIERS = [("R1", "a", "b", "2020-01-01", "EMP", "Madrid", "VAN", None), ("R2", "c", "d", "2020-01-01", "CONTRACTOR", "Vigo", "BIKE", "1")]


def _raw(k, weight="2.0", courier="R1", day="01", amount="10.5", city="Madrid"):
    return (f"T{k}", f"2024-01-{day} 08:00:00", f"2024-01-{day} 20:00:00", city, "28001", weight, "DELIVERED", courier, "PERSON", amount)


def _stamped(spark, values, schema, name, hour):
    frame = spark.createDataFrame(values, schema)
    return frame.select("*", F.lit(f"2024-02-01 {hour:02d}:00:00").cast("timestamp").alias("ingestion_timestamp"), F.lit(name).alias("source_file"), F.lit("s").alias("source_system"))


def _apply(spark, root, k, shipments=None, couriers=None):
    return maintain.apply_batch(
        spark, root, _stamped(spark, shipments, schemas.RAW_SHIPMENTS, f"s{k}", k) if shipments else None,
        _stamped(spark, couriers, schemas.RAW_COURIERS, f"c{k}", k) if couriers else None, batch_id=k)


def _rebuilt(spark, shipments, couriers):
    return enrich.silver_shipments(spark.createDataFrame(shipments, schemas.RAW_SHIPMENTS), clean.clean_couriers(spark.createDataFrame(couriers, schemas.RAW_COURIERS)))


def _same(spark, root, shipments, couriers):
    want, got = _rebuilt(spark, shipments, couriers), maintain.read_silver(spark, root)
    assert got.columns == want.columns
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(want)))
    states = maintain.read_cube(spark, root)
    assert sorted(map(str, rows(cube.kpi_daily_city(states)))) == sorted(map(str, rows(kpi.kpi_daily_city(want))))
    assert rows(cube.executive_summary(states)) == rows(kpi.executive_summary(want))


def test_resends_imputation_and_couriers(spark, tmp_path):
    root = f"{tmp_path}/store"
    # T3 has no weight and a twin with the weight that becomes the median; T4's courier comes later
    first = [_raw(1), _raw(1), _raw(2, "4,0"), _raw(3, None), _raw(3, "6.0"), _raw(4, "6.0", "R2"), _raw(5, "999"), _raw(6, "6.0", None), _raw(9, None, city=None)]
    assert _apply(spark, root, 0, first, COURIERS[:1])
    _same(spark, root, first, COURIERS[:1])
    # T1 again as one copy, T2 as it was; other weights move the median
    second = [_raw(1), _raw(2, "4,0"), _raw(7, "6.0", day="02"), _raw(8, "6.5", day="02")]
    changed = [*COURIERS[1:], (*COURIERS[0][:6], "MOTO", None)]
    assert _apply(spark, root, 1, second, changed)
    in_force = [r for r in first if r[0] not in ("T1", "T2")] + second
    _same(spark, root, in_force, changed)
    assert maintain.median_weight(maintain.Store(spark, root)) == 6.0
    assert maintain.read_silver(spark, root).where("tracking_id = 'T3'").count() == 1  # the twins have become one
    # the same batch again changes nothing
    assert not _apply(spark, root, 1, second, changed)
    _same(spark, root, in_force, changed)


def test_empty_stores_and_empty_results(spark, tmp_path):
    assert maintain.read_silver(spark, f"{tmp_path}/none").count() == 0
    assert maintain.read_cube(spark, f"{tmp_path}/none").count() == 0
    _apply(spark, f"{tmp_path}/bad", 0, [_raw(1, "999"), _raw(2, "-1")], COURIERS)
    assert maintain.read_silver(spark, f"{tmp_path}/bad").count() == 0
    _apply(spark, f"{tmp_path}/nulls", 0, [_raw(1, None)], COURIERS)
    assert [r.weight for r in maintain.read_silver(spark, f"{tmp_path}/nulls").collect()] == [None]


def test_a_batch_reads_and_writes_no_other_bucket(spark, tmp_path):
    root = f"{tmp_path}/store"
    _apply(spark, root, 0, [_raw(k) for k in range(300)], COURIERS)
    before = maintain.Store(spark, root)
    _apply(spark, root, 1, [_raw(1000, day="02"), _raw(7, "3.0")])
    after = maintain.Store(spark, root)
    touched = {f"bucket={r.b}" for r in spark.createDataFrame([("T1000",), ("T7",)], "tracking_id string").select(maintain.bucket_of().alias("b")).collect()}
    for table in ("records", "core", "counts"):
        assert len(before.parts[table]) > 25
        assert {p for p in after.parts[table] if after.parts[table][p] != before.parts[table].get(p)} == touched
    # a part that is not asked for is in no plan
    plan = after.read("records", touched)
    assert {f.rsplit("/", 2)[-2] for f in plan.inputFiles()} == touched
    assert sum(1 for _ in plan.inputFiles()) < 10


def test_a_batch_that_fails_changes_nothing(spark, tmp_path):
    root = f"{tmp_path}/store"
    _apply(spark, root, 0, [_raw(1), _raw(2, "4,0")], COURIERS)
    was = sorted(map(str, rows(maintain.read_silver(spark, root))))
    # the records of the batch are written, then its couriers fail
    broken = _stamped(spark, COURIERS, schemas.RAW_COURIERS, "c", 3).withColumn("vehicle", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        maintain.apply_batch(spark, root, _stamped(spark, [_raw(1, "9.0"), _raw(3)], schemas.RAW_SHIPMENTS, "s", 3), broken, batch_id=1)
    assert sorted(map(str, rows(maintain.read_silver(spark, root)))) == was
    assert _apply(spark, root, 1, [_raw(3)])
    _same(spark, root, [_raw(1), _raw(2, "4,0"), _raw(3)], COURIERS)


def test_states_of_parts_add_up(spark):
    silver = enrich.silver_shipments(shipment_feed(spark, SF_SMALL), clean.clean_couriers(courier_feed(spark, SF_SMALL)))
    keys = (*cube.DAY, *schemas.COURIER_KEYS)
    half = F.crc32("tracking_id") % 2
    parts = [cube.delivery_states(silver.where(half == k), keys) for k in (0, 1)]
    whole = cube.merge_states(parts[0].unionByName(parts[1]), keys)
    want = {"kpi_daily_city": kpi.kpi_daily_city(silver), "by_vehicle": kpi.by_vehicle(silver), "monthly_sla_city": kpi.monthly_sla_city(silver),
            "kpi_courier": kpi.kpi_courier(silver), "city_volume": kpi.city_volume(silver)}
    tables = cube.gold_tables(whole)
    for name, frame in want.items():
        assert tables[name].schema.simpleString() == frame.schema.simpleString()
        assert sorted(map(str, rows(tables[name]))) == sorted(map(str, rows(frame))), name


def test_the_maintained_job_takes_only_new_files(spark, tmp_path):
    layout = pipeline.Layout(f"{tmp_path}/lake")
    feed, couriers = shipment_feed(spark, SF_SMALL), courier_feed(spark, SF_SMALL)
    files.write_shipments_csv(feed.where("status = 'DELIVERED'"), os.path.join(layout.landing_shipments, "b1"))
    files.write_couriers_json(couriers, os.path.join(layout.landing_couriers, "b1"))
    first = pipeline.run_maintained(spark, layout.root)
    assert first["merged_batches"] == {"couriers": 1, "shipments": 1}
    assert pipeline.run_maintained(spark, layout.root)["merged_batches"] == {"couriers": 0, "shipments": 0}
    files.write_shipments_csv(feed.where("status <> 'DELIVERED'"), os.path.join(layout.landing_shipments, "b2"))
    assert pipeline.run_maintained(spark, layout.root)["merged_batches"] == {"couriers": 0, "shipments": 1}
    assert maintain.read_silver(spark, layout.path("store", "delivery")).count() == 5915
    summary = layers.read_layer(spark, layout.path("gold", "executive_summary")).first()
    want = kpi.executive_summary(enrich.silver_shipments(feed, clean.clean_couriers(couriers))).first()
    assert summary == want


def test_records_and_clean_rows_move_once_a_step(spark):
    schema = maintain.TABLES["records"][0]
    old = spark.createDataFrame([], schema)
    merged = maintain.merged_records(old, old, maintain.bucket_of())
    for frame in (merged, maintain._clean_rows(merged.drop("bucket"), maintain.bucket_of())):
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        steps = 1 if frame is merged else 2
        assert plan.count("Exchange hashpartitioning(bucket") == plan.count("Exchange hash") == steps


def test_a_resend_moves_no_state_and_twins_are_found(spark, tmp_path):
    root = f"{tmp_path}/store"
    first = [_raw(1), _raw(3, None), _raw(3, "6.0"), _raw(None, "6.0"), _raw(None, "4,0")]
    _apply(spark, root, 0, first, COURIERS)
    # the same shipments in other spellings, one of them a twin that comes later
    second = [_raw(1, "2,0"), _raw(3, "6,0"), _raw(1, None)]
    _apply(spark, root, 1, second)
    _same(spark, root, first + second, COURIERS)
    store = maintain.Store(spark, root)
    assert sorted((r.tracking_id, r.beside) for r in store.read("beside").collect()) == [("T1", 2.0), ("T3", 6.0)]
    assert store.read("cube").agg({"rows": "sum"}).first()[0] == 6


def test_a_resend_adds_no_run(spark, tmp_path):
    """Records that were there are merged, and nothing is cleaned or added up again."""
    root = f"{tmp_path}/store"
    first = [_raw(k) for k in range(40)]
    _apply(spark, root, 0, first, COURIERS)
    before = maintain.Store(spark, root)
    _apply(spark, root, 1, first[:20] + first[:5])
    after = maintain.Store(spark, root)
    assert after.parts["records"] != before.parts["records"]
    for table in ("core", "cube", "beside"):
        assert after.parts.get(table) == before.parts.get(table), table
    _apply(spark, root, 2, [_raw(100), _raw(0, "4.0")])
    last = maintain.Store(spark, root)
    assert last.read("core", version=last.parts["cube"]["part=2024"][-1]).count() == 2  # not the other rows of their buckets
    _same(spark, root, first + first[:5] + [_raw(100), _raw(0, "4.0")], COURIERS)


def test_full_parts_become_one_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(maintain, "RUNS", 2)
    root, taken = f"{tmp_path}/store", []
    for k in range(4):
        # T1 gets twins in every batch, T9 once more of the same clean row
        batch = [_raw(1, None if k % 2 else f"{k + 2}.0"), _raw(10 + k, "6.0"), _raw(9, "2,0" if k else "2.0")]
        taken += batch
        _apply(spark, root, k, batch, COURIERS if k == 0 else None)
        _same(spark, root, taken, COURIERS)
    store = maintain.Store(spark, root)
    assert max(len(runs) for t in ("core", "cube", "beside") for runs in store.parts[t].values()) <= 2
    assert sorted((r.tracking_id, r.beside) for r in store.read("beside").collect()) == [("T1", 2.0), ("T1", 4.0)]
    # what is no longer named has gone
    assert len(layers.names_in(spark, f"{root}/cube")) <= 3
    assert layers.names_in(spark, f"{root}/incoming") == []


def test_a_store_from_before_runs_goes_on(spark, tmp_path):
    root = f"{tmp_path}/store"
    first = [_raw(k, "4,0" if k % 3 else None) for k in range(12)]
    _apply(spark, root, 0, first, COURIERS)
    store, version = maintain.Store(spark, root), layers.new_version()
    # one version a part, all weights in one part
    store.read("weights").groupBy("weight").agg(F.sum("n").alias("n")).withColumn("part", F.lit("all")).write.partitionBy("part").parquet(f"{root}/weights/{version}")
    store.parts["weights"] = {"part=all": [version]}
    note = {"applied": store.applied, "buckets": store.buckets, "parts": {t: {p: runs[-1] for p, runs in parts.items()} for t, parts in store.parts.items()}}
    layers.name_version(spark, root, version, json.dumps(note))
    _same(spark, root, first, COURIERS)
    _apply(spark, root, 1, [_raw(50, "8.0"), _raw(1, "4.0")])
    _same(spark, root, first + [_raw(50, "8.0"), _raw(1, "4.0")], COURIERS)
    assert maintain.Store(spark, root).read("weights").agg({"n": "sum"}).first()[0] == 10


def _shuffles(spark):
    """Files of shuffles that the session's machine holds."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in (str(blocks.apply(k)) for k in range(blocks.size())) if b.startswith("shuffle_")}


def test_shuffle_files_go_with_each_write(spark, tmp_path):
    before, wanted = _shuffles(spark), spark.conf.get(session.FREE_SHUFFLES)
    _apply(spark, f"{tmp_path}/store", 0, [_raw(k) for k in range(50)], COURIERS)
    left = _shuffles(spark) - before
    for _ in range(50):
        if len(left) < 10:  # small ones of collected counts
            break
        time.sleep(0.2)
        left = _shuffles(spark) - before
    assert len(left) < 10, sorted(left)
    assert spark.conf.get(session.FREE_SHUFFLES) == wanted


def test_gold_of_states_that_leave_nothing(spark):
    """States of several runs add up, and a group that is taken back wholly has no row."""
    silver = enrich.silver_shipments(spark.createDataFrame([_raw(1), _raw(2, day="02")], schemas.RAW_SHIPMENTS), clean.clean_couriers(spark.createDataFrame(COURIERS, schemas.RAW_COURIERS)))
    keys = (*cube.DAY, *schemas.COURIER_KEYS)
    gone = cube.delivery_states(silver.where("tracking_id = 'T2'").withColumn("_sign", F.lit(-1)), keys, sign="_sign")
    states = cube.delivery_states(silver, keys).unionByName(gone)
    assert [str(r.day) for r in cube.kpi_daily_city(states).collect()] == ["2024-01-01"]
    assert cube.kpi_by(states, "vehicle").first().total_shipments == 1
    assert [r.shipments for r in cube.kpi_courier(states, 1).collect()] == [1]


def test_the_audit_time_is_that_of_the_last_file(spark, tmp_path):
    root = f"{tmp_path}/store"
    _apply(spark, root, 0, [_raw(1), _raw(2)], COURIERS)
    _apply(spark, root, 1, [_raw(2), _raw(3)])
    times = {r.tracking_id: r.bronze_ingestion_ts.hour for r in maintain.read_silver(spark, root, audit=True).collect()}
    assert times == {"T1": 0, "T2": 1, "T3": 1}
