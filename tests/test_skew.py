"""A hot key (a third of all rows) through the shuffle paths: sort-merge join
with AQE skew splitting, partial aggregation, dedup and ranks stay exact."""

import contextlib
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lastmile.operators import clean, enrich, integrity, kpi
from lastmile.operators.merge import latest_per_key


@contextlib.contextmanager
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _shipments(spark, n=3000):
    p = dt.datetime(2024, 1, 1, 8)
    rows = []
    for i in range(n):
        courier = "REP-HOT" if i % 3 == 0 else f"REP-{i % 40:03d}"
        if i % 97 == 0:
            courier = "REP-UNKNOWN"
        status = "DELIVERED" if i % 5 else "INCIDENT"
        rows.append((f"T{i}", courier, p, p + dt.timedelta(hours=10 + i % 20) if status == "DELIVERED" else None,
                     "Madrid", "28001", 1.0 + i % 7, status, "PERSON", 10.0 + i % 3))
    return spark.createDataFrame(rows, "tracking_id string, courier_id string, pickup timestamp, delivery timestamp, "
                                       "city string, zip string, weight double, status string, client_type string, "
                                       "amount double")


def _couriers(spark):
    ids = ["REP-HOT"] + [f"REP-{i:03d}" for i in range(40)]
    return spark.createDataFrame([(c, "N", "L", "EMPLOYEE", "Madrid", "VAN") for c in ids],
                                 "courier_id string, first_name string, last_name string, contract string, "
                                 "assigned_city string, vehicle string")


def test_hot_courier_join_and_ranks_are_exact(spark):
    ship, cour = _shipments(spark), _couriers(spark)
    with no_broadcast(spark):
        enriched = enrich.enrich_with_courier(ship, cour).transform(enrich.with_delivery_measures)
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        n_orphans = integrity.orphans(ship, cour).count()
        silver = enriched.select(*[c for c in enriched.columns])
        gold = kpi.kpi_courier(silver).collect()
    assert n_orphans == len([i for i in range(3000) if i % 97 == 0])
    assert enriched.count() + n_orphans == 3000
    by_id = {r.courier_id: r for r in gold}
    expected_hot = len([i for i in range(3000) if i % 3 == 0 and i % 97 != 0])
    assert by_id["REP-HOT"].shipments == expected_hot and by_id["REP-HOT"].volume_rank == 1
    check = spark.createDataFrame(gold).select(
        "courier_id", "quality_rank", F.rank().over(Window.orderBy(F.desc("sla_pct"))).alias("q"))
    assert all(r.quality_rank == r.q for r in check.collect())


def test_hot_key_dedup_and_merge(spark):
    # one key repeated in a third of the rows, with differing payloads
    rows = [("HOT" if i % 3 == 0 else f"K{i}", i % 11, f"x{i % 5}") for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v int, x string")
    with no_broadcast(spark):
        latest = {r.k: (r.v, r.x) for r in latest_per_key(df, ["k"], ["v"]).collect()}
        smallest = {r.k: (r.v, r.x) for r in clean.dedup_by_key(df, ["k"]).collect()}
    hot = [(v, x) for k, v, x in rows if k == "HOT"]
    assert latest["HOT"] == max(hot) and smallest["HOT"] == min(hot)
    assert len(latest) == len(smallest) == 1 + len([i for i in range(900) if i % 3])


def _hot_tables(spark, n=6000):
    """Raw-like couriers (through the cleaning step) and shipments, a third on one id."""
    raw = spark.range(41).selectExpr(
        "if(id = 0, 'REP-HOT', concat('REP-', lpad(cast(id as string), 3, '0'))) as courier_id", "'N' as first_name", "'L' as last_name",
        "'2020-01-02' as hire_date", "'employee' as contract", "'Madrid' as assigned_city", "'VAN' as vehicle", "'1' as phone")
    ship = spark.range(n).selectExpr(
        "concat('T', id) as tracking_id", "timestamp'2024-01-01 08:00:00' as pickup",
        "timestamp'2024-01-01 08:00:00' + make_interval(0, 0, 0, 0, cast(5 + id % 30 as int)) as delivery", "'Madrid' as city", "'28001' as zip",
        "cast(1 + id % 7 as double) as weight", "if(id % 5 = 0, 'INCIDENT', 'DELIVERED') as status",
        "if(id % 3 = 0, 'REP-HOT', if(id % 97 = 1, 'REP-NONE', concat('REP-', lpad(cast(1 + id % 40 as string), 3, '0')))) as courier_id",
        "'PERSON' as client_type", "10.0D as amount")
    return ship, clean.clean_couriers(raw)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_level_joins_split_a_hot_courier(spark):
    ship, couriers = _hot_tables(spark)
    with no_broadcast(spark):
        for frame in (enrich.enrich_with_courier(ship, couriers), integrity.orphans(ship, couriers), integrity.mark_orphans(ship, couriers),
                      integrity.quarantine(ship, couriers), integrity.join_reconciliation(ship, couriers),
                      kpi.kpi_daily_city(enrich.enrich_with_courier(ship, couriers).transform(enrich.with_delivery_measures))):
            assert "skew=true" in _final_plan(frame)


def test_courier_aggregates_and_orphan_ids_join_one_row_per_courier(spark):
    ship, couriers = _hot_tables(spark)
    measured = enrich.with_delivery_measures(ship)
    before = kpi.courier_aggregates_before_join(measured, couriers)
    silver = enrich.enrich_with_courier(ship, couriers).transform(enrich.with_delivery_measures)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, kpi.courier_aggregates(silver).select(before.columns).collect()))
    with no_broadcast(spark):
        for frame in (before, integrity.orphan_ids(ship, couriers)):
            lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
            join = next(k for k, line in enumerate(lines) if "Join" in line)
            left = next(line for line in lines[join + 1:] if "Aggregate" in line or "Range" in line)
            assert "Aggregate" in left  # shipments are aggregated below the join
        assert [r.courier_id for r in integrity.orphan_ids(ship, couriers).collect()] == ["REP-NONE"]


def test_salted_join_deals_a_hot_courier_without_adaptive_splitting(spark):
    from lastmile.operators import skewjoin
    n = 6000
    facts = spark.range(n).select(F.col("id").cast("string").alias("tracking_id"),
                                  F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.concat(F.lit("C"), F.col("id") % 500)).alias("courier_id"))
    dimension = spark.createDataFrame([("HOT", 1)] + [(f"C{k}", k) for k in range(400)], "courier_id string, x int")
    hot = skewjoin.hot_keys(facts, "courier_id", 0.05)
    assert set(hot) == {"HOT"} and abs(hot["HOT"] - 1 / 3) < 0.001
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skewjoin.salted_join(facts, dimension, "courier_id", skewjoin.salts_of(hot, 0.005))
        assert "skew=true" not in joined._jdf.queryExecution().executedPlan().toString()
        sizes = sorted(r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        for how in ("inner", "left", "left_semi", "left_anti"):
            got = skewjoin.salted_join(facts, dimension, "courier_id", skewjoin.salts_of(hot, 0.005), how=how)
            want = facts.join(dimension, ["courier_id"], how)
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
