"""Empty inputs, all-null columns and unparsable values go through without errors."""

from pyspark.sql import functions as F

from lastmile import schemas
from lastmile.operators import clean, enrich, kpi, quality
from lastmile.operators.ranking import exact_quantile, global_rank

COURIERS = ("courier_id string, first_name string, last_name string, hire_date string, contract string, "
            "assigned_city string, vehicle string, phone string")


def _raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_SHIPMENTS)


def _couriers(spark):
    return clean.clean_couriers(spark.createDataFrame(
        [("REP-1", "A", "B", "2020-01-01", "EMP", "Bilbao", "VAN", None)], COURIERS))


def test_empty_feed(spark):
    raw = _raw(spark, [])
    silver = enrich.silver_shipments(raw, _couriers(spark), "exact")
    assert silver.count() == 0
    assert kpi.kpi_courier(silver).count() == 0
    assert kpi.kpi_daily_city(silver).count() == 0
    summary = kpi.executive_summary(silver).first()
    assert summary.total_shipments == 0 and summary.sla_pct is None
    counts = quality.pipeline_counts(raw, spark.createDataFrame([], COURIERS), _couriers(spark), "exact").first()
    assert counts.raw_rows is None or counts.raw_rows == 0


def test_all_weights_null_keeps_nulls(spark):
    rows = [(f"T{i}", "2024-01-01 10:00:00", None, "bilbao", "48001", None, "INCIDENT", "REP-1", "PERSON", "1.0")
            for i in range(5)]
    for method in ("exact", "approx"):
        out = clean.impute_median(clean.normalize_shipments(_raw(spark, rows)), "weight", method)
        assert out.where(F.col("weight").isNotNull()).count() == 0


def test_unparsable_dates_form_their_own_group(spark):
    rows = [("T1", "not a date", None, "Bilbao", "48001", "1.0", "DELIVERED", "REP-1", "PERSON", "2.0"),
            ("T2", "2024-01-01 10:00:00", "2024-01-01 20:00:00", "Bilbao", "48001", "1.0", "DELIVERED", "REP-1",
             "PERSON", "2.0")]
    silver = enrich.silver_shipments(_raw(spark, rows), _couriers(spark), "exact")
    daily = {(r.day is None): r for r in kpi.kpi_daily_city(silver).collect()}
    assert daily[True].total_shipments == 1 and daily[True].sla_pct == 0.0 and daily[True].avg_transit_h is None
    assert daily[False].sla_pct == 100.0 and daily[False].avg_transit_h == 10.0


def test_rank_and_quantile_of_empty_and_single_rows(spark):
    empty = spark.createDataFrame([], "v double")
    assert global_rank(empty, "v", "r").count() == 0
    assert exact_quantile(empty, "v").first()[0] is None
    one = spark.createDataFrame([(3.5,)], "v double")
    assert global_rank(one, "v", "r").first().r == 1
    assert exact_quantile(one, "v").first()[0] == 3.5
