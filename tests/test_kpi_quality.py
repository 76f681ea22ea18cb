import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lastmile.operators import kpi
from lastmile.plans import catalog
from conftest import SF_SMALL, rows

SILVER = ("tracking_id string, courier_id string, pickup timestamp, delivery timestamp, city string, zip string, "
          "weight double, status string, client_type string, amount double, courier_first_name string, "
          "courier_last_name string, contract string, assigned_city string, vehicle string, "
          "transit_hours double, on_time int")


def _silver(spark, per_courier):
    p = dt.datetime(2024, 5, 1, 9)
    data = []
    for cid, (n, n_on_time) in per_courier.items():
        for i in range(n):
            on = i < n_on_time
            data.append((f"{cid}-{i}", cid, p, p + dt.timedelta(hours=10 if on else 30), "Bilbao", "48001", 1.0,
                         "DELIVERED", "PERSON", 10.0, "N", "L", "EMPLOYEE", "Bilbao", "VAN",
                         10.0 if on else 30.0, 1 if on else 0))
    return spark.createDataFrame(data, SILVER)


def test_kpi_courier_threshold_ties_and_score(spark):
    s = _silver(spark, {"A": (20, 10), "B": (20, 15), "C": (12, 6), "D": (9, 9)})
    out = {r.courier_id: r for r in kpi.kpi_courier(s).collect()}
    assert set(out) == {"A", "B", "C"}           # D has fewer than 10 shipments
    assert (out["A"].volume_rank, out["B"].volume_rank, out["C"].volume_rank) == (1, 1, 3)
    assert (out["B"].quality_rank, out["A"].quality_rank, out["C"].quality_rank) == (1, 2, 2)
    assert out["A"].sla_pct == 50.0 and out["B"].score == 1.0 and out["C"].score == 2.5


def test_kpi_courier_matches_window_rank(spark):
    gold = catalog.QUERIES["kpi_courier"](spark, SF_SMALL)
    check = gold.select("courier_id", "volume_rank", "quality_rank",
                        F.rank().over(Window.orderBy(F.desc("shipments"))).alias("v"),
                        F.rank().over(Window.orderBy(F.desc("sla_pct"))).alias("q"))
    assert all(r.volume_rank == r.v and r.quality_rank == r.q for r in check.collect())


def test_summary_and_top_lists(spark):
    s = catalog.silver(spark, SF_SMALL)
    summary = kpi.executive_summary(s).first()
    assert summary.total_shipments == 5915
    assert summary.delivered + summary.incidents + summary.returned == 5915
    top = rows(kpi.top_cities(s))
    assert len(top) == 3 and top[0][1] >= top[1][1] >= top[2][1]


def test_monthly_sla_is_computed_from_rows(spark):
    s = catalog.silver(spark, SF_SMALL)
    m = kpi.monthly_sla_city(s)
    assert m.count() == 414
    assert m.agg(F.sum("on_time")).first()[0] == 3091


def test_quality_metrics_and_funnel(spark):
    q = dict(rows(catalog.QUERIES["quality"](spark, SF_SMALL)))
    assert q["raw_rows"] == 6119 and q["weight_out_of_range"] == 30
    assert q["duplicates_removed"] == 6089 - 5973 and q["orphan_shipments"] == 58
    assert q["unparsed_pickup"] == 0 and q["bad_zip_length"] == 0 and q["null_weight_left"] == 0
    assert q["european_pickup"] == 634 and q["decimal_comma_weight"] == 100
    funnel = rows(catalog.QUERIES["funnel"](spark, SF_SMALL).orderBy("step_no"), "rows", "removed")
    assert funnel[0][0] == 6119 and funnel[-1][0] == 5915
    # the funnel sums to the input: final rows + everything removed = raw rows
    assert funnel[-1][0] + sum(r[1] for r in funnel) == 6119
