import datetime as dt

from pyspark.sql import functions as F

from lastmile.functions import (
    canonical_city, canonical_contract, fix_decimal_comma, money_sum, on_time_flag, pad_zip,
    parse_date, parse_mixed_timestamp, ratio_pct, round2, to_double, transit_hours,
)
from lastmile.functions.timecols import with_time_dimensions
from conftest import rows


def test_parse_mixed_timestamp_iso_then_european(spark):
    df = spark.createDataFrame(
        [("2024-03-05 10:20:30",), ("05/03/2024 10:20:30",), ("2024/03/05 10:20",), ("",), (None,)], "s string")
    got = rows(df.select(parse_mixed_timestamp(F.col("s")).alias("ts")))
    assert got == [(dt.datetime(2024, 3, 5, 10, 20, 30),), (dt.datetime(2024, 3, 5, 10, 20, 30),),
                   (None,), (None,), (None,)]


def test_parse_date_tolerates_dirt(spark):
    df = spark.createDataFrame([("2021-07-09",), ("09/07/2021",), (None,)], "s string")
    assert rows(df.select(parse_date(F.col("s")))) == [(dt.date(2021, 7, 9),), (None,), (None,)]


def test_canonical_city(spark):
    df = spark.createDataFrame([("  MADRID  ",), ("madrid",), ("san SEBASTIAN",), ("\tbilbao",), (None,)], "c string")
    got = [r[0] for r in rows(df.select(canonical_city(F.col("c"))))]
    # trim strips spaces only; initcap splits words on spaces only
    assert got == ["Madrid", "Madrid", "San Sebastian", "\tbilbao", None]


def test_pad_zip_pads_and_truncates_like_lpad(spark):
    df = spark.createDataFrame([("8045",), ("28045",), ("123456",), ("",), (None,)], "z string")
    assert [r[0] for r in rows(df.select(pad_zip(F.col("z"))))] == ["08045", "28045", "12345", "00000", None]


def test_decimal_comma_and_numeric_cast(spark):
    df = spark.createDataFrame([("2,4",), ("12.5",), ("1,234,5",), ("abc",), (None,)], "w string")
    got = [r[0] for r in rows(df.select(to_double(fix_decimal_comma(F.col("w")))))]
    assert got == [2.4, 12.5, None, None, None]


def test_canonical_contract(spark):
    df = spark.createDataFrame([("employee",), ("EMP",), ("Employee",), ("contractor",), ("freelance",),
                                ("empleado ",), (None,)], "c string")
    got = [r[0] for r in rows(df.select(canonical_contract(F.col("c"))))]
    assert got == ["EMPLOYEE", "EMPLOYEE", "EMPLOYEE", "CONTRACTOR", "FREELANCE", "EMPLEADO ", None]


def test_transit_hours_and_sla_bound_inclusive(spark):
    p = dt.datetime(2024, 1, 1, 8, 0, 0)
    data = [
        ("DELIVERED", p, p + dt.timedelta(hours=24)),
        ("DELIVERED", p, p + dt.timedelta(hours=24, seconds=1)),
        ("DELIVERED", p, p + dt.timedelta(minutes=121)),
        ("INCIDENT", p, p + dt.timedelta(hours=2)),
        ("RETURNED", p, None),
        ("DELIVERED", None, p),
    ]
    df = spark.createDataFrame(data, "status string, pickup timestamp, delivery timestamp")
    got = rows(df.select(transit_hours(F.col("pickup"), F.col("delivery")),
                         on_time_flag(F.col("status"), F.col("pickup"), F.col("delivery"))))
    assert got == [(24.0, 1), (24.0, 0), (2.02, 1), (2.0, 0), (None, 0), (None, 0)]


def test_round2_is_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (40.625,), (2.675,), (-1.005,)], "x double")
    assert [r[0] for r in rows(df.select(round2(F.col("x"))))] == [1.01, 40.63, 2.68, -1.01]


def test_ratio_pct_golden_case(spark):
    df = spark.createDataFrame([(26, 64), (1, 3), (0, 7)], "a long, b long")
    assert [r[0] for r in rows(df.select(ratio_pct(F.col("a"), F.col("b"))))] == [40.63, 33.33, 0.0]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.005,)], "a double")
    assert rows(df.agg(money_sum(F.col("a")))) == [(1.01,)]


def test_time_dimensions_weekday_starts_sunday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 6, 2, 23, 59, 0),)], "pickup timestamp")
    out = with_time_dimensions(df)
    assert rows(out, "day", "year", "month", "weekday", "hour") == [(dt.date(2024, 6, 2), 2024, 6, 1, 23)]


def test_shaped_timestamps_take_no_pattern_and_agree_with_patterns(spark):
    texts = ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-01-01 24:00:00", "2024-01-01 23:59:60", "0000-01-01 00:00:00", "29/02/2024 00:00:00",
             "01/13/2024 00:00:00", "2024-01-01", "2024-01-01T08:00:00", " 2024-01-01 08:00:00", "2024-01-01 08:00:00\n", "2024-01-01 08:00:00.5", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    by_pattern = F.coalesce(*[F.try_to_timestamp("s", F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss")])
    parsed = parse_mixed_timestamp(F.col("s"))
    assert rows(df.select("s", by_pattern.alias("a"), parsed.alias("b")).where("not (a <=> b)")) == []
    assert str(parsed._jc).find("CASE WHEN") >= 0  # the shape is looked at before any pattern
    assert "regexp" not in str(fix_decimal_comma(F.col("s"))._jc)
