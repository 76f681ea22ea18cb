import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lastmile.operators.ranking import exact_quantile, global_rank, top_k


def _data(spark, n=400, distinct=37, nulls=5, seed=7):
    rnd = random.Random(seed)
    vals = [(i, float(rnd.randrange(distinct)) / 4) for i in range(n)] + [(n + i, None) for i in range(nulls)]
    return spark.createDataFrame(vals, "id long, v double")


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("buckets", [None, 4])
def test_histogram_rank_equals_sql_rank(spark, descending, buckets):
    df = _data(spark)
    order = F.col("v").desc() if descending else F.col("v").asc()
    expected = {r.id: r.rk for r in df.select("id", F.rank().over(Window.orderBy(order)).alias("rk")).collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", descending, buckets=buckets).collect()}
    assert got == expected


def test_histogram_rank_with_one_hot_value(spark):
    # a third of the rows share one value
    vals = [(i, 5.0 if i % 3 == 0 else float(i % 17)) for i in range(300)]
    df = spark.createDataFrame(vals, "id long, v double")
    expected = {r.id: r.rk for r in df.select("id", F.rank().over(Window.orderBy(F.desc("v"))).alias("rk")).collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=3).collect()}
    assert got == expected


@pytest.mark.parametrize("q", [0.1, 0.3, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("buckets", [None, 5])
def test_exact_quantile_equals_percentile_disc(spark, q, buckets):
    df = _data(spark, n=301)
    expected = df.selectExpr(f"percentile_disc({q}) within group (order by v) as p").collect()[0].p
    got = exact_quantile(df, "v", q, buckets=buckets).collect()[0][0]
    assert got == expected


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "k string, n long")
    got = [r.k for r in top_k(df, 3, F.desc("n"), F.asc("k")).collect()]
    assert got == ["c", "a", "b"]


@pytest.mark.parametrize("buckets", [None, 3])
def test_ranks_keep_the_type_of_the_value(spark, buckets):
    """Longs above 2^53 and decimals that would tie as doubles."""
    from decimal import Decimal

    from lastmile.operators.ranking import global_ranks
    big = 2**53
    df = spark.createDataFrame([(big + k, Decimal(big) + Decimal(k) / 100) for k in range(6)] + [(None, None), (big, None)], "a long, b decimal(20,2)")
    got = global_ranks(df, [("a", "ra", True), ("b", "rb", False)], buckets).collect()
    for r in got:
        others = [x.a for x in got if x.a is not None]
        assert r.ra == (1 + sum(x > r.a for x in others) if r.a is not None else 1 + len(others))
        low = [x.b for x in got]
        assert r.rb == (1 if r.b is None else 1 + sum(x is None or x < r.b for x in low))


@pytest.mark.parametrize("seed", range(3))
def test_ranks_against_sql_on_random_values(spark, seed):
    rnd = random.Random(seed)
    df = spark.createDataFrame([(k, rnd.choice([None, 1.5, float("nan"), 2.0, -0.0, 0.0, rnd.random()])) for k in range(200)], "id long, v double")
    for descending in (True, False):
        order = F.desc("v") if descending else F.asc("v")
        want = {r.id: r.w for r in df.select("id", F.rank().over(Window.orderBy(order)).alias("w")).collect()}
        assert {r.id: r.rk for r in global_rank(df, "v", "rk", descending).collect()} == want


def test_fine_error_bounds_are_exact(spark):
    from lastmile.operators.ranking import approx_quantile_value
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    assert approx_quantile_value(df, "v", 0.5, 0) == 501.0 == approx_quantile_value(df, "v", 0.5, 1e-6)
    assert abs(approx_quantile_value(df, "v", 0.5, 0.01) - 501) <= 15


def test_building_a_quantile_reads_its_input_once(spark):
    """Two calls on the same rows give the same value."""
    df = _data(spark)
    assert len({exact_quantile(df, "v").first()[0] for _ in range(3)}) == 1


def _values(seed, n=500):
    rnd = random.Random(seed)
    kinds = [lambda: rnd.gauss(0, 1), lambda: rnd.choice([0.0, -0.0, 1.5, -1.5]), lambda: rnd.lognormvariate(0, 20) * rnd.choice([1, -1]), lambda: None,
             lambda: float("inf") * rnd.choice([1, -1]), lambda: float("nan"), lambda: 7.0, lambda: 7.0 + rnd.random() * 1e-3]
    return [(rnd.choice(kinds)(),) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_bucket_quantiles_equal_percentile_disc(spark, seed):
    from lastmile.operators.ranking import quantile_value
    df = spark.createDataFrame(_values(seed), "v double")
    for q in (0.01, 0.25, 0.5, 0.77, 1.0):
        want = df.selectExpr(f"percentile_disc({q}) within group (order by v) as p").first().p
        got = quantile_value(df, "v", q)
        assert got == want or (got != got and want != want)


def test_bucket_order_follows_the_value(spark):
    from lastmile.operators.ranking import order_bucket
    values = sorted({v for v, in _values(1) + _values(2) if v is not None and v == v} | {5e-324, -5e-324, 1.7976931348623157e308})
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", order_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_approximate_quantile_is_within_its_error_at_every_partitioning(spark):
    from lastmile.operators.ranking import approx_quantile_value
    rnd = random.Random(5)
    values = [rnd.lognormvariate(3, 1) for _ in range(3000)] + [12.5] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0.1, 0.5, 0.9):
        found = {approx_quantile_value(df.repartition(n), "v", q, 0.01) for n in (1, 3, 8)}
        assert len(found) == 1
        at = found.pop()
        assert at in values
        assert sum(v < at for v in values) / len(values) <= q + 0.01 and sum(v <= at for v in values) / len(values) >= q - 0.01


def test_weighted_quantile(spark):
    from lastmile.operators.ranking import quantile_value
    df = spark.createDataFrame([(1.0, 5), (2.0, 1), (3.0, 5), (None, 100)], "v double, n long")
    assert [quantile_value(df, "v", q, weight="n") for q in (0.4, 0.5, 0.9)] == [1.0, 2.0, 3.0]
    assert quantile_value(df.limit(0), "v", weight="n") is None
