"""Randomised properties (hypothesis): rounding, ranks and quantiles."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lastmile.functions import round2
from lastmile.operators.ranking import exact_quantile, global_rank

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=40))
def test_round2_is_half_up_of_the_decimal_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round2(F.col("x"))).collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.00000001"), ROUND_HALF_UP)
                  .quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=12)), min_size=1, max_size=60),
       st.sampled_from([None, 2, 3]), st.booleans())
def test_histogram_rank_equals_window_rank(spark, values, buckets, descending):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    order = F.col("v").desc() if descending else F.col("v").asc()
    want = {r.id: r.rk for r in df.select("id", F.rank().over(Window.orderBy(order)).alias("rk")).collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", descending, buckets=buckets).collect()}
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=30), min_size=1, max_size=60),
       st.floats(min_value=0.01, max_value=1.0), st.sampled_from([None, 2, 4]))
def test_exact_quantile_equals_percentile_disc(spark, values, q, buckets):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    want = df.selectExpr(f"percentile_disc({q}) within group (order by v) as p").first().p
    assert exact_quantile(df, "v", q, buckets=buckets).first()[0] == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(min_value=0, max_value=9)),
                          st.one_of(st.none(), st.sampled_from([0.5, 1.25, 2.0, 40.63, 99.99]))),
                min_size=1, max_size=50),
       st.booleans(), st.booleans())
def test_global_ranks_equal_window_ranks(spark, pairs, desc_a, desc_b):
    from lastmile.operators.ranking import global_ranks
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id long, a long, b double")
    oa = F.col("a").desc() if desc_a else F.col("a").asc()
    ob = F.col("b").desc() if desc_b else F.col("b").asc()
    want = {r.id: (r.ra, r.rb) for r in df.select(
        "id", F.rank().over(Window.orderBy(oa)).alias("ra"), F.rank().over(Window.orderBy(ob)).alias("rb")).collect()}
    got = {r.id: (r.ra, r.rb) for r in global_ranks(df, [("a", "ra", desc_a), ("b", "rb", desc_b)]).collect()}
    assert got == want


TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ áÉñ\t-0")), max_size=12)


def _initcap_trim(s):
    """The city rule in plain Python: strip spaces only, lowercase, capitalise after each space."""
    s = s.strip(" ").lower()
    return " ".join(w[:1].upper() + w[1:] for w in s.split(" "))


def _lpad5(s):
    return s[:5] if len(s) >= 5 else "0" * (5 - len(s)) + s


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=30))
def test_city_and_zip_rules_match_their_statement(spark, values):
    from lastmile.functions import canonical_city, pad_zip
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = df.orderBy("i").select(canonical_city(F.col("s")), pad_zip(F.col("s"))).collect()
    want = [(None, None) if v is None else (_initcap_trim(v), _lpad5(v)) for v in values]
    assert [tuple(r) for r in got] == want
