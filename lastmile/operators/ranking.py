"""Global ranks and quantiles without a single-partition window.

``rank().over(Window.orderBy(...))`` moves every row to one task. Here the
work is split into distributed steps, the same ones at every size:

1. histogram: ``groupBy(value).count()`` (partial aggregation, so a value
   held by a third of all rows costs one row per map task);
2. range buckets: ``repartitionByRange`` over the distinct values (sampled
   bounds, binary search per value); the partition id is the bucket;
3. per-bucket totals (one row a partition) give the count of rows before
   each bucket;
4. inside a bucket a window partitioned by the bucket adds the running count.

Result: for every distinct value, in its own type, the exact number of rows up
to it. Several ranks share one tagged histogram, range partitioning and
checkpoint; they are joined back to the rows on the value (null-safe equality).

Quantiles of numbers take one aggregate instead: values fall into logarithmic
buckets (128 an octave, an order-preserving function of the value), and each
bucket keeps its count, smallest and largest value. Such states merge in any
order, so the result does not depend on the partitioning. The bucket that holds the
quantile is the answer if it holds one value, or few enough rows for the error
allowed; else its values alone go through the histogram above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile.functions.numeric import round2
from lastmile.session import materialize

#: Logarithmic buckets of an octave, and what lifts the exponents of doubles above zero.
OCTAVE, LIFT, NOT_A_NUMBER = 128, 1 << 18, 1 << 20


def value_histogram(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct value (null included) with its row count ``n``."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def cumulative_counts(hist: DataFrame, order: Column, buckets: int | None = None) -> DataFrame:
    """Add ``cum_le`` (rows up to this value in ``order``) and ``total`` to a histogram.

    ``hist`` has one row per distinct value and a count column ``n``. It is cut
    into range buckets (``spark.sql.shuffle.partitions`` of them unless given)
    and materialized with its bucket: the totals and the running counts must
    see the same buckets, and the scan and aggregation behind the histogram run
    once. No task holds more than the distinct values of its bucket.
    """
    ranged = hist.repartitionByRange(buckets, order) if buckets else hist.repartitionByRange(order)
    bucketed = materialize(ranged.withColumn("_bucket", F.spark_partition_id()))
    totals = bucketed.groupBy("_bucket").agg(F.sum("n").alias("_bucket_n"))
    # one row a bucket
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket",
        F.coalesce(F.sum("_bucket_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_bucket_n").over(Window.partitionBy()).alias("total"))
    running = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = bucketed.withColumn("_running", F.sum("n").over(running))
    return (counted.join(offsets, "_bucket")
            .withColumn("cum_le", F.col("_before") + F.col("_running"))
            .drop("_bucket", "_before", "_running"))


def global_rank(df: DataFrame, value: str, out: str, descending: bool = True,
                buckets: int | None = None) -> DataFrame:
    """Add ``out`` = SQL ``rank()`` over ``value`` (ties share, gaps follow).

    Descending order puts nulls last, ascending puts them first (Spark's
    defaults for ``desc`` and ``asc``). ``df`` is read twice (histogram and join
    back): pass a materialized frame when it is expensive.
    """
    return global_ranks(df, [(value, out, descending)], buckets)


def global_ranks(df: DataFrame, specs: Sequence[tuple[str, str, bool]],
                 buckets: int | None = None) -> DataFrame:
    """Several ``rank()`` columns: ``specs`` = [(value, out, descending), ...].

    One histogram of (rank number, value) serves all of them, whatever the values' types."""
    names = [f"_v{k}" for k in range(len(specs))]
    orders = [F.col(n).desc_nulls_last() if descending else F.col(n).asc_nulls_first() for n, (_, _, descending) in zip(names, specs)]

    def tagged(k: int) -> Column:
        values = [F.col(v) if j == k else F.lit(None).cast(df.schema[v].dataType) for j, (v, _, _) in enumerate(specs)]
        return F.struct(F.lit(k).alias("_tag"), *[v.alias(n) for v, n in zip(values, names)])

    hist = df.select(F.explode(F.array(*[tagged(k) for k in range(len(specs))])).alias("_t")).select("_t.*")
    hist = hist.groupBy("_tag", *names).agg(F.count(F.lit(1)).alias("n"))
    ranged = hist.repartitionByRange(buckets, "_tag", *orders) if buckets else hist.repartitionByRange("_tag", *orders)
    bucketed = materialize(ranged.withColumn("_bucket", F.spark_partition_id()))
    totals = bucketed.groupBy("_bucket", "_tag").agg(F.sum("n").alias("_bucket_n"))  # one row a bucket and rank
    before = Window.partitionBy("_tag").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", "_tag", F.coalesce(F.sum("_bucket_n").over(before), F.lit(0)).alias("_before"))
    running = Window.partitionBy("_bucket", "_tag").orderBy(*orders).rowsBetween(Window.unboundedPreceding, 0)
    counted = bucketed.withColumn("_running", F.sum("n").over(running)).join(offsets, ["_bucket", "_tag"])
    counted = counted.withColumn("_rank", (F.col("_before") + F.col("_running") - F.col("n") + 1).cast("int"))
    for k, (value, out, _) in enumerate(specs):
        ranks = counted.where(F.col("_tag") == k).select(F.col(names[k]).alias("_rank_value"), F.col("_rank").alias(out))
        df = df.join(ranks, df[value].eqNullSafe(ranks["_rank_value"]), "left").drop("_rank_value")
    return df


def order_bucket(value: Column) -> Column:
    """Number of a value's logarithmic bucket; larger values never have a smaller one."""
    x = value.cast("double")
    size = F.floor(F.log2(F.least(F.abs(x), F.lit(1.7e308))) * OCTAVE) + LIFT
    return F.when(F.isnan(x), F.lit(NOT_A_NUMBER)).when(x == 0, F.lit(0)).otherwise(F.when(x > 0, size).otherwise(-size)).cast("int")


def quantile_value(df: DataFrame, value: str, q: float = 0.5, relative_error: float = 0.0, weight: str | None = None):
    """The smallest value whose cumulative share of rows reaches ``q`` (nulls ignored);
    null without values. With ``relative_error``, a value of the data at most that share of
    rows before it. ``weight``: a column with the number of rows that a row stands for.

    One aggregate over logarithmic buckets; only where the bucket that holds the
    quantile has several values and too many rows are its values counted one by one.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(value), (F.col(weight) if weight else F.lit(1)).alias("n"))
    states = rows.withColumn("_bucket", order_bucket(F.col(value))).groupBy("_bucket").agg(
        F.sum("n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    order = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)  # one row a bucket
    running = states.select("*", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))
    reached = running.where(F.col("upto") >= F.lit(q) * F.col("total"))
    found = reached.agg(F.min(F.struct("_bucket", "n", "low", "high", "upto", "total")).alias("at")).first()["at"]
    if found is None:
        return None
    if found["_bucket"] == NOT_A_NUMBER or found["low"] == found["high"] or found["n"] <= relative_error * found["total"]:
        return found["low"]
    inside = rows.where(order_bucket(F.col(value)) == found["_bucket"]).groupBy(value).agg(F.sum("n").alias("n"))
    before = found["upto"] - found["n"]
    cum = cumulative_counts(inside, F.col(value).asc())
    return cum.where(F.col("cum_le") + before >= F.lit(q) * found["total"]).agg(F.min(value).alias("v")).first()["v"]


def _one_row(df: DataFrame, value: str, out: str, found) -> DataFrame:
    return df.sparkSession.createDataFrame([(found,)], T.StructType([T.StructField(out, df.schema[value].dataType)]))


def exact_quantile(df: DataFrame, value: str, q: float = 0.5, out: str = "quantile",
                   buckets: int | None = None) -> DataFrame:
    """One-row frame with ``percentile_disc(q)`` of ``value`` (nulls ignored).

    The smallest value whose cumulative share of rows reaches ``q``. Numbers take
    :func:`quantile_value`; other types, or a given number of range ``buckets``, the histogram.
    """
    if buckets is None and isinstance(df.schema[value].dataType, T.NumericType):
        return _one_row(df, value, out, quantile_value(df, value, q))
    hist = value_histogram(df.select(value).where(F.col(value).isNotNull()), value)
    cum = cumulative_counts(hist, F.col(value).asc(), buckets)
    return (cum.where(F.col("cum_le") >= F.lit(q) * F.col("total"))
            .agg(F.min(value).alias(out)))


def quantile_share(df: DataFrame, value: str, found: float | None) -> DataFrame:
    """One row: ``below`` and ``upto``, the shares of the non-null values below and
    up to ``found`` (null without values). A quantile's rank error follows from them."""
    rows = df.where(F.col(value).isNotNull())
    share = lambda cond: F.try_divide(F.count_if(cond), F.count(F.lit(1)))
    at = F.lit(found).cast("double")
    return rows.agg(share(F.col(value) < at).alias("below"), share(F.col(value) <= at).alias("upto"))


def approx_quantile_value(df: DataFrame, value: str, q: float = 0.5, relative_error: float = 0.01):
    """Approximate quantile of the non-null values: a value of the data whose rank is
    within ``relative_error`` of ``q``, the same one at every run and partitioning."""
    return quantile_value(df, value, q, relative_error)


def approx_quantile(df: DataFrame, value: str, q: float = 0.5, relative_error: float = 0.01,
                    out: str = "quantile") -> DataFrame:
    """One-row frame with :func:`approx_quantile_value`."""
    return _one_row(df, value, out, quantile_value(df, value, q, relative_error))


def composite_score(rank_a: Column, rank_b: Column) -> Column:
    """Mean of two ranks, 2 decimals; lower is better."""
    return round2((rank_a + rank_b) / F.lit(2.0))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows by ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)
