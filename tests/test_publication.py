"""Tables are replaced as a whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from lastmile.sources import layers


def _values(spark, path):
    return sorted(r.id for r in layers.read_layer(spark, path).collect())


def test_a_write_that_fails_half_way_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    layers.publish(spark.range(3), path)
    # one task of many fails after others have written their files
    broken = spark.range(0, 100, 1, 8).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        layers.publish(broken, path)
    assert _values(spark, path) == [0, 1, 2] and layers.row_count(spark, path) == 3
    assert len(layers.names_in(spark, f"{path}/_published")) == 1
    layers.publish(spark.range(5), path)
    assert _values(spark, path) == [0, 1, 2, 3, 4]


def test_a_first_write_that_fails_leaves_no_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(Exception, match="lost"):
        layers.publish(spark.range(5).select(F.raise_error(F.lit("lost")).alias("id")), path)
    assert layers.row_count(spark, path) == 0


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = f"{tmp_path}/t"
    layers.publish(spark.range(3), path)
    before = layers.read_layer(spark, path)
    layers.publish(before.select((F.col("id") + 10).alias("id")), path)  # also: a table may be made from itself
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert _values(spark, path) == [10, 11, 12]


def test_old_versions_go_and_the_schema_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    for k in range(5):
        layers.publish(spark.range(k + 1).withColumn(f"c{k}", F.lit(k)), path)
    assert layers.read_layer(spark, path).columns == ["id", "c4"]
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2
    assert layers.table_detail(spark, path).first().num_files == len([n for n in os.listdir(layers.resolve(spark, path)) if n.endswith(".parquet")])


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    layers.write_layer(spark.range(4), f"{tmp_path}/plain")
    assert layers.row_count(spark, f"{tmp_path}/plain") == 4 and layers.current_version(spark, f"{tmp_path}/plain") is None
    assert layers.row_count(spark, f"{tmp_path}/nothing") == 0
