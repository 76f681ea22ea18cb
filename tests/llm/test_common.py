import os
import subprocess
import sys

from lastmile.llm import common

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {folder!r}).getOrCreate())
import __spark_entry__ as entry
print("rows", len(entry.queries()["op3_url_filter"](spark, "/root/testdata/sf0.001").collect()))
"""


def test_workers_import_the_package_from_any_folder(tmp_path):
    """A plain session outside the repository, without PYTHONPATH or settings."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=f"{tmp_path}/warehouse")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 50" in run.stdout, run.stderr[-2000:]


def test_word_counts(spark):
    rows = [("a b\tc\x0bd",), ("",), (None,), (" \n ",), ("a\xa0b",)]
    frame = spark.createDataFrame(rows, "text string").select(common.word_count(common.F.col("text")).alias("n"))
    assert [r.n for r in frame.collect()] == [4, 0, 0, 0, 1]


def test_frozen_uses_the_configured_folder(spark):
    assert common.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir").replace("file:", "").rstrip("/")) or spark.conf.get("spark.checkpoint.dir") in common.shared_folder(spark)
    assert common.frozen(spark.range(5)).count() == 5
