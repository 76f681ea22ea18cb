"""Counts belong to committed files: a task that runs twice counts once."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from lastmile import schemas
from lastmile.plans import pipeline
from lastmile.sources import layers
from conftest import SF_SMALL

SCRIPT = r"""
import json, os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from lastmile.session import build_session
from lastmile.plans import pipeline
from lastmile.operators import quality
spark = build_session("local[2, 3]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": {base!r} + "/ckpt", "spark.sql.warehouse.dir": {base!r} + "/wh", "spark.local.dir": {base!r} + "/local"}})
plain, marks = quality.checked_groups, {base!r} + "/marks"
os.makedirs(marks)

def failing(raw, stamped=False):
    # the first attempt of every reducing task fails after it has produced its rows
    def once(batches):
        from pyspark import TaskContext
        context = TaskContext.get()
        yield from batches
        if context.attemptNumber() == 0:
            open(os.path.join(marks, str(context.partitionId())), "w").close()
            raise RuntimeError("lost")
    groups = plain(raw, stamped)
    return groups.mapInArrow(once, groups.schema)

quality.checked_groups = failing
result = pipeline.run_all(spark, {sf!r}, {base!r} + "/lake")
print("RESULT", json.dumps([result["silver"], len(os.listdir(marks))], default=str))
spark.stop()
"""


def test_counts_are_exact_when_every_task_fails_once(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = SCRIPT.format(repo=repo, base=str(tmp_path), sf=SF_SMALL)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    line = next((x for x in out.stdout.splitlines() if x.startswith("RESULT")), None)
    assert line, out.stderr[-2000:]
    silver, failed = json.loads(line[7:])
    assert failed > 0
    assert (silver["raw_rows"], silver["in_range_rows"], silver["dedup_rows"], silver["silver_rows"]) == (6119, 6089, 5973, 5915)
    assert silver["duplicates_removed"] == 116 and silver["orphan_shipments"] == 58


def test_funnel_of_the_layers_comes_from_the_written_tables(spark, tmp_path):
    layout = pipeline.Layout(f"{tmp_path}/lake")
    pipeline.run_all(spark, SF_SMALL, layout.root)
    checked = layers.read_layer(spark, layout.path("silver", "shipments_checked"))
    assert checked.agg(F.sum("n").alias("n")).first().n == 6119
    assert set(schemas.SILVER_SHIPMENT_COLUMNS) <= set(layers.read_layer(spark, layout.path("silver", "shipments")).columns)
