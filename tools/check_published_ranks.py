"""Recompute ranks and score of a published courier KPI table and compare them row by row.

Usage: python tools/check_published_ranks.py PATH_TO_CSV

The table is an independent check of the rank operators: its volume, rounded SLA,
both ranks and the score were not made by this library. Its header is given by
``COLUMNS`` (volume, SLA %, volume rank, quality rank, score), found by name.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Header names of the published table.
COLUMNS = ("envios_asignados", "pct_sla_cumplido", "ranking_volumen", "ranking_calidad", "score_combinado")


def main() -> int:
    from pyspark.sql import functions as F

    from lastmile.operators.ranking import composite_score, global_ranks
    from lastmile.session import build_session
    spark = build_session("local[2]", shuffle_partitions=4)
    volume, sla, volume_rank, quality_rank, score = COLUMNS
    table = spark.read.option("header", True).csv(sys.argv[1]).select(
        F.col(volume).cast("long").alias("volume"), F.col(sla).cast("double").alias("sla"),
        F.col(volume_rank).cast("int").alias("volume_rank"), F.col(quality_rank).cast("int").alias("quality_rank"), F.col(score).cast("double").alias("score"))
    ranked = global_ranks(table, [("volume", "v", True), ("sla", "q", True)]).withColumn("s", composite_score(F.col("v"), F.col("q")))
    rows = ranked.count()
    wrong = ranked.where("v <> volume_rank or q <> quality_rank or s <> score").count()
    print(f"{rows} rows, {wrong} differ")
    return int(wrong > 0 or rows == 0)


if __name__ == "__main__":
    sys.exit(main())
