"""Spark session settings the pipeline relies on.

* UTC session time zone: epoch differences never cross a DST jump.
* ANSI stays on; the cleaning code uses the ``try_`` parse/cast forms.
* AQE on, with partition coalescing and skew-join splitting: the fact tables
  are joined and grouped on courier ids that can be heavily skewed.
* Broadcast of a join side is decided by Spark from its measured size
  (``autoBroadcastJoinThreshold`` at plan time, the AQE threshold at run time);
  above it the join stays a shuffle join. Explicit ``broadcast()`` hints are
  used only for sides with a proven bound (one-row aggregates, bucket tables).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # checkpoint files of materialized intermediates are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "lastmile",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Where it is unset (tests, single-machine runs) a folder of the
    warehouse is used, which driver and executors share as well; never a
    machine-local temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint, not local).

    Used for small intermediates that several branches of a plan read (a
    value histogram, the per-courier aggregate), so the large input behind
    them is scanned once. Files go to the session's checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Whether a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each has ended.

    Otherwise they stay until the driver happens to collect its garbage, and the disk holds
    those of all steps of a job at once."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
