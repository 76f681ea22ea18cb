"""Incremental (append) ingestion of the landing folder with Structured Streaming.

The batch pipeline rebuilds every layer by overwrite. For a landing folder
that keeps receiving files, the append form is a file-source stream into the
bronze folder: the stream checkpoint records which files were already
ingested and the file sink commits each micro-batch atomically, so running
the job again (or after a failure) appends each file exactly once.
``trigger(availableNow=True)`` processes what is there and stops, which fits
a scheduled job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.sources import files, layers


def _landing_stream(spark: SparkSession, landing_dir: str, kind: str,
                    max_files_per_trigger: int | None, vocab: fixed.Vocabulary, rejected: bool) -> DataFrame:
    stream = spark.readStream
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    marked = files.marked_lines(spark, landing_dir, kind, vocab, stream)
    return files.stamped_rejects(marked, kind, vocab) if rejected else files.stamped_records(marked, kind, vocab)


def ingest_available(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                     kind: str = "shipments", max_files_per_trigger: int | None = None,
                     vocab: fixed.Vocabulary = fixed.ENGLISH, rejected: bool = False) -> int:
    """Append every landing file not ingested yet to ``bronze_dir``; return rows appended.

    ``max_files_per_trigger`` cuts a large backlog into bounded micro-batches
    (``availableNow`` still stops when the backlog is done). The rows are counted
    in the committed table (from its footers), however many batches there were.
    A table that the batch job wrote is refused: its rows are not in the sink's
    log, and readers would lose them. ``rejected``: the lines that are no records
    are appended instead of the records.
    """
    if layers.path_exists(spark, bronze_dir) and not layers.is_stream_table(spark, bronze_dir):
        raise ValueError(f"{bronze_dir} was written by the batch job; append to a root of its own")
    before = layers.row_count(spark, bronze_dir)
    query = (_landing_stream(spark, landing_dir, kind, max_files_per_trigger, vocab, rejected).writeStream
             .format("parquet")
             .option("checkpointLocation", checkpoint_dir)
             .outputMode("append")
             .trigger(availableNow=True)
             .start(bronze_dir))
    query.awaitTermination()
    return layers.row_count(spark, bronze_dir) - before


def current_bronze(spark: SparkSession, bronze_dir: str,
                   keys=schemas.RAW_SHIPMENT_COLUMNS) -> DataFrame:
    """Bronze as appended, each raw record as often as in the last file that holds it.

    A file landed twice (a resend) then counts once, while copies inside one
    file stay (the funnel counts them). Both steps are aggregates combined on
    the map side.
    """
    keys = list(keys)
    bronze = layers.read_layer(spark, bronze_dir)
    per_file = bronze.groupBy(*keys, "ingestion_timestamp", "source_file", "source_system").agg(F.count(F.lit(1)).alias("n"))
    last = per_file.groupBy(*keys).agg(F.max(F.struct("ingestion_timestamp", "source_file", "source_system", "n")).alias("last"))
    return last.select(*keys, "last.ingestion_timestamp", "last.source_file", "last.source_system",
                       F.explode(F.sequence(F.lit(1), F.col("last.n"))).alias("copy")).drop("copy")
