"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import io
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lastmile

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed
#: and carriage return (Java regular expression).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table by its path (any file system Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package, wherever they run.

    The zipped sources go to the shared folder, from where Spark hands them to
    every executor, once an application. A package that was itself sent to the
    driver as a zip is known to the workers."""
    context = spark.sparkContext
    root = Path(lastmile.__file__).parent
    if context.applicationId in _sent or not root.is_dir():
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lastmile.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    stream.write(held.getvalue())
    stream.close()
    context.addPyFile(path.toString())
    _sent.add(context.applicationId)


#: Bytes of an Arrow batch that a Python worker holds at once (Spark's own bound counts
#: rows, and ten thousand long texts are many megabytes).
BATCH_BYTES = 4 << 20


def ready(query):
    """``query`` with the package sent to the workers before it runs, and Arrow batches bounded."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest):
        send_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return query(spark, *rest)

    return run


def trimmed(work):
    """``work`` on a task's Arrow batches, after which a worker, which lives on, hands
    back the memory that it has freed."""

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share.

    It is ``spark.checkpoint.dir``; only where that is unset (tests) a folder
    beside the warehouse, which a cluster shares as well, is set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the session ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def frozen(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used for frames without texts that several branches read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the texts replaced; ``n_chars``, where it exists, follows."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
