"""Layer tables by path (bronze / silver / gold), exports and inventories.

A table is published in versions. ``publish`` writes a new folder under the table's
path and, once all of its files are there, names it in ``_published``; readers
take the last name. A write that fails half-way therefore leaves the table as it
was, and a reader that began before goes on with the version it found. The
version before the current one stays, older ones go.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile import fixed
from lastmile.session import shuffles_freed


#: Most rows of an export into a single file.
SINGLE_FILE_ROWS = 1_000_000


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full overwrite of one layer table as parquet (schema replaced).

    The shuffle files of its rows go when the table is written."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)


#: Folder of a table whose file names are the published versions, in order.
PUBLISHED = "_published"
VERSION = "version-"


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a path that Spark can write."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; none where there is no folder."""
    fs, found = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(found)) if fs.exists(found) else []


def new_version() -> str:
    """Name of a version: later ones sort last."""
    return f"{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def name_version(spark: SparkSession, path: str, version: str, note: str = "") -> None:
    """Make ``version`` the current one: one small file appears, or doesn't."""
    fs, marker = _folder(spark, f"{path.rstrip('/')}/{PUBLISHED}/{version}")
    stream = fs.create(marker, False)
    stream.write(note.encode())
    stream.close()


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of a table's current version; null for a plain folder."""
    published = [n for n in names_in(spark, f"{path.rstrip('/')}/{PUBLISHED}") if n.startswith(VERSION)]
    return published[-1] if published else None


def version_note(spark: SparkSession, path: str, version: str) -> str:
    """The text that ``name_version`` left with a version."""
    fs, marker = _folder(spark, f"{path.rstrip('/')}/{PUBLISHED}/{version}")
    stream = fs.open(marker)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that this library has written."""
    fs, gone = _folder(spark, path)
    fs.delete(gone, True)


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` published versions, and what failed writes before them left."""
    base = path.rstrip("/")
    published = [n for n in names_in(spark, f"{base}/{PUBLISHED}") if n.startswith(VERSION)]
    if not published:
        return
    kept = published[-keep:]
    for name in names_in(spark, base):
        if name.startswith(VERSION) and name < kept[0]:
            remove(spark, f"{base}/{name}")
    for name in published[:-keep]:
        remove(spark, f"{base}/{PUBLISHED}/{name}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Full overwrite of one layer table as a new version; returns its folder.

    The former version stays readable until the new one is complete, and is what
    readers see if the write fails."""
    spark, version = df.sparkSession, new_version()
    target = f"{path.rstrip('/')}/{version}"
    write_layer(df, target, partition_by)
    name_version(spark, path, version)
    drop_versions(spark, path)
    return target


def resolve(spark: SparkSession, path: str) -> str:
    """Folder that holds a table's current files."""
    version = current_version(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A published table's current version, or a plain folder of Parquet files."""
    return spark.read.parquet(resolve(spark, path))


def register_layer(spark: SparkSession, layer: str, table: str, path: str) -> str:
    """Expose a table's current version as the external table ``layer.table``.

    The layer is a database of the session catalog, so ``spark.table("silver.shipments")``
    and ``SHOW TABLES IN silver`` work; re-registering replaces the definition
    and never deletes data (the table is external).
    """
    name = f"{layer}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=resolve(spark, path), source="parquet")
    return name


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists, in any file system that Spark reads."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def is_stream_table(spark: SparkSession, path: str) -> bool:
    """Whether a folder is written by a stream (its sink keeps a log there)."""
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a layer table; 0 where there is none yet."""
    started = path_exists(spark, path) and not (current_version(spark, path) is None and any(n.startswith(VERSION) for n in names_in(spark, path)))
    return read_layer(spark, path).count() if started else 0


def export_csv(df: DataFrame, path: str, order: Sequence[Column] = (), single_file: bool = False) -> None:
    """CSV export with header, comma, UTF-8, LF, values unquoted unless needed.

    A global sort keeps the order across the part files. ``single_file`` is
    for KPI tables that are small by construction; more than
    ``SINGLE_FILE_ROWS`` rows are an error rather than one huge task.
    """
    out = df.orderBy(*order) if order else df
    if single_file:
        if not df.offset(SINGLE_FILE_ROWS).isEmpty():
            raise ValueError(f"more than {SINGLE_FILE_ROWS} rows: export them as several files")
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("quoteAll", False)
     .option("lineSep", "\n").option("encoding", "UTF-8").csv(path))


def table_detail(spark: SparkSession, path: str, fmt: str = "parquet", name: str | None = None) -> DataFrame:
    """``format``, ``name``, ``num_files``, ``size_in_bytes`` of a table folder.

    The file listing is a distributed ``binaryFile`` scan that reads only
    the length column (file contents are pruned away).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*.{fmt}").load(resolve(spark, path)).select("length"))
    return files.agg(
        F.lit(fmt).alias("format"),
        F.lit(name or path.rstrip("/").rsplit("/", 1)[-1]).alias("name"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("size_in_bytes"),
    )


def landing_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a landing folder: ``path``, ``length``, ``modification_time``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(path)
            .select("path", "length", F.col("modificationTime").alias("modification_time")))


def preview(df: DataFrame, n: int = fixed.PREVIEW_ROWS, order: Sequence[Column | str] = ()) -> DataFrame:
    """First ``n`` rows (by ``order`` when given, which makes the preview stable)."""
    return (df.orderBy(*order) if order else df).limit(n)
