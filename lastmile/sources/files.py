"""Raw file sources: shipments as CSV with header, couriers as JSON Lines.

Every column is read as a string (no inference of types, no ``_corrupt_record``
column, stable column order) and stamped with audit columns. Landing folders are
read with their sub-folders. Lines that are no records go to a channel of their
own (``rejects``). CSV columns are found by their header names: the
order is taken from a file of the folder, and a file whose header differs from it
makes the read fail instead of swapping columns. ``source_file`` is the real file
name from the scan metadata unless a literal is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile import fixed, schemas
from lastmile.sources import rejects


def audit_stamp(df: DataFrame, source_system: str, source_file: str | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` (one value per query), ``source_file``, ``source_system``."""
    file_col = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_file": file_col,
        "source_system": F.lit(source_system),
    })


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header of a landing folder of CSV files (the first line of one file is read).

    An empty folder is an error: it must not replace a layer by nothing."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


#: Header line, UTF-8, sub-folders too; a differing header fails the read.
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "mode": "PERMISSIVE", "recursiveFileLookup": "true", "enforceSchema": "false"}


def _checked_header(found: list[str], wanted: tuple[str, ...]) -> list[str]:
    missing = [c for c in wanted if c not in found]
    if missing:
        raise ValueError(f"the CSV header lacks {missing}; it has {found}")
    return found


def _shipment_lines(spark: SparkSession, path: str, field_names: tuple[str, ...], reader=None) -> DataFrame:
    header = _checked_header(csv_header(spark, path), field_names)
    return rejects.shipment_lines(spark, path, header, reader)


def read_shipments_csv(spark: SparkSession, path: str,
                       field_names: tuple[str, ...] = fixed.SHIPMENT_FIELDS) -> DataFrame:
    """Shipments by header name, every column a string; empty field -> null.

    ``field_names`` are the header names in the order of the raw shipment
    columns (e.g. ``fixed.SPANISH_SHIPMENT_FIELDS``); further columns are left out.
    Broken lines are no shipments: :func:`rejected_shipments` returns them.
    """
    return rejects.good(_shipment_lines(spark, path, field_names), field_names, schemas.RAW_SHIPMENT_COLUMNS).drop("source_file")


def read_couriers_json(spark: SparkSession, path: str,
                       field_names: tuple[str, ...] = fixed.COURIER_FIELDS) -> DataFrame:
    """JSON Lines (one record per line), every field a string.

    ``field_names`` are the record keys in the order of the raw courier
    columns (e.g. ``fixed.SPANISH_COURIER_FIELDS``); they are renamed to the
    pipeline's column names. Broken lines are no couriers: :func:`rejected_couriers`
    returns them.
    """
    return rejects.good(rejects.courier_lines(spark, path, field_names), field_names, schemas.RAW_COURIER_COLUMNS).drop("source_file")


def marked_lines(spark: SparkSession, path: str, kind: str, vocab: fixed.Vocabulary = fixed.ENGLISH, reader=None) -> DataFrame:
    """Every line of a landing folder with its record and the reason if it is none."""
    if kind == "shipments":
        return _shipment_lines(spark, path, vocab.shipment_fields, reader)
    if kind == "couriers":
        return rejects.courier_lines(spark, path, vocab.courier_fields, reader)
    raise ValueError(f"unknown feed kind: {kind}")


def stamped_records(marked: DataFrame, kind: str, vocab: fixed.Vocabulary = fixed.ENGLISH, source_file: str | None = None) -> DataFrame:
    """The records among marked lines, stamped."""
    names, columns, system = ((vocab.shipment_fields, schemas.RAW_SHIPMENT_COLUMNS, vocab.shipments_system) if kind == "shipments"
                              else (vocab.courier_fields, schemas.RAW_COURIER_COLUMNS, vocab.couriers_system))
    file_column = F.lit(source_file) if source_file is not None else F.col("source_file")
    return rejects.good(marked, names, columns).select(
        *columns, F.current_timestamp().alias("ingestion_timestamp"), file_column.alias("source_file"), F.lit(system).alias("source_system"))


def stamped_rejects(marked: DataFrame, kind: str, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    """The lines that are no records: ``line``, ``reason`` and the audit columns."""
    system = vocab.shipments_system if kind == "shipments" else vocab.couriers_system
    return rejects.rejected(marked).select(
        "line", "reason", F.current_timestamp().alias("ingestion_timestamp"), "source_file", F.lit(system).alias("source_system"))


def ingest_shipments(spark: SparkSession, path: str, source_file: str | None = None,
                     vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return stamped_records(marked_lines(spark, path, "shipments", vocab), "shipments", vocab, source_file)


def ingest_couriers(spark: SparkSession, path: str, source_file: str | None = None,
                    vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return stamped_records(marked_lines(spark, path, "couriers", vocab), "couriers", vocab, source_file)


def rejected_shipments(spark: SparkSession, path: str, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return stamped_rejects(marked_lines(spark, path, "shipments", vocab), "shipments", vocab)


def rejected_couriers(spark: SparkSession, path: str, vocab: fixed.Vocabulary = fixed.ENGLISH) -> DataFrame:
    return stamped_rejects(marked_lines(spark, path, "couriers", vocab), "couriers", vocab)


def write_lines(lines: DataFrame, path: str, header: str) -> None:
    """Land raw lines as they are (one text column) as CSV files that begin with ``header``."""
    (lines.toDF(header).write.mode("overwrite")
     .options(header="true", sep="\u0001", quote="", escape="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))


def write_shipments_csv(df: DataFrame, path: str) -> None:
    """Land raw shipments as CSV files with a header (overwrite).

    Surrounding spaces are part of the dirt and are kept (the writer trims
    them by default).
    """
    (df.select(*schemas.RAW_SHIPMENT_COLUMNS).write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_couriers_json(df: DataFrame, path: str) -> None:
    """Land raw couriers as JSON Lines (null fields are left out of a record)."""
    df.select(*schemas.RAW_COURIER_COLUMNS).write.mode("overwrite").json(path)
