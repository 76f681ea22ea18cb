"""Records that a landing file holds but that are no records: a channel of their own.

Raw lines are checked before they are parsed. What is broken leaves as a row
(``REJECTED``: file, line, reason, with the time of ingestion) instead of turning
into a record of nulls, and everything else goes on. One scan of the files
serves both: ``split_*`` marks every line, ``good`` and ``rejected`` choose.

Shipments (CSV, one record a line):

* ``unclosed_quote``: an odd number of quotes that no backslash escapes;
* ``short_line``, ``long_line``: fewer or more fields than the header has.

Couriers (JSON Lines):

* ``broken_json``: no JSON, or cut off;
* ``not_an_object``: JSON, but a list, a text or a number;
* ``no_key``: an object without the courier id.

Lines of white space only are no lines. Everything is built from Spark
expressions; a file is split for parallel reading like any text file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lastmile import schemas

#: A separator that no landing file holds: a line is read as one field.
NO_SEPARATOR = "\u0001\u0002\u0001"
REJECTED = ("source_file", "line", "reason")
UNCLOSED, SHORT, LONG = "unclosed_quote", "short_line", "long_line"
BROKEN, NO_OBJECT, NO_KEY = "broken_json", "not_an_object", "no_key"
_CORRUPT = "_corrupt"


def line_options(header: bool) -> dict[str, str]:
    """Reader options under which each line of a CSV file is one field.

    With ``header`` the first line of each file is left out, and the read fails
    where it is not the expected one."""
    return {"header": str(header).lower(), "encoding": "UTF-8", "sep": NO_SEPARATOR, "quote": "", "escape": "",
            "enforceSchema": "false", "recursiveFileLookup": "true", "mode": "PERMISSIVE"}


def raw_lines(reader, path: str, header_line: str) -> DataFrame:
    """``line`` and ``source_file`` of every CSV record under ``path`` (a batch or stream reader)."""
    lines = reader.schema(T.StructType([T.StructField(header_line, T.StringType())])).options(**line_options(True)).csv(path)
    return lines.select(F.col(f"`{header_line}`").alias("line"), F.col("_metadata.file_name").alias("source_file"))


def header_line(spark: SparkSession, path: str) -> str:
    """First line of one CSV file of a landing folder."""
    return spark.read.options(**line_options(True)).csv(path).columns[0]


def csv_reason(line: Column, fields: int) -> Column:
    """Why a CSV line is no record of ``fields`` fields; null for a record."""
    def number_of(text: Column, sign: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))

    def by_fields(found: Column) -> Column:
        return F.when(found < fields, F.lit(SHORT)).when(found > fields, F.lit(LONG))

    # most lines have neither quotes nor backslashes: their commas are counted as they are
    plain = ~F.contains(line, F.lit('"')) & ~F.contains(line, F.lit("\\"))
    bare = F.regexp_replace(line, r'\\.', "")  # a backslash escapes what follows
    outside = F.regexp_replace(bare, r'"[^"]*"', "")
    quoted = F.when(number_of(bare, '"') % 2 == 1, F.lit(UNCLOSED)).otherwise(by_fields(number_of(outside, ",") + 1))
    return F.when(plain, by_fields(number_of(line, ",") + 1)).otherwise(quoted)


def split_csv(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """``lines`` (line, source_file) with ``record`` (a struct of texts, by header name) and ``reason``."""
    schema = ", ".join(f"`{c}` string" for c in header)
    filled = lines.where(F.trim("line") != "")
    return filled.select("*", F.from_csv("line", schema, {"mode": "PERMISSIVE"}).alias("record"), csv_reason(F.col("line"), len(header)).alias("reason"))


def json_reason(line: Column, parsed: Column, key: str) -> Column:
    """Why a JSON line is no record with a ``key``; null for a record."""
    kind = F.substring(F.ltrim(line), 1, 1)
    other = F.when(F.try_parse_json(line).isNull(), F.lit(BROKEN)).otherwise(F.lit(NO_OBJECT))
    return F.when(kind != "{", other).when(parsed[_CORRUPT].isNotNull(), F.lit(BROKEN)).when(parsed[key].isNull(), F.lit(NO_KEY))


def split_json(lines: DataFrame, fields: Sequence[str], key: str) -> DataFrame:
    """``lines`` (line, source_file) with ``record`` (a struct of texts) and ``reason``."""
    schema = ", ".join(f"`{c}` string" for c in (*fields, _CORRUPT))
    filled = lines.where(F.trim("line") != "")
    parsed = filled.withColumn("record", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    return parsed.withColumn("reason", json_reason(F.col("line"), F.col("record"), key))


def good(split: DataFrame, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The records, their fields ``names`` renamed to ``columns``, with ``source_file``."""
    return split.where(F.col("reason").isNull()).select(*[F.col("record")[src].alias(dst) for src, dst in zip(names, columns)], "source_file")


def rejected(split: DataFrame) -> DataFrame:
    """``source_file``, ``line`` and ``reason`` of what is no record."""
    return split.where(F.col("reason").isNotNull()).select(*REJECTED)


def shipment_lines(spark: SparkSession, path: str, header: Sequence[str], reader=None) -> DataFrame:
    """Marked lines of a landing folder of CSV files; ``reader``: ``spark.read`` unless given."""
    return split_csv(raw_lines(reader or spark.read, path, header_line(spark, path)), header)


def courier_lines(spark: SparkSession, path: str, fields: Sequence[str], reader=None) -> DataFrame:
    """Marked lines of a landing folder of JSON Lines."""
    text = (reader or spark.read).option("recursiveFileLookup", True).text(path)
    lines = text.select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("source_file"))
    return split_json(lines, fields, fields[schemas.RAW_COURIER_COLUMNS.index("courier_id")])


def line_counts(split: DataFrame, kind: str) -> DataFrame:
    """``kind``, ``outcome`` (``accepted`` or the reason) and ``lines`` of a landing folder, in one pass."""
    outcome = F.coalesce(F.col("reason"), F.lit("accepted")).alias("outcome")
    return split.groupBy(outcome).agg(F.count(F.lit(1)).alias("lines")).select(F.lit(kind).alias("kind"), "outcome", "lines")
