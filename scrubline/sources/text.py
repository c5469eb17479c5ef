"""Text-typed CSV scan, header check and provenance stamp."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline import vocab as V


class ShapeError(ValueError):
    """The header of an input isn't the one its table declares."""


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def check_shape(table: str, actual: list[str], expected: tuple[str, ...]) -> None:
    if tuple(actual) != tuple(expected):
        raise ShapeError(f"table {table}: header is {list(actual)}; declared are {list(expected)}")


#: How files whose lines may end inside quotes are read: ``auto`` looks and reads those files whole,
#: ``always`` reads every file whole, ``refuse`` looks and stops.
LINE_BREAKS = ("auto", "always", "refuse")


def open_files(spark: SparkSession, path: str) -> list[str]:
    """Files below ``path`` of which some line ends inside quotes, or may do so.

    A quote inside quotes is doubled, so that quotes come in pairs wherever a record ends.  A file
    all of whose lines hold an even number of them can therefore be split at any line.
    Lines are counted where they are read; one row per file with an odd line comes back.
    """
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2).alias("odd"))
    return sorted(r["file"] for r in lines.where("odd = 1").select("file").distinct().collect())


def _plain_path(spark: SparkSession, uri: str) -> str:
    """The path of a scanned file as a reader takes it: not encoded, pattern characters escaped."""
    jvm = spark._jvm
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString())


def csv_scans(
    spark: SparkSession,
    path: str,
    table: str,
    columns: tuple[str, ...] | None = None,
    line_breaks: str = "auto",
) -> list[DataFrame]:
    """One or two scans of a CSV as text only; a blank cell is the empty string, never NULL.

    The first header is compared here, every other file's when the file is read; a file
    whose columns are named or ordered otherwise stops the read.  Files that :func:`open_files`
    proves safe are split over tasks.  One with line breaks inside quotes can't be split and is
    one task, or is refused; it is never cut inside a cell.
    """
    if line_breaks not in LINE_BREAKS:
        raise ValueError(f"line_breaks is one of {LINE_BREAKS}")
    expected = columns or V.RAW_COLUMNS[table]
    options = dict(header=True, escape='"', encoding="UTF-8", inferSchema=False)
    check_shape(table, spark.read.options(**options).csv(path).columns, expected)

    def scan(paths: str | list[str], whole: bool) -> DataFrame:
        reader = spark.read.schema(text_schema(expected)).options(**options, enforceSchema=False, multiLine=whole)
        return reader.csv(paths).fillna("")

    if line_breaks == "always":
        return [scan(path, True)]
    found = open_files(spark, path)
    if found and line_breaks == "refuse":
        raise ShapeError(f"table {table}: lines of {found[0]} end inside quotes")
    if not found:
        return [scan(path, False)]
    every = [r["file"] for r in spark.read.text(path).select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
    safe = sorted(set(every) - set(found))
    parts = [scan([_plain_path(spark, f) for f in found], True)]
    return parts + ([scan([_plain_path(spark, f) for f in safe], False)] if safe else [])


def read_text_csv(
    spark: SparkSession,
    path: str,
    table: str,
    columns: tuple[str, ...] | None = None,
    line_breaks: str = "auto",
) -> DataFrame:
    """All rows of :func:`csv_scans`."""
    return reduce(DataFrame.unionByName, csv_scans(spark, path, table, columns, line_breaks))


def read_stamped(
    spark: SparkSession,
    path: str,
    table: str,
    columns: tuple[str, ...] | None = None,
    line_breaks: str = "auto",
) -> DataFrame:
    """All rows of :func:`csv_scans`, each with its file and row number."""
    return reduce(DataFrame.unionByName, (stamp_rows(s) for s in csv_scans(spark, path, table, columns, line_breaks)))


def is_header_error(error: Exception) -> bool:
    """Whether a read stopped at a file with another header."""
    return "CSV header does not conform" in str(error)


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a cleaned CSV of ours with explicit types; blank is NULL.  Our cells hold no line breaks."""
    return spark.read.schema(schema).options(header=True, escape='"').csv(path)


def stamp_rows(frame: DataFrame, file_name: str | None = None) -> DataFrame:
    """Add ``source_file``, the 1-based ``source_row_num`` within it, and an empty log.

    Must follow the file scan directly.  Each scan block (file, start offset) counts its
    rows; the counts of earlier blocks of the file give its offset.  There is one count
    row per block and never one per record; the join that brings them back is left to
    adaptive execution, which broadcasts them as long as they are small.  No global window
    is involved.
    """
    columns = frame.columns
    placed = frame.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    block = ["_file", "_start", "_part"]
    in_file = Window.partitionBy("_file").orderBy("_start")
    offsets = (
        placed.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
        .withColumn("_before", F.sum("_n").over(in_file) - F.col("_n"))
        .drop("_n")
    )
    return placed.join(offsets, block).select(
        *columns,
        (F.lit(file_name) if file_name else F.col("_name")).alias(V.SOURCE_FILE),
        (F.col("_before") + F.col("_seq") - F.col("_first") + 1).alias(V.SOURCE_ROW),
        F.lit("").alias(V.LOG),
    )
