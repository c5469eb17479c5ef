"""Artifacts on storage: snapshots, change logs, summaries, load-ready and report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline import vocab as V


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> str:
    """Overwrite ``path``; nothing written depends on the time of writing.

    An empty frame replaces what an earlier run left there, so no stale rows survive.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, lineSep="\n", encoding="UTF-8", escape='"', emptyValue="")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)
    return path


def in_row_order(df: DataFrame) -> DataFrame:
    """Rows in source order across and within the part files."""
    return df.repartitionByRange(F.col(V.SOURCE_ROW)).sortWithinPartitions(V.SOURCE_ROW)


def collect_log(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The stage summaries of every table as one frame."""
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in V.SUMMARY_COLUMNS[:-1]]
        + [T.StructField(V.SUMMARY_COLUMNS[-1], T.LongType())]
    )
    frames = [
        spark.read.schema(schema).format(fmt).options(header=True).load(p).select(*V.SUMMARY_COLUMNS)
        for p in paths
    ]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)
