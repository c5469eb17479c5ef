"""Written hand-overs, row places and small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrubline.sources.workspace import shared_folder


def scratch(spark: SparkSession) -> str:
    """A new folder name inside the shared checkpoint folder."""
    return f"{shared_folder(spark)}/llm-{uuid4().hex}"


#: Folders to delete when the innermost open scope ends, and those left when the driver does.
_scopes: list[list[str]] = []
_left: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`stored` writes inside are deleted at the end, but for lasting ones, which
    live as long as what surrounds."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            _delete(spark, path)


@atexit.register
def _delete_left() -> None:
    for spark, path in _left:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def stored(df: DataFrame, lasting: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    The table goes with the scope that it is written in (:func:`passing`), a ``lasting`` one with
    the scope around that, and without such a scope when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    around = _scopes[: len(_scopes) - lasting]
    if around:
        around[-1].append(path)
    else:
        _left.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``pos``, the 0-based place of every row in ``order``, without a single-task sort.

    Rows are range-partitioned, sorted and written; a row's place is its place in its
    partition plus the rows of earlier partitions (one count per partition, so broadcast).
    """
    columns = df.columns
    rows = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_seq"))
    )
    before = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
        .select(
            F.col("_part").alias("_at"),
            (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"),
        )
    )
    return rows.join(F.broadcast(before), F.col("_part") == F.col("_at")).select(
        *columns, (F.col("_seq") + F.col("_shift")).alias("pos")
    )


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (NULL as empty) and the named columns; all others are left out."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def row_key(text: str = "text") -> Column:
    """Tells rows apart that share a doc_id; equal rows share it."""
    return F.xxhash64("doc_id", text)


#: Bits of a filter; as a table of 64-bit words it has at most 2**17 rows and so is safe to broadcast.
FILTER_BITS = 1 << 23


def sifted(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_maybe``: false where no row of ``wanted`` has the same keys.

    A filter of a fixed size, built on the executors, so that most rows that can't match need
    no shuffle.  Where it says true, a join has to decide.
    """
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    word, place = F.shiftright(bit, 6), bit.bitwiseAND(F.lit(63)).cast("int")
    words = wanted.select(word.alias("_at"), F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("_set"))
    words = words.groupBy("_at").agg(F.bit_or("_set").alias("_set"))
    met = rows.withColumn("_word", word).join(F.broadcast(words), F.col("_word") == F.col("_at"), "left")
    maybe = F.coalesce(F.call_function("shiftright", F.col("_set"), place).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return met.withColumn("_maybe", maybe).drop("_word", "_at", "_set")


def without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't in ``gone``, NULL equal to NULL; only doubtful rows are shuffled."""
    marked = sifted(rows, gone, keys)
    gone = gone.select(*(F.col(k).alias(f"_gone_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys))
    doubtful = marked.where("_maybe").join(gone, same, "left_anti")
    return marked.where("not _maybe").union(doubtful).select(*rows.columns)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per session, as ``--py-files`` would.

    Arrow batches are cut by size, as texts and sets differ in length by orders of magnitude.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    context = spark.sparkContext
    if getattr(context, "_scrubline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "scrubline")
    context.addPyFile(
        shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    )
    context._scrubline_shipped = True
