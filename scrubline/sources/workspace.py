"""Written intermediate tables, kept where the cluster keeps its checkpoints."""

from __future__ import annotations

import atexit
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names; a temporary one only for a local master."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            import tempfile

            configured = tempfile.mkdtemp(prefix="scrubline-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def content_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files in a folder, one level deep, so that changed input is noticed."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = []
    for entry in files.listStatus(path):
        inner = files.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(found))


def partitions(spark: SparkSession, path: str, each: int = 4 << 20) -> int:
    """Tasks for a shuffle of all rows of a file or folder, so that each gets about ``each`` stored bytes."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return max(spark.sparkContext.defaultParallelism, -(-files.getContentSummary(where).getLength() // each))


class Workspace:
    """Writes a table once and reads it back ever after; deleted when the driver ends.

    Phases (clean, load, repair) hand over through storage: plans stay short, later phases
    scan only the columns they need, and a lost executor never recomputes an earlier phase.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/scrubline-{uuid4().hex}"
        self._written: set[str] = set()
        atexit.register(self.delete)

    def delete(self) -> None:
        """Remove everything written here; nothing is left to do once the session has stopped."""
        if self.spark.sparkContext._jsc is None:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        self._written.clear()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, build, distinct: tuple[str, ...] = ()) -> DataFrame:
        """The table ``build`` gives; no dictionary is tried for columns with about a value a row."""
        if name not in self._written:
            plain = {f"parquet.enable.dictionary#{c}": "false" for c in distinct}
            build().write.mode("overwrite").options(**plain).parquet(self.path(name))
            self._written.add(name)
        return self.spark.read.parquet(self.path(name))
