"""Cuts of lineage that outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where the session names none, a temporary folder stands in if driver and executors are one process, as in tests;
    on a cluster that is an error, as no machine's own folder outlives it."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of Parquet up to which a scratch table may be broadcast.
SMALL = 1 << 18


class Scratch:
    """Tables of one iterative job, as Parquet in the shared folder.

    A table that is read again has its true size. A checkpoint keeps its plan's estimate, which joins multiply: after some
    twenty rounds of joins with itself, planning such a number takes longer than the round. As the size on disk is far below
    that of the rows, larger tables than SMALL are joined by merging: many rounds of broadcasts would go through the driver."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.written: dict[str, list[str]] = {}

    def put(self, df: DataFrame, name: str = "") -> DataFrame:
        """`df`, written. Of the tables of one name the last two stay; those without a name stay all."""
        path = f"{self.folder}/{name or 'table'}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if name:
            paths = self.written.setdefault(name, [])
            paths.append(path)
            while len(paths) > 2:
                self._drop(paths.pop(0))
        rows = self.spark.read.schema(df.schema).parquet(path)
        fs, folder = self._fs(path)
        return rows if fs.getContentSummary(folder).getLength() <= SMALL else rows.hint("merge")

    def _fs(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _drop(self, path: str) -> None:
        fs, folder = self._fs(path)
        fs.delete(folder, True)
