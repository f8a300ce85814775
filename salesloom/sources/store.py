"""Written tables below one folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class Store:
    """Parquet tables addressed by name; saving replaces the table and reads it back.

    Reading back cuts the lineage at a table on shared storage, so no later job repeats the
    work and none of it is lost with an executor.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        # Zstandard takes about a quarter less room than Spark's default, snappy.
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        # The schema is known: no footer has to be read, and a partitioned table without rows,
        # which has no file at all, can be read too. Partition columns come back last.
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        try:
            self.load(name)
        except AnalysisException:
            return False
        return True


class VersionedStore(Store):
    """Tables whose saving never touches what readers see until all of it is written.

    Every save writes a folder of its own, `<table>/v-<id>`, and then replaces `<table>.current`, a file of one line
    that names it. Readers follow that file, so a write that fails half-way leaves the last table as it was, and a
    job that reads an older version goes on reading it. Versions that are no longer named can be deleted
    by age; nothing is deleted here.
    """

    def _pointer(self, name: str):
        """The file that names a table's version, and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}.current")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self, name: str) -> str | None:
        """The folder of the version in use; None if the table was never saved."""
        path, system = self._pointer(name)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            version = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return f"{self.path(name)}/{version}"

    def save(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        version = f"v-{uuid.uuid4().hex}"
        written = super().save(df, f"{name}/{version}", partition_by)
        path, system = self._pointer(name)
        stream = system.create(path, True)
        try:
            stream.write(version.encode())
        finally:
            stream.close()
        return written

    def load(self, name: str) -> DataFrame:
        version = self.current(name)
        if version is None:
            raise LookupError(f"no table '{name}' in {self.root}")
        return self.spark.read.parquet(version)

    def exists(self, name: str) -> bool:
        return self.current(name) is not None
