"""Intermediate results as Parquet tables in the cluster's shared folder.

A stored table cuts lineage, survives the loss of executors and keeps column pruning and filter
pushdown for whoever reads it next.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="demandcast-")


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


class Storage:
    """Tables of one run, below one folder of their own."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def table(self, name: str, rows: DataFrame) -> DataFrame:
        """Write ``rows`` and return the table that reads them back."""
        path = f"{self.folder}/{name}"
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self) -> None:
        """Delete the run's tables; call it once its results have been written elsewhere."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
