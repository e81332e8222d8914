"""Tables that grow by batches, each of which counts once."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder_of(batch: str) -> str:
    """A folder name for any id: no text of an id leads elsewhere or reads as another one."""
    return f"b{hashlib.sha256(batch.encode()).hexdigest()}"


class BatchTable:
    """path/rows has a folder for each attempt at a batch; a folder of the batch's own name in path/commits says which attempt counts.

    What failed attempts leave is never read. Of two writers of one batch, the one that commits second finds the folder there, and its rows do not count.
    """

    COMMIT = "id string, batch string"

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        spark.createDataFrame([], self.COMMIT).write.mode("ignore").parquet(f"{path}/commits/none")
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/rows/batch=none")

    def batches(self) -> DataFrame:
        """id and batch (the folder) of each attempt that counts."""
        return self.spark.read.schema(self.COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def append(self, batch: str, rows: DataFrame) -> bool:
        """False, and nothing counts, if the batch does already."""
        if self.batches().where(F.col("id") == batch).take(1):
            return False
        attempt = f"{folder_of(batch)}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/rows/batch={attempt}")
        try:
            self.spark.createDataFrame([(batch, attempt)], self.COMMIT).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{folder_of(batch)}")
        except AnalysisException:
            return False
        return True

    def read(self, batch: str | None = None) -> DataFrame:
        """Rows of all batches that count, or of one."""
        rows = self.spark.read.schema(f"{self.schema}, batch string").parquet(f"{self.path}/rows")
        wanted = self.batches() if batch is None else self.batches().where(F.col("id") == batch)
        return rows.join(wanted.select("batch"), "batch", "left_semi").drop("batch")
