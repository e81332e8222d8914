"""Scratch tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir. Where that is unset, local mode takes a temporary folder; a cluster has none that all machines see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="waymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/waymark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, group_bytes: int = 128 << 20) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read back, so that a lost executor costs no earlier stage.

    A task holds a row group of group_bytes as it writes and, in batches of 4096 rows at most, as it reads; wide rows want less than Spark's 128 MB.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").option("parquet.block.size", group_bytes).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
