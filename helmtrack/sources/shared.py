"""Written intermediates in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and all runs on one machine, as in tests."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="helmtrack-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: what follows doesn't compute it again, and a lost executor costs a reread."""
    path = f"{shared_folder(df.sparkSession)}/helmtrack-core/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys) -> DataFrame:
    """``df`` over all of Spark's shuffle partitions, however few its bytes: for rows that are small but take long."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)
