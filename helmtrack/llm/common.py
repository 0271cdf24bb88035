"""Helpers that the operators share: reading, the shared folder, written intermediates, blobs."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where it is unset and all runs on
    one machine (as in tests) it is a temporary folder; on a cluster an unset folder is an error."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="helmtrack-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


#: Fixed value: Spark's setting by which a query's shuffle files go when it ends. An intermediate's plan is run once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: lineage ends here, and a lost
    executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/helmtrack/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a written intermediate from which nothing is to be read any more."""
    context = df.sparkSession.sparkContext
    if files := df.inputFiles():
        path = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small frame, for iterative plans."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_packer, _thorough = zstandard.ZstdCompressor(level=1), zstandard.ZstdCompressor(level=4)
_unpacker = zstandard.ZstdDecompressor()


def pack(array: np.ndarray, thorough: bool = False) -> bytes:
    """An array as compressed bytes."""
    return (_thorough if thorough else _packer).compress(np.ascontiguousarray(array).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(_unpacker.decompress(data), dtype=dtype)


def pack_sorted(array: np.ndarray) -> bytes:
    """An ascending uint64 array as compressed differences, laid out byte plane by byte plane."""
    steps = np.diff(array, prepend=np.uint64(0)) if len(array) else array
    return _packer.compress(np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacker.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
