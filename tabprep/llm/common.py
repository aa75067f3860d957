"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import sys

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.session import scratch_path


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def by_value(module: str) -> None:
    """Tasks carry the code of ``module``: executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder (spark.checkpoint.dir),
    read back: lineage is cut and later plans know the true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: Column) -> Column:
    return F.encode(column, "UTF-8")


def lower_az(column: Column) -> Column:
    """Lower case for A-Z only (other letters keep their case)."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def top_bits(hashed: Column, bits: int) -> Column:
    """The highest bits of a 64-bit hash: 0 .. 2**bits - 1."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int")


def ship(spark: SparkSession, model) -> Broadcast:
    """A model of fixed size for all executors, with the code of its class."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shipped(sent: Broadcast):
    return pickle.loads(sent.value)


def trim() -> None:
    """Hand freed memory back to the system, where the C library can: Spark
    keeps a task's Python worker, which later tasks' workers stand beside."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when
    the driver's JVM collects the frames that nobody holds any more.  It hears
    of those that Python dropped with the first call, hence the second."""
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
