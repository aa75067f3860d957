"""Profiles kept as mergeable state (A1-A9 over a growing table).

Missing counts, moments, value counts and quantile sketches of two sets of
rows merge without the rows.  Every micro-batch of a stream is profiled by
itself, merged with the state before it and written as the state of that
batch.  A batch that is run again after a failure starts from the same state
and overwrites the same folder, so together with the stream's checkpoint every
file counts exactly once; appending costs one pass over the new rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabprep.functions.missing import is_missing, nan_to_null
from tabprep.operators import stats
from tabprep.session import scratch_path

#: One row per column; ``m2`` is the sum of squared deviations from the mean.
PROFILE = "column string, rows long, missing long, n long, mean double, m2 double, min double, max double, sketch binary"
VALUES = "column string, value string, n long"


def profile_of(df: DataFrame, numeric: Sequence[str], category: Sequence[str]) -> DataFrame:
    """The state of one set of rows: one aggregate over its cells."""
    cells = [F.struct(F.lit(c).alias("column"), is_missing(df, c).alias("gone"),
                      (nan_to_null(df, c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("v"))
             for c in (*numeric, *category)]
    v = F.col("v")
    return (df.select(F.inline(F.array(*cells))).groupBy("column")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if("gone").alias("missing"), F.count(v).alias("n"),
                 F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("min"), F.max(v).alias("max"),
                 F.kll_sketch_agg_double(v).alias("sketch")))


def values_of(df: DataFrame, category: Sequence[str]) -> DataFrame:
    """``column, value, n`` of the non-missing category values, as text."""
    names = F.array(*[F.lit(c) for c in category])
    return (stats.value_counts(df, category)
            .select(F.element_at(names, F.col("c") + 1).alias("column"), F.col("v").alias("value"), "n"))


def merged(states: DataFrame) -> DataFrame:
    """Several states of each column as one (the parallel-variance rule)."""
    whole = Window.partitionBy("column")  # one row per state
    return (states.withColumn("all", F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), F.sum("n").over(whole)))
            .groupBy("column")
            .agg(F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.sum("n").alias("n"), F.max("all").alias("mean"),
                 F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("all")) ** 2).alias("m2"),
                 F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch")))


def _before(spark: SparkSession, path: str, schema: str, version: int | None) -> DataFrame:
    """The last state, or the last one before ``version``."""
    every = spark.read.schema(f"{schema}, version long").parquet(path)
    if version is not None:
        every = every.where(F.col("version") < version)
    last = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == F.lit(-1 if last is None else last)).drop("version")


def merge_batch(df: DataFrame, version: int, state: str, numeric: Sequence[str], category: Sequence[str] = ()) -> None:
    """Write the state of ``version``: the one before it and these rows."""
    spark = df.sparkSession
    old = _before(spark, f"{state}/profile", PROFILE, version)
    merged(old.unionByName(profile_of(df, numeric, category))).write.mode("overwrite").parquet(f"{state}/profile/version={version}")
    if category:
        old = _before(spark, f"{state}/values", VALUES, version)
        (old.unionByName(values_of(df, category)).groupBy("column", "value").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{state}/values/version={version}"))


def append_profile(spark: SparkSession, source: DataFrame, state: str, numeric: Sequence[str], category: Sequence[str] = (),
                   checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Keep the profile of a stream's rows under ``state`` (a folder all
    executors share), one version per micro-batch.  With ``once`` the query
    takes what is there now and stops."""
    for name, schema in (("profile", PROFILE), ("values", VALUES)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{state}/{name}/version=-1")

    def batch(df: DataFrame, version: int) -> None:
        merge_batch(df, version, state, numeric, category)

    w = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint or scratch_path(spark, "profile-ckpt"))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()


def read_profile(spark: SparkSession, state: str) -> DataFrame:
    """``column, missing, rows, ratio, mean, std, min, max, range, median``;
    the median is the sketch's (its rank is within about 1.5 percent)."""
    s = _before(spark, f"{state}/profile", PROFILE, None)
    return s.select("column", "missing", "rows", (F.col("missing") / F.col("rows")).alias("ratio"), "mean",
                    F.sqrt(F.try_divide("m2", "n")).alias("std"), "min", "max", (F.col("max") - F.col("min")).alias("range"),
                    F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))).alias("median"))


def read_modes(spark: SparkSession, state: str) -> DataFrame:
    """``column, mode``: the most frequent value, ties to the least."""
    s = _before(spark, f"{state}/values", VALUES, None)
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v")))
    return s.groupBy("column").agg(best.alias("b")).select("column", F.col("b.v").alias("mode"))


def read_categories(spark: SparkSession, state: str) -> DataFrame:
    """``column, value, n`` of every category value."""
    return _before(spark, f"{state}/values", VALUES, None)
