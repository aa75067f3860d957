"""Error and accuracy aggregates.

Every metric is one aggregate over the scored table (partial per task, a
single tiny final); grouped variants add a grouping key such as the fold.
Division by zero rows gives NULL (``try_divide``) instead of an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(df: DataFrame, pred: Column | str, label: Column | str,
             by: Sequence[str] = ()) -> DataFrame:
    """A10: (correct, total, accuracy)."""
    p, y = _c(pred), _c(label)
    aggs = [F.count_if(p == y).alias("correct"), F.count(F.lit(1)).alias("total")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return g.withColumn("accuracy", F.try_divide(F.col("correct").cast("double"),
                                                 F.col("total").cast("double")))


def regression_errors(df: DataFrame, pred: Column | str, label: Column | str,
                      by: Sequence[str] = ()) -> DataFrame:
    """N, sse, mse, half_mse, rmse, mae, neg_mae, neg_rmse.  Rows
    without a prediction or a label have no error and do not count."""
    p, y = _c(pred).cast("double"), _c(label).cast("double")
    e = p - y
    aggs = [F.count(e).alias("n"), F.sum(e * e).alias("sse"),
            F.sum(F.abs(e)).alias("sae")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    n = F.col("n").cast("double")
    mse = F.try_divide(F.col("sse"), n)
    mae = F.try_divide(F.col("sae"), n)
    return g.select(*by, "n", "sse", mse.alias("mse"), (mse / 2.0).alias("half_mse"),
                    F.sqrt(mse).alias("rmse"), mae.alias("mae"),
                    (-mae).alias("neg_mae"), (-F.sqrt(mse)).alias("neg_rmse"))


def score_summary(scores: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std (ddof 0) of per-fold scores."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return scores.agg(*aggs)


def accumulate(df: DataFrame, sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Several running sums in one pass (the reference's Accumulator);
    ``reset`` is simply a new query."""
    aggs = [F.sum(v).alias(k) for k, v in sums.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
