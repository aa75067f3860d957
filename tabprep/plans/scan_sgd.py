"""Mini-batch gradient descent of linear models as an ordered scan (M2).

One step on a batch is an affine map of the parameters:
``w -> (I - s X'X) w + s X'y`` with ``s = lr * k / batch_size``, given by the
batch's own sums.  Maps compose associatively, so the exact sequence of steps
is a reduction: rows are grouped by batch (all epochs at once, since a map does
not depend on the parameters), the batches' maps are composed in order by a
tree of bounded groups, and the driver receives one map per epoch.  The result
is that of sequential training on any number of executors and partitions.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.missing import qcol
from tabprep.operators.align import consecutive_index
from tabprep.operators.comoments import co_moments
from tabprep.operators.permute import epoch_batches
from tabprep.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers in one group of maps, at most: it bounds a task's memory.
GROUP_CELLS = 1 << 20


@dataclass
class LinearRun:
    """Parameters after each epoch and, per epoch, the root of the mean
    squared error on the rows trained on and on the validation rows."""
    weights: list[np.ndarray]
    bias: list[float]
    train_rmse: list[float]
    valid_rmse: list[float | None]


def composed(maps: np.ndarray) -> np.ndarray:
    """Product of maps given in the order they are applied, neighbours first."""
    while len(maps) > 1:
        even = maps if len(maps) % 2 == 0 else maps[:-1]
        joined = even[1::2] @ even[0::2]
        maps = joined if len(even) == len(maps) else np.concatenate([joined, maps[-1:]])
    return maps[0]


def _compose(size: int):
    """One group of consecutive maps -> their product, as the next level's."""
    def task(key, rows):
        rows = rows.sort_values("at")
        maps = np.stack(rows["map"].to_numpy()).reshape(-1, size, size)
        return pd.DataFrame({"epoch": [key[0]], "at": [key[1]], "map": [composed(maps).ravel().tolist()]})
    return task


def batch_maps(numbered: DataFrame, features: Sequence[str], label: str, row: str, n: int, batch_size: int,
               rates: Sequence[float], half: bool = True, nominal: bool = True) -> DataFrame:
    """``epoch, at, map``: the map of every batch of every epoch, as the
    row-major matrix over (weights, bias, 1).  ``nominal`` divides by
    ``batch_size`` also where the last batch is short."""
    d = len(features) + 1
    x = [qcol(c).cast("double") for c in features]
    rows = numbered.select(qcol(row).alias("row"), *[c.alias(f"x{i}") for i, c in enumerate(x)],
                           F.lit(1.0).alias(f"x{d - 1}"), qcol(label).cast("double").alias("y"))
    parts = [epoch_batches(rows, "row", n, batch_size, e).withColumn("epoch", F.lit(e)) for e in range(1, len(rates) + 1)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = every.groupBy("epoch", F.col("batch").alias("at")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"t{i}") for i in range(d)])
    k = 1.0 if half else 2.0            # d/dp of (p - y)^2 / 2, or of (p - y)^2
    rate = F.element_at(F.array(*[F.lit(float(r) * k) for r in rates]), F.col("epoch"))
    step = rate / (F.lit(float(batch_size)) if nominal else F.col("n"))
    cells = []
    for i in range(d):
        cells += [F.lit(1.0 if i == j else 0.0) - step * F.col(f"s{min(i, j)}_{max(i, j)}") for j in range(d)]
        cells.append(step * F.col(f"t{i}"))
    cells += [F.lit(0.0)] * d + [F.lit(1.0)]
    return sums.select("epoch", "at", F.array(*cells).alias("map"))


def reduced(maps: DataFrame, size: int, batches: int) -> dict[int, np.ndarray]:
    """One map per epoch: groups of consecutive maps are composed until one is
    left.  A group's size follows from the map's, not from the table's."""
    fan = max(2, GROUP_CELLS // (size * size))
    while batches > 1:
        maps = (maps.withColumn("group", F.floor(F.col("at") / F.lit(fan)).cast("bigint"))
                .groupBy("epoch", "group").applyInPandas(_compose(size), "epoch int, at bigint, map array<double>"))
        batches = -(-batches // fan)
    # one map per epoch
    return {r["epoch"]: np.array(r["map"]).reshape(size, size) for r in maps.collect()}


def linear_sgd_scan(df: DataFrame, features: Sequence[str], label: str, key: str, lr: float = 0.03, epochs: int = 3,
                    batch_size: int = 10, step: int | None = None, gamma: float = 1.0, half: bool = True,
                    nominal: bool = True, valid: DataFrame | None = None) -> LinearRun:
    """M2: sequential mini-batch descent from zero parameters.  Batches follow
    the epoch's shuffled order of the rows numbered by ``key``; the rate is
    multiplied by ``gamma`` every ``step`` epochs.  Rows with a NULL feature
    or label do not take part.  Errors after each epoch follow from one pass
    of co-moments over each part."""
    spark, d = df.sparkSession, len(features)
    used = [qcol(c) for c in (*features, label)]
    rows = df.select(qcol(key).alias("k"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(used)])
    whole = " and ".join(f"x{i} is not null" for i in range(d + 1))
    # features may be costly expressions: evaluated once, then numbered once,
    # and kept, since each epoch reads them
    paths = scratch_path(spark, "rows"), scratch_path(spark, "numbered")
    rows.write.parquet(paths[0])
    consecutive_index(spark.read.parquet(paths[0]).where(whole), ["k"], out="row").write.parquet(paths[1])
    numbered = spark.read.parquet(paths[1])
    n = numbered.count()
    names = [f"x{i}" for i in range(d + 1)]
    run = LinearRun([], [], [], [])
    if not n:
        return run
    rates = [lr * gamma ** ((e // step) if step else 0) for e in range(epochs)]
    maps = batch_maps(numbered, names[:d], names[d], "row", n, batch_size, rates, half, nominal)
    found = reduced(maps, d + 2, -(-n // batch_size))
    trained = co_moments(numbered, [F.col(c) for c in names])[None]
    checked = co_moments(valid, used)[None] if valid is not None and not valid.isEmpty() else None
    state = np.append(np.zeros(d + 1), 1.0)
    for e in range(1, epochs + 1):
        state = found[e] @ state
        w, b = state[:d].copy(), float(state[d])
        run.weights.append(w)
        run.bias.append(b)
        run.train_rmse.append((trained.squared_error(w, b) / trained.n) ** 0.5)
        run.valid_rmse.append((checked.squared_error(w, b) / checked.n) ** 0.5 if checked else None)
    return run
