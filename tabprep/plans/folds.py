"""Grid searches that reuse what one pass or one fit already knows.

``linear_grid`` (M13, M14): a linear model's fit and its squared error depend
on rows only through their co-moments.  One pass gathers them per fold; the
training part of a fold is the merge of the other folds (M - fold), every
regularisation is a solve of a small system, and the held fold's error follows
from its own co-moments.  Nothing is read twice, whatever the grid.

``staged_grid`` (M15): a boosted model of m rounds is the first m trees of one
of more rounds.  One fit of the most rounds per fold and other setting scores
every smaller number of rounds from the running sums of its trees' outputs, in
one pass over the held fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml import Model
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.functions.missing import qcol
from tabprep.operators.comoments import CoMoments, co_moments
from tabprep.plans.models import _persisted, spread


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold") -> dict[int, CoMoments]:
    """Co-moments of features and label per fold, in one pass."""
    return co_moments(df, [qcol(c) for c in (*features, label)], by=fold_col)


def _without(folds: dict[int, CoMoments], f: int) -> CoMoments:
    """The other folds, merged (adding them keeps digits that subtracting the
    fold from the whole would lose)."""
    return reduce(CoMoments.merge, [m for g, m in sorted(folds.items()) if g != f])


def linear_fold_errors(folds: dict[int, CoMoments], reg: float = 0.0) -> list[tuple[int, int, float]]:
    """(fold, rows, root mean squared error) of the ridge fit on the others."""
    return [(f, m.n, (m.squared_error(*_without(folds, f).ridge(reg)) / m.n) ** 0.5) for f, m in sorted(folds.items())]


def _ranked(spark: SparkSession, rows: list[tuple], names: Sequence[str], metric: str) -> DataFrame:
    """The table of a search: one row per candidate, best first by rank."""
    schema = ", ".join(["candidate int"] + [f"`{n}` double" for n in names]
                       + [f"neg_{metric}_mean double", f"neg_{metric}_std double"])
    # one row per candidate: the single-partition window is tiny
    return spark.createDataFrame(rows, schema).withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(f"neg_{metric}_mean").desc(), F.col("candidate"))))


def linear_grid(df: DataFrame, features: Sequence[str], label: str, regs: Sequence[float],
                fold_col: str = "fold") -> tuple[np.ndarray, float, DataFrame]:
    """M14 for linear models: weights and intercept of the best ``regParam``
    refit on all rows, and the table of candidates (as ``models.grid_search``
    gives it, by root mean squared error).  Rows with a NULL feature or label
    do not take part."""
    folds = fold_moments(df, features, label, fold_col)
    if len(folds) < 2:
        raise ValueError("a grid search needs at least two folds")
    rows = []
    for i, reg in enumerate(regs):
        neg = -np.array([e for _, _, e in linear_fold_errors(folds, reg)])
        rows.append((i, float(reg), float(neg.mean()), float(neg.std())))
    best = max(rows, key=lambda r: (r[2], -r[0]))
    w, b = reduce(CoMoments.merge, folds.values()).ridge(best[1])
    return w, b, _ranked(df.sparkSession, rows, ["regParam"], "rmse")


def staged_errors(model, held: DataFrame, rounds: Sequence[int], metric: str = "rmse") -> dict[int, float]:
    """Error of the first m trees for every m of ``rounds``, in one pass."""
    per_round = model.evaluateEachIteration(held, "squared" if metric == "rmse" else "absolute")
    return {m: per_round[m - 1] ** (0.5 if metric == "rmse" else 1.0) for m in rounds}


def staged_grid(spark: SparkSession, estimator: GBTRegressor, df: DataFrame, grid: dict[str, Sequence], label: str,
                k: int, fold_col: str = "fold", parallelism: int = 1, metric: str = "rmse") -> tuple[Model, DataFrame]:
    """The search of ``models.grid_search`` over boosted trees, with the
    ``maxIter`` axis scored in stages: ``k`` fits per combination of the other
    parameters, instead of that times the number of ``maxIter`` values.  The
    table and the refit model are those of separate fits."""
    if metric not in ("rmse", "mae"):
        raise ValueError("metric must be 'rmse' or 'mae'")
    rounds = [int(m) for m in grid["maxIter"]]
    others = {n: v for n, v in grid.items() if n != "maxIter"}
    combos = [dict(zip(others, values)) for values in product(*others.values())]
    most = max(rounds)

    def params(combo: dict, m: int) -> dict:
        return {estimator.getParam(n): v for n, v in (combo | {"maxIter": m}).items()}

    with _persisted(spread(estimator, df)) as data, ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        def one(task):
            c, f = task
            fitted = estimator.fit(data.where(F.col(fold_col) != f), params(combos[c], most))
            return c, staged_errors(fitted, data.where(F.col(fold_col) == f), rounds, metric)

        errors: dict[tuple[int, int], list[float]] = {}
        for c, found in pool.map(one, product(range(len(combos)), range(k))):
            for m, e in found.items():
                errors.setdefault((c, m), []).append(e)
        rows, at = [], {}
        for i, values in enumerate(product(*grid.values())):  # candidates in the order of the grid
            candidate = dict(zip(grid, values))
            key = combos.index({n: v for n, v in candidate.items() if n != "maxIter"}), int(candidate["maxIter"])
            neg = -np.array(errors[key])
            rows.append((i, *[float(v) for v in values], float(neg.mean()), float(neg.std())))
            at[i] = key
        c, m = at[max(rows, key=lambda r: (r[-2], -r[0]))[0]]
        best = estimator.fit(data, params(combos[c], m))
    return best, _ranked(spark, rows, list(grid), metric)
