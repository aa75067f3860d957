"""Counts, means and centred co-moments of several columns, by group.

They are all that squared errors of linear models depend on: least squares,
ridge, gradient descent, and the error of any linear model on any group of
rows follow from them without another pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many columns each pair is its own aggregate; above, one vector.
PAIRWISE = 24


@dataclass
class CoMoments:
    """``n`` rows, their ``mean`` and ``c``, the sums of products of
    deviations from it."""
    n: int
    mean: np.ndarray
    c: np.ndarray

    def merge(self, other: "CoMoments") -> "CoMoments":
        n = self.n + other.n
        if not n:
            return self
        d = other.mean - self.mean
        return CoMoments(n, self.mean + d * (other.n / n),
                         self.c + other.c + np.outer(d, d) * (self.n * other.n / n))

    def squared_error(self, w: np.ndarray, b: float) -> float:
        """Sum of squared errors of ``x . w + b`` against the last column."""
        v = np.append(w, -1.0)
        return float(max(0.0, v @ self.c @ v) + self.n * (v @ self.mean + b) ** 2)

    def ridge(self, reg: float = 0.0) -> tuple[np.ndarray, float]:
        """Weights and intercept minimising the mean squared error / 2 plus
        ``reg`` / (2 s) times the squared weights, where s is the label's
        population deviation (MLlib's scaling of ``regParam``)."""
        d = len(self.mean) - 1
        a, t = self.c[:d, :d] / self.n, self.c[:d, d] / self.n
        spread = np.sqrt(self.c[d, d] / self.n)
        if reg and spread:
            a = a + np.eye(d) * (reg / spread)
        w = np.linalg.solve(a, t) if reg else np.linalg.lstsq(a, t, rcond=None)[0]
        return w, float(self.mean[d] - w @ self.mean[:d])


def co_moments(df: DataFrame, columns: Sequence[Column], by: str | None = None) -> dict:
    """``{group: CoMoments}`` of the rows where no column is NULL (one group
    ``None`` without ``by``).  One pass up to PAIRWISE columns: a stable
    covariance aggregate per pair.  Above, the columns are kept as one array
    and read twice: means, then the centred products summed as one vector, so
    the plan does not grow with their square.  Only the sums (one row per
    group) reach the driver."""
    d = len(columns)
    group = F.col(f"`{by}`") if by else F.lit(None).cast("int")
    # the columns are evaluated here once: pair aggregates name them d times
    plain = df.select(group.alias("g"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    whole = F.expr(" and ".join(f"x{i} is not null" for i in range(d)))
    if d > PAIRWISE:
        return _wide(plain.where(whole), d)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    # no filter on the columns: it would be pushed below them, and their
    # expressions evaluated once more for it
    x = [F.when(whole, F.col(f"x{i}")) for i in range(d)]
    rows = plain.groupBy("g").agg(
        F.count_if(whole).alias("n"), *[F.avg(x[i]).alias(f"m{i}") for i in range(d)],
        *[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in rows:
        if not r["n"]:
            continue
        c = np.zeros((d, d))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"c{i}_{j}"] * r["n"]
        out[r["g"]] = CoMoments(r["n"], np.array([r[f"m{i}"] for i in range(d)]), c)
    return out


def _wide(plain: DataFrame, d: int) -> dict:
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    z = plain.select("g", F.array(*[f"x{i}" for i in range(d)]).alias("z")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        means = {r["g"]: r for r in z.groupBy("g").agg(
            F.count(F.lit(1)).alias("n"), Summarizer.mean(array_to_vector("z")).alias("m")).collect()}
        out = {}
        for g, r in means.items():  # one group (or fold) at a time: the mean is a constant of the plan
            mean = np.array(r["m"].toArray())
            centred = F.zip_with("z", F.array(*[F.lit(float(m)) for m in mean]), lambda a, m: a - m)
            rows = z.where(F.col("g").eqNullSafe(F.lit(g))).select(centred.alias("z"))
            outer = F.flatten(F.transform("z", lambda a: F.transform("z", lambda b: a * b)))
            total = rows.select(array_to_vector(outer).alias("o")).select(Summarizer.sum(F.col("o")).alias("s")).first()["s"]
            out[g] = CoMoments(r["n"], mean, np.array(total.toArray()).reshape(d, d))
        return out
    finally:
        z.unpersist()
