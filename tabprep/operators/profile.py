"""Missing-value profiling, row/column selection and sparse-column pruning.

A1-A3: one aggregate counts the missing values of every column at once
(partial aggregation per task, a single-row final); the one row is turned into
long form (``column, missing, rows, ratio``) with ``inline``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.kinds import split_kinds
from tabprep.functions.missing import is_missing, not_missing, qcol

PROFILE_MODES = ("total", "omission")


def missing_profile(df: DataFrame, mode: str = "omission",
                    columns: Sequence[str] | None = None,
                    with_ratio: bool = True) -> DataFrame:
    """Per-column missing count, row count and ratio.

    ``mode="total"`` keeps every column, ``"omission"`` (default) only the
    columns with at least one missing value.  ``with_ratio=False`` gives the
    older two-column form ``(column, missing)``.
    """
    if mode not in PROFILE_MODES:
        raise ValueError("mode must be 'omission' or 'total'")
    names = list(columns) if columns is not None else df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(is_missing(df, n)).alias(f"__m{i}") for i, n in enumerate(names)]
    one = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(f"__m{i}").alias("missing"))
        for i, n in enumerate(names)
    ])
    out = one.select(F.col("__rows").alias("rows"), F.inline(entries))
    if mode == "omission":
        out = out.where(F.col("missing") > 0)
    if not with_ratio:
        return out.select("column", "missing")
    return out.select(
        "column", "missing", "rows",
        F.try_divide(F.col("missing").cast("double"), F.col("rows").cast("double"))
         .alias("ratio"))


def split_missing_target(df: DataFrame, target: str | None = None
                         ) -> tuple[DataFrame, DataFrame]:
    """(rows whose target is present, rows whose target is missing).
    The target defaults to the last column."""
    target = target or df.columns[-1]
    return df.where(not_missing(df, target)), df.where(is_missing(df, target))


def missing_flags(df: DataFrame, key: str, columns: Sequence[str] | None = None
                  ) -> DataFrame:
    """Per-row ``isna`` flags, one boolean column per input column."""
    names = [n for n in (columns or df.columns) if n != key]
    return df.select(qcol(key), *[is_missing(df, n).alias(f"{n}_isna") for n in names])


def select_kind(df: DataFrame, kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """The numeric (``kind="numeric"``) or non-numeric (``"category"``)
    columns in table order, plus any ``keep`` columns in front."""
    rest = [n for n in df.columns if n not in keep]
    num, cat = split_kinds(df, rest)
    chosen = num if kind == "numeric" else cat if kind == "category" else None
    if chosen is None:
        raise ValueError("kind must be 'numeric' or 'category'")
    return df.select(*[qcol(n) for n in list(keep) + chosen])


def features_and_target(df: DataFrame, target: str | None = None,
                        key: str | None = None) -> tuple[list[str], str]:
    """(feature names, target name); target defaults to the last column."""
    target = target or df.columns[-1]
    feats = [n for n in df.columns if n not in (target, key)]
    return feats, target


def drop_columns(*dfs: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, ...]:
    """Drop the named columns from every table (absent names ignored)."""
    return tuple(d.drop(*[c for c in columns if c in d.columns]) for d in dfs)


def prune_sparse_columns(train: DataFrame, test: DataFrame, alpha: float = 0.5,
                         target: str | None = None, key: str | None = None
                         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """drop from both tables the columns whose *train* missing ratio is
    ``>= alpha`` (complete columns never, even at ``alpha=0``).

    Returns (dropped profile rows, train, test).  The target and key are not
    profiled, so a sparse target is never dropped (run ``split_missing_target``
    first).  Only one row per sparse column reaches the driver.
    """
    target = target if target is not None else train.columns[-1]
    cols = [c for c in train.columns if c not in (target, key)]
    prof = missing_profile(train, mode="omission", columns=cols)
    rows = prof.where(F.col("ratio") >= F.lit(float(alpha))).collect()
    dropped_names = [r["column"] for r in rows]
    spark = train.sparkSession
    dropped = spark.createDataFrame(
        [(r["column"], r["missing"], r["rows"], r["ratio"]) for r in rows],
        "column string, missing bigint, rows bigint, ratio double")
    tr, te = drop_columns(train, test, columns=dropped_names)
    return dropped, tr, te
