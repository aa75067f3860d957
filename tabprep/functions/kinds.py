"""Column kinds: numeric (fills with mean/median, scaled) versus categorical
(mode-filled, one-hot encoded).  Booleans count as categorical, like a pandas
object column that holds missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
           T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC)


def numeric_columns(df: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    names = list(among) if among is not None else df.columns
    return [n for n in names if is_numeric_type(df.schema[n].dataType)]


def categorical_columns(df: DataFrame, among: Iterable[str] | None = None) -> list[str]:
    names = list(among) if among is not None else df.columns
    return [n for n in names if not is_numeric_type(df.schema[n].dataType)]


def split_kinds(df: DataFrame, among: Iterable[str] | None = None,
                kinds: dict[str, str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) in column order; ``kinds`` overrides per column
    with "numeric" or "category" (for numerically coded categories)."""
    names = list(among) if among is not None else df.columns
    kinds = kinds or {}
    num, cat = [], []
    for n in names:
        k = kinds.get(n)
        if k is None:
            k = "numeric" if is_numeric_type(df.schema[n].dataType) else "category"
        if k not in ("numeric", "category"):
            raise ValueError(f"kind of {n!r} must be 'numeric' or 'category', got {k!r}")
        (num if k == "numeric" else cat).append(n)
    return num, cat
