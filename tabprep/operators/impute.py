"""Imputation fitted on one table and applied to any table.

``Imputer.fit`` gathers every statistic it needs from the fitting table
(means/std in one aggregate, exact medians, modes in one grouped aggregate);
``FittedImputer.transform`` is a single ``select`` of
``coalesce(nanvl(c, NULL), value)`` projections, so it adds no shuffle and
also runs on a streaming DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.kinds import split_kinds
from tabprep.functions.missing import MISSING_LABEL, nan_to_null, qcol
from tabprep.operators import stats

NUMERIC_METHODS = ("mean", "median")
CATEGORY_METHODS = ("mode",)


@dataclass
class FittedImputer:
    """Fill values by column; numeric fills are doubles, category fills text
    cast back to the column's type.  A whole-number column keeps its type
    where the fill is whole too or nothing is missing, as in pandas."""
    numeric: dict[str, float | None] = field(default_factory=dict)
    category: dict[str, str | None] = field(default_factory=dict)

    def transform(self, df: DataFrame, missing: Sequence[str] | None = None) -> DataFrame:
        """``missing`` names the whole-number columns of ``df`` that have
        missing values; not given, those whose fill is fractional are counted
        (one narrow aggregate; on a stream they are taken to have some)."""
        whole = [n for n in self.numeric if n in df.columns and isinstance(df.schema[n].dataType, T.IntegralType)]
        asked = [n for n in whole if self.numeric[n] is not None and not float(self.numeric[n]).is_integer()]
        if missing is None:
            missing = asked
            if asked and not df.isStreaming:
                row = df.agg(*[F.bool_or(qcol(n).isNull()).alias(f"m{i}") for i, n in enumerate(asked)]).first()
                missing = [n for i, n in enumerate(asked) if row[f"m{i}"]]
        out = []
        for n in df.columns:
            if n in whole and not (n in asked and n in missing):
                v = self.numeric[n]
                fill = F.lit(int(v)).cast(df.schema[n].dataType) if v is not None and n not in asked else None
                out.append((qcol(n) if fill is None else F.coalesce(qcol(n), fill)).alias(n))
            elif n in self.numeric:
                v = self.numeric[n]
                c = nan_to_null(df, n).cast("double")
                out.append((c if v is None else F.coalesce(c, F.lit(float(v)))).alias(n))
            elif n in self.category and self.category[n] is not None:
                out.append(_fill_category(df, n, self.category[n]).alias(n))
            else:
                out.append(qcol(n))
        return df.select(*out)

    def to_json(self) -> str:
        return json.dumps({"numeric": self.numeric, "category": self.category})

    @staticmethod
    def from_json(s: str) -> "FittedImputer":
        d = json.loads(s)
        return FittedImputer(d["numeric"], d["category"])


def _fill_category(df: DataFrame, name: str, value: str) -> Column:
    dt = df.schema[name].dataType
    c = qcol(name)
    if isinstance(dt, T.BooleanType):
        return F.coalesce(c, F.lit(value == "True"))
    if isinstance(dt, T.StringType):
        return F.coalesce(c, F.lit(value))
    return F.coalesce(c, F.lit(value).cast(dt))


@dataclass
class Imputer:
    """``numeric`` in {"median" (default), "mean"}; ``category`` = "mode".
    ``columns`` defaults to every column but ``exclude`` (target, key).  The
    kind of a column is decided on the fitting table."""
    numeric: str = "median"
    category: str = "mode"
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = ()
    kinds: dict[str, str] | None = None

    def __post_init__(self):
        # validated at once, not when a column of that kind is first met
        if self.numeric not in NUMERIC_METHODS:
            raise ValueError("numeric method must be 'mean' or 'median'")
        if self.category not in CATEGORY_METHODS:
            raise ValueError("category method must be 'mode'")

    def fit(self, df: DataFrame, moments: dict[str, dict] | None = None,
            modes: dict[str, str | None] | None = None) -> FittedImputer:
        """``moments`` / ``modes`` already gathered from the same table (e.g.
        by a plan that needs them for other steps too) save their passes."""
        cols = list(self.columns) if self.columns is not None else \
            [c for c in df.columns if c not in self.exclude]
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"columns not in table: {missing}")
        num, cat = split_kinds(df, cols, self.kinds)
        mom = {n: moments[n] for n in num} if moments is not None else stats.moments(df, num)
        if self.numeric == "mean":
            nv = {n: mom[n]["mean"] for n in num}
        else:
            nv = stats.exact_medians(df, num, mom)
        cv = {c: modes[c] for c in cat} if modes is not None else stats.modes(df, cat)
        return FittedImputer(nv, cv)


def fill_constant(df: DataFrame, value: str = MISSING_LABEL,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """missing categorical cells -> ``value``.  Non-string categorical
    columns become text first (booleans as True/False).  Numeric missing values
    stay missing."""
    names = set(columns) if columns is not None else set(df.columns)
    _, cat = split_kinds(df)
    out = []
    for n in df.columns:
        if n in names and n in cat:
            out.append(F.coalesce(stats.as_category_string(df, n), F.lit(value)).alias(n))
        else:
            out.append(qcol(n))
    return df.select(*out)


def empty_to_missing(df: DataFrame, value: str = MISSING_LABEL,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """empty strings -> ``value``."""
    names = set(columns) if columns is not None else set(df.columns)
    out = []
    for n in df.columns:
        if n in names and isinstance(df.schema[n].dataType, T.StringType):
            out.append(F.when(qcol(n) == "", F.lit(value)).otherwise(qcol(n)).alias(n))
        else:
            out.append(qcol(n))
    return df.select(*out)
