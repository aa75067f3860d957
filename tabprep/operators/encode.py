"""Scaling and one-hot encoding that keep train and test columns aligned.

``TableEncoder.fit(train)`` runs two jobs: one aggregate for the mean,
population std, min and max of every numeric column (and the target), and one
distinct ``(column, value)`` job for the category lists.  The fitted encoder
emits its whole output as one ``select``:

* ``num__<col>``: standardized ``(x-mean)/std``, normalized ``(x-min)/range``
  (not clipped, so test values may leave [0, 1]) or passed through; a
  constant column divides by 1, giving 0 on train.
* ``cat__<col>_<value>``: 0/1 per sorted train category of ``<col>``; a test
  value never seen in train is all zeros.  Missing categories are the label
  ``missing_value`` and empty strings too.
* the target, last: raw (``keep_target_separate=True``) or scaled by its own
  scaler, whose ``sigma``/``mu`` invert it: ``y * sigma + mu``.

``dummies`` is dummy coding over one table (get_dummies semantics), and
``joint_dummies`` codes train and test stacked together so widths match.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.kinds import split_kinds
from tabprep.functions.missing import MISSING_LABEL, qcol
from tabprep.operators import stats
from tabprep.operators.align import stack_tagged
from tabprep.operators.impute import empty_to_missing, fill_constant

NUMERIC_METHODS = ("standardize", "normalize", "none")


def _scale_params(method: str, m: dict) -> tuple[float, float]:
    """(shift, scale) so that the output is (x - shift) / scale."""
    if method == "standardize":
        sd = m["std"]
        return (m["mean"] or 0.0), (sd if sd else 1.0)
    if method == "normalize":
        lo, hi = m["min"], m["max"]
        rng = (hi - lo) if lo is not None else None
        return (lo or 0.0), (rng if rng else 1.0)
    return 0.0, 1.0


@dataclass
class FittedEncoder:
    numeric_method: str
    numeric: list[str]
    shift: dict[str, float]
    scale: dict[str, float]
    category: dict[str, list[str]]
    target: str | None
    target_scaled: bool
    sigma: float = 1.0
    mu: float = 0.0
    key: str | None = None
    passthrough: list[str] = field(default_factory=list)

    @property
    def output_columns(self) -> list[str]:
        names = [f"num__{n}" for n in self.numeric]
        for c, vals in self.category.items():
            names += [f"cat__{c}_{v}" for v in vals]
        return names

    def feature_exprs(self, df: DataFrame) -> list[Column]:
        out = []
        for n in self.numeric:
            x = qcol(n).cast("double")
            if self.numeric_method != "none":
                x = (x - F.lit(self.shift[n])) / F.lit(self.scale[n])
            out.append(x.alias(f"num__{n}"))
        for c, vals in self.category.items():
            # the value as text, missing and empty -> the label (F5, F6); text
            # comparison also holds when the column's type differs from train
            txt = stats.as_category_string(df, c)
            txt = F.coalesce(F.when(txt == "", F.lit(MISSING_LABEL)).otherwise(txt),
                             F.lit(MISSING_LABEL))
            for v in vals:
                out.append((txt == F.lit(v)).cast("double").alias(f"cat__{c}_{v}"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """One select: key (if any), features, passthrough columns, target
        (when the table has it)."""
        d = df
        cols: list[Column] = []
        if self.key and self.key in d.columns:
            cols.append(qcol(self.key))
        cols += self.feature_exprs(d)
        cols += [qcol(p) for p in self.passthrough if p in d.columns]
        if self.target and self.target in d.columns:
            y = qcol(self.target).cast("double")
            if self.target_scaled:
                y = (y - F.lit(self.mu)) / F.lit(self.sigma)
            cols.append(y.alias(self.target))
        return d.select(*cols)

    def inverse_target(self, y: Column) -> Column:
        """back to the original target scale."""
        return y * F.lit(self.sigma) + F.lit(self.mu)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(s: str) -> "FittedEncoder":
        return FittedEncoder(**json.loads(s))


@dataclass
class TableEncoder:
    numeric_method: str = "standardize"
    keep_target_separate: bool = True
    target: str | None = None
    key: str | None = None
    kinds: dict[str, str] | None = None
    passthrough: Sequence[str] = ()
    max_categories: int | None = 100_000

    def __post_init__(self):
        if self.numeric_method not in NUMERIC_METHODS:
            raise ValueError("numeric_method must be 'standardize', 'normalize' or 'none'")

    def fit(self, train: DataFrame, categories: dict[str, list[str]] | None = None,
            moments: dict[str, dict] | None = None) -> FittedEncoder:
        """``categories`` (the sorted category lists of the table after the
        constant fill) and ``moments`` (of the numeric columns and the
        target), when a plan already knows them, save their passes."""
        target = self.target or train.columns[-1]
        feats = [c for c in train.columns
                 if c not in (target, self.key) and c not in self.passthrough]
        num, cat = split_kinds(train, feats, self.kinds)
        need = list(num)
        scale_target = not self.keep_target_separate and self.numeric_method != "none"
        if scale_target:
            need.append(target)
        if moments is not None:
            mom = {n: moments[n] for n in need}
        else:
            mom = stats.moments(train, need) \
                if (self.numeric_method != "none" or scale_target) else {}
        shift, scale = {}, {}
        for n in num:
            shift[n], scale[n] = _scale_params(self.numeric_method, mom[n]) \
                if mom else (0.0, 1.0)
        if categories is not None:
            cats = {c: list(categories[c]) for c in cat}
        else:
            filled = empty_to_missing(fill_constant(train.select(*[qcol(c) for c in cat]),
                                                    columns=cat), columns=cat)
            cats = stats.categories(filled, cat, self.max_categories)
        sigma, mu = 1.0, 0.0
        if scale_target:
            mu, sigma = _scale_params(self.numeric_method, mom[target])
        return FittedEncoder(self.numeric_method, num, shift, scale,
                             {c: cats[c] for c in cat}, target, scale_target,
                             sigma, mu, self.key, list(self.passthrough))


# ------------------------------------------------------------ dummy coding

def _prefixes(columns: list[str], prefix) -> dict[str, str]:
    if prefix is None:
        return {c: c for c in columns}
    if isinstance(prefix, str):
        return {c: prefix for c in columns}
    if isinstance(prefix, dict):
        return {c: prefix.get(c, c) for c in columns}
    prefix = list(prefix)
    if len(prefix) != len(columns):
        raise ValueError("prefix list must have one entry per encoded column")
    return dict(zip(columns, prefix))


_DTYPES = {"bool": T.BooleanType(), "uint8": T.ShortType(), "int8": T.ByteType(),
           "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
           "float32": T.FloatType(), "float64": T.DoubleType()}


@dataclass
class FittedDummies:
    columns: list[str]
    values: dict[str, list[str]]
    prefix: dict[str, str]
    prefix_sep: str = "_"
    dummy_na: bool = False
    drop_first: bool = False
    dtype: str = "bool"
    sparse: bool = False

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(s: str) -> "FittedDummies":
        return FittedDummies(**json.loads(s))

    def names(self, c: str) -> list[str]:
        vals = self.values[c][1:] if self.drop_first else self.values[c]
        names = [f"{self.prefix[c]}{self.prefix_sep}{v}" for v in vals]
        if self.dummy_na:
            names.append(f"{self.prefix[c]}{self.prefix_sep}nan")
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        """Other columns first, in table order, then each encoded column's
        indicators (sorted values, optional ``_nan`` last).  With ``sparse``
        each encoded column becomes one SparseVector column named by its
        prefix, built JVM-side by the ML one-hot transformer."""
        if self.sparse:
            return self._sparse(df)
        dt = _DTYPES[self.dtype]
        keep = [qcol(c) for c in df.columns if c not in self.columns]
        out: list[Column] = []
        for c in self.columns:
            txt = stats.as_category_string(df, c)
            vals = self.values[c][1:] if self.drop_first else self.values[c]
            for v, name in zip(vals, self.names(c)):
                out.append(F.coalesce(txt == F.lit(v), F.lit(False)).cast(dt).alias(name))
            if self.dummy_na:
                out.append(txt.isNull().cast(dt).alias(self.names(c)[-1]))
        return df.select(*keep, *out)

    def _sparse(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import OneHotEncoder
        keep = [c for c in df.columns if c not in self.columns]
        idx_cols, out_cols = [], []
        exprs = [qcol(c) for c in keep]
        for i, c in enumerate(self.columns):
            txt = stats.as_category_string(df, c)
            vals = self.values[c][1:] if self.drop_first else self.values[c]
            k = len(vals)
            pos = F.array_position(F.array(*[F.lit(v) for v in vals]) if vals
                                   else F.array().cast("array<string>"), txt)
            # slots: the k values, the NaN indicator (with dummy_na), then one
            # more that dropLast removes: NULL without dummy_na and unseen
            # values land there, giving all zeros
            width = k + (1 if self.dummy_na else 0) + 1
            zero = width - 1
            slot = F.when(txt.isNull(), F.lit(k if self.dummy_na else zero))
            slot = slot.when(pos > 0, pos - 1).otherwise(F.lit(zero))
            name = f"__idx{i}"
            exprs.append(slot.cast("double").alias(
                name, metadata={"ml_attr": {"type": "nominal", "num_vals": width}}))
            idx_cols.append(name)
            out_cols.append(self.prefix[c])
        staged = df.select(*exprs)
        enc = OneHotEncoder(inputCols=idx_cols, outputCols=out_cols, dropLast=True,
                            handleInvalid="error").fit(staged)
        return enc.transform(staged).select(*[qcol(c) for c in keep + out_cols])


def fit_dummies(df: DataFrame, columns: Sequence[str] | None = None, prefix=None,
                prefix_sep: str = "_", dummy_na: bool = False, drop_first: bool = False,
                dtype: str = "bool", sparse: bool = False,
                max_categories: int | None = 100_000) -> FittedDummies:
    """get_dummies over one table; ``columns`` defaults to every
    string column (booleans are left alone)."""
    if dtype not in _DTYPES:
        raise ValueError(f"dtype must be one of {sorted(_DTYPES)}")
    if columns is None:
        columns = [c for c in df.columns if isinstance(df.schema[c].dataType, T.StringType)]
    columns = list(columns)
    vals = stats.categories(df, columns, max_categories)
    return FittedDummies(columns, vals, _prefixes(columns, prefix), prefix_sep,
                         dummy_na, drop_first, dtype, sparse)


def dummies(df: DataFrame, **kw) -> DataFrame:
    return fit_dummies(df, **kw).transform(df)


def joint_dummies(train: DataFrame, test: DataFrame, origin: str = "__origin", **kw
                  ) -> tuple[DataFrame, DataFrame]:
    """F16: stack train and test (columns by name, absent ones missing), dummy
    code the stack, split back by the origin tag."""
    stacked = stack_tagged(train, test, origin=origin)
    kw = dict(kw)
    cols = kw.pop("columns", None)
    if cols is None:
        cols = [c for c in stacked.columns
                if c != origin and isinstance(stacked.schema[c].dataType, T.StringType)]
    enc = fit_dummies(stacked, columns=cols, **kw).transform(stacked)
    tr = enc.where(F.col(origin) == "train").drop(origin)
    te = enc.where(F.col(origin) == "test").drop(origin)
    return tr, te


# -------------------------------------------------------- image features

def scale_pixels(pixels: Column, top: float = 255.0) -> Column:
    """pixel values [0, top] -> [0, 1], element-wise on nested arrays."""
    return F.transform(pixels, lambda row: F.transform(row, lambda x: x.cast("double") / top))


def flatten_image(pixels: Column) -> Column:
    """2-D pixel grid -> flat array (row-major)."""
    return F.flatten(pixels)


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features",
             keep: Sequence[str] = ()) -> DataFrame:
    """feature columns -> one ML vector column (JVM side, no UDF)."""
    from pyspark.ml.functions import array_to_vector
    vec = array_to_vector(F.array(*[qcol(c).cast("double") for c in columns]))
    return df.select(*[qcol(k) for k in keep], vec.alias(out))


__all__ = ["TableEncoder", "FittedEncoder", "fit_dummies", "dummies", "joint_dummies",
           "scale_pixels", "flatten_image", "assemble", "MISSING_LABEL"]
