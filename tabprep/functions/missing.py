"""pandas meaning of "missing": NULL, and NaN on floating columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens pandas' CSV reader turns into a missing value by
# default (its documented ``na_values`` list), used by the CSV source.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Fixed value: the label the encoder gives to a missing category.
MISSING_LABEL = "missing_value"

FLOATING = (T.FloatType, T.DoubleType)


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def qcol(name: str) -> Column:
    """Column by exact name, safe for dots, spaces and other odd characters."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    c = qcol(name)
    if isinstance(field_type(df, name), FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def not_missing(df: DataFrame, name: str) -> Column:
    return ~is_missing(df, name)


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL (floating types only)."""
    c = qcol(name)
    if isinstance(field_type(df, name), FLOATING):
        return F.nanvl(c, F.lit(None).cast(field_type(df, name)))
    return c
