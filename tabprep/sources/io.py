"""CSV scan with pandas missing-value semantics, prediction and table export,
preview (S1-S3, S6-S8).

``read_csv`` reads every field as text (Spark's CSV reader takes a single
``nullValue`` token), turns any of the NA tokens into NULL in one projection,
then types each column the way pandas would: integer if every present value
parses as one, else floating if every present value parses as a number,
else text; truth values as booleans, and a column without values as floating.  Type inference is one aggregate over the file (per column, a
count of values that do not match the integer / number pattern, partial per
task); with ``types`` given for a column it is skipped there.  Both steps are projections, so filters and column pruning
still reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.missing import PANDAS_NA_TOKENS, qcol
from tabprep.sources import records


def _na_to_null(c, tokens: Sequence[str]):
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


# The text forms a number may take (pandas' parser also takes
# surrounding blanks and inf/infinity in any case).
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = (r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
                 r"|(?i:inf|infinity))\s*$")


# The spellings of truth values that pandas' parser takes.
BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """pandas-like type of every text column: 'boolean', 'bigint',
    'decimal(20,0)' (whole numbers up to 2^64 - 1), 'double' (also where nothing
    is present) or 'string' (also for whole numbers beyond that).  One aggregate: per column, the count of present values that
    do not look like an integer / a number (regular expressions, JVM side; a
    failed ``try_cast`` costs an exception per value, so casts run only on
    columns known to parse), and the range of integers of 19 digits or more."""
    cols = list(columns) if columns is not None else df.columns
    aggs = []
    for i, c in enumerate(cols):
        x = qcol(c)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x.isNotNull() & ~x.isin(*BOOLEANS)).alias(f"b{i}"),
                 F.count_if(x.isNotNull() & ~x.rlike(INT_PATTERN)).alias(f"i{i}"),
                 F.count_if(x.isNotNull() & ~x.rlike(FLOAT_PATTERN)).alias(f"d{i}")]
        digits = F.regexp_replace(x, r"^\s*[+-]?0*|\s*$", "")
        wide = F.when(x.rlike(INT_PATTERN) & (F.length(digits) >= 19), digits)
        minus = F.trim(x).startswith("-")
        # of the longest numbers, the largest as text is the largest
        size = F.struct(F.length(wide).alias("n"), wide.alias("v"))
        aggs += [F.max(F.when(wide.isNotNull() & ~minus, size)).alias(f"p{i}"),
                 F.max(F.when(wide.isNotNull() & minus, size)).alias(f"m{i}"),
                 F.count_if(minus & x.rlike(INT_PATTERN)).alias(f"s{i}")]
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        if row[f"n{i}"] == 0:
            out[c] = "double"  # nothing present
        elif row[f"b{i}"] == 0:
            out[c] = "boolean"
        elif row[f"i{i}"] == 0:
            top = int(row[f"p{i}"]["v"]) if row[f"p{i}"] else 0
            low = int(row[f"m{i}"]["v"]) if row[f"m{i}"] else 0
            if top < 1 << 63 and low <= 1 << 63:
                out[c] = "bigint"
            elif top < 1 << 64 and not row[f"s{i}"]:
                out[c] = "decimal(20,0)"
            else:
                out[c] = "string"
        elif row[f"d{i}"] == 0:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def read_csv(spark: SparkSession, path: str, key: str | None = None,
             na_tokens: Sequence[str] = PANDAS_NA_TOKENS,
             types: dict[str, str] | None = None, drop: Sequence[str] = (),
             sep: str = ",") -> DataFrame:
    """S1 (``key`` named: it comes first and is never a feature), S2
    (``key=None``: every column stays, an ``Id`` column is then an ordinary
    feature), S3 (``drop``: columns removed at load).  ``types`` maps column
    name to a Spark type and skips inference for those columns.  Line breaks
    inside quotes are kept, and such files are still read in splits (see
    ``records``); column names hold none."""
    raw = (spark.read.option("header", True).option("sep", sep)
           .option("inferSchema", False).option("mode", "FAILFAST")
           .option("escape", '"').csv(path))
    if records.has_broken_lines(spark, path):
        raw = records.parsed(spark, path, raw.columns, sep)
    raw = raw.drop(*[c for c in drop if c in raw.columns])
    text = raw.select(*[_na_to_null(qcol(c), na_tokens).alias(c) for c in raw.columns])
    given = dict(types or {})
    todo = [c for c in text.columns if c not in given]
    given.update(infer_types(text, todo))
    typed = text.select(*[(F.expr(f"try_cast(`{c}` AS {given[c]})") if given[c] != "string"
                           else qcol(c)).alias(c) for c in text.columns])
    if key is not None:
        if key not in typed.columns:
            raise ValueError(f"key column {key!r} not in file")
        typed = typed.select(qcol(key), *[qcol(c) for c in typed.columns if c != key])
    return typed


def write_predictions(df: DataFrame, key: str, prediction: str, path: str,
                      target: str = "SalePrice") -> None:
    """``key,target`` CSV with a header and no row index; one file per
    partition, written by the executors."""
    (df.select(qcol(key), qcol(prediction).alias(target))
       .write.mode("overwrite").option("header", True).csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> None:
    """Intermediate tables (encoded tables, targets, predictions).
    Workbooks are not written; Parquet or CSV instead."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key (a top-n: each task keeps n rows,
    the final merge sees n per task)."""
    return df.orderBy(qcol(key)).limit(n)
