"""Repeatable hold-out, folds, per-epoch order and mini-batches.

All draws are functions of the row key (``tabprep.functions.hashing``), so a
row lands in the same part on any partitioning, after executor loss, and in
the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import key_hash, row_key
from tabprep.operators.align import consecutive_index

EPOCH_SALT = 1000


def holdout_flag(key: Column | str, train_pct: int = 80, salt: int = 0) -> Column:
    """True for the ``train_pct`` percent train part."""
    return F.pmod(key_hash(key, salt), F.lit(100)) < F.lit(train_pct)


def holdout(df: DataFrame, key: str, train_pct: int = 80, salt: int = 0
            ) -> tuple[DataFrame, DataFrame]:
    """(train part, validation part); every row is in exactly one, also
    rows with a NULL or non-integer key (see ``row_key``)."""
    f = holdout_flag(row_key(df, key), train_pct, salt)
    return df.where(f), df.where(~f)


def fold_of(key: Column | str, k: int = 5, salt: int = 1) -> Column:
    """Fold number 0..k-1."""
    return F.pmod(key_hash(key, salt), F.lit(k)).cast("int")


def with_folds(df: DataFrame, key: str, k: int = 5, salt: int = 1, out: str = "fold"
               ) -> DataFrame:
    """D2 on a table: every row has a fold (see ``row_key``)."""
    return df.withColumn(out, fold_of(row_key(df, key), k, salt))


def epoch_order(key: Column | str, epoch: int) -> Column:
    """D3: shuffle key of a row in an epoch (no ties for keys below 2^32)."""
    return key_hash(key, EPOCH_SALT + epoch)


def with_batches(df: DataFrame, key: str, batch_size: int, epoch: int = 0,
                 out: str = "batch", exact: bool = True) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in the epoch's shuffled
    order; the last batch may be short.  Adds ``pos`` (position in the
    epoch) and ``out`` (batch number).

    ``exact=False`` is the cheap form for very large tables: one count, then
    each row goes to batch ``hash mod ceil(n / batch_size)`` of the epoch's
    key hash, with no sort, shuffle or checkpoint; batch sizes then average
    ``batch_size`` instead of matching it (no ``pos`` column)."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    if not exact:
        n_batches = max(1, -(-df.count() // batch_size))
        return df.withColumn(out, F.pmod(epoch_order(row_key(df, key), epoch), F.lit(n_batches)))
    ordered = df.withColumn("__order", epoch_order(row_key(df, key), epoch))
    numbered = consecutive_index(ordered, ["__order", key], out="pos")
    return numbered.drop("__order").withColumn(
        out, F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint"))
