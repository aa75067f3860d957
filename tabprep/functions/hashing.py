"""Repeatable per-row randomness from an integer key.

The reference draws hold-outs, folds, batch orders and synthetic noise from a
seeded generator.  A seeded generator cannot be replayed across partitions or
in SQL, so every random step here is a pure function of the row key: a 32-bit
multiplicative hash (Knuth's constant), mixed with a salt.  The same formula is
rendered as Spark columns and as SQL text, so the DuckDB oracle reproduces it.

All steps are bijections on ``key mod 2^32``: keys below 2^32 never tie.
Products are split into 16-bit halves so nothing overflows a signed 64-bit
integer (Spark runs in ANSI mode).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Knuth's multiplicative-hash constant and its 16-bit halves.
GOLDEN = 2654435761
GOLDEN_HI = GOLDEN >> 16      # 40503
GOLDEN_LO = GOLDEN & 0xFFFF   # 31153
MOD32 = 1 << 32
MOD16 = 1 << 16


def _mulhash(x: Column) -> Column:
    """(x * GOLDEN) mod 2^32 for 0 <= x < 2^32, overflow free."""
    hi = F.pmod(x * F.lit(GOLDEN_HI), F.lit(MOD16)) * F.lit(MOD16)
    return F.pmod(hi + x * F.lit(GOLDEN_LO), F.lit(MOD32))


def key_hash(key: Column | str, salt: int = 0) -> Column:
    """32-bit hash of an integer key, as a bigint in [0, 2^32)."""
    k = F.col(key) if isinstance(key, str) else key
    h = _mulhash(F.pmod(k.cast("bigint"), F.lit(MOD32)))
    if salt == 0:
        return h
    s = F.pmod(h + F.lit(salt * GOLDEN_HI), F.lit(MOD32))
    s = s.bitwiseXOR(F.shiftright(s, 15))
    return _mulhash(s)


def row_key(df: DataFrame, key: str) -> Column:
    """A whole number that names the row: the key itself if it is an integer,
    else its 64-bit hash; the hash of the whole row where the key is NULL, so
    that such rows are drawn like any other and spread evenly."""
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    k = F.col(f"`{key}`")
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.coalesce(k.cast("bigint") if whole else F.when(k.isNotNull(), F.xxhash64(k)), F.xxhash64(*hashable))


def key_uniform(key: Column | str, salt: int = 0) -> Column:
    """Uniform draw in (0, 1) from the key hash."""
    return (key_hash(key, salt) + F.lit(0.5)) / F.lit(float(MOD32))


def key_normal(key: Column | str, salt: int = 0) -> Column:
    """Standard normal draw (Box-Muller) from two salted key hashes."""
    u1 = key_uniform(key, 2 * salt + 1)
    u2 = key_uniform(key, 2 * salt + 2)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


# ---- the same formulas as SQL text (DuckDB dialect) for the oracle ----

def _sql_pmod(x: str, m: int) -> str:
    return f"((({x}) % {m} + {m}) % {m})"


def _sql_mulhash(x: str) -> str:
    hi = f"({_sql_pmod(f'({x}) * {GOLDEN_HI}', MOD16)} * {MOD16})"
    return _sql_pmod(f"{hi} + ({x}) * {GOLDEN_LO}", MOD32)


def sql_key_hash(key: str, salt: int = 0) -> str:
    h = _sql_mulhash(_sql_pmod(f"CAST({key} AS BIGINT)", MOD32))
    if salt == 0:
        return h
    s = _sql_pmod(f"{h} + {salt * GOLDEN_HI}", MOD32)
    s = f"xor({s}, ({s}) >> 15)"
    return _sql_mulhash(s)


def sql_key_uniform(key: str, salt: int = 0) -> str:
    return f"(({sql_key_hash(key, salt)}) + 0.5) / {float(MOD32)}"


def sql_key_normal(key: str, salt: int = 0) -> str:
    u1 = sql_key_uniform(key, 2 * salt + 1)
    u2 = sql_key_uniform(key, 2 * salt + 2)
    return f"(sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2}))"
