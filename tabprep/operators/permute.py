"""A shuffled order of numbered rows, computed per row.

``shuffled`` maps row numbers 0..n-1 onto 0..n-1, each once, in an order that
depends on the epoch.  Every round mixes the numbers below the largest power
of two in n by a two-part Feistel step (each half is shifted by a hash of the
other, modulo its own size, so halves of unequal width work too), then rotates
all n numbers by about half, which moves those above the power of two into the
mixed part.  Both steps are one to one on 0..n-1, so there is no cycle to walk
back into range, whose length no fixed expression could bound.

Rows are numbered once (``align.consecutive_index``); an epoch's exact
positions and batches are then a projection: no sort, shuffle or checkpoint,
and the same arithmetic in SQL (``shuffled_sql``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.missing import qcol

ROUNDS = 4
# A Mersenne prime and two known multipliers of Lehmer's
# generator with this modulus.
PRIME, FIRST, SECOND = 2147483647, 1583458089, 784588716


def _keys(epoch: int, step: int) -> tuple[int, int]:
    """What the two multiplications of a hash are shifted by."""
    salt = (epoch * 2 * ROUNDS + step + 1) * 2654435761
    return salt % PRIME, (salt >> 7) * 40503 % PRIME


def _hash(x, epoch: int, step: int):
    """A number below PRIME from a half below 2**32; names ``x`` once."""
    a, b = _keys(epoch, step)
    first = (x * F.lit(FIRST).cast("long") + F.lit(a)) % F.lit(PRIME).cast("long")
    return F.shiftright(first, 3) * F.lit(SECOND).cast("long") % F.lit(PRIME).cast("long") + F.lit(b)


def _hash_sql(x: str, epoch: int, step: int) -> str:
    a, b = _keys(epoch, step)
    return f"(((({x}) * {FIRST} + {a}) % {PRIME}) // 8 * {SECOND} % {PRIME} + {b})"


def _turn(n: int, step: int) -> int:
    """Rotation after a round: about half of n."""
    return n // 2 + step


def _let(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` evaluated once, however often it is named: the
    optimizer puts plain columns into all their uses, and here each round
    names the one before several times."""
    return F.transform(F.array(x), lambda v: use(v))[0]


def shuffled_position(row: Column, n: int, epoch: int) -> Column:
    """The position of row number ``row`` (0..n-1) in the epoch; NULL for a
    number outside 0..n-1 or NULL."""
    if n < 1:
        return F.lit(None).cast("bigint")
    bits = n.bit_length() - 1           # 2**bits <= n
    low, high = bits // 2, bits - bits // 2
    if high > 31:
        raise ValueError("more than 2**62 rows")

    def round_of(i: int, x: Column) -> Column:
        def mixed(a: Column) -> Column:
            b = F.pmod(x + _hash(a, epoch, 2 * i), F.lit(1 << low).cast("long"))
            return _let(b, lambda b: F.shiftleft(F.pmod(a + _hash(b, epoch, 2 * i + 1), F.lit(1 << high).cast("long")), low) + b)
        inner = F.when(x < F.lit(1 << bits), _let(F.shiftright(x, low), mixed)).otherwise(x)
        return F.pmod(inner + F.lit(_turn(n, i)), F.lit(n).cast("long"))

    x = F.when(row.between(0, n - 1), row.cast("long"))
    for i in range(ROUNDS):
        x = _let(x, partial(round_of, i))
    return x


def shuffled(df: DataFrame, row: str, n: int, epoch: int, out: str = "pos") -> DataFrame:
    """``df`` with ``out``, the position of each row of 0..n-1 in the epoch.
    A row number outside 0..n-1 (or NULL) gives NULL."""
    return df.withColumn(out, shuffled_position(qcol(row), n, epoch))


def epoch_batches(df: DataFrame, row: str, n: int, batch_size: int, epoch: int,
                  pos: str = "pos", out: str = "batch") -> DataFrame:
    """Exact batches of ``batch_size`` rows of an epoch; the last one may
    be short.  A projection over numbered rows."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    return shuffled(df, row, n, epoch, pos).withColumn(
        out, F.floor(F.col(pos) / F.lit(batch_size)).cast("bigint"))


def shuffled_sql(table: str, row: str, epoch: int, out: str = "pos") -> str:
    """The same as a DuckDB query over ``table``, whose row count is n."""
    p = f"SELECT *, {row}::BIGINT AS x, (SELECT count(*) FROM {table}) AS n FROM {table}"
    p = f"SELECT *, length(bin(n)) - 1 AS bits, (length(bin(n)) - 1) // 2 AS low FROM ({p})"
    for i in range(ROUNDS):
        p = f"SELECT * EXCLUDE (x), x, x >> low AS a FROM ({p})"
        p = f"SELECT *, (x + {_hash_sql('a', epoch, 2 * i)}) % (1::BIGINT << low) AS b FROM ({p})"
        p = (f"SELECT * EXCLUDE (a), (a + {_hash_sql('b', epoch, 2 * i + 1)}) "
             f"% (1::BIGINT << (bits - low)) AS a FROM ({p})")
        p = (f"SELECT * EXCLUDE (x, a, b), (CASE WHEN x < (1::BIGINT << bits) THEN (a << low) + b ELSE x END + n // 2 + {i}) % n AS x "
             f"FROM ({p})")
    return f"SELECT * EXCLUDE (x, n, bits, low), CAST(x AS BIGINT) AS {out} FROM ({p})"
