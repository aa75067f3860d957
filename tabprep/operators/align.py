"""Stacking, splitting back, consecutive row numbers, side-by-side columns.

``consecutive_index`` (P6) numbers rows 0..n-1 in a total order without a
single-partition window and without copying the table: only the order columns
and a 128-bit locator of the row are range-partitioned, sorted and written to
the shared checkpoint folder, each with its range and its place in it.  Range
offsets are a small table of running sums that is joined, so the plan is the
same for ten ranges and for ten thousand.  The numbers then go to the rows by
a join on the locator; rows equal in every column share one and take its
numbers in turn.

``glue_columns`` (U2) joins keys that hold many rows on both sides apart from
the others, in a grid of salted cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.missing import qcol
from tabprep.session import scratch_path


def stack_tagged(first: DataFrame, second: DataFrame, origin: str = "origin",
                 tags: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Rows of both tables, columns matched by name (absent -> NULL),
    with a tag column telling where each row came from."""
    a = first.withColumn(origin, F.lit(tags[0]))
    b = second.withColumn(origin, F.lit(tags[1]))
    return a.unionByName(b, allowMissingColumns=True)


def take_part(df: DataFrame, tag: str, origin: str = "origin") -> DataFrame:
    """P5: the rows of one original table back out of a stack."""
    return df.where(F.col(origin) == tag).drop(origin)


#: A key is hot when it holds more than this share of a side's rows.
HOT_SHARE = 1 / 64

#: A salt stands for at most this many hot rows; a task makes about this many
#: joined rows from this many right rows: the tasks grow with the result.
ROWS_PER_SALT, PAIRS_PER_TASK, ROWS_PER_TASK = 2048, 1 << 24, 1 << 18


def _located(df: DataFrame) -> list[Column]:
    """128 bits that name a row's content (entries of maps in key order)."""
    cols = [F.array_sort(F.map_entries(qcol(f.name))) if isinstance(f.dataType, T.MapType) else qcol(f.name)
            for f in df.schema.fields]
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x5bd1e995), *reversed(cols), F.lit(len(cols)))]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """``{key: rows}`` of the keys that hold more than ``share`` of the rows:
    a frequent-items sketch names at most ``2 / share`` candidates in one
    pass, which are then counted (so nothing named by mistake stays)."""
    found = df.select(qcol(key).alias("k")).freqItems(["k"], share / 2).first()["k_freqItems"]
    found = [k for k in found if k is not None]
    if not found:
        return {}
    named = qcol(key).isin(found)
    counts = df.groupBy(F.when(named, qcol(key)).alias("k")).count().collect()  # candidates and one row for the rest
    total = sum(r["count"] for r in counts)
    return {r["k"]: r["count"] for r in counts if r["k"] is not None and r["count"] > share * total}


def glue_columns(left: DataFrame, right: DataFrame, key: str, share: float = HOT_SHARE,
                 rows_per_cell: int | None = None) -> DataFrame:
    """Put the columns of two keyed tables side by side.  Rows stay
    whole; keys present on one side only (and NULL keys) get NULLs on the
    other.

    A key that is hot on either side and present on both is joined apart: its
    left rows are dealt to ``a`` and its right rows to ``b`` salts, and each of
    the ``a * b`` cells is one join key.  ``a`` and ``b`` follow from the
    counts: about ``rows_per_cell`` rows (default: ``share`` / 4 of the larger
    table, at most ``ROWS_PER_SALT``) a salt.  The cells go to a number of
    tasks that follows from the joined rows, about ``PAIRS_PER_TASK`` each: by
    the size of what they read, which is small, adaptive execution would put
    them all into one.  Both sides' hot rows are written with their salt first,
    so a lost executor can't deal them anew.  Hot keys of one side only need no
    join.  Columns come as in a full outer join."""
    hot = {k: None for k in (*hot_keys(left, key, share), *hot_keys(right, key, share))}
    plain = left.join(right, key, "full_outer")
    if not hot:
        return plain
    spark, k = left.sparkSession, qcol(key)
    named = k.isin(*hot)  # at most 2 / share keys
    counted = [{r[key]: r["count"] for r in side.where(named).groupBy(key).count().collect()} for side in (left, right)]
    both = [x for x in hot if x in counted[0] and x in counted[1]]
    if not both:
        return plain
    per = rows_per_cell or min(ROWS_PER_SALT, max(1, int(share / 4 * max(left.count(), right.count()))))
    cells = [(x, -(-counted[0][x] // per), -(-counted[1][x] // per)) for x in both]
    pairs, copied = sum(counted[0][x] * counted[1][x] for x in both), sum(counted[1][x] * a for x, a, _ in cells)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs // PAIRS_PER_TASK, copied // ROWS_PER_TASK)
    grid = F.broadcast(spark.createDataFrame(cells, T.StructType([
        T.StructField("__k", left.schema[key].dataType), T.StructField("__a", T.LongType()), T.StructField("__b", T.LongType())])))

    def dealt(side: DataFrame, mine: str, other: str, salt: str, copies: str) -> DataFrame:
        rows = side.where(k.isin(*both)).withColumn("__n", F.monotonically_increasing_id()).join(grid, k == F.col("__k"))
        rows = rows.withColumn(salt, F.pmod(F.xxhash64("__n", F.spark_partition_id()), F.col(mine)))
        rows = _written(rows.drop("__k", "__n", mine), f"hot-{salt.strip('_')}")
        return rows.withColumn(copies, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop(other)

    cell = [k, F.col("__i"), F.col("__j")]
    hot_left = dealt(left, "__a", "__b", "__i", "__j").repartition(tasks, *cell)
    hot_right = dealt(right, "__b", "__a", "__j", "__i").repartition(tasks, *cell)
    # a task's right rows are bounded, so they are hashed; nothing is sorted
    joined = hot_left.join(hot_right.hint("shuffle_hash"), [key, "__i", "__j"]).drop("__i", "__j")
    cold = F.coalesce(~k.isin(*both), F.lit(True))
    return left.where(cold).join(right.where(cold), key, "full_outer").unionByName(joined.select(*plain.columns))


def consecutive_index(df: DataFrame, order: Sequence[Column | str],
                      out: str = "row", rows_per_range: int = 1_000_000) -> DataFrame:
    """``out`` = 0..n-1 following ``order``; rows that tie there follow a
    hash of the whole row, so that a tie of any size spreads over the ranges
    (only rows equal in every column still tie, and there it does not matter).
    Exact on any partitioning.  One count sets the number of ranges: about
    ``rows_per_range`` rows each, whatever the table's size."""
    cols = [qcol(c) if isinstance(c, str) else c for c in order]
    names = [f"o{i}" for i in range(len(cols))]
    n = max(1, -(-df.count() // rows_per_range))
    pid = F.spark_partition_id()
    if set(df.columns) <= {c for c in order if isinstance(c, str)}:  # the table is its own key
        keys, sort, kept = df, cols, [qcol(c) for c in df.columns]
    else:
        keys = df.select(*[c.alias(n) for c, n in zip(cols, names)], *[h.alias(n) for h, n in zip(_located(df), ("h1", "h2"))])
        sort, kept = [*names, "h1", "h2"], [F.col("h1"), F.col("h2")]
    ordered = keys.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    # place and range are written with the keys: reading them again in other
    # partitions, or after a lost executor, changes nothing
    range_, place, start = (("__" if keys is df else "") + x for x in ("range", "place", "start"))
    placed = _written(ordered.select(*kept, pid.alias(range_), (
        F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias(place)), "row-order")
    before = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _written(placed.groupBy(range_).count()  # one row per range
                       .select(range_, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start)), "range-offsets")
    if keys is df:
        return placed.join(offsets, range_).select(*kept, (F.col(start) + F.col(place)).alias(out))
    numbers = (placed.join(offsets, range_).groupBy("h1", "h2")
               .agg(F.min(F.col("start") + F.col("place")).alias("first"), F.count(F.lit(1)).alias("copies")))
    located = df.select(F.struct(*[qcol(c) for c in df.columns]).alias("r"), *[
        h.alias(n) for h, n in zip(_located(df), ("h1", "h2"))])
    single = located.join(numbers.where("copies = 1"), ["h1", "h2"]).select("r.*", F.col("first").alias(out))
    if numbers.where("copies > 1").isEmpty():
        return single
    # equal rows: one of them, combined before the shuffle, takes all the numbers
    again = (located.join(numbers.where("copies > 1"), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.first("r").alias("r")).join(numbers, ["h1", "h2"])
             .select("r.*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias(out)))
    return single.unionByName(again)
