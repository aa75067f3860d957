"""Column statistics gathered in as few distributed aggregates as possible.

* ``moments``: count, mean, population std, min, max of many numeric columns
  in one aggregate (partial aggregation per task, one tiny final row).
* ``summary``: the missing count of every column and the moments of the
  numeric ones in the same single aggregate.
* ``modes`` / ``categories`` / ``category_counts``: a long ``(column, value)`` frame grouped by
  ``(column, value)``; partial aggregation collapses a hot value inside each
  task before the shuffle, so a value holding a third of all rows costs one
  row per task.
* ``exact_medians``: the exact pandas median (mean of the two middle values)
  without holding a column's values in one task.  Spark's ``median``
  aggregate keeps a value->count map per column and merges it in one final
  task, which does not survive a high-cardinality column at scale.  Here each
  round buckets the values still in play by equal-width ranges (one
  aggregate: count, min, max per bucket, at most ``buckets`` rows per column
  reach the driver), keeps the bucket holding each middle rank, and stops once
  a range holds at most ``threshold`` rows; those are ranked exactly with a
  window partitioned by probe, whose size is therefore bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.missing import is_missing, nan_to_null


def _moment_aggs(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    aggs = []
    for i, n in enumerate(cols):
        v = nan_to_null(df, n).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"),
                 F.stddev_pop(v).alias(f"s{i}"), F.min(v).alias(f"lo{i}"),
                 F.max(v).alias(f"hi{i}")]
    return aggs


def _moments_of(row, cols: Sequence[str]) -> dict[str, dict[str, float | None]]:
    return {n: {"count": row[f"n{i}"], "mean": row[f"a{i}"], "std": row[f"s{i}"],
                "min": row[f"lo{i}"], "max": row[f"hi{i}"]} for i, n in enumerate(cols)}


# Above this many columns the statistics are gathered in long form: one
# (column, flag, value) row per cell, grouped by column.  Same single pass,
# but the plan holds a handful of aggregates instead of five per column,
# which analysis and code generation handle far better (about 3x faster at
# 1,500 columns); below it the wide aggregate avoids the explode.
WIDE = 200


def _long_summary(df: DataFrame, cols: Sequence[str], numeric: Sequence[str]
                  ) -> tuple[int, dict[str, int], dict[str, dict[str, float | None]]]:
    names = list(dict.fromkeys(list(cols) + list(numeric)))
    num = set(numeric)
    entries = F.array(*[
        F.struct(F.lit(i).alias("c"), is_missing(df, n).alias("m"),
                 (nan_to_null(df, n).cast("double") if n in num
                  else F.lit(None).cast("double")).alias("v"))
        for i, n in enumerate(names)])
    rows = (df.select(F.inline(entries)).groupBy("c")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if("m").alias("missing"),
                 F.count("v").alias("n"), F.avg("v").alias("a"),
                 F.stddev_pop("v").alias("s"), F.min("v").alias("lo"),
                 F.max("v").alias("hi"))
            .collect())
    by = {r["c"]: r for r in rows}
    empty = {"count": 0, "mean": None, "std": None, "min": None, "max": None}
    n_rows = rows[0]["rows"] if rows else 0
    missing = {n: (by[i]["missing"] if i in by else 0)
               for i, n in enumerate(names) if n in set(cols)}
    mom = {}
    for i, n in enumerate(names):
        if n in num:
            r = by.get(i)
            mom[n] = dict(empty) if r is None else {
                "count": r["n"], "mean": r["a"], "std": r["s"], "min": r["lo"], "max": r["hi"]}
    return n_rows, missing, mom


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float | None]]:
    """{column: {count, mean, std, min, max}}; NaN and NULL are skipped;
    ``std`` is the population standard deviation (ddof 0)."""
    cols = list(cols)
    if not cols:
        return {}
    if len(cols) > WIDE:
        return _long_summary(df, [], cols)[2]
    return _moments_of(df.agg(*_moment_aggs(df, cols)).first(), cols)


def summary(df: DataFrame, cols: Sequence[str], numeric: Sequence[str]
            ) -> tuple[int, dict[str, int], dict[str, dict[str, float | None]]]:
    """One aggregate: (row count, missing count of every column in ``cols``,
    moments of the ``numeric`` ones), i.e. the missing profile and the
    moments in a single pass."""
    cols, numeric = list(cols), list(numeric)
    if len(cols) + len(numeric) > WIDE:
        return _long_summary(df, cols, numeric)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(is_missing(df, n)).alias(f"m{i}") for i, n in enumerate(cols)]
    row = df.agg(*aggs, *_moment_aggs(df, numeric)).first()
    return (row["__rows"], {n: row[f"m{i}"] for i, n in enumerate(cols)},
            _moments_of(row, numeric))


def moments_after_fill(m: dict[str, float | None], fill: float | None, rows: int
                       ) -> dict[str, float | None]:
    """Moments of a column after its missing cells take ``fill``, from its
    moments before: the filled column is the old values plus ``k`` copies
    of ``fill``, merged the way partial aggregates merge (mean by weights,
    squared deviations by the parallel-variance rule), so no pass over the
    data is needed."""
    c = m["count"] or 0
    k = rows - c
    if fill is None or k == 0:
        return dict(m)
    f = float(fill)
    if c == 0:
        return {"count": rows, "mean": f, "std": 0.0, "min": f, "max": f}
    lo, hi = min(m["min"], f), max(m["max"], f)
    if lo == hi:                       # constant after the fill: exact
        return {"count": rows, "mean": lo, "std": 0.0, "min": lo, "max": hi}
    mean = m["mean"]
    new_mean = (c * mean + k * f) / rows
    m2 = c * m["std"] ** 2 + c * (mean - new_mean) ** 2 + k * (f - new_mean) ** 2
    return {"count": rows, "mean": new_mean, "std": math.sqrt(m2 / rows),
            "min": lo, "max": hi}


def category_counts(df: DataFrame, cols: Sequence[str],
                    max_categories: int | None = None) -> dict[str, dict[str, int]]:
    """{column: {value: count}} of the non-missing values (as text), from one
    grouped count with map-side combine.  Collected, so bounded: a column
    with more than ``max_categories`` values raises."""
    cols = list(cols)
    if not cols:
        return {}
    counts = value_counts(df, cols).persist()
    try:
        if max_categories is not None:
            wide = counts.groupBy("c").count().where(F.col("count") > max_categories).collect()
            if wide:
                names = [cols[r["c"]] for r in wide]
                raise ValueError(f"more than {max_categories} categories in {names}; "
                                 "raise max_categories (sparse output keeps the width cheap)")
        out: dict[str, dict[str, int]] = {n: {} for n in cols}
        for r in counts.collect():
            out[cols[r["c"]]][r["v"]] = r["n"]
    finally:
        counts.unpersist()
    return out


def mode_of(counts: dict[str, int]) -> str | None:
    """Most frequent value, ties to the smallest (same rule as ``modes``)."""
    if not counts:
        return None
    return min(counts.items(), key=lambda kv: (-kv[1], kv[0]))[0]


def _long_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, v): one row per non-missing cell, value as string."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("c"), as_category_string(df, n).alias("v"))
        for i, n in enumerate(cols)])
    return df.select(F.inline(entries)).where(F.col("v").isNotNull())


def as_category_string(df: DataFrame, name: str) -> Column:
    """A categorical column as text; booleans print like pandas (True/False)."""
    dt = df.schema[name].dataType
    c = nan_to_null(df, name)
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(c, v, n): count of each value of each column (column by position)."""
    return _long_strings(df, cols).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-missing value per column, ties to the smallest value
    (pandas ``mode()[0]``); all-missing columns give None.  Values as text."""
    cols = list(cols)
    if not cols:
        return {}
    best = (value_counts(df, cols)
            .groupBy("c")
            .agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").alias("v")))
                 .alias("b"))
            .select("c", F.col("b.v").alias("v"))
            .collect())
    found = {r["c"]: r["v"] for r in best}
    return {n: found.get(i) for i, n in enumerate(cols)}


def categories(df: DataFrame, cols: Sequence[str],
               max_categories: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct non-missing values per column.  The lists are the
    output schema of one-hot encoding, so they must reach the driver; with
    ``max_categories`` a larger column raises instead of building that many
    columns (nothing is dropped silently)."""
    cols = list(cols)
    if not cols:
        return {}
    # the distinct (column, value) table is small next to the data and is
    # read twice (the size check, the listing): keep it for both
    d = _long_strings(df, cols).distinct().persist()
    try:
        if max_categories is not None:
            wide = (d.groupBy("c").count().where(F.col("count") > max_categories)
                    .collect())
            if wide:
                names = [cols[r["c"]] for r in wide]
                raise ValueError(f"more than {max_categories} categories in {names}; "
                                 "raise max_categories (sparse output keeps the width cheap)")
        out: dict[str, list[str]] = {n: [] for n in cols}
        # bounded by the check above; one job (an iterator would run one
        # job per partition)
        for r in d.collect():
            out[cols[r["c"]]].append(r["v"])
    finally:
        d.unpersist()
    return {n: sorted(v) for n, v in out.items()}


# ------------------------------------------------------------ exact medians

def _long_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(i).alias("c"), nan_to_null(df, n).cast("double").alias("v"))
        for i, n in enumerate(cols)])
    return df.select(F.inline(entries)).where(F.col("v").isNotNull())


def exact_medians(df: DataFrame, cols: Sequence[str],
                  mom: dict[str, dict] | None = None,
                  threshold: int = 65_536, buckets: int = 1024) -> dict[str, float | None]:
    """Exact median of each column (NaN/NULL skipped), pandas convention.

    Each round narrows the open range that holds a wanted rank: a quantile
    sketch (bounded memory per task) names two values around the rank, and a
    count says exactly how many values lie below, at, between and above them.
    A rank at one of the two is found (a value of any frequency ends the
    search there); otherwise about three in ``buckets`` of the range's rows
    are left.  Quantiles follow the data, so infinities or values spread over
    hundreds of decades take no more rounds than others.  Ranges of at most
    ``threshold`` rows are ranked by a window."""
    cols = list(cols)
    if not cols:
        return {}
    mom = mom or moments(df, cols)
    long = _long_doubles(df, cols)
    result: dict[int, dict[int, float]] = {i: {} for i in range(len(cols))}
    # probe: the values of column c strictly between lo and hi (None: open
    # end); `below` values of c lie under them; `ranks` are 0-based global
    # ranks wanted, all of them inside
    probes = [{"c": i, "lo": None, "hi": None, "below": 0, "n": mom[n]["count"],
               "ranks": sorted({(mom[n]["count"] - 1) // 2, mom[n]["count"] // 2})}
              for i, n in enumerate(cols) if mom[n]["count"]]
    while probes:
        small = [p for p in probes if p["n"] <= threshold]
        if small:
            _rank_small(long, small, result)
        large = [p for p in probes if p["n"] > threshold]
        probes = _refine(long, large, buckets, result) if large else []

    out = {}
    for i, n in enumerate(cols):
        cnt = mom[n]["count"] or 0
        if cnt == 0:
            out[n] = None
            continue
        a, b = result[i][(cnt - 1) // 2], result[i][cnt // 2]
        out[n] = a if a == b else a + (b - a) * 0.5
    return out


def _probe_id(probes: list[dict]) -> Column:
    """Probe of a cell ``(c, v)``: a column has at most two probes (its two
    middle ranks), so the lookup is two array reads by column index, not a
    branch per probe."""
    width = max(p["c"] for p in probes) + 1
    slots: list[list] = [[None] * width for _ in range(6)]   # lo, hi, id for a and b
    for j, p in enumerate(probes):
        k = 0 if slots[2][p["c"]] is None else 3
        slots[k][p["c"]], slots[k + 1][p["c"]], slots[k + 2][p["c"]] = p["lo"], p["hi"], j
    c, v = F.col("c") + 1, F.col("v")

    def at(vals, typ):
        # columns past the last probed one get NULL: no probe
        return F.try_element_at(F.array(*[F.lit(x).cast(typ) for x in vals]), c)

    def inside(lo, hi):
        return (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))

    lo_a, hi_a, id_a = at(slots[0], "double"), at(slots[1], "double"), at(slots[2], "int")
    lo_b, hi_b, id_b = at(slots[3], "double"), at(slots[4], "double"), at(slots[5], "int")
    return (F.when(id_a.isNotNull() & inside(lo_a, hi_a), id_a)
             .when(id_b.isNotNull() & inside(lo_b, hi_b), id_b))


def _refine(long: DataFrame, probes: list[dict], buckets: int,
            result: dict[int, dict[int, float]]) -> list[dict]:
    """One round: two values around the ranks of each probe, then the counts."""
    cells = long.select("v", _probe_id(probes).alias("p")).where(F.col("p").isNotNull())
    # the two grid points around the ranks of each probe
    ends = []
    for p in probes:
        at = [(r - p["below"]) / p["n"] * buckets for r in p["ranks"]]
        ends.append((max(0, int(min(at)) - 1), min(buckets, int(max(at)) + 2)))
    grid = sorted({x for pair in ends for x in pair})
    # one row per probe: at most two per column
    found = {r["p"]: dict(zip(grid, r["q"])) for r in cells.groupBy("p").agg(
        F.percentile_approx("v", [x / buckets for x in grid], 10_000).alias("q")).collect()}
    lo, hi = ([found[j][pair[side]] for j, pair in enumerate(ends)] for side in (0, 1))
    a = F.element_at(F.array(*[F.lit(x) for x in lo]), F.col("p") + 1)
    b = F.element_at(F.array(*[F.lit(x) for x in hi]), F.col("p") + 1)
    v = F.col("v")
    counts = {r["p"]: r for r in cells.groupBy("p").agg(
        F.count_if(v < a).alias("under"), F.count_if(v == a).alias("low"),
        F.count_if((v > a) & (v < b)).alias("between"),
        F.count_if((v == b) & (a < b)).alias("high"), F.count_if(v > b).alias("over")).collect()}
    nxt = []
    for j, p in enumerate(probes):
        r, start = counts[j], p["below"]
        for name, x, y in (("under", p["lo"], lo[j]), ("low", lo[j], None), ("between", lo[j], hi[j]),
                           ("high", hi[j], None), ("over", hi[j], p["hi"])):
            ranks = [k for k in p["ranks"] if start <= k < start + r[name]]
            if ranks and name in ("low", "high"):
                result[p["c"]].update(dict.fromkeys(ranks, x))
            elif ranks:
                nxt.append({"c": p["c"], "lo": x, "hi": y, "below": start, "n": r[name], "ranks": ranks})
            start += r[name]
    return nxt


def _rank_small(long: DataFrame, probes: list[dict],
                result: dict[int, dict[int, float]]) -> None:
    """Exact ranks inside ranges of bounded size: distinct values with counts,
    running count over a window partitioned by probe."""
    spark = long.sparkSession
    wanted = spark.createDataFrame(
        [(j, r) for j, p in enumerate(probes) for r in p["ranks"]],
        "p int, r bigint")
    below = F.element_at(F.array(*[F.lit(p["below"]) for p in probes]), F.col("p") + 1)
    w = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (long.select("c", "v", _probe_id(probes).alias("p"))
              .where(F.col("p").isNotNull())
              .groupBy("p", "v").agg(F.count(F.lit(1)).alias("n"))
              .select("p", "v", "n", (F.sum("n").over(w) + below).alias("upto")))
    # `wanted` holds one row per requested rank (at most two per column)
    hits = (ranked.join(F.broadcast(wanted), "p")
            .where((F.col("upto") - F.col("n") <= F.col("r")) & (F.col("r") < F.col("upto")))
            .select("p", "r", "v").collect())
    for h in hits:
        result[probes[h["p"]]["c"]][h["r"]] = h["v"]
