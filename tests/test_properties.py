"""Property tests against pandas/numpy on small random tables."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabprep.operators import align, profile, stats

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.just(float("nan")),
                            st.sampled_from([0.0, 1.5, -2.0, 7.25]),
                            st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=0, max_size=60)


@SETTINGS
@given(vals=values, hot=st.integers(0, 40))
def test_median_matches_pandas(spark, vals, hot):
    vals = vals + [3.0] * hot                      # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = stats.exact_medians(df, ["v"], threshold=4, buckets=4)["v"]
    want = pd.Series(vals, dtype="float64").median()
    if math.isnan(want):
        assert got is None
    else:
        assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "B", "", "x y"])),
                     max_size=40))
def test_mode_matches_pandas(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = stats.modes(df, ["v"])["v"]
    s = pd.Series(vals, dtype="object").dropna()
    want = None if s.empty else sorted(s.mode().tolist())[0]
    assert got == want


@SETTINGS
@given(vals=values)
def test_profile_ratio_times_rows_is_count(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = profile.missing_profile(df, mode="total").collect()[0]
    want = sum(1 for v in vals if v is None or (isinstance(v, float) and math.isnan(v)))
    assert r["missing"] == want and r["rows"] == len(vals)
    if vals:
        assert r["ratio"] * r["rows"] == pytest.approx(want)


@SETTINGS
@given(n=st.integers(0, 300), parts=st.integers(1, 9), ranges=st.integers(1, 6))
def test_consecutive_index_is_row_number(spark, n, parts, ranges):
    from pyspark.sql import functions as F
    df = spark.range(n).repartition(parts).select((F.col("id") * 7 % 1009).alias("k"),
                                                  F.col("id").alias("u"))
    out = align.consecutive_index(df, ["k", "u"], rows_per_range=max(1, n // ranges)).collect()
    ordered = sorted((r["k"], r["u"]) for r in out)
    pos = {kv: i for i, kv in enumerate(ordered)}
    assert sorted(r["row"] for r in out) == list(range(n))
    assert all(pos[(r["k"], r["u"])] == r["row"] for r in out)


def test_median_many_columns_one_pass(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({f"c{i}": rng.normal(size=500).round(2) for i in range(5)})
    df = spark.createDataFrame(pdf)
    got = stats.exact_medians(df, list(pdf.columns), threshold=16, buckets=8)
    for c in pdf.columns:
        assert got[c] == pytest.approx(float(pdf[c].median()))


cells = st.one_of(st.sampled_from(["", "NA", "N/A", "NaN", "null", "None", "nan"]),
                  st.integers(-10**6, 10**6).map(str),
                  st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False).map(repr),
                  st.sampled_from(["Pave", "Grvl", "1.5Fin", "Wd Sdng", "x"]))


@SETTINGS
@given(grid=st.lists(st.tuples(cells, cells, cells), min_size=1, max_size=25))
def test_csv_reader_matches_pandas(spark, grid):
    import io as _io
    import os
    from tabprep.session import scratch_path
    from tabprep.sources import io
    text = "a,b,c\n" + "\n".join(",".join(r) for r in grid) + "\n"
    path = scratch_path(spark, "csv-prop")
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local)
    with open(os.path.join(local, "part-0.csv"), "w") as f:
        f.write(text)
    ours = io.read_csv(spark, path)
    theirs = pd.read_csv(_io.StringIO(text))
    kinds = dict(ours.dtypes)
    rows = ours.collect()
    for j, c in enumerate(["a", "b", "c"]):
        numeric_pd = pd.api.types.is_numeric_dtype(theirs[c])
        assert (kinds[c] in ("bigint", "double")) == numeric_pd, (c, kinds[c], theirs[c].dtype)
        for i, r in enumerate(rows):
            mine, ref = r[c], theirs[c].iloc[i]
            if pd.isna(ref):
                assert mine is None
            elif numeric_pd:
                assert float(mine) == pytest.approx(float(ref))
            else:
                assert mine == ref


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4, allow_nan=False)),
                     min_size=1, max_size=40),
       fill=st.floats(-1e4, 1e4, allow_nan=False))
def test_moments_after_fill_match_a_pass(spark, vals, fill):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    before = stats.moments(df, ["v"])["v"]
    derived = stats.moments_after_fill(before, fill, len(vals))
    after = stats.moments(df.select(F.coalesce("v", F.lit(fill)).alias("v")), ["v"])["v"]
    assert derived["count"] == after["count"]
    for k in ("mean", "min", "max"):
        assert derived[k] == pytest.approx(after[k], rel=1e-9, abs=1e-9)
    assert derived["std"] == pytest.approx(after["std"], rel=1e-7, abs=1e-7)
    assert (derived["std"] == 0.0) == (after["std"] == 0.0)


def test_median_columns_without_probes_interleaved(spark):
    rng = np.random.default_rng(3)
    n = 301
    pdf = pd.DataFrame({"k0": np.full(n, 2.0), "v1": rng.normal(size=n).round(3),
                        "k2": np.full(n, -1.0), "v3": rng.integers(0, 7, size=n).astype(float),
                        "v4": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n))})
    df = spark.createDataFrame(pdf)
    got = stats.exact_medians(df, list(pdf.columns), threshold=8, buckets=4)
    for c in pdf.columns:
        assert got[c] == pytest.approx(float(pdf[c].median())), c


def test_long_form_statistics_equal_wide(spark, monkeypatch):
    from pyspark.sql import functions as F
    df = spark.range(500).select(
        "id", *[F.when(F.col("id") % (i + 2) == 0, None).otherwise(F.col("id") * 1.0 / (i + 1))
                .alias(f"c{i}") for i in range(6)],
        F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("x")).alias("s"))
    cols = [f"c{i}" for i in range(6)]
    wide_m = stats.moments(df, cols)
    wide_s = stats.summary(df, cols + ["s"], cols)
    monkeypatch.setattr(stats, "WIDE", 2)
    long_m = stats.moments(df, cols)
    long_s = stats.summary(df, cols + ["s"], cols)
    assert long_s[0] == wide_s[0] and long_s[1] == wide_s[1]
    for c in cols:
        for k in ("count", "mean", "std", "min", "max"):
            assert long_m[c][k] == pytest.approx(wide_m[c][k], rel=1e-12)
            assert long_s[2][c][k] == pytest.approx(wide_s[2][c][k], rel=1e-12)
    empty = df.where(F.lit(False))
    assert stats.summary(empty, cols + ["s"], cols)[0] == 0
    assert stats.moments(empty, cols)["c0"]["count"] == 0
