"""Physical plan shapes: fitted transforms stay narrow and keep pushdown;
profiles are one partial + final aggregate."""

from pyspark.sql import functions as F

from tabprep.operators import encode, impute, profile, split
from tabprep.sources import tables

from conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_transform_is_narrow_and_keeps_pushdown(spark):
    c = tables.load(spark, SMALL, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "c_name")
    imp = impute.Imputer(exclude=("c_custkey", "c_name")).fit(c)
    enc = encode.TableEncoder("standardize", target="c_name", key="c_custkey").fit(
        imp.transform(c))
    out = enc.transform(imp.transform(c)).where(F.col("c_custkey") > 10) \
             .select("c_custkey", "num__c_acctbal")
    plan = _plan(out)
    assert "Exchange" not in plan                       # no shuffle
    assert "GreaterThan(c_custkey,10)" in plan          # filter reaches the scan
    # only the columns the projection needs are read
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "c_acctbal" in scan and "c_mktsegment" not in scan and "c_name" not in scan


def test_profile_is_one_aggregate(spark):
    o = tables.load(spark, SMALL, "orders")
    plan = _plan(profile.missing_profile(o, mode="total"))
    assert plan.count("Exchange") == 1                  # one exchange to a single row
    assert "partial_count" in plan


def test_folds_and_holdout_add_no_shuffle(spark):
    o = tables.load(spark, SMALL, "orders")
    tr, _ = split.holdout(split.with_folds(o, "o_orderkey", 5), "o_orderkey", 80)
    assert "Exchange" not in _plan(tr)
