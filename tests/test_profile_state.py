"""Profiles kept as mergeable state: appended batches equal the whole table,
whatever is run again."""

import pytest
from pyspark.sql import functions as F
from tabprep.operators import profile, stats
from tabprep.plans import catalog_scale
from tabprep.sources import tables
from tabprep.streaming import profile_state as ps
from tabprep.streaming.score import read_table_stream

from conftest import SMALL

NUM, CAT = ["acctbal", "nation", "target"], ["segment", "rare"]


def _equal(spark, state, whole):
    got = {r["column"]: r for r in ps.read_profile(spark, state).collect()}
    mom = stats.moments(whole, NUM)
    for r in profile.missing_profile(whole, "total", NUM + CAT).collect():
        assert (got[r["column"]]["missing"], got[r["column"]]["rows"]) == (r["missing"], r["rows"])
    medians = stats.exact_medians(whole, NUM)
    for c in NUM:
        m, g = mom[c], got[c]
        assert (g["min"], g["max"]) == (m["min"], m["max"])
        assert g["mean"] == pytest.approx(m["mean"], rel=1e-12) and g["std"] == pytest.approx(m["std"], rel=1e-9)
        below = whole.where(F.col(c) <= g["median"]).count() / whole.where(F.col(c).isNotNull()).count()
        assert abs(below - 0.5) < 0.06 and m["min"] <= medians[c] <= m["max"]  # nation has 25 values
    assert {r["column"]: r["mode"] for r in ps.read_modes(spark, state).collect()} == stats.modes(whole, CAT)
    values = {c: sorted(r["value"] for r in ps.read_categories(spark, state).where(F.col("column") == c).collect()) for c in CAT}
    assert values == stats.categories(whole, CAT)


def test_appended_batches_equal_the_whole_table(spark, tmp_path):
    train, _ = tables.house_train_test(spark, SMALL)
    rows, state, checkpoint = (str(tmp_path / x) for x in ("rows", "state", "checkpoint"))

    def append(part):
        part.coalesce(1).write.mode("append").parquet(rows)
        source = read_table_stream(spark, rows, train.schema, max_files_per_trigger=1)
        ps.append_profile(spark, source, state, NUM, CAT, checkpoint).awaitTermination()

    append(train.where("id % 3 = 0"))
    append(train.where("id % 3 = 1"))
    _equal(spark, state, train.where("id % 3 < 2"))
    append(train.where("id % 3 = 2"))
    _equal(spark, state, train)
    # the stream's last batch once more, as after a failure
    ps.merge_batch(train.where("id % 3 = 2"), 2, state, NUM, CAT)
    _equal(spark, state, train)


def test_columns_without_values(spark, tmp_path):
    df = spark.createDataFrame([(None, float("nan")), (None, 2.0)], "s string, x double")
    empty = spark.createDataFrame([], "s string, x double")
    state = str(tmp_path / "state")
    for name, schema in (("profile", ps.PROFILE), ("values", ps.VALUES)):
        spark.createDataFrame([], schema).write.parquet(f"{state}/{name}/version=-1")
    for version, part in enumerate((empty, df, empty)):
        ps.merge_batch(part, version, state, ["x"], ["s"])
    got = {r["column"]: r.asDict() for r in ps.read_profile(spark, state).collect()}
    assert (got["x"]["missing"], got["x"]["rows"], got["x"]["mean"], got["x"]["std"], got["x"]["median"]) == (1, 2, 2.0, 0.0, 2.0)
    assert (got["s"]["missing"], got["s"]["mean"], got["s"]["median"]) == (2, None, None)
    assert ps.read_modes(spark, state).collect() == []


def test_appended_rows_are_not_written_by_one_task(spark, monkeypatch):
    """Each append used to be joined and written by one task."""
    orders = spark.range(0, 600, 1, 6).selectExpr("id as o_orderkey", "id % 20 as o_custkey", "'O' as o_orderstatus",
                                                  "cast(id as double) as o_totalprice", "'1-URGENT' as o_orderpriority")
    customer = spark.range(20).selectExpr("id as c_custkey", "cast(id % 5 as int) as c_nationkey",
                                          "cast(id as double) as c_acctbal", "'BUILDING' as c_mktsegment")
    monkeypatch.setattr(tables, "load", lambda spark, sf_dir, name: {"orders": orders, "customer": customer}[name])
    paths = []
    real = catalog_scale.read_table_stream
    monkeypatch.setattr(catalog_scale, "read_table_stream", lambda spark, path, *a, **k: paths.append(path) or real(spark, path, *a, **k))
    state = catalog_scale._appended(spark, "")
    assert len(spark.read.parquet(paths[0]).inputFiles()) > 3
    assert {r["rows"] for r in ps.read_profile(spark, state).collect()} == {480}
    versions = spark.read.parquet(f"{state}/profile").select("version").distinct().collect()
    assert sorted(r["version"] for r in versions) == [0, 1, 2]
