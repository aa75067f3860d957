"""Forms made for large tables: numbering without copies, permuted epochs, the
ordered scan, dictionaries, fold statistics, staged scoring, hot keys."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tabprep.operators import align, comoments, dictionary, encode, permute, split
from tabprep.plans import folds, models, scan_sgd
from tabprep.sources import tables

from conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _size(df) -> int:
    return df._jdf.queryExecution().analyzed().toString().count("\n")


# ------------------------------------------------------------------ P6

def test_numbering_writes_key_columns_only(spark, monkeypatch):
    names = []
    real = align._written
    monkeypatch.setattr(align, "_written", lambda df, name: names.append((name, df.columns)) or real(df, name))
    wide = spark.range(1000).selectExpr("id % 97 as k", "id as v", *[f"id * {i} as c{i}" for i in range(30)])
    out = align.consecutive_index(wide, ["k", "v"], rows_per_range=100)
    assert out.columns == [*wide.columns, "row"]
    got = [r["row"] for r in out.orderBy("k", "v").collect()]
    assert got == list(range(1000))
    assert dict(names) == {"row-order": ["h1", "h2", "range", "place"], "range-offsets": ["range", "start"]}


def test_numbering_plan_does_not_grow_with_ranges(spark):
    df = spark.range(2_000).selectExpr("id as k")
    few, many = (align.consecutive_index(df, ["k"], rows_per_range=n) for n in (200, 8))
    assert _size(few) == _size(many)
    assert [r["row"] for r in many.orderBy("k").collect()] == list(range(2_000))


def test_a_table_of_its_order_columns_is_numbered_at_once(spark):
    df = spark.range(500).selectExpr("id % 50 as start", "id % 7 as range")
    out = align.consecutive_index(df.repartition(3), ["range", "start"], rows_per_range=60)
    rows = sorted(tuple(r) for r in out.select("row", "range", "start").collect())
    assert [r[0] for r in rows] == list(range(500)) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    assert "h1" not in _plan(out)


def test_equal_rows_take_all_their_numbers(spark):
    df = spark.range(900).selectExpr("if(id < 300, 1, id) as k", "map('a', if(id < 300, 1, id)) as m", "if(id < 300, null, 'x') as s")
    out = align.consecutive_index(df.repartition(5), ["k"], rows_per_range=100)
    rows = out.collect()
    assert sorted(r["row"] for r in rows) == list(range(900))
    assert sorted(r["row"] for r in rows if r["k"] == 1) == list(range(300))
    assert [r["row"] for r in out.where("k > 1").orderBy("k").collect()] == list(range(300, 900))
    assert align.consecutive_index(df.limit(0), ["k"]).collect() == []


# -------------------------------------------------------------- D3, D4

@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 64, 1000])
def test_epoch_positions_are_a_permutation(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row")
    for epoch in (0, 7):
        got = [r["pos"] for r in permute.shuffled(df, "row", n, epoch).orderBy("row").collect()]
        assert sorted(got) == list(range(n))


def test_epochs_mix_and_differ(spark):
    n = 10_000
    d = spark.range(n).withColumnRenamed("id", "row")
    a = permute.shuffled(permute.shuffled(d, "row", n, 1, "a"), "row", n, 2, "b").orderBy("row").toPandas()
    for x, y in (("row", "a"), ("row", "b"), ("a", "b")):
        assert abs(np.corrcoef(a[x], a[y])[0, 1]) < 0.05
    # neighbours end up far apart, and a batch draws from the whole table
    assert np.median(np.abs(np.diff(a["a"]))) > n / 10
    spread = a.groupby(a["a"] // 100)["row"].agg(["min", "max"])
    assert ((spread["max"] - spread["min"]) > n / 2).mean() > 0.95


def test_epoch_batches_are_a_projection(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr("o_orderkey as row")
    out = permute.epoch_batches(df, "row", 1500, 64, 3)
    assert "Exchange" not in _plan(out) and "Window" not in _plan(out)
    sizes = {r["batch"]: r["count"] for r in out.where("pos is not null").groupBy("batch").count().collect()}
    assert set(sizes.values()) <= {64, 1500 % 64} and sum(sizes.values()) == 1500
    assert permute.shuffled(spark.range(3).selectExpr("cast(null as long) row"), "row", 3, 0).where("pos is null").count() == 3


# ------------------------------------------------------------------ M2

def _sequential(rows, pos, lr, batch, d):
    w = np.zeros(d + 1)
    order = sorted(rows, key=lambda r: pos[r[0]])
    for a in range(0, len(order), batch):
        x = np.array([[*r[1:-1], 1.0] for r in order[a:a + batch]])
        y = np.array([r[-1] for r in order[a:a + batch]])
        w = w - lr / batch * (x.T @ (x @ w - y))
    return w


def test_scan_equals_sequential_descent(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(0, 1), rng.gauss(1, 2), rng.gauss(0, 1)) for i in range(203)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    run = scan_sgd.linear_sgd_scan(df, ["a", "b"], "y", "id", lr=0.05, epochs=1, batch_size=10)
    pos = {r["row"]: r["pos"] for r in permute.shuffled(spark.range(203).withColumnRenamed("id", "row"), "row", 203, 1).collect()}
    want = _sequential(rows, pos, 0.05, 10, 2)
    assert np.allclose([*run.weights[0], run.bias[0]], want, atol=1e-10)
    p = np.array([[a, b, 1] for _, a, b, _ in rows]) @ want
    assert np.isclose(run.train_rmse[0], np.sqrt(np.mean((p - [r[-1] for r in rows]) ** 2)))


def test_scan_does_not_depend_on_partitions(spark, monkeypatch):
    s4 = tables.synthetic_regression(tables.load(spark, SMALL, "orders"), "o_orderkey", [2.0, -3.4], 4.2)
    s4 = s4.union(s4.limit(5).selectExpr("id + 9000000", "cast(null as double)", "x1", "y"))  # left out
    fit, val = split.holdout(s4, "id", 80)
    runs = []
    for parts, cells in ((1, 1 << 20), (64, 1 << 20), (7, 64)):  # the last one composes in many small groups
        monkeypatch.setattr(scan_sgd, "GROUP_CELLS", cells)
        runs.append(scan_sgd.linear_sgd_scan(fit.repartition(parts), ["x0", "x1"], "y", "id", valid=val, step=2, gamma=0.5))
    for r in runs[1:]:
        assert np.allclose(r.weights, runs[0].weights, atol=1e-9) and np.allclose(r.valid_rmse, runs[0].valid_rmse, atol=1e-9)
    assert np.allclose(runs[0].weights[-1], [2.0, -3.4], atol=0.01) and runs[0].valid_rmse[-1] < 0.02
    assert scan_sgd.linear_sgd_scan(fit.limit(0), ["x0"], "y", "id").weights == []


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5))
def test_maps_compose_in_order(n, size):
    maps = np.random.default_rng(n).normal(size=(n, size, size))
    want = np.eye(size)
    for m in maps:
        want = m @ want
    assert np.allclose(scan_sgd.composed(maps), want)


# ------------------------------------------------------- M13, M14 by moments

@pytest.mark.parametrize("pairwise", [24, 1])
def test_co_moments(spark, monkeypatch, pairwise):
    monkeypatch.setattr(comoments, "PAIRWISE", pairwise)
    rng = np.random.default_rng(2)
    x = rng.normal(1e8, 1, size=(500, 3))
    rows = [(int(i % 3), *map(float, r)) for i, r in enumerate(x)] + [(0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double").repartition(5)
    got = comoments.co_moments(df, [F.col(c) for c in "abc"], by="g")
    for g in range(3):
        part = x[np.arange(500) % 3 == g]
        assert got[g].n == len(part) and np.allclose(got[g].mean, part.mean(0), rtol=1e-12)
        assert np.allclose(got[g].c, np.cov(part.T, bias=True) * len(part), rtol=1e-6, atol=1e-4)
    whole = got[0].merge(got[1]).merge(got[2])
    assert np.allclose(whole.c, np.cov(x.T, bias=True) * 500, rtol=1e-6, atol=1e-4)


def test_linear_grid_equals_the_general_search(spark):
    part = tables.load(spark, SMALL, "part").select("p_partkey", "p_size", "p_retailprice")
    data = split.with_folds(part, "p_partkey", 5)
    grid = [0.0, 0.5, 20.0]
    w, b, fast = folds.linear_grid(data, ["p_partkey", "p_size"], "p_retailprice", grid)
    vectors = models.vectorize(data, ["p_partkey", "p_size"], keep=("p_retailprice", "fold"))
    model, slow = models.grid_search(spark, models.linear_regression(label="p_retailprice"), vectors,
                                     {"regParam": grid}, "p_retailprice", 5)
    a, c = (t.orderBy("candidate").toPandas() for t in (fast, slow))
    assert list(a.columns) == list(c.columns)
    assert np.allclose(a.to_numpy(float), c.to_numpy(float), rtol=1e-6, atol=1e-6)  # the price is linear: errors are near 0
    assert np.allclose([*w, b], [*model.coefficients, model.intercept], rtol=1e-6)


def test_linear_grid_reads_once(spark):
    part = split.with_folds(tables.load(spark, SMALL, "part"), "p_partkey", 5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("linear-grid", "one pass")
    try:
        folds.linear_grid(part, ["p_partkey", "p_size"], "p_retailprice", [0.0, 0.1, 1.0, 10.0])
        jobs = tracker.getJobIdsForGroup("linear-grid")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # adaptive execution runs the one exchange as a job of its own


def test_staged_scores_equal_separate_fits(spark):
    part = tables.load(spark, SMALL, "part").select("p_partkey", "p_size", "p_retailprice")
    data = split.with_folds(models.vectorize(part, ["p_partkey", "p_size"], keep=("p_partkey", "p_retailprice")), "p_partkey", 3)
    est = models.boosted_trees(label="p_retailprice", max_depth=3, seed=5)
    grid = {"maxIter": [1, 3, 4], "stepSize": [0.1, 0.3]}
    for metric in ("rmse", "mae"):
        best, staged = folds.staged_grid(spark, est, data, grid, "p_retailprice", 3, metric=metric)
        again, apart = models.grid_search(spark, est, data, grid, "p_retailprice", 3, metric=metric)
        a, b = (t.orderBy("candidate").toPandas() for t in (staged, apart))
        assert list(a.columns) == list(b.columns) and np.allclose(a.to_numpy(float), b.to_numpy(float), rtol=1e-9)
        assert best.getNumTrees == again.getNumTrees


# ---------------------------------------------------- A9, F10 dictionaries

def _cats(spark, n=600):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "", None, "c d", "é"]) if i % 3 else "hot", rng.choice([1.5, None, 2.0]), f"v{i % 50}", float(i))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, s string, x double, t string, target double")


def test_vectors_equal_the_wide_encoding(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "HOT_SHARE", 1 / 8)
    df = _cats(spark)
    train, test = df.where("id < 400"), df.where("id >= 400").withColumn("t", F.concat("t", F.when(F.col("id") % 2 == 0, "new").otherwise("")))
    test = test.drop("target")
    for method in ("standardize", "normalize", "none"):
        for raw in (True, False):
            kw = dict(numeric_method=method, target="target", key="id", keep_target_separate=raw)
            wide, narrow = encode.TableEncoder(**kw).fit(train), dictionary.VectorEncoder(**kw).fit(train)
            assert [r["name"] for r in narrow.names(spark).orderBy("slot").collect()] == wide.output_columns
            for part in (train, test):
                want = {r["id"]: [r[c] for c in wide.output_columns] + [r["target"] if "target" in part.columns else None]
                        for r in wide.transform(part).collect()}
                out = narrow.transform(part)
                assert out.count() == part.count()
                for r in out.collect():
                    x = r["features"].toArray().tolist()
                    y = r["target"] if "target" in part.columns else None
                    assert [None if np.isnan(v) else v for v in x] == want[r["id"]][:-1] and y == want[r["id"]][-1]


def test_hot_values_are_dealt_to_salts(spark, monkeypatch):
    df = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 500 as string)) as s", "1.0 as target")
    fitted = dictionary.VectorEncoder("none", target="target", key="id").fit(df)
    hot = {r["v"]: r["copies"] for r in fitted.dictionary.table(spark).where("copies > 1").collect()}
    assert hot == {"hot": 2}  # a salt stands for at least 10,000 rows
    out = fitted.transform(df, "arrays")
    assert out.count() == 60_000 and out.where("size(indices) = 1").count() == 60_000
    assert out.where("id % 3 = 0").select("indices").distinct().count() == 1


def test_a_million_categories(spark):
    n = 1_000_000
    big = spark.range(n).selectExpr("id", "concat('v', lpad(cast(id as string), 7, '0')) as s", "1.0 as x", "0.0 as target")
    small = big.where("id < 10")
    plans = []
    for part in (small, big):
        fitted = dictionary.VectorEncoder("none", target="target", key="id").fit(part)
        assert fitted.size == (11 if part is small else n + 1)
        plans.append(_size(fitted.transform(part, "arrays")))
    assert plans[0] == plans[1]
    got = fitted.transform(big, "arrays").agg(
        F.count("*").alias("n"), F.count_if(F.col("indices")[1] != F.col("id") + 1).alias("wrong")).first()
    assert (got["n"], got["wrong"]) == (n, 0)


def test_dictionary_of_nothing(spark):
    df = _cats(spark).limit(0)
    fitted = dictionary.VectorEncoder(target="target", key="id").fit(df)
    assert fitted.size == 1 and fitted.transform(_cats(spark, 5)).count() == 5
    assert dictionary.fit_dictionary(df, []).widths == []


# ------------------------------------------------------------------ U2

def test_hot_keys_are_found(spark):
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 'h' when id % 7 = 0 then null else cast(id as string) end as k")
    assert align.hot_keys(df, "k") == {"h": 1000}
    assert align.hot_keys(spark.range(500).selectExpr("id as k"), "k") == {}
    assert align.hot_keys(spark.range(0).selectExpr("id as k"), "k") == {}


def test_glue_with_hot_keys_equals_the_plain_join(spark):
    def side(name, mod, n):
        return spark.range(n).selectExpr(
            f"case when id % 3 = 0 then 'h' when id % 3 = 1 and id < 200 then '{name}' when id % {mod} = 0 then null "
            "else cast(id as string) end as k", f"id as {name}")
    left, right = side("l", 11, 600), side("r", 13, 450)
    got, want = align.glue_columns(left, right, "k"), left.join(right, "k", "full_outer")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_task_takes_the_hot_key_alone(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as k", "id as l")
    right = spark.range(3000).selectExpr("if(id % 3 = 0, -1, id) as k", "id as r")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = align.glue_columns(left, right, "k")
        rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        joined = [n for n in rows if n > 5_000]  # the hot key's cells; the other tasks hold single keys
        assert sum(rows) == 1000 * 1000 + 2000 + 0 and len(joined) == 8
        assert max(joined) <= 2 * sum(joined) / len(joined)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_hot_cells_keep_their_tasks(spark, monkeypatch):
    """Small inputs of a large result: adaptive execution used to put all the
    cells into one task, and the cells grew with the square of the table."""
    monkeypatch.setattr(align, "PAIRS_PER_TASK", 10_000)
    monkeypatch.setattr(align, "ROWS_PER_SALT", 10)
    left = spark.range(1500).selectExpr("if(id % 3 = 0, -1, id) as k", "id as l")
    right = spark.range(1500).selectExpr("if(id % 3 = 0, -1, id) as k", "id as r")
    out = align.glue_columns(left, right, "k", share=1 / 8)
    rows = [r["count"] for r in out.where("k = -1").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 500 * 500 and len(rows) >= 20 and max(rows) < 500 * 500 / 5
    assert out.where("k = -1").distinct().count() == 500 * 500
