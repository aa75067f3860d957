"""No row or digit is lost: odd keys, wide integers, extreme values, caches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import align, metrics, split, stats
from tabprep.plans import models, sgd
from tabprep.sources import io


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "double"])
def test_every_key_lands_in_one_part_and_fold(spark, kind):
    key = {"bigint": F.col("id"), "string": F.concat(F.lit("k"), F.col("id")),
           "date": F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")),
           "double": F.col("id") / 3}[kind]
    df = spark.range(600).select(F.when(F.col("id") % 3 > 0, key).alias("k"), F.col("id").alias("v"))
    a, b = split.holdout(df, "k", 80)
    assert a.count() + b.count() == 600 and a.count() > 300 and b.count() > 30
    folds = split.with_folds(df, "k", 5).groupBy("fold").count().collect()
    assert sum(r["count"] for r in folds) == 600 and {r["fold"] for r in folds} == set(range(5))
    batches = split.with_batches(df, "k", 100).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in batches) == [100] * 6


def test_tied_order_spreads_over_ranges(spark, monkeypatch):
    tables, real = {}, align._written
    monkeypatch.setattr(align, "_written", lambda df, name: tables.setdefault(name, real(df, name)))
    df = spark.range(3000).select(F.lit(1).alias("k"), "id")
    out = align.consecutive_index(df, ["k"], rows_per_range=500)
    assert sorted(r["row"] for r in out.select("row").collect()) == list(range(3000))
    ranges = [r["count"] for r in tables["row-order"].groupBy("range").count().collect()]
    assert len(ranges) == 6 and max(ranges) < 1000


def test_wide_integers_stay_whole(spark, tmp_path):
    big = [str(2 ** 63 - 1), str(2 ** 64 - 1), str(2 ** 64), "-9223372036854775808", "-9223372036854775809"]
    rows = ["a,b,c,d,e"] + [f"{big[0]},{big[1]},{big[2]},{big[3]},{big[4]}", "1,2,3,4,5"]
    path = tmp_path / "wide.csv"
    path.write_text("\n".join(rows) + "\n")
    df = io.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"a": "bigint", "b": "decimal(20,0)", "c": "string", "d": "bigint", "e": "string"}
    first = df.where("d < 0").first()
    assert [str(x) for x in first] == big


@pytest.mark.parametrize("values", [
    [-math.inf] + list(range(3000)), [math.inf] * 400 + [-math.inf] * 400 + list(range(777)),
    [10.0 ** e for e in range(-200, 200)] * 10, [5.0] * 2000 + list(range(999))])
def test_median_in_few_rounds(spark, values, monkeypatch):
    sizes, rounds = [], []
    small, refine = stats._rank_small, stats._refine
    monkeypatch.setattr(stats, "_rank_small", lambda long, probes, result: (
        sizes.extend(p["n"] for p in probes), small(long, probes, result)))
    monkeypatch.setattr(stats, "_refine", lambda *a: (rounds.append(1), refine(*a))[1])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = stats.exact_medians(df, ["v"], threshold=20)["v"]
    assert got == np.median(np.array(values, float))
    assert all(n <= 20 for n in sizes) and len(rounds) <= 4


def test_dense_parts_are_even(spark, monkeypatch):
    df = spark.range(64_000).select("id", F.array(F.col("id").cast("double")).alias("x"), F.lit(1.0).alias("y"))
    seen = []
    real = sgd._combine
    monkeypatch.setattr(sgd, "_combine", lambda out, parts: (seen.append(parts), real(out, parts))[1])
    sizes = (df.repartition(64, F.xxhash64("id", "x", "y")).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 64 and max(r["count"] for r in sizes) < 1.5 * 1000
    sgd.train_dense(spark, df.limit(500), "x", "y", (), key="id", epochs=1, rows_per_part=100)
    assert set(seen) == {5}


def test_caches_are_released(spark):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    df = spark.range(200).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"), (F.col("id") % 2).alias("fold"))
    data = models.vectorize(df, ["x"], keep=("id", "y", "fold"))
    est = models.linear_regression(label="y")
    models.cv_scores(est, data, "y", 2).collect()
    _, table = models.grid_search(spark, est, data, {"regParam": [0.0, 0.1]}, "y", 2, metric="mae")
    assert {"neg_mae_mean", "neg_mae_std"} <= set(table.columns)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == before
    with pytest.raises(ValueError):
        models.random_forest(max_depth=31)


def test_errors_count_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, None), (None, 2.0)], "p double, y double")
    r = metrics.regression_errors(df, "p", "y").first()
    assert (r["n"], r["rmse"], r["mae"]) == (1, 2.0, 2.0)


def test_linear_gd_far_from_zero(spark):
    df = spark.range(5000).select(
        (F.col("id") % 97 + 1e6).alias("a"), (F.col("id") % 89 + 2e6).alias("b")).withColumn(
        "y", 3 * F.col("a") - 2 * F.col("b") + 1e8 + F.sin("a"))
    fast = sgd.linear_gd(df, ["a", "b"], "y", lr=1e-14, epochs=3)
    slow = sgd.linear_gd(df, ["a", "b"], "y", lr=1e-14, epochs=3, method="pass")
    for x, z in zip(fast, slow):
        assert x["loss"] == pytest.approx(z["loss"], rel=1e-9)
        assert x["w"] == pytest.approx(z["w"], rel=1e-9)


def test_folds_are_scored_from_the_fits_cache(spark):
    """Each row is made once for all fits and scores of the folds."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(i):
        made.add(1)
        return float(i % 7)

    df = spark.range(60).select("id", slow("id").alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    got = models.cv_scores(models.MeanRegressor(labelCol="y"), df, "y", 3).collect()
    assert made.value == 60
    for f, n, rmse, mae in sorted(got):
        mean = np.mean([i % 7 for i in range(60) if i % 3 != f])
        errors = np.array([i % 7 - mean for i in range(60) if i % 3 == f])
        assert n == 20 and rmse == pytest.approx(-np.sqrt((errors ** 2).mean())) and mae == pytest.approx(-np.abs(errors).mean())


def test_cv_boosting_trains_all_rounds(spark, monkeypatch):
    """The query used to train 5 rounds of the reference's 500."""
    from tabprep.plans import catalog, house
    asked = {}
    monkeypatch.setattr(catalog, "house_parts", lambda *_: ("train", "test"))
    monkeypatch.setattr(house, "tree_flow", lambda *a, **b: (asked.update(b), None))
    catalog.QUERIES["m13_cv_boosting"](spark, "nowhere")
    est = asked["estimator"]
    assert (est.getMaxIter(), est.getStepSize(), est.getMaxDepth(), est.getSubsamplingRate()) == (500, 0.05, 5, 0.7)
    assert asked["k"] == 5 and asked.get("with_scores", True)


def test_flow_is_the_same_side_by_side(spark, monkeypatch):
    """Folds and refit side by side give what one after the other gives; a
    large table's fits run one at a time."""
    from tabprep.plans import house
    train = spark.range(0, 200, 1, 1).selectExpr("id", "cast(id % 7 as double) as a", "if(id % 3 = 0, 'u', 'v') as s", "cast(id % 11 as double) as y")
    test = train.drop("y")
    est = models.boosted_trees(label="y", max_iter=2, max_depth=2)
    runs = [house.tree_flow(spark, train, test, "id", "y", estimator=est, k=3, parallelism=p) for p in (1, None)]
    one, many = [[sorted(map(tuple, x.collect())) for x in run] for run in runs]
    assert one == many and len(one[0]) == 3 and len(one[1]) == 200
    assert models.fits_at_once(train, 4) == min(4, spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(models, "ROWS_PER_TASK", 10)
    assert models.fits_at_once(train, 4) == 1 and models.fits_at_once(train.limit(0), 4) >= 1


def test_long_boosting_cuts_its_lineage(spark, monkeypatch):
    """Without a checkpoint folder every round stays in the lineage."""
    made = []
    monkeypatch.setattr(models, "ensure_checkpoint_dir", lambda s: made.append(s), raising=False)
    df = spark.range(10)
    models.spread(models.boosted_trees(max_iter=10), df)
    assert not made
    models.spread(models.boosted_trees(max_iter=11), df)
    assert len(made) == 1
