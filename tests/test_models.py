"""Invariants of the learners on the synthetic regression table (E4) and the
embeddings (E5 stand-in)."""

import pytest
from pyspark.sql import functions as F

from tabprep.operators import metrics, split
from tabprep.plans import models, sgd
from tabprep.sources import tables

from conftest import SMALL


@pytest.fixture(scope="module")
def s4(spark):
    base = spark.range(1000).withColumnRenamed("id", "k")
    return tables.synthetic_regression(base, "k", [2.0, -3.4], 4.2).cache()


def test_linear_fit_near_truth(s4):
    m = models.linear_regression(label="y").fit(models.vectorize(s4, ["x0", "x1"], keep=("y",)))
    w = m.coefficients.toArray()
    assert abs(w[0] - 2.0) < 0.01 and abs(w[1] + 3.4) < 0.01 and abs(m.intercept - 4.2) < 0.01


def test_gd_stats_equals_per_pass(s4):
    a = sgd.linear_gd(s4, ["x0", "x1"], "y", lr=0.03, epochs=5)
    b = sgd.linear_gd(s4, ["x0", "x1"], "y", lr=0.03, epochs=5, method="pass")
    for x, y in zip(a, b):
        assert x["w"] == pytest.approx(y["w"], abs=1e-12)
        assert x["loss"] == pytest.approx(y["loss"], rel=1e-9)
    assert [o["loss"] for o in a] == sorted((o["loss"] for o in a), reverse=True)


def test_gd_converges_to_truth(s4):
    out = sgd.linear_gd(s4, ["x0", "x1"], "y", lr=0.5, epochs=200)
    assert out[-1]["w"] == pytest.approx([2.0, -3.4], abs=0.01)


def _arr(s4):
    return s4.select("id", F.array("x0", "x1").alias("x"), "y")


def test_dense_exact_mode_independent_of_partitioning(spark, s4):
    d = _arr(s4)
    a = sgd.train_dense(spark, d, "x", "y", (4,), key="id", lr=0.1, epochs=3,
                        mode="exact", partitions=1, seed=3)
    b = sgd.train_dense(spark, d, "x", "y", (4,), key="id", lr=0.1, epochs=3,
                        mode="exact", partitions=70, seed=3)   # two combine rounds
    assert a.net.pack() == pytest.approx(b.net.pack(), abs=1e-10)


def test_dense_local_mode_learns_and_curve(spark, s4):
    d = _arr(s4)
    tr, va = split.holdout(d, "id", 80)
    res = sgd.train_dense(spark, tr, "x", "y", (16,), key="id", valid=va, lr=0.1,
                          epochs=10, batch_size=16, partitions=2)
    assert len(res.curve) == 10
    assert res.curve[-1]["valid_rmse"] < res.curve[0]["valid_rmse"] < 5
    scored = d.select(sgd.dense_score(spark, res.net, "x").alias("p"), "y")
    rmse = metrics.regression_errors(scored, "p", "y").first()["rmse"]
    assert rmse < 1.0          # the mean predictor is near 3.9


def test_dense_score_equals_array_expression(spark, s4):
    from tabprep.functions import rowexpr
    net = sgd.init_net([2, 3, 1], std=1.0, seed=5)
    layers = [(w.tolist(), b.tolist()) for w, b in zip(net.weights, net.biases)]
    d = _arr(s4)
    got = d.select(sgd.dense_score(spark, net, "x").alias("a"),
                   F.element_at(rowexpr.dense_layers(F.col("x"), layers), 1).alias("b"))
    for r in got.collect():
        assert r["a"] == pytest.approx(r["b"], abs=1e-9)


def test_trees_beat_mean_predictor(spark, s4):
    data = split.with_folds(models.vectorize(s4, ["x0", "x1"], keep=("id", "y")), "id", 3)
    base = models.cv_scores(models.MeanRegressor(labelCol="y"), data, "y", 3)
    gbt = models.cv_scores(models.boosted_trees(label="y", max_iter=10, max_depth=3), data, "y", 3)
    rf = models.cv_scores(models.random_forest(label="y", num_trees=10, max_depth=5), data, "y", 3)
    mean = lambda s: s.agg(F.avg("neg_rmse")).first()[0]
    assert mean(gbt) > mean(base) and mean(rf) > mean(base)
    assert base.count() == 3 and sorted(r["fold"] for r in base.collect()) == [0, 1, 2]


def test_grid_search_picks_smallest_error(spark, s4):
    data = split.with_folds(models.vectorize(s4, ["x0", "x1"], keep=("id", "y")), "id", 3)
    est = models.boosted_trees(label="y", max_iter=2, max_depth=2)
    best, table = models.grid_search(spark, est, data, {"maxIter": [2, 8]}, "y", 3)
    rows = table.orderBy("rank").collect()
    assert rows[0]["rank"] == 1 and rows[0]["neg_rmse_mean"] >= rows[1]["neg_rmse_mean"]
    assert best.getMaxIter() == int(rows[0]["maxIter"])


def test_classifiers_beat_chance(spark):
    e = tables.load(spark, SMALL, "embeddings")
    data = models.vectorize(e, "embedding", keep=("vec_id", "label"))
    for est in (models.softmax_regression(label="label", max_iter=30),
                models.perceptron([64, 16, 10], label="label", max_iter=30)):
        pred = models.fit_score(est, data, data, keep=("label",))
        acc = metrics.accuracy(pred, "prediction", F.col("label").cast("double")).first()
        assert acc["total"] == e.count() and acc["accuracy"] > 0.2


def test_linear_sgd_minibatch_reference_run(spark, s4):
    """lr 0.03, batch 10, 3 epochs, sequential (one part): near the truth."""
    res = sgd.linear_sgd(spark, s4, ["x0", "x1"], "y", key="id", lr=0.03, epochs=3,
                         batch_size=10, partitions=1)
    w, b = res.net.weights[0][0], res.net.biases[0][0]
    assert abs(w[0] - 2.0) < 0.01 and abs(w[1] + 3.4) < 0.01 and abs(b - 4.2) < 0.01
    assert res.curve[-1]["train_rmse"] < 0.05


def test_relu_classifier_learns_quadrants(spark, s4):
    d = s4.select("id", F.array("x0", "x1").alias("x"),
                  ((F.col("x0") > 0).cast("int") + 2 * (F.col("x1") > 0).cast("int")).alias("q"))
    tr, va = split.holdout(d, "id", 80)
    res = sgd.train_dense(spark, tr, "x", "q", (16,), key="id", valid=va, out_dim=4,
                          loss="softmax", lr=0.5, epochs=12, batch_size=16, step=0,
                          partitions=1, init_std=0.5, seed=1)
    assert res.curve[-1]["valid_accuracy"] > 0.85
    from tabprep.functions import rowexpr
    scored = va.select("q", rowexpr.argmax(sgd.dense_score(spark, res.net, "x", classes=True))
                       .alias("p"))
    acc = metrics.accuracy(scored, "p", "q").first()["accuracy"]
    assert acc == pytest.approx(res.curve[-1]["valid_accuracy"])


def test_tree_flow_one_prediction_per_test_row(spark):
    from tabprep.plans import house
    train, test = tables.house_train_test(spark, SMALL)
    est = models.boosted_trees(label="target", max_iter=3, max_depth=2)
    scores, preds = house.tree_flow(spark, train, test, "id", "target", estimator=est, k=3)
    rows = preds.collect()
    assert len(rows) == test.count() and len({r["id"] for r in rows}) == len(rows)
    assert all(r["target"] is not None for r in rows)
    assert sorted(r["fold"] for r in scores.collect()) == [0, 1, 2]


def test_same_seed_same_result(spark, s4):
    d = _arr(s4)
    a = sgd.train_dense(spark, d, "x", "y", (8,), key="id", epochs=2, partitions=3, seed=4)
    b = sgd.train_dense(spark, d.repartition(5), "x", "y", (8,), key="id", epochs=2,
                        partitions=3, seed=4)
    # same parts on any input layout; the parts' weights are added in
    # shuffle-read order, so only the last bits may differ
    assert a.net.pack() == pytest.approx(b.net.pack(), rel=1e-12, abs=1e-15)
    data = models.vectorize(s4, ["x0", "x1"], keep=("id", "y"))
    est = models.random_forest(label="y", num_trees=5, max_depth=4, seed=9)
    p1 = models.fit_score(est, data, data, keep=("id",)).collect()
    p2 = models.fit_score(est, data, data, keep=("id",)).collect()
    assert sorted(map(tuple, p1)) == sorted(map(tuple, p2))


def test_trees_train_on_tasks_of_bounded_rows(spark, monkeypatch):
    """One file of any size used to be one task, which read it all again at
    every level of the trees."""
    df = spark.range(0, 5000, 1, 1).selectExpr("id", "cast(id % 7 as double) as a", "cast(id % 11 as double) as y")
    data = models.vectorize(df, ["a"], keep=("id", "y"))
    forest = models.random_forest(label="y", num_trees=2, max_depth=3)
    assert models.spread(forest, data) is data
    monkeypatch.setattr(models, "ROWS_PER_TASK", 1000)
    dealt = models.spread(forest, data)
    assert [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()] == [1000] * 5
    assert sorted(r["id"] for r in dealt.collect()) == list(range(5000))
    assert models.spread(models.linear_regression(label="y"), data) is data
