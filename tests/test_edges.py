"""E8 edge rows and documented differences."""

import pytest
from pyspark.sql import functions as F

from tabprep.operators import align, encode, impute, metrics, profile, split, stats


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert stats.modes(df, ["v"]) == {"v": "a"}


def test_median_of_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert stats.exact_medians(df, ["v"]) == {"v": 2.5}


def test_median_large_matches_numpy(spark):
    import numpy as np
    df = spark.range(20001).select((F.pmod(F.col("id") * 7919, F.lit(10007)) / 3.0).alias("v"))
    vals = np.array([r[0] for r in df.collect()])
    got = stats.exact_medians(df, ["v"], threshold=100, buckets=16)["v"]
    assert got == pytest.approx(float(np.median(vals)))


def test_null_and_nan_are_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "v double")
    assert profile.missing_profile(df).collect()[0]["missing"] == 2
    assert stats.moments(df, ["v"])["v"]["mean"] == 1.0


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, "x"), (None, None)], "v double, c string")
    df = df.withColumn("c2", F.lit(None).cast("string"))
    fitted = impute.Imputer().fit(df)
    assert fitted.numeric["v"] is None and fitted.category["c2"] is None
    out = fitted.transform(df).collect()
    assert out[0]["v"] is None and out[1]["c2"] is None and out[1]["c"] == "x"


def test_constant_column_and_outside_range(spark):
    tr = spark.createDataFrame([(1.0, 0.0, 1.0), (1.0, 10.0, 2.0)], "k double, x double, y double")
    te = spark.createDataFrame([(1.0, -5.0), (1.0, 20.0)], "k double, x double")
    for method in ("standardize", "normalize"):
        f = encode.TableEncoder(method).fit(tr)
        assert {r["num__k"] for r in f.transform(tr).collect()} == {0.0}
    f = encode.TableEncoder("normalize").fit(tr)
    xs = [r["num__x"] for r in f.transform(te).collect()]
    assert xs == [-0.5, 2.0]


def test_empty_table_gives_null_ratio_and_accuracy(spark):
    df = spark.createDataFrame([], "v double, p int, y int")
    prof = profile.missing_profile(df, mode="total").collect()
    assert prof[0]["ratio"] is None
    assert metrics.accuracy(df, "p", "y").collect()[0]["accuracy"] is None


def test_odd_names_and_case(spark):
    df = spark.createDataFrame([("1.5Fin",), ("Wd Sdng",), ("Tar&Grv",), ("a",), ("A",)],
                               "style string")
    f = encode.fit_dummies(df, dtype="int32")
    out = f.transform(df)
    assert out.columns == ["style_1.5Fin", "style_A", "style_Tar&Grv", "style_Wd Sdng", "style_a"]
    assert [sum(r) for r in out.collect()] == [1] * 5


def test_boolean_with_null_is_mode_filled_category(spark):
    df = spark.createDataFrame([(True,), (True,), (False,), (None,)], "b boolean")
    fitted = impute.Imputer().fit(df)
    assert [r["b"] for r in fitted.transform(df).collect()] == [True, True, False, True]
    enc = encode.TableEncoder("none", target="y").fit(df.withColumn("y", F.lit(1.0)))
    assert enc.category == {"b": ["False", "True", "missing_value"]}


def test_last_batch_short(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    b = split.with_batches(df, "k", 4)
    sizes = sorted((r["batch"], r["count"]) for r in b.groupBy("batch").count().collect())
    assert [s for _, s in sizes] == [4, 4, 2]
    assert sorted(r["pos"] for r in b.collect()) == list(range(10))


def test_consecutive_index_any_partitioning(spark):
    df = spark.range(1000).repartition(7).select((F.col("id") * 3).alias("k"))
    out = align.consecutive_index(df, ["k"], rows_per_range=200)
    assert sorted((r["k"], r["row"]) for r in out.collect()) == [(3 * i, i) for i in range(1000)]


def test_holdout_and_folds_are_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = split.with_folds(df.repartition(3), "k", 5).collect()
    b = split.with_folds(df.repartition(11), "k", 5).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    n_train = split.holdout(df, "k", 80)[0].count()
    assert 3800 < n_train < 4200


def test_bad_method_fails_at_once():
    with pytest.raises(ValueError):
        impute.Imputer(numeric="mode")
    with pytest.raises(ValueError):
        encode.TableEncoder("minmax")


def test_sparse_dummies_null_and_unseen_are_all_zero(spark):
    from pyspark.ml.functions import vector_to_array
    tr = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    te = spark.createDataFrame([("b",), ("zz",), (None,)], "v string")
    for na in (False, True):
        f = encode.fit_dummies(tr, sparse=True, dummy_na=na)
        dense = encode.fit_dummies(tr, sparse=False, dummy_na=na, dtype="float64")
        got = [list(r[0]) for r in f.transform(te).select(vector_to_array("v")).collect()]
        want = [list(r) for r in dense.transform(te).collect()]
        assert got == want


def test_encoder_test_column_of_other_type(spark):
    tr = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "c string, y double")
    te = spark.createDataFrame([(None,), (None,)], "c bigint")     # all missing, typed as int
    f = encode.TableEncoder("none").fit(tr)
    rows = f.transform(te).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0, 1.0)] * 2


def test_hash_batches_average_size(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    b = split.with_batches(df, "k", 100, epoch=2, exact=False)
    counts = [r["count"] for r in b.groupBy("batch").count().collect()]
    assert len(counts) == 200 and sum(counts) == 20000
    assert 60 < min(counts) and max(counts) < 140


def test_dummy_prefix_forms(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "s string, t string, n int")
    cols = lambda **kw: encode.dummies(df, dtype="int32", **kw).columns
    assert cols() == ["n", "s_a", "s_b", "t_x", "t_y"]
    assert cols(prefix="p") == ["n", "p_a", "p_b", "p_x", "p_y"]
    assert cols(prefix=["S", "T"], prefix_sep="-") == ["n", "S-a", "S-b", "T-x", "T-y"]
    assert cols(prefix={"t": "tt"}) == ["n", "s_a", "s_b", "tt_x", "tt_y"]
    assert cols(columns=["t"], drop_first=True) == ["s", "n", "t_y"]
    assert cols(columns=["s"], dummy_na=True) == ["t", "n", "s_a", "s_b", "s_nan"]
    with pytest.raises(ValueError):
        encode.dummies(df, prefix=["only-one"])


def test_sparse_target_is_never_pruned_and_alpha_zero_keeps_complete(spark):
    tr = spark.createDataFrame([(1.0, None, "a", None), (2.0, None, "b", 1.0),
                                (3.0, 5.0, "c", None)], "x double, s double, c string, y double")
    te = spark.createDataFrame([(1.0, 1.0, "a")], "x double, s double, c string")
    dropped, tr2, te2 = profile.prune_sparse_columns(tr, te, alpha=0.5)
    assert [r["column"] for r in dropped.collect()] == ["s"]
    assert tr2.columns == ["x", "c", "y"] and te2.columns == ["x", "c"]
    dropped, tr3, _ = profile.prune_sparse_columns(tr, te, alpha=0.0)
    assert [r["column"] for r in dropped.collect()] == ["s"]      # complete columns stay
    assert "x" in tr3.columns and "c" in tr3.columns


def test_constant_fill_leaves_numeric_missing(spark):
    df = spark.createDataFrame([(None, None), (1.0, "a")], "v double, c string")
    out = impute.fill_constant(df).collect()
    assert out[0]["v"] is None and out[0]["c"] == "missing_value"


def test_kind_override_numeric_codes_as_categories(spark):
    df = spark.createDataFrame([(20, 1.0), (60, 2.0), (20, 3.0)], "MSSubClass int, y double")
    f = encode.TableEncoder("standardize", kinds={"MSSubClass": "category"}).fit(df)
    assert f.numeric == [] and f.category == {"MSSubClass": ["20", "60"]}
    assert f.transform(df).columns == ["cat__MSSubClass_20", "cat__MSSubClass_60", "y"]
    imp = impute.Imputer(kinds={"MSSubClass": "category"}, exclude=("y",)).fit(df)
    assert imp.category == {"MSSubClass": "20"} and imp.numeric == {}


def test_sum_reduction_steps_batch_size_times_larger(spark):
    from tabprep.plans import sgd
    df = spark.range(64).select("id", F.array((F.col("id") / 64.0).cast("double"))
                                .alias("x"), (F.col("id") / 32.0).alias("y"))
    common = dict(key="id", lr=0.01, epochs=1, batch_size=64, partitions=1, mode="exact",
                  nominal_batch=True)
    mean = sgd.train_dense(spark, df, "x", "y", (), **common)
    summed = sgd.train_dense(spark, df, "x", "y", (), reduction="sum", **common)
    start = sgd.init_net([1, 1], 0.01, 0).pack()
    assert (summed.net.pack() - start) == pytest.approx(64 * (mean.net.pack() - start))


def test_batches_spread_a_hot_key(spark):
    # a third of the rows share one key
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
                                  .alias("k"), F.col("id").alias("v"))
    b = split.with_batches(df, "k", 100)
    assert sorted(r["pos"] for r in b.select("pos").collect()) == list(range(3000))
    sizes = sorted(r["count"] for r in b.groupBy("batch").count().collect())
    assert sizes == [100] * 30
