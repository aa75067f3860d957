"""The 5-row train / 3-row test pair with hand-worked results."""

import math

import pytest

from tabprep.operators import encode, impute, profile, stats

TRAIN = [(28, 70000.0, "Sales", "Tokyo", 4.5), (35, 95000.0, "IT", "Osaka", 4.8),
         (45, 120000.0, None, "Kyoto", 4.0), (23, 45000.0, "Sales", None, 3.5),
         (51, 135000.0, "HR", "Tokyo", 4.9)]
TEST = [(31, 82000.0, "IT", "Osaka"), (29, 68000.0, "Marketing", "Kyoto"),
        (48, 150000.0, "Sales", "Tokyo")]
SCHEMA = "Age int, Salary double, Department string, City string"


@pytest.fixture(scope="module")
def pair(spark):
    tr = spark.createDataFrame(TRAIN, SCHEMA + ", Satisfaction_Score double")
    te = spark.createDataFrame(TEST, SCHEMA)
    return tr, te


def test_profile(pair):
    tr, _ = pair
    rows = {r["column"]: r for r in profile.missing_profile(tr).collect()}
    assert set(rows) == {"Department", "City"}
    assert rows["Department"]["ratio"] == pytest.approx(0.2)
    assert rows["City"]["missing"] == 1 and rows["City"]["rows"] == 5


def test_prune_threshold_is_inclusive(pair):
    tr, te = pair
    dropped, tr2, te2 = profile.prune_sparse_columns(tr, te, alpha=0.5)
    assert dropped.count() == 0 and tr2.columns == tr.columns
    dropped, tr2, te2 = profile.prune_sparse_columns(tr, te, alpha=0.2)
    assert sorted(r["column"] for r in dropped.collect()) == ["City", "Department"]
    assert "City" not in te2.columns and "Satisfaction_Score" in tr2.columns


def test_modes_and_medians(pair):
    tr, _ = pair
    assert stats.modes(tr, ["Department", "City"]) == {"Department": "Sales", "City": "Tokyo"}
    assert stats.exact_medians(tr, ["Age", "Salary"]) == {"Age": 35.0, "Salary": 95000.0}


def test_fill_from_train(pair):
    tr, te = pair
    fitted = impute.Imputer(exclude=("Satisfaction_Score",)).fit(tr)
    filled = fitted.transform(tr).collect()
    assert filled[2]["Department"] == "Sales" and filled[3]["City"] == "Tokyo"
    # test is filled with train statistics; it has nothing missing
    assert fitted.transform(te).collect()[1]["Department"] == "Marketing"


def test_encoder_standardize(pair):
    tr, te = pair
    fitted = encode.TableEncoder("standardize", keep_target_separate=False).fit(tr)
    assert fitted.output_columns == [
        "num__Age", "num__Salary", "cat__Department_HR", "cat__Department_IT",
        "cat__Department_Sales", "cat__Department_missing_value", "cat__City_Kyoto",
        "cat__City_Osaka", "cat__City_Tokyo", "cat__City_missing_value"]
    assert fitted.shift["Age"] == pytest.approx(36.4)
    assert fitted.scale["Age"] == pytest.approx(math.sqrt(107.84))
    assert fitted.scale["Salary"] == pytest.approx(math.sqrt(1066000000))
    assert fitted.mu == pytest.approx(4.34) and fitted.sigma == pytest.approx(math.sqrt(0.2744))
    out_te = fitted.transform(te)
    assert out_te.columns == fitted.output_columns     # no target in test
    row = out_te.collect()[1]                           # Marketing: unseen
    assert [row[c] for c in fitted.output_columns if c.startswith("cat__Department")] == [0.0] * 4
    out_tr = fitted.transform(tr)
    assert out_tr.columns[-1] == "Satisfaction_Score"
    back = out_tr.select(fitted.inverse_target(out_tr["Satisfaction_Score"]).alias("y")).collect()
    assert [r["y"] for r in back] == pytest.approx([t[-1] for t in TRAIN])


def test_scaled_train_has_mean_zero_std_one(pair):
    from pyspark.sql import functions as F
    tr, _ = pair
    fitted = encode.TableEncoder("standardize").fit(tr)
    r = fitted.transform(tr).agg(F.avg("num__Age"), F.stddev_pop("num__Age")).first()
    assert r[0] == pytest.approx(0.0, abs=1e-12) and r[1] == pytest.approx(1.0)


def test_indicators_sum_to_zero_or_one(pair):
    tr, te = pair
    fitted = encode.TableEncoder("normalize").fit(tr)
    for r in fitted.transform(te).collect():
        s = sum(r[c] for c in fitted.output_columns if c.startswith("cat__Department"))
        assert s in (0.0, 1.0)


def test_prepare_shared_passes_equal_separate_operators(spark):
    """The plan's fused statistics give the same fit as the operators."""
    from tabprep.plans import house
    from tabprep.sources import tables
    from conftest import SMALL
    train, test = tables.house_train_test(spark, SMALL)
    every = ["acctbal", "nation", "const", "segment", "priority", "status"]
    d = house.prepare(train, test, "id", "target", alpha=0.5, keep_target_separate=False, fill=every)
    kept, _ = profile.split_missing_target(train, "target")
    dropped, tr, te = profile.prune_sparse_columns(kept, test, 0.5, target="target", key="id")
    assert sorted(map(tuple, d.dropped.collect())) == sorted(map(tuple, dropped.collect()))
    imp = impute.Imputer(exclude=("id", "target")).fit(tr)
    assert imp.numeric == d.imputer.numeric and imp.category == d.imputer.category
    enc = encode.TableEncoder("standardize", False, target="target", key="id").fit(
        imp.transform(tr))
    assert enc.category == d.encoder.category
    assert enc.output_columns == d.features
    for n in enc.numeric:
        assert enc.shift[n] == pytest.approx(d.encoder.shift[n], rel=1e-12)
        assert enc.scale[n] == pytest.approx(d.encoder.scale[n], rel=1e-12)
    assert enc.sigma == d.encoder.sigma and enc.mu == d.encoder.mu


def test_prepare_on_smoke_pair(pair):
    from tabprep.plans import house
    tr, te = pair
    tr = tr.withColumn("k", __import__("pyspark.sql.functions", fromlist=["x"])
                       .monotonically_increasing_id())
    tr = tr.select("k", "Age", "Salary", "Department", "City", "Satisfaction_Score")
    te = te.withColumn("k", __import__("pyspark.sql.functions", fromlist=["x"]).lit(0))
    d = house.prepare(tr, te, "k", "Satisfaction_Score", alpha=0.5,
                      fill=["Age", "Salary", "Department", "City"])
    assert d.features == [
        "num__Age", "num__Salary", "cat__Department_HR", "cat__Department_IT",
        "cat__Department_Sales", "cat__City_Kyoto", "cat__City_Osaka", "cat__City_Tokyo"]


def test_prepare_keeps_unlisted_missing_categories(spark):
    """A missing category that is not filled stays a category of its own."""
    from tabprep.plans import house
    from tabprep.sources import tables
    from conftest import SMALL
    train, test = tables.house_train_test(spark, SMALL)
    d = house.prepare(train, test, "id", "target", alpha=0.5)
    assert d.train.where("cat__segment_missing_value = 1").count() > 0
    tr, te = house.tree_design(train, test, "id", "target", numeric_missing="indicator")
    assert tr.where("segment_nan = 1").count() > 0 and te.where("rare_nan = 1").count() > 0
    assert tr.where("acctbal_isna = 1").count() == train.where("target IS NOT NULL AND acctbal IS NULL").count()
