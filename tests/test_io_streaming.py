"""CSV scan with NA tokens, exports round trip, streaming scoring."""

import os

import pytest
from pyspark.sql import functions as F

from tabprep.operators import encode, impute
from tabprep.session import scratch_path
from tabprep.sources import io, tables
from tabprep.streaming import score

from conftest import SMALL


def _write_text(path, text):
    path = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)


def test_csv_na_tokens_types_and_key(spark):
    path = scratch_path(spark, "csv-test")
    _write_text(path, "Alley,Id,Area,Frontage,Kind\n"
                      "NA,1,8450,65.0,None\n"
                      "Grvl,2,9600,,1Fam\n"
                      "Pave,3,11250,NaN,n/a\n"
                      "nan,4,9550,60,Duplx\n")
    df = io.read_csv(spark, path, key="Id")
    assert df.columns == ["Id", "Alley", "Area", "Frontage", "Kind"]
    assert dict(df.dtypes) == {"Id": "bigint", "Alley": "string", "Area": "bigint",
                               "Frontage": "double", "Kind": "string"}
    rows = df.orderBy("Id").collect()
    assert [r["Alley"] for r in rows] == [None, "Grvl", "Pave", None]
    assert [r["Frontage"] for r in rows] == [65.0, None, None, 60.0]
    assert [r["Kind"] for r in rows] == [None, "1Fam", None, "Duplx"]
    # with a narrower token list "NA" and "None" are real categories
    keep = io.read_csv(spark, path, key="Id", na_tokens=("",))
    assert [r["Alley"] for r in keep.orderBy("Id").collect()][0] == "NA"
    nokey = io.read_csv(spark, path, drop=("Kind",))
    assert nokey.columns == ["Alley", "Id", "Area", "Frontage"]


def test_prediction_export_round_trip(spark):
    df = spark.createDataFrame([(1461, 120000.5), (1462, 99999.25)], "Id bigint, p double")
    path = scratch_path(spark, "pred")
    io.write_predictions(df, "Id", "p", path)
    back = io.read_csv(spark, path, key="Id")
    assert back.columns == ["Id", "SalePrice"]
    assert sorted(map(tuple, back.collect())) == [(1461, 120000.5), (1462, 99999.25)]


def test_table_export_round_trip(spark):
    h = tables.house_like(spark, SMALL)
    path = scratch_path(spark, "tbl")
    io.write_table(h, path)
    back = spark.read.parquet(path)
    assert back.exceptAll(h).count() == 0 and h.exceptAll(back).count() == 0


def test_stream_scoring_equals_batch(spark):
    train, test = tables.house_train_test(spark, SMALL)
    imp = impute.Imputer(exclude=("id", "target")).fit(train)
    enc = encode.TableEncoder("standardize", target="target", key="id").fit(imp.transform(train))
    src = scratch_path(spark, "stream-src")
    test.repartition(3).write.parquet(src)
    sink = scratch_path(spark, "stream-sink")
    stream = score.read_table_stream(spark, src, test.schema)
    q = score.score_stream(spark, stream, [imp.transform, enc.transform], sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    want = enc.transform(imp.transform(test))
    assert got.count() == test.count()
    assert got.exceptAll(want).count() == 0


def test_preview_first_rows(spark):
    h = tables.house_like(spark, SMALL)
    assert [r["id"] for r in io.preview(h, "id", 5).collect()] == \
        sorted(r["id"] for r in h.select("id").collect())[:5]


def test_fitted_objects_round_trip_json(spark):
    from tabprep.operators.encode import FittedDummies, FittedEncoder
    from tabprep.operators.impute import FittedImputer
    from tabprep.plans import sgd
    train, test = tables.house_train_test(spark, SMALL)
    imp = impute.Imputer(exclude=("id", "target")).fit(train)
    enc = encode.TableEncoder("normalize", False, target="target", key="id").fit(imp.transform(train))
    dum = encode.fit_dummies(test, dummy_na=True, dtype="int32")
    imp2, enc2 = FittedImputer.from_json(imp.to_json()), FittedEncoder.from_json(enc.to_json())
    dum2 = FittedDummies.from_json(dum.to_json())
    a = enc.transform(imp.transform(test))
    b = enc2.transform(imp2.transform(test))
    assert a.exceptAll(b).count() == 0 and a.columns == b.columns
    assert dum.transform(test).exceptAll(dum2.transform(test)).count() == 0
    net = sgd.init_net([3, 4, 1], 0.1, 2)
    assert (sgd.DenseNet.from_json(net.to_json()).pack() == net.pack()).all()


def test_stream_scoring_with_a_network_equals_batch(spark):
    from tabprep.plans import house, sgd
    train, test = tables.house_train_test(spark, SMALL)
    d = house.prepare(train, test, "id", "target", alpha=0.5)
    net = sgd.init_net([len(d.features), 4, 1], 0.5, 7)

    def score_step(df):
        x = F.array(*[F.col(f"`{c}`") for c in d.features])
        return df.select("id", sgd.dense_score(spark, net, x).alias("pred"))

    src = scratch_path(spark, "stream-src2")
    test.write.parquet(src)
    sink = scratch_path(spark, "stream-sink2")
    stream = score.read_table_stream(spark, src, test.schema)
    q = score.score_stream(spark, stream, [d.imputer.transform, d.encoder.transform, score_step],
                           sink)
    q.awaitTermination(120)
    got = {r["id"]: r["pred"] for r in spark.read.parquet(sink).collect()}
    want = {r["id"]: r["pred"] for r in score_step(d.test).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
