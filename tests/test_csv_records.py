"""CSV files with line breaks inside quotes, types as pandas infers them, and
whole-number columns through the fill."""

import random

import pandas as pd
import pytest
from tabprep.operators import impute
from tabprep.sources import io, records


def _write(path, rows, end="\n"):
    def cell(x):
        return "" if x is None else '"' + str(x).replace('"', '""') + '"' if any(c in str(x) for c in '",\n\r') else str(x)
    path.write_bytes(end.join(["id,text,n", *(",".join(map(cell, r)) for r in rows)]).encode() + end.encode())


def _broken(n, seed):
    rng = random.Random(seed)
    words = ["a", "bb", '"', ",", "\n", "\n\n", "é", "x y", '""', "'"]
    return [(i, "t" + "".join(rng.choice(words) for _ in range(rng.randrange(40))) + ".", rng.choice([1, None, 7])) for i in range(n)]


@pytest.mark.parametrize("split", ["600", "128m"])
def test_quoted_line_breaks_in_splits(spark, tmp_path, split):
    rows = _broken(150, 1)
    _write(tmp_path / "a.csv", rows[:100])
    _write(tmp_path / "b.csv", rows[100:])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = io.read_csv(spark, str(tmp_path), key="id")
        got = sorted(tuple(r) for r in out.collect())
        tasks = records.lines_of(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == rows and dict(out.dtypes) == {"id": "bigint", "text": "string", "n": "bigint"}
    assert tasks > 4 or split == "128m"
    both = pd.concat([pd.read_csv(tmp_path / f) for f in ("a.csv", "b.csv")])
    assert list(both["text"]) == [t for _, t, _ in got]


def test_carriage_returns_blank_lines_and_a_record_over_many_splits(spark, tmp_path):
    rows = [(1, "one\r\ntwo", 3), (2, "x\n" * 200, None), (3, "end", 4)]
    _write(tmp_path / "a.csv", rows, end="\r\n")
    with open(tmp_path / "a.csv", "ab") as f:
        f.write(b"\r\n\r\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        got = sorted(tuple(r) for r in io.read_csv(spark, str(tmp_path / "a.csv")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == rows


def test_a_quote_that_is_never_closed_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="never closed"):
        io.read_csv(spark, str(tmp_path / "a.csv"))


def test_types_as_pandas_infers_them(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,e,i,f,m,s\nTrue,NA,1,1.5,True,x\nfalse,,2,2,1,y\nTRUE,nan,,3,,\n")
    got = dict(io.read_csv(spark, str(tmp_path / "a.csv")).dtypes)
    assert got == {"b": "boolean", "e": "double", "i": "bigint", "f": "double", "m": "string", "s": "string"}
    want = pd.read_csv(tmp_path / "a.csv").dtypes
    assert [str(want[c]) for c in "be"] == ["bool", "float64"]


def test_whole_numbers_stay_whole(spark):
    df = spark.createDataFrame([(1, 1, None, 5.0), (2, 2, 4, None), (3, 5, 6, 1.0), (4, 5, 8, 2.0)],
                               "full int, odd bigint, gaps int, x double")
    for method, kinds in (("mean", {"full": "int", "odd": "bigint", "gaps": "int", "x": "double"}),
                          ("median", {"full": "int", "odd": "bigint", "gaps": "int", "x": "double"})):
        fitted = impute.Imputer(numeric=method).fit(df)
        assert dict(fitted.transform(df).dtypes) == kinds  # a mean of 6 fills the gaps; 2.5 has nothing to fill
        assert [r["gaps"] for r in fitted.transform(df).orderBy("full").collect()] == [6, 4, 6, 8]
    other = df.selectExpr("cast(null as int) full", "odd", "gaps", "x")
    filled = impute.Imputer(numeric="mean").fit(df).transform(other)
    assert dict(filled.dtypes)["full"] == "double" and {r["full"] for r in filled.collect()} == {2.5}
    known = impute.Imputer(numeric="mean").fit(df).transform(df, missing=["full"])
    assert dict(known.dtypes)["full"] == "double"
