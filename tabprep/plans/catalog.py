"""Registered queries (one per operator of the inventory) and their oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the driver
tables (or views Spark derives from them), so its work grows with the data.
``ORACLE`` holds the DuckDB SQL of every query SQL can express; computed
floating columns are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions import rowexpr
from tabprep.functions.hashing import sql_key_hash
from tabprep.operators import align, encode, impute, metrics, profile, split, stats
from tabprep.plans import folds, house, models, sgd
from tabprep.session import scratch_path
from tabprep.sources import io, tables
from tabprep.sources.tables import HOUSE_LIKE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

R = 6  # decimals kept for computed floating columns


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_house(body: str, extra: str = "") -> str:
    """SQL with the ``house_like`` view and its train/test parts as CTEs."""
    return (f"WITH house AS ({HOUSE_LIKE_SQL}),\n"
            "train AS (SELECT * EXCLUDE (origin) FROM house WHERE origin = 'train'),\n"
            "test AS (SELECT * EXCLUDE (origin, target) FROM house WHERE origin = 'test')"
            f"{extra}\n{body}")


def rnd(c, d: int = R):
    return F.round(c, d)


# ------------------------------------------------------------ A1-A3 profile

def _profile_sql(table: str, cols: list[str], mode: str, with_ratio: bool = True) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS missing, "
                     f"CAST(count(*) AS BIGINT) AS \"rows\" FROM {table}")
    body = " UNION ALL ".join(parts)
    where = "WHERE missing > 0" if mode == "omission" else ""
    if with_ratio:
        sel = 'SELECT "column", missing, "rows", CAST(missing AS DOUBLE) / "rows" AS ratio'
    else:
        sel = 'SELECT "column", missing'
    return f"{sel} FROM ({body}) p {where}"


HOUSE_ALL = list(tables.HOUSE_COLUMNS)


@register("a1_missing_total", with_house(_profile_sql("house", HOUSE_ALL, "total")))
def a1_missing_total(spark, sf_dir):
    return profile.missing_profile(tables.house_like(spark, sf_dir), mode="total")


@register("a2_missing_omission", with_house(_profile_sql("house", HOUSE_ALL, "omission")))
def a2_missing_omission(spark, sf_dir):
    return profile.missing_profile(tables.house_like(spark, sf_dir))


@register("a3_missing_counts",
          with_house(_profile_sql("house", HOUSE_ALL, "total", with_ratio=False)))
def a3_missing_counts(spark, sf_dir):
    return profile.missing_profile(tables.house_like(spark, sf_dir), mode="total",
                                   with_ratio=False)




# ------------------------------------------------- shared pieces of the SQL

# Category domains of the driver tables (TPC-H), used only to
# spell out the one-hot columns in the oracle SQL.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]

NUM_FEATS = ["acctbal", "nation", "const"]
CAT_FEATS = ["segment", "priority", "status", "rare"]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def house_parts(spark, sf_dir):
    return tables.house_train_test(spark, sf_dir)


def whole_house(spark, sf_dir):
    """Train and test rows together, features only."""
    return tables.house_like(spark, sf_dir).drop("origin", "target")


def union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------- P1-P8 selection

@register("p1_target_kept", with_house("SELECT * FROM train WHERE target IS NOT NULL"))
def p1_target_kept(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return profile.split_missing_target(train, "target")[0]


@register("p1_target_removed", with_house("SELECT * FROM train WHERE target IS NULL"))
def p1_target_removed(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return profile.split_missing_target(train, "target")[1]


@register("p2_missing_flags", with_house(
    "SELECT id, " + ", ".join(f"{c} IS NULL AS {c}_isna" for c in HOUSE_ALL if c != "id")
    + " FROM house"))
def p2_missing_flags(spark, sf_dir):
    return profile.missing_flags(tables.house_like(spark, sf_dir), key="id")


@register("p3_numeric_columns", with_house("SELECT id, acctbal, nation, const, target FROM house"))
def p3_numeric_columns(spark, sf_dir):
    return profile.select_kind(tables.house_like(spark, sf_dir), "numeric")


@register("p3_category_columns",
          with_house("SELECT id, segment, priority, status, rare, origin FROM house"))
def p3_category_columns(spark, sf_dir):
    return profile.select_kind(tables.house_like(spark, sf_dir), "category", keep=("id",))


@register("p4_features", with_house(
    "SELECT id, acctbal, nation, segment, priority, status, rare, const FROM train"))
def p4_features(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    feats, _t = profile.features_and_target(train, key="id")
    return train.select("id", *feats)


@register("p5_test_part", with_house("SELECT *, CAST(NULL AS DOUBLE) AS target FROM test"))
def p5_test_part(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    return align.take_part(align.stack_tagged(train, test, origin="src"), "test", origin="src")


@register("p6_row_numbers", with_house(
    "SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS \"row\" FROM house"))
def p6_row_numbers(spark, sf_dir):
    h = tables.house_like(spark, sf_dir).select("id")
    return align.consecutive_index(h, ["id"], out="row")


@register("p7_drop_columns", with_house("SELECT * EXCLUDE (rare, const, target), CASE WHEN origin = 'train' THEN target END AS target FROM house"))
def p7_drop_columns(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    return align.stack_tagged(*profile.drop_columns(train, test, columns=["rare", "const"]))


def _fit_standard(spark, sf_dir, keep_target_separate=True, method="standardize"):
    train, test = house_parts(spark, sf_dir)
    enc = encode.TableEncoder(method, keep_target_separate, target="target", key="id")
    return enc.fit(train), train, test


@register("p8_affine_back", with_house(f"SELECT id, round(acctbal, {R}) AS acctbal FROM test"))
def p8_affine_back(spark, sf_dir):
    fitted, _, test = _fit_standard(spark, sf_dir)
    enc = fitted.transform(test)
    back = rowexpr.affine(F.col("num__acctbal"), fitted.scale["acctbal"], fitted.shift["acctbal"])
    return enc.select("id", rnd(back).alias("acctbal"))


# ----------------------------------------------------- A4-A9 statistics

def _per_column(stat_sql: str, cols: list[str], table: str = "train") -> str:
    return union_sql([f"SELECT {lit(c)} AS \"column\", {stat_sql.format(c=c)} FROM {table}"
                      for c in cols])


@register("a4_mean", with_house(_per_column(f"round(avg({{c}}), {R}) AS mean", NUM_FEATS + ["target"])))
def a4_mean(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    m = stats.moments(train, NUM_FEATS + ["target"])
    return _long(spark, [(c, _r(m[c]["mean"])) for c in m], "column string, mean double")


@register("a5_median", with_house(_per_column(
    f"round(CAST(median({{c}}) AS DOUBLE), {R}) AS median", NUM_FEATS + ["target", "id"])))
def a5_median(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    med = stats.exact_medians(train, NUM_FEATS + ["target", "id"])
    return _long(spark, [(c, _r(v)) for c, v in med.items()], "column string, median double")


@register("a6_mode", with_house(union_sql([
    f"SELECT {lit(c)} AS \"column\", (SELECT {c} FROM train WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode" for c in CAT_FEATS])))
def a6_mode(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    m = stats.modes(train, CAT_FEATS)
    return _long(spark, list(m.items()), "column string, mode string")


@register("a7_mean_std", with_house(_per_column(
    f"round(avg({{c}}), {R}) AS mean, round(stddev_pop({{c}}), {R}) AS std",
    NUM_FEATS + ["target"])))
def a7_mean_std(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    m = stats.moments(train, NUM_FEATS + ["target"])
    return _long(spark, [(c, _r(m[c]["mean"]), _r(m[c]["std"])) for c in m],
                 "column string, mean double, std double")


@register("a8_min_range", with_house(_per_column(
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) - min({c}) AS DOUBLE) AS range",
    NUM_FEATS + ["target"])))
def a8_min_range(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    m = stats.moments(train, NUM_FEATS + ["target"])
    return _long(spark, [(c, m[c]["min"], m[c]["max"] - m[c]["min"]) for c in m],
                 "column string, min double, range double")


@register("a9_categories", with_house(
    "SELECT \"column\", CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY category) - 1 "
    "AS INTEGER) AS pos, category FROM (" + union_sql([
        f"SELECT DISTINCT {lit(c)} AS \"column\", {c} AS category FROM train "
        f"WHERE {c} IS NOT NULL" for c in CAT_FEATS]) + ")"))
def a9_categories(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    cats = stats.categories(train, CAT_FEATS)
    return _long(spark, [(c, i, v) for c, vs in cats.items() for i, v in enumerate(vs)],
                 "column string, pos int, category string")


def _r(v, d=R):
    return None if v is None else round(float(v), d)


def _long(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------- F1-F6 prune / fill

@register("f1_pruned_columns", with_house(
    "SELECT * FROM (" + _profile_sql("train", NUM_FEATS[:0] + [c for c in HOUSE_ALL if c not in
                                                                 ("id", "target", "origin")],
                                     "omission") + ") WHERE ratio >= 0.5"))
def f1_pruned_columns(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    return profile.prune_sparse_columns(train, test, 0.5, target="target", key="id")[0]


@register("f1_pruned_test", with_house("SELECT * EXCLUDE (rare) FROM test"))
def f1_pruned_test(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    return profile.prune_sparse_columns(train, test, 0.5, target="target", key="id")[2]


def _fill_sql(table: str, stat: str, source: str = "train") -> str:
    # nation has nothing missing and stays a whole number
    num = ", ".join(c if c == "nation" else
        f"round(coalesce(CAST({c} AS DOUBLE), (SELECT CAST({stat}({c}) AS DOUBLE) FROM {source})), {R}) AS {c}"
        for c in NUM_FEATS)
    cat = ", ".join(
        f"coalesce({c}, (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in CAT_FEATS)
    return f"SELECT id, {num}, {cat} FROM {table}"


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[rnd(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("f2_fill_test_median", with_house(_fill_sql("test", "median")))
def f2_fill_test_median(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    fitted = impute.Imputer("median", "mode", exclude=("id", "target")).fit(train)
    out = fitted.transform(test)
    return _rounded(out, NUM_FEATS).select("id", *NUM_FEATS, *CAT_FEATS)


@register("f3_fill_self_mean", with_house(_fill_sql("train", "avg")))
def f3_fill_self_mean(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    fitted = impute.Imputer("mean", "mode", exclude=("id", "target")).fit(train)
    return _rounded(fitted.transform(train), NUM_FEATS).select("id", *NUM_FEATS, *CAT_FEATS)


@register("f4_fill_from_other", with_house(_fill_sql("test", "avg")))
def f4_fill_from_other(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    fitted = impute.Imputer("mean", "mode", columns=NUM_FEATS + CAT_FEATS).fit(train)
    return _rounded(fitted.transform(test), NUM_FEATS).select("id", *NUM_FEATS, *CAT_FEATS)


@register("f5_constant_fill", with_house(
    "SELECT id, acctbal, nation, " + ", ".join(
        f"coalesce({c}, 'missing_value') AS {c}" for c in CAT_FEATS) + ", const FROM house"))
def f5_constant_fill(spark, sf_dir):
    return impute.fill_constant(whole_house(spark, sf_dir))


@register("f6_empty_to_missing", with_house(
    "SELECT id, acctbal, nation, " + ", ".join(
        f"CASE WHEN {c} = '' THEN 'missing_value' ELSE {c} END AS {c}" for c in CAT_FEATS)
    + ", const FROM house"))
def f6_empty_to_missing(spark, sf_dir):
    return impute.empty_to_missing(whole_house(spark, sf_dir))


# ------------------------------------------------ F7-F14 scale and encode

def _num_sql(method: str, columns: list[str] | None = None) -> str:
    out = []
    for c in (columns or NUM_FEATS):
        if method == "standardize":
            e = (f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM train)) / "
                 f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM train)")
        elif method == "normalize":
            e = (f"(CAST({c} AS DOUBLE) - (SELECT min({c}) FROM train)) / "
                 f"(SELECT CASE WHEN max({c}) = min({c}) THEN 1.0 ELSE max({c}) - min({c}) END FROM train)")
        else:
            e = f"CAST({c} AS DOUBLE)"
        out.append(f"round({e}, {R}) AS {q('num__' + c)}")
    return ", ".join(out)


def _train_categories() -> dict[str, list[str]]:
    """Categories the train part holds after the missing label is applied
    (MACHINERY is kept out of train by the view)."""
    seg = sorted([s for s in SEGMENTS if s != "MACHINERY"] + ["missing_value"])
    return {"segment": seg, "priority": sorted(PRIORITIES + ["missing_value"]),
            "status": sorted(STATUSES), "rare": sorted(PRIORITIES + ["missing_value"])}


def _cat_sql() -> str:
    out = []
    for c, vals in _train_categories().items():
        filled = f"coalesce(nullif({c}, ''), 'missing_value')"
        for v in vals:
            out.append(f"CASE WHEN {filled} = {lit(v)} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS {q(f'cat__{c}_{v}')}")
    return ", ".join(out)


def _encoded(spark, sf_dir, method, table="test"):
    fitted, train, test = _fit_standard(spark, sf_dir, method=method)
    out = fitted.transform(test if table == "test" else train)
    return _rounded(out, [f"num__{c}" for c in NUM_FEATS])


@register("f7_standardize", with_house(f"SELECT id, {_num_sql('standardize')} FROM test"))
def f7_standardize(spark, sf_dir):
    return _encoded(spark, sf_dir, "standardize").select("id", *[f"num__{c}" for c in NUM_FEATS])


@register("f8_normalize", with_house(f"SELECT id, {_num_sql('normalize')} FROM test"))
def f8_normalize(spark, sf_dir):
    return _encoded(spark, sf_dir, "normalize").select("id", *[f"num__{c}" for c in NUM_FEATS])


@register("f9_passthrough", with_house(f"SELECT id, {_num_sql('none')} FROM test"))
def f9_passthrough(spark, sf_dir):
    return _encoded(spark, sf_dir, "none").select("id", *[f"num__{c}" for c in NUM_FEATS])


@register("f10_onehot_train_fitted",
          with_house(f"SELECT id, {_num_sql('standardize')}, {_cat_sql()} FROM test"))
def f10_onehot_train_fitted(spark, sf_dir):
    return _encoded(spark, sf_dir, "standardize")


@register("f10_onehot_streamed", ORACLE["f10_onehot_train_fitted"])
def f10_onehot_streamed(spark, sf_dir):
    """F10 through Structured Streaming: the encoder is fitted on train (a
    batch job); the test part arrives as files and is encoded by a stream
    (stateless projection, checkpointed, ``availableNow``); the sink read
    back must equal the batch result."""
    from tabprep.streaming import score
    fitted, _, test = _fit_standard(spark, sf_dir, method="standardize")
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    test.write.parquet(src)
    stream = score.read_table_stream(spark, src, test.schema)
    q = score.score_stream(spark, stream, [fitted.transform], sink)
    q.awaitTermination()
    return _rounded(spark.read.parquet(sink), [f"num__{c}" for c in NUM_FEATS])


@register("f11_train_encoded", with_house(
    f"SELECT id, {_num_sql('standardize')}, {_cat_sql()}, target FROM train"))
def f11_train_encoded(spark, sf_dir):
    return _encoded(spark, sf_dir, "standardize", table="train")


@register("f12_target_scaled", with_house(
    f"SELECT id, round((target - (SELECT avg(target) FROM train)) / "
    f"(SELECT stddev_pop(target) FROM train), {R}) AS target FROM train"))
def f12_target_scaled(spark, sf_dir):
    fitted, train, _ = _fit_standard(spark, sf_dir, keep_target_separate=False)
    return fitted.transform(train).select("id", rnd(F.col("target")).alias("target"))


@register("f12_target_normalized", with_house(
    f"SELECT id, round((target - (SELECT min(target) FROM train)) / "
    f"(SELECT max(target) - min(target) FROM train), {R}) AS target FROM train"))
def f12_target_normalized(spark, sf_dir):
    fitted, train, _ = _fit_standard(spark, sf_dir, keep_target_separate=False, method="normalize")
    return fitted.transform(train).select("id", rnd(F.col("target")).alias("target"))


@register("f12_target_none", with_house("SELECT id, target FROM train"))
def f12_target_none(spark, sf_dir):
    fitted, train, _ = _fit_standard(spark, sf_dir, keep_target_separate=False, method="none")
    return fitted.transform(train).select("id", "target")


@register("f12_target_constants", with_house(
    f"SELECT round(stddev_pop(target), {R}) AS sigma, round(avg(target), {R}) AS mu FROM train"))
def f12_target_constants(spark, sf_dir):
    fitted, _, _ = _fit_standard(spark, sf_dir, keep_target_separate=False)
    return spark.createDataFrame([(_r(fitted.sigma), _r(fitted.mu))], "sigma double, mu double")


@register("f13_target_raw", with_house("SELECT id, target FROM train"))
def f13_target_raw(spark, sf_dir):
    fitted, train, _ = _fit_standard(spark, sf_dir, keep_target_separate=True)
    return fitted.transform(train).select("id", "target")


@register("f14_inverse_target", with_house(f"SELECT id, round(target, {R}) AS target FROM train"))
def f14_inverse_target(spark, sf_dir):
    fitted, train, _ = _fit_standard(spark, sf_dir, keep_target_separate=False)
    scaled = fitted.transform(train)
    return scaled.select("id", rnd(fitted.inverse_target(F.col("target"))).alias("target"))


# ------------------------------------------------------ F15-F16 dummies

def _dummy_sql(cols_vals: dict[str, list[str]], prefix=None, sep="_", dummy_na=False,
               drop_first=False, cast="BOOLEAN") -> str:
    out = []
    for c, vals in cols_vals.items():
        p = (prefix or {}).get(c, c)
        for v in (vals[1:] if drop_first else vals):
            out.append(f"CAST(coalesce({c} = {lit(v)}, false) AS {cast}) AS {q(p + sep + v)}")
        if dummy_na:
            out.append(f"CAST({c} IS NULL AS {cast}) AS {q(p + sep + 'nan')}")
    return ", ".join(out)


# categories of the whole table ('' is a value of priority)
HOUSE_VALUES = {"segment": SEGMENTS, "priority": sorted([""] + PRIORITIES),
               "status": STATUSES, "rare": PRIORITIES}
HOUSE_OTHERS = "id, acctbal, nation, const"


@register("f15_dummies", with_house(f"SELECT {HOUSE_OTHERS}, {_dummy_sql(HOUSE_VALUES)} FROM house"))
def f15_dummies(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir))


@register("f15a_dummy_na", with_house(
    f"SELECT {HOUSE_OTHERS}, {_dummy_sql(HOUSE_VALUES, dummy_na=True)} FROM house"))
def f15a_dummy_na(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), dummy_na=True)


@register("f15b_drop_first", with_house(
    f"SELECT {HOUSE_OTHERS}, {_dummy_sql(HOUSE_VALUES, drop_first=True)} FROM house"))
def f15b_drop_first(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), drop_first=True)


@register("f15c_prefix", with_house(
    f"SELECT {HOUSE_OTHERS}, "
    f"{_dummy_sql(HOUSE_VALUES, prefix={'segment': 'seg', 'priority': 'pri'}, sep='=')} FROM house"))
def f15c_prefix(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), prefix={"segment": "seg", "priority": "pri"}, prefix_sep="=")


@register("f15d_columns", with_house(
    "SELECT id, acctbal, nation, segment, priority, rare, const, "
    f"{_dummy_sql({'status': STATUSES})} FROM house"))
def f15d_columns(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), columns=["status"])


@register("f15e_dtype_int32", with_house(
    f"SELECT {HOUSE_OTHERS}, {_dummy_sql(HOUSE_VALUES, cast='INTEGER')} FROM house"))
def f15e_dtype_int32(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), dtype="int32")


@register("f15f_sparse")
def f15f_sparse(spark, sf_dir):
    return encode.dummies(whole_house(spark, sf_dir), dummy_na=True, sparse=True)


def _dummy_array_sql(cols_vals: dict[str, list[str]]) -> str:
    out = []
    for c, vals in cols_vals.items():
        items = [f"CAST(coalesce({c} = {lit(v)}, false) AS DOUBLE)" for v in vals]
        items.append(f"CAST({c} IS NULL AS DOUBLE)")
        out.append(f"[{', '.join(items)}] AS {q(c)}")
    return ", ".join(out)


@register("f15f_sparse_as_arrays", with_house(
    f"SELECT {HOUSE_OTHERS}, {_dummy_array_sql(HOUSE_VALUES)} FROM house"))
def f15f_sparse_as_arrays(spark, sf_dir):
    """F15f's sparse vectors read back as arrays, so SQL can check them."""
    from pyspark.ml.functions import vector_to_array
    sp = f15f_sparse(spark, sf_dir)
    return sp.select(*[vector_to_array(c).alias(c) if c in HOUSE_VALUES else F.col(c)
                       for c in sp.columns])


JOINT_VALUES = {"segment": SEGMENTS, "priority": sorted([""] + PRIORITIES),
                "status": STATUSES, "rare": PRIORITIES}


@register("f16_joint_encoding", with_house(
    "SELECT id, acctbal, nation, const, CASE WHEN origin = 'train' THEN target END AS target, origin, "
    f"{_dummy_sql(JOINT_VALUES, dummy_na=True, cast='INTEGER')} FROM house"))
def f16_joint_encoding(spark, sf_dir):
    """Both halves, each as it is taken back out of the stack."""
    train, test = house_parts(spark, sf_dir)
    return align.stack_tagged(*encode.joint_dummies(train, test, dummy_na=True, dtype="int32"))


# ------------------------------------------------- F17-F19 image / vector

IMG = f"WITH images AS ({tables.IMAGES_SQL})\n"


@register("f17_pixel_scale", IMG + (
    "SELECT vec_id, CAST(i AS INTEGER) AS pos, round(v, 9) AS value FROM ("
    "SELECT vec_id, unnest(generate_series(0, len(flatten(pixels)) - 1)) AS i, "
    "unnest(list_transform(flatten(pixels), lambda x: x / 255.0)) AS v FROM images)"))
def f17_pixel_scale(spark, sf_dir):
    img = tables.images(spark, sf_dir)
    flat = encode.flatten_image(encode.scale_pixels(F.col("pixels")))
    return img.select("vec_id", F.posexplode(flat).alias("pos", "value")).select(
        "vec_id", "pos", F.round("value", 9).alias("value"))


@register("f18_flatten", IMG + (
    "SELECT vec_id, CAST(i AS INTEGER) AS pos, v AS pixel FROM ("
    "SELECT vec_id, unnest(generate_series(0, len(flatten(pixels)) - 1)) AS i, "
    "unnest(flatten(pixels)) AS v FROM images)"))
def f18_flatten(spark, sf_dir):
    img = tables.images(spark, sf_dir)
    return img.select("vec_id", F.posexplode(encode.flatten_image(F.col("pixels")))
                      .alias("pos", "pixel"))


@register("f19_assemble")
def f19_assemble(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    filled = impute.Imputer(exclude=("id", "target")).fit(train).transform(train)
    fitted = encode.TableEncoder("standardize", target="target", key="id").fit(filled)
    enc = fitted.transform(filled)
    return encode.assemble(enc, fitted.output_columns, keep=("id", "target"))


def _f19_sql() -> str:
    """Train filled from its own medians and modes, then standardized and
    one-hot encoded, assembled into one list per row."""
    num = ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(median({c}) AS DOUBLE) FROM train)) AS {c}"
        for c in NUM_FEATS)
    cat = ", ".join(
        f"coalesce({c}, (SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in CAT_FEATS)
    items = []
    for c in NUM_FEATS:
        items.append(f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT CASE WHEN "
                     f"stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM filled), {R})")
    # categories of the filled train part (no NULL left; '' is the label)
    cats = {"segment": [v for v in SEGMENTS if v != "MACHINERY"],
            "priority": sorted(PRIORITIES + ["missing_value"]),
            "status": STATUSES, "rare": PRIORITIES}
    for c, vals in cats.items():
        for v in vals:
            items.append(f"CAST(CASE WHEN coalesce(nullif({c}, ''), 'missing_value') = {lit(v)} "
                         "THEN 1.0 ELSE 0.0 END AS DOUBLE)")
    return with_house(
        f"SELECT id, target, [{', '.join(items)}] AS features FROM filled",
        f",\nfilled AS (SELECT id, {num}, {cat}, target FROM train)")


@register("f19_assemble_as_arrays", _f19_sql())
def f19_assemble_as_arrays(spark, sf_dir):
    """F19's vectors read back as arrays (rounded), so SQL can check them."""
    from pyspark.ml.functions import vector_to_array
    a = f19_assemble(spark, sf_dir)
    return a.select("id", "target", F.transform(vector_to_array("features"),
                                                lambda x: F.round(x, R)).alias("features"))


# --------------------------------------------------- U1-U3 set operations

@register("u1_stack", with_house(
    "SELECT *, 'train' AS origin FROM train UNION ALL BY NAME SELECT *, 'test' AS origin FROM test"))
def u1_stack(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    return align.stack_tagged(train, test)


@register("u2_glue", with_house(
    f"SELECT coalesce(a.id, b.id) AS id, a.{q('num__acctbal')}, b.target FROM "
    f"(SELECT id, {_num_sql('standardize', ['acctbal'])} FROM train) a "
    "FULL OUTER JOIN (SELECT id, target FROM train WHERE target IS NOT NULL) b ON a.id = b.id"))
def u2_glue(spark, sf_dir):
    """Scaled features and the kept targets, two keyed tables side by side."""
    fitted, train, _ = _fit_standard(spark, sf_dir)
    left = _rounded(fitted.transform(train), ["num__acctbal"]).select("id", "num__acctbal")
    right = profile.split_missing_target(train, "target")[0].select("id", "target")
    return align.glue_columns(left, right, "id")


@register("u3_stats_table", with_house(
    "SELECT p.\"column\", p.missing, p.\"rows\", p.ratio, s.mean, s.std FROM ("
    + _profile_sql("train", NUM_FEATS + ["target"], "total") + ") p JOIN ("
    + _per_column(f"round(avg({{c}}), {R}) AS mean, round(stddev_pop({{c}}), {R}) AS std",
                  NUM_FEATS + ["target"]) + ") s ON p.\"column\" = s.\"column\""))
def u3_stats_table(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    prof = profile.missing_profile(train, "total", NUM_FEATS + ["target"])
    mom = a7_mean_std(spark, sf_dir)
    return prof.join(mom, "column")


# ------------------------------------------------------ D1-D4 splits



@register("d1_holdout", with_house(
    f"SELECT id, ({sql_key_hash('id')}) % 100 < 80 AS is_train FROM house"))
def d1_holdout(spark, sf_dir):
    h = tables.house_like(spark, sf_dir)
    return h.select("id", split.holdout_flag("id", 80).alias("is_train"))


@register("d2_folds", with_house(
    f"SELECT id, CAST(({sql_key_hash('id', 1)}) % 5 AS INTEGER) AS fold FROM train"))
def d2_folds(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return split.with_folds(train, "id", 5).select("id", "fold")


@register("d3_epoch_order", with_house(
    f"SELECT id, {sql_key_hash('id', split.EPOCH_SALT + 1)} AS shuffle FROM train"))
def d3_epoch_order(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return train.select("id", split.epoch_order("id", 1).alias("shuffle"))


@register("d4_batches", with_house(
    "SELECT id, pos, CAST(floor(pos / 64) AS BIGINT) AS batch FROM ("
    f"SELECT id, CAST(row_number() OVER (ORDER BY {sql_key_hash('id', split.EPOCH_SALT + 1)}, id) - 1 "
    "AS BIGINT) AS pos FROM train)"))
def d4_batches(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return split.with_batches(train.select("id"), "id", 64, epoch=1)


# ------------------------------------- A10-A15, M8-M12 scoring and metrics

# Class scores for the evaluation operators come from a given linear scorer
# over the 64-dim embeddings: weight (k, j) = (((64k + j) * 37) mod 101 - 50) / 50,
# no bias.  Exact in both engines.
N_CLASSES, DIM = 10, 64


def given_weights() -> list[list[float]]:
    return [[(((DIM * k + j) * 37) % 101 - 50) / 50.0 for j in range(DIM)]
            for k in range(N_CLASSES)]


SCORES_SQL = f"""
WITH cells AS (
  SELECT vec_id, label, unnest(embedding) AS v,
         unnest(generate_series(0, len(embedding) - 1)) AS j FROM embeddings),
weights AS (
  SELECT i // {DIM} AS k, i % {DIM} AS j, CAST((((i * 37) % 101) - 50) AS DOUBLE) / 50.0 AS w
  FROM range({N_CLASSES * DIM}) t(i)),
scores AS (
  SELECT c.vec_id, c.label, w.k, sum(CAST(c.v AS DOUBLE) * w.w) AS s
  FROM cells c JOIN weights w ON c.j = w.j GROUP BY c.vec_id, c.label, w.k),
ranked AS (
  SELECT vec_id, label, k, s, max(s) OVER (PARTITION BY vec_id) AS m FROM scores),
per_row AS (
  SELECT vec_id, label, min(k) FILTER (WHERE s = m) AS pred,
         ln(sum(exp(s - m))) + max(m) - max(s) FILTER (WHERE k = label) AS ce
  FROM ranked GROUP BY vec_id, label)
"""


def _scored(spark, sf_dir):
    e = tables.load(spark, sf_dir, "embeddings")
    s = rowexpr.class_scores(F.col("embedding"), given_weights())
    return e.select("vec_id", "label", s.alias("scores"))


@register("m8_class_scores", SCORES_SQL + f"SELECT vec_id, k, round(s, {R}) AS score FROM scores")
def m8_class_scores(spark, sf_dir):
    sc = _scored(spark, sf_dir)
    return sc.select("vec_id", F.posexplode("scores").alias("k", "score")).select(
        "vec_id", F.col("k").cast("bigint").alias("k"), rnd(F.col("score")).alias("score"))


@register("m10_argmax", SCORES_SQL + "SELECT vec_id, CAST(pred AS INTEGER) AS pred FROM per_row")
def m10_argmax(spark, sf_dir):
    return _scored(spark, sf_dir).select("vec_id", rowexpr.argmax(F.col("scores")).alias("pred"))


@register("m11_cross_entropy", SCORES_SQL + f"SELECT vec_id, round(ce, {R}) AS ce FROM per_row")
def m11_cross_entropy(spark, sf_dir):
    sc = _scored(spark, sf_dir)
    return sc.select("vec_id", rnd(rowexpr.cross_entropy(F.col("scores"), F.col("label"))).alias("ce"))


@register("a10_accuracy", SCORES_SQL + (
    "SELECT CAST(count_if(pred = label) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total, "
    "CAST(count_if(pred = label) AS DOUBLE) / count(*) AS accuracy FROM per_row"))
def a10_accuracy(spark, sf_dir):
    sc = _scored(spark, sf_dir).select("label", rowexpr.argmax(F.col("scores")).alias("pred"))
    return metrics.accuracy(sc, "pred", "label")


@register("a15_accumulator", SCORES_SQL + (
    "SELECT label, CAST(count_if(pred = label) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS n, "
    f"round(sum(ce), 4) AS loss_sum FROM per_row GROUP BY label"))
def a15_accumulator(spark, sf_dir):
    sc = _scored(spark, sf_dir)
    rows = sc.select("label", rowexpr.argmax(F.col("scores")).alias("pred"),
                     rowexpr.cross_entropy(F.col("scores"), F.col("label")).alias("ce"))
    acc = metrics.accumulate(rows, {"correct": (F.col("pred") == F.col("label")).cast("bigint"),
                                    "n": F.lit(1).cast("bigint"), "loss_sum": F.col("ce")},
                             by=["label"])
    return acc.select("label", "correct", "n", F.round("loss_sum", 4).alias("loss_sum"))


# mean predictor errors on the hold-out: prediction = train-part target mean
HOLD = f"({sql_key_hash('id')}) % 100 < 80"
ERR_SQL = (
    f", kept AS (SELECT id, target, {HOLD} AS is_train FROM train WHERE target IS NOT NULL),\n"
    "pred AS (SELECT k.*, (SELECT avg(target) FROM kept WHERE is_train) AS p FROM kept k)")


def _errors_sql(by: str) -> str:
    return with_house(
        f"SELECT {by}, CAST(count(*) AS BIGINT) AS n, "
        f"round(sqrt(avg((p - target) * (p - target))), 4) AS rmse, "
        f"round(avg((p - target) * (p - target)) / 1e6, 4) AS mse_m, "
        f"round(avg((p - target) * (p - target)) / 2 / 1e6, 4) AS half_mse_m, "
        f"round(avg(abs(p - target)), 4) AS mae FROM pred GROUP BY {by}", ERR_SQL)


def _mean_predictions(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    kept = profile.split_missing_target(train, "target")[0].select(
        "id", "target", split.holdout_flag("id").alias("is_train"))
    mu = kept.where("is_train").agg(F.avg("target")).first()[0]
    return kept.withColumn("p", F.lit(mu))


@register("a11_rmse_holdout", _errors_sql("is_train"))
def a11_rmse_holdout(spark, sf_dir):
    err = metrics.regression_errors(_mean_predictions(spark, sf_dir), "p", "target",
                                    by=["is_train"])
    return err.select("is_train", "n", F.round("rmse", 4).alias("rmse"),
                      F.round(F.col("mse") / 1e6, 4).alias("mse_m"),
                      F.round(F.col("half_mse") / 1e6, 4).alias("half_mse_m"),
                      F.round("mae", 4).alias("mae"))


S4_W, S4_B = [2.0, -3.4], 4.2
S4_SQL = "WITH s4 AS (" + tables.synthetic_regression_sql("orders", "o_orderkey", S4_W, S4_B) + ")\n"


def _s4(spark, sf_dir):
    return tables.synthetic_regression(tables.load(spark, sf_dir, "orders"), "o_orderkey",
                                       S4_W, S4_B)


@register("a12_half_mse", S4_SQL + (
    f"SELECT round(avg(power({S4_B} + {S4_W[0]} * x0 + {S4_W[1]} * x1 - y, 2)) / 2, 9) AS half_mse, "
    f"round(avg(power({S4_B} + {S4_W[0]} * x0 + {S4_W[1]} * x1 - y, 2)), 9) AS mse FROM s4"))
def a12_half_mse(spark, sf_dir):
    s4 = _s4(spark, sf_dir)
    p = rowexpr.linear_score([F.col("x0"), F.col("x1")], S4_W, S4_B)
    e = metrics.regression_errors(s4.select(p.alias("p"), "y"), "p", "y")
    return e.select(F.round("half_mse", 9).alias("half_mse"), F.round("mse", 9).alias("mse"))


@register("s4_synthetic", S4_SQL + f"SELECT id, round(x0, {R}) AS x0, round(x1, {R}) AS x1, "
          f"round(y, {R}) AS y FROM s4")
def s4_synthetic(spark, sf_dir):
    s4 = _s4(spark, sf_dir)
    return s4.select("id", *[rnd(F.col(c)).alias(c) for c in ("x0", "x1", "y")])


@register("m8_linear_score", S4_SQL + (
    f"SELECT id, round({S4_B} + {S4_W[0]} * x0 + {S4_W[1]} * x1, {R}) AS pred FROM s4"))
def m8_linear_score(spark, sf_dir):
    s4 = _s4(spark, sf_dir)
    return s4.select("id", rnd(rowexpr.linear_score([F.col("x0"), F.col("x1")], S4_W, S4_B))
                     .alias("pred"))


# a given 2-3-1 ReLU network (Linear, ReLU, Linear)
TINY_NET = [([[0.5, -1.0], [1.5, 0.25], [-0.75, 0.8]], [0.1, -0.2, 0.3]),
            ([[1.0, -2.0, 0.5]], [0.05])]


def _tiny_net_sql() -> str:
    (w1, b1), (w2, b2) = TINY_NET
    hs = [f"greatest({b1[i]!r} + ({w1[i][0]!r}) * x0 + ({w1[i][1]!r}) * x1, 0.0)" for i in range(3)]
    out = f"{b2[0]!r} + " + " + ".join(f"({w2[0][i]!r}) * {hs[i]}" for i in range(3))
    return out


@register("m9_dense_score", S4_SQL + f"SELECT id, round({_tiny_net_sql()}, {R}) AS out FROM s4")
def m9_dense_score(spark, sf_dir):
    s4 = _s4(spark, sf_dir)
    x = F.array(F.col("x0"), F.col("x1"))
    out = F.element_at(rowexpr.dense_layers(x, TINY_NET), 1)
    return s4.select("id", rnd(out).alias("out"))


@register("m12_relu_loss", S4_SQL + (
    f"SELECT id, round(greatest(x0, 0.0), {R}) AS relu_x0, "
    f"round(power({S4_B} + {S4_W[0]} * x0 + {S4_W[1]} * x1 - y, 2) / 2, 12) AS loss FROM s4"))
def m12_relu_loss(spark, sf_dir):
    s4 = _s4(spark, sf_dir)
    p = rowexpr.linear_score([F.col("x0"), F.col("x1")], S4_W, S4_B)
    return s4.select("id", rnd(rowexpr.relu(F.col("x0"))).alias("relu_x0"),
                     F.round(rowexpr.squared_loss(p, F.col("y")), 12).alias("loss"))


# ------------------------------------------------------------ M1, M2 linear



@register("m1_linear_fit", S4_SQL + f""", m AS (
  SELECT covar_pop(x0, x0) AS c00, covar_pop(x1, x1) AS c11, covar_pop(x0, x1) AS c01,
         covar_pop(x0, y) AS c0y, covar_pop(x1, y) AS c1y,
         avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my FROM s4),
w AS (SELECT (c11 * c0y - c01 * c1y) / (c00 * c11 - c01 * c01) AS w0,
             (c00 * c1y - c01 * c0y) / (c00 * c11 - c01 * c01) AS w1, m0, m1, my FROM m)
SELECT round(w0, {R}) AS w0, round(w1, {R}) AS w1, round(my - w0 * m0 - w1 * m1, {R}) AS b FROM w""")
def m1_linear_fit(spark, sf_dir):
    data = models.vectorize(_s4(spark, sf_dir), ["x0", "x1"], keep=("y",))
    m = models.linear_regression(label="y").fit(data)
    w = m.coefficients.toArray().tolist()
    return spark.createDataFrame([(_r(w[0]), _r(w[1]), _r(m.intercept))],
                                 "w0 double, w1 double, b double")


M2_LR, M2_EPOCHS = 0.03, 3


def _m2_sql() -> str:
    steps = ["e0 AS (SELECT CAST(0.0 AS DOUBLE) AS w0, CAST(0.0 AS DOUBLE) AS w1, "
             "CAST(0.0 AS DOUBLE) AS b)"]
    for t in range(1, M2_EPOCHS + 1):
        p = f"e{t - 1}"
        r = (f"((SELECT b FROM {p}) + (SELECT w0 FROM {p}) * x0 + (SELECT w1 FROM {p}) * x1 - y)")
        steps.append(
            f"e{t} AS (SELECT (SELECT w0 FROM {p}) - {M2_LR} * avg({r} * x0) AS w0, "
            f"(SELECT w1 FROM {p}) - {M2_LR} * avg({r} * x1) AS w1, "
            f"(SELECT b FROM {p}) - {M2_LR} * avg({r}) AS b FROM s4)")
    rows = []
    for t in range(1, M2_EPOCHS + 1):
        r = (f"((SELECT b FROM e{t}) + (SELECT w0 FROM e{t}) * x0 + (SELECT w1 FROM e{t}) * x1 - y)")
        rows.append(f"SELECT {t} AS epoch, round((SELECT w0 FROM e{t}), {R}) AS w0, "
                    f"round((SELECT w1 FROM e{t}), {R}) AS w1, round((SELECT b FROM e{t}), {R}) AS b, "
                    f"round(avg({r} * {r}) / 2, {R}) AS loss FROM s4")
    return S4_SQL.rstrip("\n") + ",\n" + ",\n".join(steps) + "\n" + union_sql(rows)


@register("m2_gd_linear", _m2_sql())
def m2_gd_linear(spark, sf_dir):
    out = sgd.linear_gd(_s4(spark, sf_dir), ["x0", "x1"], "y", lr=M2_LR, epochs=M2_EPOCHS)
    return spark.createDataFrame(
        [(o["epoch"], _r(o["w"][0]), _r(o["w"][1]), _r(o["b"]), _r(o["loss"])) for o in out],
        "epoch int, w0 double, w1 double, b double, loss double")


# ------------------------------------------ M3, M4 classifiers (embeddings)

def _embedding_parts(spark, sf_dir):
    e = tables.load(spark, sf_dir, "embeddings")
    data = models.vectorize(e, "embedding", keep=("vec_id", "label"))
    return split.holdout(data, "vec_id", 80)


@register("m3_softmax_fit")
def m3_softmax_fit(spark, sf_dir):
    fit_part, test_part = _embedding_parts(spark, sf_dir)
    est = models.softmax_regression(label="label", max_iter=50)
    return models.fit_score(est, fit_part, test_part, keep=("vec_id", "label"))


@register("m4_perceptron_fit")
def m4_perceptron_fit(spark, sf_dir):
    fit_part, test_part = _embedding_parts(spark, sf_dir)
    dim = len(fit_part.select("features").first()[0])
    est = models.perceptron([dim, 256, N_CLASSES], label="label", max_iter=50)
    return models.fit_score(est, fit_part, test_part, keep=("vec_id", "label"))


def _sgd_classifier(spark, sf_dir, hidden, lr, step, reduction):
    e = tables.load(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    fit_part, test_part = split.holdout(e, "vec_id", 80)
    res = sgd.train_dense(spark, fit_part, "x", "label", hidden, key="vec_id",
                          valid=test_part, out_dim=N_CLASSES, loss="softmax", lr=lr,
                          epochs=10, batch_size=256, step=step, gamma=0.2,
                          reduction=reduction, rows_per_part=5_000)
    return spark.createDataFrame(
        [(c["epoch"], c["train_accuracy"], c["valid_accuracy"]) for c in res.curve],
        "epoch int, train_accuracy double, valid_accuracy double")


@register("m3_softmax_sgd")
def m3_softmax_sgd(spark, sf_dir):
    """The reference's softmax run: SGD lr 0.05 on the batch-summed loss,
    batch 256, 10 epochs, lr x 0.2 every 4; test accuracy per epoch."""
    return _sgd_classifier(spark, sf_dir, (), 0.05, 4, "sum")


@register("m4_relu_perceptron_sgd")
def m4_relu_perceptron_sgd(spark, sf_dir):
    """The reference's perceptron run with ReLU hidden units: one hidden
    layer (256), SGD lr 0.2 on the mean loss, batch 256, 10 epochs, lr x 0.2
    every 5; test accuracy per epoch."""
    return _sgd_classifier(spark, sf_dir, (256,), 0.2, 5, "mean")


# ------------------------------------------- house design for the learners

# filled from train; missing segments stay a category of their own
FILLED = ["acctbal", "nation", "const", "priority", "status"]


def _design(spark, sf_dir, keep_target_separate=True):
    train, test = house_parts(spark, sf_dir)
    return house.prepare(train, test, "id", "target", alpha=0.5,
                         keep_target_separate=keep_target_separate, fill=FILLED)


def _design_vectors(spark, sf_dir):
    d = _design(spark, sf_dir)
    tr = models.vectorize(d.train, d.features, keep=("id", "target"))
    te = models.vectorize(d.test, d.features, keep=("id",))
    return tr, te


def _flagship_sql() -> str:
    """Both parts as ``prepare`` leaves them; ``rare`` is pruned."""
    mode = ("(SELECT {c} FROM kept WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
    cols = [f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(median({c}) AS DOUBLE) FROM kept)) AS {c}"
            for c in NUM_FEATS]
    cols += [f"coalesce({c}, {mode.format(c=c)}) AS {c}" for c in ("priority", "status")] + ["segment"]
    out = [f"round(({c} - (SELECT avg({c}) FROM ftrain)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0 "
           f"ELSE stddev_pop({c}) END FROM ftrain), {R}) AS {q('num__' + c)}" for c in NUM_FEATS]
    seen = _train_categories()
    for c in ("segment", "priority", "status"):
        out += [f"CAST(coalesce(nullif({c}, ''), 'missing_value') = {lit(v)} AS DOUBLE) AS {q(f'cat__{c}_{v}')}"
                for v in seen[c]]
    return with_house(
        f"SELECT 'train' AS origin, id, target, {', '.join(out)} FROM ftrain UNION ALL "
        f"SELECT 'test' AS origin, id, NULL AS target, {', '.join(out)} FROM ftest",
        ",\nkept AS (SELECT * FROM train WHERE target IS NOT NULL),\n"
        f"ftrain AS (SELECT id, target, {', '.join(cols)} FROM kept),\n"
        f"ftest AS (SELECT id, {', '.join(cols)} FROM test)")


@register("flagship", _flagship_sql())
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-fitted preparation of the house-like tables: drop rows without
    target, prune sparse columns, fill the named columns, scale, one-hot."""
    d = _design(spark, sf_dir)
    return _rounded(align.stack_tagged(d.train, d.test), [f"num__{c}" for c in NUM_FEATS])


def _tree_sql() -> str:
    num = ", ".join(c if c == "nation" else f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM kept)), {R}) AS {c}"
                    for c in NUM_FEATS)
    dummies = _dummy_sql(JOINT_VALUES, dummy_na=True, cast="INTEGER")
    return with_house(
        f"SELECT 'train' AS origin, id, target, {num}, {dummies} FROM kept UNION ALL "
        f"SELECT 'test' AS origin, id, NULL AS target, {num}, {dummies} FROM test",
        ",\nkept AS (SELECT * FROM train WHERE target IS NOT NULL)")


@register("tree_preparation", _tree_sql())
def tree_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tree learners see: numbers filled from train means, categories
    dummy-coded together, missing ones flagged in their ``_nan`` columns."""
    train, test = house_parts(spark, sf_dir)
    return _rounded(align.stack_tagged(*house.tree_design(train, test, "id", "target")), NUM_FEATS)


# small settings for the registered queries but m13_cv_boosting (500 rounds);
# the reference's sizes stay the function defaults (600 trees, 500 rounds,
# 128 epochs, full grids)
DEEP = dict(hidden=(32, 16), lr=0.05, epochs=4, batch_size=64, step=80, gamma=0.7, fill=FILLED)


@register("m5_dense_regressor")
def m5_dense_regressor(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    preds, _ = house.deep_flow(spark, train, test, "id", "target", alpha=0.5, **DEEP)
    return preds


@register("m17_train_valid_curve")
def m17_train_valid_curve(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    _, curve = house.deep_flow(spark, train, test, "id", "target", alpha=0.5, **DEEP)
    return curve


@register("m6_forest_fit")
def m6_forest_fit(spark, sf_dir):
    tr, te = _design_vectors(spark, sf_dir)
    est = models.random_forest(label="target", num_trees=20, max_depth=15, cache_node_ids=True)
    return models.fit_score(est, tr, te, keep=("id",))


@register("m7_boosting_fit")
def m7_boosting_fit(spark, sf_dir):
    tr, te = _design_vectors(spark, sf_dir)
    est = models.boosted_trees(label="target", max_iter=10)
    return models.fit_score(est, tr, te, keep=("id",))


@register("m16_refit_score")
def m16_refit_score(spark, sf_dir):
    tr, te = _design_vectors(spark, sf_dir)
    return models.fit_score(models.linear_regression(label="target"), tr, te, keep=("id",))



def _part_parts(spark, sf_dir):
    p = tables.load(spark, sf_dir, "part")
    data = models.vectorize(p, ["p_partkey", "p_size"], keep=("p_partkey", "p_retailprice"))
    return split.holdout(data, "p_partkey", 80)


@register("m1_linear_part")
def m1_linear_part(spark, sf_dir):
    fit_part, test_part = _part_parts(spark, sf_dir)
    return models.fit_score(models.linear_regression(label="p_retailprice"), fit_part,
                            test_part, keep=("p_partkey",))


@register("m6_forest_part")
def m6_forest_part(spark, sf_dir):
    fit_part, test_part = _part_parts(spark, sf_dir)
    est = models.random_forest(label="p_retailprice", num_trees=50, max_depth=15, cache_node_ids=True)
    return models.fit_score(est, fit_part, test_part, keep=("p_partkey",))


@register("m7_boosting_part")
def m7_boosting_part(spark, sf_dir):
    fit_part, test_part = _part_parts(spark, sf_dir)
    est = models.boosted_trees(label="p_retailprice", max_iter=20, max_depth=5)
    return models.fit_score(est, fit_part, test_part, keep=("p_partkey",))


# ------------------------------------------------- M13-M15 folds and grids

FOLD_SQL = (f", kept AS (SELECT id, target, CAST(({sql_key_hash('id', 1)}) % 5 AS INTEGER) AS fold "
            "FROM train WHERE target IS NOT NULL),\n"
            "per AS (SELECT fold, sum(target) AS s, count(*) AS n FROM kept GROUP BY fold),\n"
            "pred AS (SELECT k.fold, k.target, ((SELECT sum(target) FROM kept) - p.s) / "
            "((SELECT count(*) FROM kept) - p.n) AS p FROM kept k JOIN per p ON k.fold = p.fold)")


@register("m13_cv_mean_predictor", with_house(
    "SELECT fold, CAST(count(*) AS BIGINT) AS n, round(-sqrt(avg((p - target) * (p - target))), 4) "
    "AS neg_rmse, round(-avg(abs(p - target)), 4) AS neg_mae FROM pred GROUP BY fold", FOLD_SQL))
def m13_cv_mean_predictor(spark, sf_dir):
    s = _mean_predictor_folds(spark, sf_dir)
    return s.select("fold", "n", F.round("neg_rmse", 4).alias("neg_rmse"),
                    F.round("neg_mae", 4).alias("neg_mae"))


@register("m13_cv_boosting")
def m13_cv_boosting(spark, sf_dir):
    """Fold scores of the reference's 500 rounds, and the refit on all rows."""
    train, test = house_parts(spark, sf_dir)
    est = models.boosted_trees(label="target")
    scores, _ = house.tree_flow(spark, train, test, "id", "target", estimator=est, k=5)
    return scores


def _mean_predictor_folds(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    kept = split.with_folds(profile.split_missing_target(train, "target")[0]
                            .select("id", "target"), "id", 5)
    return models.cv_scores(models.MeanRegressor(labelCol="target"), kept, "target", 5)


@register("m16_tree_flow_predictions")
def m16_tree_flow_predictions(spark, sf_dir):
    """The tree pipeline's last step: fill test from train, dummy-code train
    and test together (with the NaN column), refit boosting on all train
    rows, score the test rows (``id, target``)."""
    train, test = house_parts(spark, sf_dir)
    est = models.boosted_trees(label="target", max_iter=5)
    _, preds = house.tree_flow(spark, train, test, "id", "target", estimator=est,
                               with_scores=False)
    return preds


@register("a14_fold_summary", with_house(
    "SELECT round(avg(neg_rmse), 4) AS neg_rmse_mean, round(stddev_pop(neg_rmse), 4) AS neg_rmse_std, "
    "round(avg(neg_mae), 4) AS neg_mae_mean, round(stddev_pop(neg_mae), 4) AS neg_mae_std FROM ("
    "SELECT fold, -sqrt(avg((p - target) * (p - target))) AS neg_rmse, -avg(abs(p - target)) AS neg_mae "
    "FROM pred GROUP BY fold)", FOLD_SQL))
def a14_fold_summary(spark, sf_dir):
    s = metrics.score_summary(_mean_predictor_folds(spark, sf_dir), ["neg_rmse", "neg_mae"])
    return s.select(*[F.round(c, 4).alias(c) for c in s.columns])


# A13 on a given (slightly wrong) linear scorer of the synthetic table, by fold
A13_W, A13_B = [1.9, -3.3], 4.0


@register("a13_neg_scorers", S4_SQL + (
    f"SELECT CAST(({sql_key_hash('id', 1)}) % 5 AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n, "
    f"round(-avg(abs({A13_B} + {A13_W[0]} * x0 + {A13_W[1]} * x1 - y)), {R}) AS neg_mae, "
    f"round(-sqrt(avg(power({A13_B} + {A13_W[0]} * x0 + {A13_W[1]} * x1 - y, 2))), {R}) AS neg_rmse "
    "FROM s4 GROUP BY 1"))
def a13_neg_scorers(spark, sf_dir):
    s4 = split.with_folds(_s4(spark, sf_dir), "id", 5)
    p = rowexpr.linear_score([F.col("x0"), F.col("x1")], A13_W, A13_B)
    e = metrics.regression_errors(s4.select("fold", p.alias("p"), "y"), "p", "y", by=["fold"])
    return e.select("fold", "n", rnd(F.col("neg_mae")).alias("neg_mae"),
                    rnd(F.col("neg_rmse")).alias("neg_rmse"))


@register("m14_grid_forest")
def m14_grid_forest(spark, sf_dir):
    tr, _ = _design_vectors(spark, sf_dir)
    data = split.with_folds(tr, "id", 5)
    est = models.random_forest(label="target", num_trees=4, max_depth=4)
    _, table = models.grid_search(spark, est, data, {"numTrees": [4, 8], "maxDepth": [3, 5]},
                                  "target", 5, metric="mae", parallelism=2)
    return table


@register("m15_grid_boosting")
def m15_grid_boosting(spark, sf_dir):
    tr, _ = _design_vectors(spark, sf_dir)
    data = split.with_folds(tr, "id", 5)
    est = models.boosted_trees(label="target", max_depth=5)
    _, table = folds.staged_grid(spark, est, data, {"maxIter": [2, 4, 6, 8], "stepSize": [0.05, 0.1]},
                                 "target", 5, parallelism=2)
    return table


# -------------------------------------------------- S1-S8 sources and sinks


CSV_HOUSE_SQL = with_house(
    "SELECT CAST(id AS BIGINT) AS id, acctbal, CAST(nation AS BIGINT) AS nation, segment, "
    "CASE WHEN priority = '' THEN NULL ELSE priority END AS priority, status, rare, const, "
    "target, origin FROM house")


def _house_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "house-csv")
    tables.house_like(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return path


@register("s1_csv_scan", CSV_HOUSE_SQL)
def s1_csv_scan(spark, sf_dir):
    return io.read_csv(spark, _house_csv(spark, sf_dir), key="id")


@register("s2_csv_no_key", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
          "o_orderpriority FROM orders")
def s2_csv_no_key(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    (tables.load(spark, sf_dir, "orders")
     .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
     .write.mode("overwrite").option("header", True).csv(path))
    return io.read_csv(spark, path)


@register("s3_drop_at_load", with_house(
    "SELECT CAST(id AS BIGINT) AS id, acctbal, CAST(nation AS BIGINT) AS nation, segment, "
    "CASE WHEN priority = '' THEN NULL ELSE priority END AS priority, status, rare, const, "
    "origin FROM house"))
def s3_drop_at_load(spark, sf_dir):
    return io.read_csv(spark, _house_csv(spark, sf_dir), key="id", drop=("target",))


@register("s5_images", tables.IMAGES_SQL)
def s5_images(spark, sf_dir):
    return tables.images(spark, sf_dir)


@register("s6_prediction_export", with_house(
    "SELECT id, round((SELECT avg(target) FROM train WHERE target IS NOT NULL), 4) "
    "AS SalePrice FROM test"))
def s6_prediction_export(spark, sf_dir):
    train, test = house_parts(spark, sf_dir)
    est = models.MeanRegressor(labelCol="target")
    kept = profile.split_missing_target(train, "target")[0]
    pred = models.fit_score(est, kept, test, keep=("id",))
    path = scratch_path(spark, "predictions")
    io.write_predictions(pred.select("id", F.round("prediction", 4).alias("prediction")),
                         "id", "prediction", path)
    return io.read_csv(spark, path, key="id")


@register("s7_table_export", ORACLE["f11_train_encoded"])
def s7_table_export(spark, sf_dir):
    path = scratch_path(spark, "encoded")
    io.write_table(f11_train_encoded(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("s8_preview", with_house("SELECT * FROM house ORDER BY id LIMIT 5"))
def s8_preview(spark, sf_dir):
    return io.preview(tables.house_like(spark, sf_dir), "id", 5)
