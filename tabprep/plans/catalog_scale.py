"""Registered queries of the forms made for large tables: dictionaries and
sparse vectors, permuted epochs, the ordered scan, fold statistics, hot keys.
Importing this module adds them to ``catalog.QUERIES`` and ``ORACLE``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions.hashing import sql_key_hash
from tabprep.operators import align, dictionary, permute, split
from tabprep.plans import folds, models, scan_sgd
from tabprep.plans.catalog import (CAT_FEATS, M2_EPOCHS, M2_LR, NUM_FEATS, ORACLE, R, S4_SQL, _num_sql, _r, _s4,
                                   house_parts, lit, q, register, union_sql, with_house)
from tabprep.session import scratch_path
from tabprep.sources import io, tables
from tabprep.streaming import profile_state
from tabprep.streaming.score import read_table_stream

# ------------------------------------- A9, F10, F11: dictionaries and vectors

FILLED = "coalesce(nullif({c}, ''), 'missing_value')"


def _places_sql(columns: list[str], text: str = FILLED, table: str = "train") -> str:
    """A CTE per column: its values and their places."""
    return "".join(
        f",\ndict_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM "
        f"(SELECT DISTINCT {text.format(c=c)} AS v FROM {table}))" for c in columns)


def _slots_sql(columns: list[str], first: int, text: str = FILLED) -> tuple[str, list[str], str]:
    """(joins, slot expressions, width) of the category columns."""
    joins, slots, at = "", [], str(first)
    for c in columns:
        joins += f" LEFT JOIN dict_{c} ON dict_{c}.v = {text.format(c=c)}"
        slots.append(f"CAST({at} + dict_{c}.place AS INTEGER)")
        at += f" + (SELECT count(*) FROM dict_{c})"
    return joins, slots, at


def _vector_sql(key: str, numeric: list[str], columns: list[str], table: str, tag: str, text: str = FILLED) -> str:
    joins, slots, width = _slots_sql(columns, len(numeric), text)
    hits = f"list_filter([{', '.join(slots)}], lambda x: x IS NOT NULL)"
    return (f"SELECT {key}, {lit(tag)} AS origin, CAST({width} AS INTEGER) AS size, "
            f"list_concat([{', '.join(map(str, range(len(numeric))))}]::INTEGER[], {hits}) AS indices, "
            f"list_concat([{', '.join(numeric)}], list_transform({hits}, lambda x: 1.0::DOUBLE)) AS \"values\" FROM {table}{joins}")


def _numbers(method: str) -> list[str]:
    return [_num_sql(method, [c]).rsplit(" AS ", 1)[0] for c in NUM_FEATS]


def _as_arrays(fitted, part, tag):
    """The encoder's arrays, rounded, a missing number as NULL again."""
    known = F.transform("values", lambda x: F.when(~F.isnan(x), F.round(x, R)))
    return (fitted.transform(part, output="arrays").drop("target")
            .select(fitted.key, F.lit(tag).alias("origin"), "size", "indices", known.alias("values")))


@register("f10_vector_as_arrays", with_house(
    union_sql([_vector_sql("id", _numbers("standardize"), CAT_FEATS, t, t) for t in ("train", "test")]), _places_sql(CAT_FEATS)))
def f10_vector_as_arrays(spark, sf_dir):
    """Train-fitted encoding of both parts as sparse vectors, in arrays."""
    train, test = house_parts(spark, sf_dir)
    fitted = dictionary.VectorEncoder("standardize", target="target", key="id").fit(train)
    return _as_arrays(fitted, train, "train").unionByName(_as_arrays(fitted, test, "test"))


@register("f10_sparse_vectors")
def f10_sparse_vectors(spark, sf_dir):
    """The same as MLlib vectors."""
    train, test = house_parts(spark, sf_dir)
    fitted = dictionary.VectorEncoder("standardize", target="target", key="id").fit(train)
    return fitted.transform(train).drop("target").unionByName(fitted.transform(test))


ORDER_CATS = ["o_custkey", "o_clerk"]
_ORDERS_SQL = ("WITH src AS (SELECT o_orderkey, o_totalprice, CAST(o_custkey AS VARCHAR) AS o_custkey, "
               "CAST(o_custkey % 1000 AS VARCHAR) || o_orderstatus AS o_clerk FROM orders),\n"
               "train AS (SELECT * FROM src WHERE o_orderkey % 10 < 8), test AS (SELECT * FROM src WHERE o_orderkey % 10 >= 8)")


@register("f10_many_categories", _ORDERS_SQL + _places_sql(ORDER_CATS) + "\n" + union_sql([
    _vector_sql("o_orderkey", ["o_totalprice"], ORDER_CATS, t, t) for t in ("train", "test")]))
def f10_many_categories(spark, sf_dir):
    """Categories that grow with the table: a customer key, and a value
    derived from it."""
    o = tables.load(spark, sf_dir, "orders")
    src = o.select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("string").alias("o_custkey"),
                   F.concat((F.col("o_custkey") % 1000).cast("string"), F.col("o_orderstatus")).alias("o_clerk"))
    train, test = (src.where(c) for c in ("o_orderkey % 10 < 8", "o_orderkey % 10 >= 8"))
    fitted = dictionary.VectorEncoder("none", target="none", key="o_orderkey").fit(train)
    return _as_arrays(fitted, train, "train").unionByName(_as_arrays(fitted, test, "test"))


@register("a9_dictionary", ORACLE["a9_categories"])
def a9_dictionary(spark, sf_dir):
    """The category lists as a table that never passes through the driver."""
    train, _ = house_parts(spark, sf_dir)
    fitted = dictionary.fit_dictionary(train, CAT_FEATS)
    names = F.array(*[F.lit(c) for c in CAT_FEATS])
    return fitted.table(spark).select(F.element_at(names, F.col("c") + 1).alias("column"),
                                      F.col("place").cast("int").alias("pos"), F.col("v").alias("category"))


@register("f11_vector_names", with_house(
    f"SELECT CAST(slot AS BIGINT) AS slot, name FROM (SELECT unnest(range({len(NUM_FEATS)})) AS slot, "
    f"unnest([{', '.join(lit('num__' + c) for c in NUM_FEATS)}]) AS name UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {slot}, 'cat__{c}_' || v FROM dict_{c}" for c, slot in zip(CAT_FEATS, _slots_sql(CAT_FEATS, len(NUM_FEATS))[1]))
    + ")", _places_sql(CAT_FEATS)))
def f11_vector_names(spark, sf_dir):
    train, _ = house_parts(spark, sf_dir)
    return dictionary.VectorEncoder("standardize", target="target", key="id").fit(train).names(spark)


# ----------------------------------------------- D3, D4: permuted epochs

_NUMBERED_SQL = ",\nnumbered AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS \"row\" FROM train)"


@register("d4_epoch_batches", with_house(union_sql([
    f"SELECT id, \"row\", {e} AS epoch, pos, CAST(pos // 64 AS BIGINT) AS batch FROM ({permute.shuffled_sql('numbered', q('row'), e)})"
    for e in (1, 2)]), _NUMBERED_SQL))
def d4_epoch_batches(spark, sf_dir):
    """Exact batches of two epochs from one numbering of the rows."""
    train, _ = house_parts(spark, sf_dir)
    numbered = align.consecutive_index(train.select("id"), ["id"], out="row")
    n = numbered.count()
    parts = [permute.epoch_batches(numbered, "row", n, 64, e).select("id", "row", F.lit(e).alias("epoch"), "pos", "batch")
             for e in (1, 2)]
    return parts[0].unionByName(parts[1])


# ----------------------------------------------------- M2: the ordered scan

def _scan_sql(batch: int) -> str:
    """Steps one after the other, as a fold over the batches in order."""
    step = M2_LR / batch
    sums = ["x0*x0 AS s00", "x0*x1 AS s01", "x1*x1 AS s11", "x0 AS s0", "x1 AS s1", "1.0 AS s", "x0*y AS t0", "x1*y AS t1", "y AS t"]
    names = [s.split(" AS ")[1] for s in sums]
    ctes = [f"fit AS (SELECT id, x0, x1, y, row_number() OVER (ORDER BY id) - 1 AS r FROM s4 WHERE ({sql_key_hash('id')}) % 100 < 80)",
            f"val AS (SELECT * FROM s4 WHERE NOT (({sql_key_hash('id')}) % 100 < 80))"]
    for e in range(1, M2_EPOCHS + 1):
        ctes.append(f"p{e} AS ({permute.shuffled_sql('fit', 'r', e)})")
    every = " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM p{e}" for e in range(1, M2_EPOCHS + 1))
    ctes.append("maps AS (SELECT epoch, pos // {} AS batch, {} FROM ({}) GROUP BY ALL)".format(
        batch, ", ".join("sum({}) AS {}".format(*s.split(" AS ")) for s in sums), every))
    item = "{" + ", ".join(f"{n}: {n}" for n in names) + ", w0: 0.0::DOUBLE, w1: 0.0::DOUBLE, b: 0.0::DOUBLE}"
    zero = "{" + ", ".join(f"{n}: 0.0::DOUBLE" for n in [*names, "w0", "w1", "b"]) + "}"
    kept = ", ".join(f"{n}: m.{n}" for n in names)
    fold = (f"lambda a, m: {{{kept}, w0: a.w0 - {step!r} * (m.s00 * a.w0 + m.s01 * a.w1 + m.s0 * a.b - m.t0), "
            f"w1: a.w1 - {step!r} * (m.s01 * a.w0 + m.s11 * a.w1 + m.s1 * a.b - m.t1), "
            f"b: a.b - {step!r} * (m.s0 * a.w0 + m.s1 * a.w1 + m.s * a.b - m.t)}}")
    for e in range(1, M2_EPOCHS + 1):
        ctes.append(f"e{e} AS (SELECT list_reduce(list_prepend({zero}, list({item} ORDER BY epoch, batch)), {fold}) AS z FROM maps WHERE epoch <= {e})")
    err = "(SELECT sqrt(avg(power(z.b + z.w0 * x0 + z.w1 * x1 - y, 2))) FROM {}, e{})"
    rows = [f"SELECT {e} AS epoch, round(z.w0, {R}) AS w0, round(z.w1, {R}) AS w1, round(z.b, {R}) AS b, "
            f"round({err.format('fit', e)}, {R}) AS train_rmse, round({err.format('val', e)}, {R}) AS valid_rmse FROM e{e}"
            for e in range(1, M2_EPOCHS + 1)]
    return S4_SQL.rstrip("\n") + ",\n" + ",\n".join(ctes) + "\n" + union_sql(rows)


@register("m2_sgd_minibatch", _scan_sql(10))
def m2_sgd_minibatch(spark, sf_dir):
    """The reference's run: batch 10, lr 0.03, 3 epochs, half squared loss,
    nominal batch division; exact sequential steps, one row per epoch."""
    fit_part, val_part = split.holdout(_s4(spark, sf_dir), "id", 80)
    run = scan_sgd.linear_sgd_scan(fit_part, ["x0", "x1"], "y", "id", lr=M2_LR, epochs=M2_EPOCHS, batch_size=10, valid=val_part)
    return spark.createDataFrame(
        [(e, _r(w[0]), _r(w[1]), _r(b), _r(t), _r(v)) for e, (w, b, t, v) in
         enumerate(zip(run.weights, run.bias, run.train_rmse, run.valid_rmse), 1)],
        "epoch int, w0 double, w1 double, b double, train_rmse double, valid_rmse double")


# ------------------------------------------------- M13, M14: fold statistics

_REGS = [0.0, 0.1]
_PART_SQL = (f"WITH part_rows AS (SELECT CAST(p_partkey AS DOUBLE) AS x0, CAST(p_size AS DOUBLE) AS x1, CAST(p_retailprice AS DOUBLE) AS y, "
             f"CAST(({sql_key_hash('p_partkey', 1)}) % 5 AS INTEGER) AS fold FROM part),\nk AS (SELECT DISTINCT fold FROM part_rows),\n"
             "m AS (SELECT k.fold, covar_pop(x0, x0) AS c00, covar_pop(x0, x1) AS c01, covar_pop(x1, x1) AS c11, covar_pop(x0, y) AS c0y, "
             "covar_pop(x1, y) AS c1y, avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my, stddev_pop(y) AS sy "
             "FROM k JOIN part_rows p ON p.fold <> k.fold GROUP BY k.fold),\n"
             "s AS (SELECT *, c00 + reg / sy AS a00, c11 + reg / sy AS a11 FROM m, (VALUES (0, 0.0), (1, 0.1)) g(candidate, reg)),\n"
             "w AS (SELECT fold, candidate, reg, (a11 * c0y - c01 * c1y) / (a00 * a11 - c01 * c01) AS w0, "
             "(a00 * c1y - c01 * c0y) / (a00 * a11 - c01 * c01) AS w1, m0, m1, my FROM s),\n"
             "err AS (SELECT candidate, reg, fold, count(*) AS n, sqrt(avg(power(my + w0 * (x0 - m0) + w1 * (x1 - m1) - y, 2))) AS rmse "
             "FROM w JOIN part_rows USING (fold) GROUP BY ALL)\n")


def _part_rows(spark, sf_dir):
    return split.with_folds(tables.load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), "p_partkey", 5)


@register("m14_cv_linear_part", _PART_SQL + (
    "SELECT CAST(candidate AS INTEGER) AS candidate, CAST(reg AS DOUBLE) AS \"regParam\", round(avg(-rmse), 4) + 0.0 AS neg_rmse_mean, "
    "round(stddev_pop(-rmse), 4) + 0.0 AS neg_rmse_std, CAST(row_number() OVER (ORDER BY avg(-rmse) DESC, candidate) AS INTEGER) AS rank "
    "FROM err GROUP BY candidate, reg"))
def m14_cv_linear_part(spark, sf_dir):
    """BASELINE's job (2 settings x 5 folds) from one pass of co-moments."""
    _, _, table = folds.linear_grid(_part_rows(spark, sf_dir), ["p_partkey", "p_size"], "p_retailprice", _REGS)
    return table.withColumns({c: F.round(c, 4) for c in ("neg_rmse_mean", "neg_rmse_std")})


@register("m13_cv_linear", _PART_SQL + "SELECT fold, CAST(n AS BIGINT) AS n, round(-rmse, 4) + 0.0 AS neg_rmse FROM err WHERE candidate = 0")
def m13_cv_linear(spark, sf_dir):
    """Fold scores of least squares, from the same pass."""
    found = folds.linear_fold_errors(folds.fold_moments(_part_rows(spark, sf_dir), ["p_partkey", "p_size"], "p_retailprice"))
    return spark.createDataFrame([(f, n, _r(-e, 4) + 0.0) for f, n, e in found], "fold int, n bigint, neg_rmse double")


# --------------------------------------------------------- U2 with a hot key

_KEYED = "CASE WHEN o_orderkey % {m} = 0 THEN -1 ELSE o_orderkey END"


@register("u2_glue_hot_key",
          f"SELECT coalesce(a.k, b.k) AS k, a.price, b.priority FROM "
          f"(SELECT {_KEYED.format(m=3)} AS k, o_totalprice AS price FROM orders WHERE o_orderkey % 7 <> 1) a FULL OUTER JOIN "
          f"(SELECT {_KEYED.format(m=1500)} AS k, o_orderpriority AS priority FROM orders WHERE o_orderkey % 7 <> 2) b ON a.k = b.k")
def u2_glue_hot_key(spark, sf_dir):
    """Two keyed tables side by side; one key holds a third of the first."""
    o = tables.load(spark, sf_dir, "orders")

    def keyed(m: int, column: str, name: str, out: int):
        k = F.when(F.col("o_orderkey") % m == 0, F.lit(-1)).otherwise(F.col("o_orderkey"))
        return o.where(F.col("o_orderkey") % 7 != out).select(k.alias("k"), F.col(column).alias(name))

    return align.glue_columns(keyed(3, "o_totalprice", "price", 1), keyed(1500, "o_orderpriority", "priority", 2), "k")


# ------------------------------------- S1: records with quoted line breaks

@register("s1_csv_line_breaks", "SELECT doc_id, CASE WHEN text <> '' THEN text END AS text, lang, source, "
          "doc_id % 3 = 0 AS flag, CAST(NULL AS DOUBLE) AS nothing, n_chars FROM documents")
def s1_csv_line_breaks(spark, sf_dir):
    """Whole texts with their line breaks and quotes, through a CSV file."""
    path = scratch_path(spark, "texts-csv")
    docs = tables.load(spark, sf_dir, "documents")
    flag = F.when(F.col("doc_id") % 3 == 0, "True").otherwise("False")
    (docs.select("doc_id", "text", "lang", "source", flag.alias("flag"), F.lit("NA").alias("nothing"), "n_chars")
     .write.option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return io.read_csv(spark, path, key="doc_id")


# --------------------------- A1-A9 as state merged over a growing table

_STATE_NUMBERS = ["acctbal", "nation", "target"]


def _appended(spark, sf_dir) -> str:
    """The state after the train rows have come in three appends, each of as
    many files as its rows make and one micro-batch of the same stream."""
    train, _ = house_parts(spark, sf_dir)
    rows, state, checkpoint = (scratch_path(spark, x) for x in ("growing", "profile-state", "profile-ckpt"))
    for i in range(3):
        train.where(F.col("id") % 3 == i).write.mode("append").parquet(rows)
        source = read_table_stream(spark, rows, train.schema)
        profile_state.append_profile(spark, source, state, _STATE_NUMBERS, CAT_FEATS, checkpoint).awaitTermination()
    return state


@register("a1_a8_appended", with_house(union_sql([
    f"SELECT {lit(c)} AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS missing, CAST(count(*) AS BIGINT) AS \"rows\", "
    f"CAST(count_if({c} IS NULL) AS DOUBLE) / count(*) AS ratio, "
    + (f"round(avg({c}), {R}) AS mean, round(stddev_pop({c}), {R}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
       f"CAST(max({c}) AS DOUBLE) AS max, round(CAST(max({c}) - min({c}) AS DOUBLE), {R}) AS range, NULL AS mode" if c in _STATE_NUMBERS else
       f"NULL AS mean, NULL AS std, NULL AS min, NULL AS max, NULL AS range, (SELECT {c} FROM train WHERE {c} IS NOT NULL "
       f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode") + " FROM train"
    for c in (*_STATE_NUMBERS, *CAT_FEATS)])))
def a1_a8_appended(spark, sf_dir):
    """Missing profile, moments and modes from the merged state alone."""
    state = _appended(spark, sf_dir)
    found = profile_state.read_profile(spark, state).drop("median")
    found = found.withColumns({c: F.round(c, R) for c in ("mean", "std", "range")})
    return found.join(profile_state.read_modes(spark, state), "column", "left")


# ------------------- M3, M4, M6, M7, M16: learners against SQL or a baseline

def _stump_sql(source: str, out: str, value: str) -> str:
    """CTEs of the best split of ``source`` (x0, x1, {value}) by squared error:
    thresholds half way between neighbouring values, the first feature and the
    least threshold on a tie."""
    return (f"{out}_v AS (SELECT DISTINCT 0 AS f, x0 AS x FROM {source} UNION SELECT DISTINCT 1, x1 FROM {source}),\n"
            f"{out}_t AS (SELECT f, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2 AS t FROM {out}_v QUALIFY t IS NOT NULL),\n"
            f"{out}_s AS (SELECT f, t, avg({value}) FILTER (x <= t) AS l, avg({value}) FILTER (x > t) AS r, "
            f"var_pop({value}) FILTER (x <= t) * count(*) FILTER (x <= t) + var_pop({value}) FILTER (x > t) * count(*) FILTER (x > t) AS sse "
            f"FROM (SELECT f, t, CASE WHEN f = 0 THEN x0 ELSE x1 END AS x, {value} FROM {source}, {out}_t) GROUP BY f, t),\n"
            f"{out} AS (SELECT * FROM {out}_s ORDER BY round(sse, 3), f, t LIMIT 1)")


_TREE_SQL = (f"WITH rows AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x0, CAST(p_partkey % 23 AS DOUBLE) AS x1, "
             f"CAST(p_retailprice AS DOUBLE) + 40 * CAST(p_size AS DOUBLE) + 900 * CAST(p_partkey % 23 > 7 AS DOUBLE) AS y, "
             f"({sql_key_hash('p_partkey')}) % 100 < 80 AS fit FROM part),\nfitted AS (SELECT * FROM rows WHERE fit),\n")
_LEAF = "(CASE WHEN CASE WHEN {s}.f = 0 THEN x0 ELSE x1 END <= {s}.t THEN {s}.l ELSE {s}.r END)"


def _tree_rows(spark, sf_dir):
    p = tables.load(spark, sf_dir, "part")
    x1 = (F.col("p_partkey") % 23).cast("double")
    rows = p.select("p_partkey", F.col("p_size").cast("double").alias("x0"), x1.alias("x1"),
                    (F.col("p_retailprice").cast("double") + 40 * F.col("p_size").cast("double")
                     + 900 * (F.col("p_partkey") % 23 > 7).cast("double")).alias("y"))
    return split.holdout(models.vectorize(rows, ["x0", "x1"], keep=("p_partkey", "y")), "p_partkey", 80)


def _predicted(spark, sf_dir, est):
    fit_part, test_part = _tree_rows(spark, sf_dir)
    out = models.fit_score(est, fit_part, test_part, keep=("p_partkey",))
    return out.withColumn("prediction", F.round("prediction", 4))


@register("m6_stump_part", _TREE_SQL + _stump_sql("fitted", "s", "y") + (
    f"\nSELECT p_partkey, round({_LEAF.format(s='s')}, 4) AS prediction FROM rows, s WHERE NOT fit"))
def m6_stump_part(spark, sf_dir):
    """A forest of one tree of depth 1 on all rows and features."""
    est = models.random_forest(label="y", num_trees=1, max_depth=1, feature_subset="all").setBootstrap(False).setMaxBins(64)
    return _predicted(spark, sf_dir, est)


@register("m7_two_rounds_part", _TREE_SQL + _stump_sql("fitted", "s", "y") + (
    f",\nrest AS (SELECT fitted.*, 2 * (y - {_LEAF.format(s='s')}) AS z FROM fitted, s),\n") + _stump_sql("rest", "u", "z") + (
    f"\nSELECT p_partkey, round({_LEAF.format(s='s')} + 0.3 * {_LEAF.format(s='u')}, 4) AS prediction FROM rows, s, u WHERE NOT fit"))
def m7_two_rounds_part(spark, sf_dir):
    """Two rounds of boosting with stumps: the second fits the gradient."""
    est = models.boosted_trees(label="y", max_iter=2, step_size=0.3, max_depth=1, subsample=1.0, feature_subset="all").setMaxBins(64)
    return _predicted(spark, sf_dir, est)


@register("m16_linear_refit_part", _TREE_SQL + """c AS (
  SELECT covar_pop(x0, x0) AS c00, covar_pop(x1, x1) AS c11, covar_pop(x0, x1) AS c01, covar_pop(x0, y) AS c0y,
         covar_pop(x1, y) AS c1y, avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my FROM fitted),
w AS (SELECT (c11 * c0y - c01 * c1y) / (c00 * c11 - c01 * c01) AS w0, (c00 * c1y - c01 * c0y) / (c00 * c11 - c01 * c01) AS w1, * FROM c)
SELECT p_partkey, round(my + w0 * (x0 - m0) + w1 * (x1 - m1), 4) AS prediction FROM rows, w WHERE NOT fit""")
def m16_linear_refit_part(spark, sf_dir):
    """Refit on all training rows, score the others."""
    return _predicted(spark, sf_dir, models.linear_regression(label="y"))


_LEARNABLE_SQL = (f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS missing, true AS beats_baseline "
                  f"FROM embeddings WHERE NOT (({sql_key_hash('vec_id')}) % 100 < 80)")


def _beats_baseline(spark, sf_dir, est):
    """Hold-out rows, missing predictions, and whether the classifier's
    accuracy is above the most frequent class's share by a quarter of the
    rest; the label is which of three coordinates is greatest."""
    e = tables.load(spark, sf_dir, "embeddings").withColumn("x", F.slice("embedding", 1, 3))
    e = e.withColumn("label", (F.array_position("x", F.array_max("x")) - 1).cast("double"))
    fit_part, test_part = split.holdout(models.vectorize(e, "x", keep=("vec_id", "label")), "vec_id", 80)
    scored = models.fit_score(est, fit_part, test_part, keep=("label",))
    counts = scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull()).alias("missing"),
                                         F.count_if(F.col("prediction") == F.col("label")).alias("hits"))
    share = F.max("n") / F.sum("n")
    return counts.agg(F.sum("n").alias("n"), F.sum("missing").alias("missing"),
                      (F.sum("hits") / F.sum("n") > share + (1 - share) / 4).alias("beats_baseline"))


@register("m3_softmax_learnable", _LEARNABLE_SQL)
def m3_softmax_learnable(spark, sf_dir):
    return _beats_baseline(spark, sf_dir, models.softmax_regression(label="label", max_iter=50))


@register("m4_perceptron_learnable", _LEARNABLE_SQL)
def m4_perceptron_learnable(spark, sf_dir):
    return _beats_baseline(spark, sf_dir, models.perceptron([3, 8, 3], label="label", max_iter=60))
