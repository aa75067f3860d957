"""The house-price flows end to end, as Spark jobs.

``prepare`` is the deep pipeline's preparation: drop rows without a target
(P1), prune sparse columns (F1), fill from train statistics (F2), scale and
one-hot encode fitted on train (F7-F12).  Fitting shares its passes: one
aggregate for the profile and moments, the median rounds, one grouped count
for modes and category lists, one aggregate for the scaling moments;
applying it is one ``select`` per table, with no shuffle.

``deep_flow`` adds the hold-out (D1), the dense SGD regressor (M5) with its
train/validation curve (M17), scoring (M9) and the inverse target transform
(F14).  ``tree_flow`` is the tree pipeline: fill test from train (F4), joint
dummy coding (F16), fold scores of boosted trees (M13) and refit + score
(M16).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.kinds import split_kinds
from tabprep.functions.missing import MISSING_LABEL, is_missing, qcol
from tabprep.operators import encode, impute, profile, split, stats
from tabprep.plans import models, sgd


@dataclass
class Design:
    """Encoded train and test tables plus what produced them."""
    train: DataFrame
    test: DataFrame
    features: list[str]
    encoder: encode.FittedEncoder
    imputer: impute.FittedImputer
    dropped: DataFrame
    key: str
    target: str


def prepare(train: DataFrame, test: DataFrame, key: str, target: str,
            alpha: float = 0.4, numeric_fill: str = "median",
            numeric_method: str = "standardize",
            keep_target_separate: bool = True,
            max_categories: int | None = 100_000,
            fill: Sequence[str] | None = None, persist: bool = False) -> Design:
    """P1 + F1 + F2 + F7-F12 with shared passes over the train table.
    ``fill`` names the columns filled from train statistics (default: the
    numeric ones); other missing categories stay a category of their own and
    other missing numbers stay missing.

    1. one aggregate: row count, missing count of every feature (the F1
       profile) and moments of the numeric ones and the target (mean fill,
       target scaling);
    2. the median rounds (median fill only);
    3. one grouped ``(column, value)`` count: the modes (fill) and, derived
       from them, the encoder's category lists after filling.

    The scaling moments after filling follow from the moments before (the
    fill adds k copies of one value), so they cost no pass.  Results equal
    the separate operators (``prune_sparse_columns``, ``Imputer.fit``,
    ``TableEncoder.fit``) up to floating rounding."""
    kept, _ = profile.split_missing_target(train, target)
    feats = [c for c in kept.columns if c not in (key, target)]
    # fitting reads a few columns of the train table three or four times; by
    # default it scans them again, `persist` keeps the whole table meanwhile
    cached = kept.persist(StorageLevel.MEMORY_AND_DISK) if persist else kept
    try:
        num, cat = split_kinds(cached, feats)
        rows, missing, mom = stats.summary(cached, feats, num + [target])
        sparse = [c for c in feats
                  if missing[c] > 0 and rows and missing[c] / rows >= alpha]
        spark = train.sparkSession
        dropped = spark.createDataFrame(
            [(c, missing[c], rows, missing[c] / rows) for c in sparse],
            "column string, missing bigint, rows bigint, ratio double")
        tr, te = profile.drop_columns(cached, test, columns=sparse)
        num = [c for c in num if c not in sparse]
        cat = [c for c in cat if c not in sparse]
        counts = stats.category_counts(cached, cat, max_categories)
        modes = {c: stats.mode_of(counts[c]) for c in cat}
        filled = [c for c in num + cat if c in (num if fill is None else fill)]
        imp = impute.Imputer(numeric=numeric_fill, columns=filled).fit(
            tr, moments=mom, modes=modes)
        cats = {c: _categories_seen(counts[c], missing[c] > 0 and (c not in filled or modes[c] is None))
                for c in cat}
        filled_mom = {n: stats.moments_after_fill(mom[n], imp.numeric[n], rows) if n in filled else mom[n]
                      for n in num}
        filled_mom[target] = mom[target]
        enc = encode.TableEncoder(numeric_method, keep_target_separate, target=target,
                                  key=key, max_categories=max_categories
                                  ).fit(imp.transform(tr), categories=cats, moments=filled_mom)
    finally:
        if persist:
            cached.unpersist()
    tr_f, te_f = imp.transform(tr), imp.transform(te)
    return Design(enc.transform(tr_f), enc.transform(te_f), enc.output_columns, enc,
                  imp, dropped, key, target)


def _categories_seen(counts: dict[str, int], some_missing: bool) -> list[str]:
    """Sorted categories of a column after the mode fill where it applies
    (F2; the mode is one of the values), the constant fill of what is still
    missing (F5) and empty -> label (F6)."""
    vals = {MISSING_LABEL if v == "" else v for v in counts}
    if some_missing:
        vals.add(MISSING_LABEL)
    return sorted(vals)


def with_feature_array(df: DataFrame, features: Sequence[str], out: str = "x") -> DataFrame:
    """The encoded feature columns as one ``array<double>`` column."""
    keep = [c for c in df.columns if c not in features]
    return df.select(*[qcol(c) for c in keep],
                     F.array(*[qcol(c).cast("double") for c in features]).alias(out))


def deep_flow(spark: SparkSession, train: DataFrame, test: DataFrame, key: str, target: str,
              hidden: Sequence[int] = (1024, 512, 256, 64), lr: float = 0.2,
              epochs: int = 128, batch_size: int = 64, step: int = 80, gamma: float = 0.7,
              alpha: float = 0.4, partitions: int | None = None, seed: int = 0,
              mode: str = "local", fill: Sequence[str] | None = None,
              ) -> tuple[DataFrame, DataFrame]:
    """Returns (test predictions ``key, target`` on the original scale,
    train/validation curve one row per epoch)."""
    d = prepare(train, test, key, target, alpha, keep_target_separate=False, fill=fill)
    tr = with_feature_array(d.train, d.features)
    te = with_feature_array(d.test, d.features)
    fit_part, val_part = split.holdout(tr, key, 80)
    res = sgd.train_dense(spark, fit_part, "x", target, hidden, key=key, valid=val_part,
                          lr=lr, epochs=epochs, batch_size=batch_size, step=step,
                          gamma=gamma, mode=mode, partitions=partitions, seed=seed,
                          target_scale=d.encoder.sigma)
    pred = d.encoder.inverse_target(sgd.dense_score(spark, res.net, "x"))
    preds = te.select(qcol(key), pred.alias(target))
    curve = spark.createDataFrame(
        [(c["epoch"], c["train_rmse"], c["valid_rmse"]) for c in res.curve],
        "epoch int, train_rmse double, valid_rmse double")
    return preds, curve


def tree_design(train: DataFrame, test: DataFrame, key: str, target: str,
                fill_train: Sequence[str] | None = None, fill_test: Sequence[str] | None = None,
                numeric_missing: str = "impute") -> tuple[DataFrame, DataFrame]:
    """F4 + F16: (train rows with a target, test rows), filled and dummy-coded
    together with a ``_nan`` column per category.  ``fill_train`` and
    ``fill_test`` name the columns filled from train means and modes (default:
    the numeric ones, which the trees need; a list replaces that); a missing
    category that is not listed keeps its meaning in the ``_nan`` column.
    ``numeric_missing="indicator"`` also adds ``<column>_isna`` for numeric
    columns, as it was before the fill."""
    if numeric_missing not in ("impute", "indicator"):
        raise ValueError("numeric_missing must be 'impute' or 'indicator'")
    kept, _ = profile.split_missing_target(train, target)
    num, _ = split_kinds(kept, [c for c in kept.columns if c not in (key, target)])

    def filled(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
        imp = impute.Imputer(numeric="mean", columns=list(num if columns is None else columns)).fit(kept)
        if numeric_missing == "indicator":
            df = df.select("*", *[is_missing(df, c).cast("int").alias(f"{c}_isna") for c in num])
        return imp.transform(df)

    # the target rides along in the stack (test gets NULL there), so the
    # indicator columns line up without any join back
    tr_d, te_d = encode.joint_dummies(filled(kept, fill_train), filled(test, fill_test),
                                      dummy_na=True, dtype="int32")
    return tr_d, te_d.drop(target)


def tree_flow(spark: SparkSession, train: DataFrame, test: DataFrame, key: str, target: str,
              estimator=None, k: int = 5, key_as_feature: bool = True,
              parallelism: int | None = None, with_scores: bool = True,
              fill_train: Sequence[str] | None = None, fill_test: Sequence[str] | None = None,
              numeric_missing: str = "impute") -> tuple[DataFrame | None, DataFrame]:
    """Returns (fold scores: fold, n, neg_rmse, neg_mae, or None without
    ``with_scores``; test predictions ``key, target`` from the model refit
    on all train rows).  ``parallelism`` of the folds' fits and the refit run
    at once (default: ``models.fits_at_once``); the results do not depend on
    it."""
    tr_d, te_d = tree_design(train, test, key, target, fill_train, fill_test, numeric_missing)
    feats = [c for c in tr_d.columns if c != target and (c != key or key_as_feature)]
    est = estimator or models.boosted_trees(label=target, max_iter=500)
    data = split.with_folds(models.vectorize(tr_d, feats, keep=(key, target)), key, k)
    test_x = models.vectorize(te_d, feats, keep=(key,))
    if with_scores:
        # the fits, the folds' scores and the refit read one dealt table
        with models._persisted(models.spread(est, data)) as dealt, ThreadPoolExecutor(1) as beside:
            def refit(own):
                return models.fit_score(own, dealt, test_x, keep=(key,), dealt=True)

            n = parallelism or models.fits_at_once(dealt, k + 1)
            early = beside.submit(refit, est.copy()) if n > 1 else None
            scores = models.dealt_scores(est, dealt, target, k, parallelism=max(1, n - 1))
            preds = early.result() if early else refit(est)
    else:
        scores, preds = None, models.fit_score(est, data, test_x, keep=(key,))
    return scores, preds.withColumnRenamed(models.PREDICTION, target)
