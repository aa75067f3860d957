"""Gradient descent on tables: linear regression (M2) and dense networks
(M5, M9, M17).

M2, full batch.  The squared loss of a linear model only needs the means and
co-moments of features and label (``operators.comoments``: one aggregate up to
some tens of features); then any number of epochs runs on d x d numbers on the
driver.  Its mini-batch form is ``plans.scan_sgd``.
The iterates are the ones a per-epoch pass would give (one pass instead of
one per epoch).  ``method="pass"`` runs one aggregate per epoch instead.

M5, dense ReLU networks, two modes:

* ``local`` (default): one Spark job per epoch.  The table is hash
  partitioned into a fixed number of parts and persisted; each epoch
  sorts every part by the epoch's key hash (D3, no shuffle) and a
  ``mapInPandas`` task runs mini-batch SGD over its rows, streaming Arrow
  batches, from the broadcast weights (the partitioning is a hash of the
  whole row, so a hot key does not skew it).  Tasks emit their weights times
  their row count in fixed-size chunks; grouped sums per chunk (two rounds
  for many tasks, so no group holds a row from every task) average them
  (model averaging), and the driver receives one model, never one per task.  The result depends on the number of parts, which is a parameter.
* ``exact``: full-batch gradient descent, one job per step, each task
  summing its rows' gradients; independent of the partitioning.

Each epoch job also measures the incoming weights (the previous epoch's
result) on train and validation rows, so the train/validation curve (M17)
costs no extra pass; one last pass measures the final weights.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.missing import qcol
from tabprep.operators.comoments import CoMoments, co_moments
from tabprep.operators.split import epoch_order

CHUNK = 8192  # floats per weight chunk sent between tasks

# The task functions below ship with their code (numpy and pandas only), so
# executors need no copy of this package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ------------------------------------------------------------ M2 (linear)

def linear_gd(df: DataFrame, features: Sequence[str], label: str, lr: float = 0.03,
              epochs: int = 3, half: bool = True, init: Sequence[float] | None = None,
              init_bias: float = 0.0, method: str = "stats") -> list[dict]:
    """M2, full-batch gradient descent on the (half) squared loss.  Returns
    one dict per epoch: epoch, w (list), b, loss (mean loss over the table
    after the step; half of the squared error when ``half``)."""
    d = len(features)
    xs = [qcol(c).cast("double") for c in features]
    y = qcol(label).cast("double")
    w = np.array(init if init is not None else [0.0] * d, dtype=float)
    b = float(init_bias)
    k = 1.0 if half else 2.0          # d/dp of (p-y)^2/2 vs (p-y)^2
    out = []
    if method == "pass":
        for e in range(1, epochs + 1):
            p = F.lit(b)
            for xi, wi in zip(xs, w):
                p = p + xi * F.lit(float(wi))
            r = p - y
            row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(r).alias("g"),
                         *[F.sum(r * xi).alias(f"g{i}") for i, xi in enumerate(xs)]).first()
            n = row["n"]
            w = w - lr * k * np.array([row[f"g{i}"] for i in range(d)]) / n
            b = b - lr * k * row["g"] / n
            out.append({"epoch": e, "w": w.tolist(), "b": b})
        losses = [_loss_pass(df, xs, y, o["w"], o["b"], half) for o in out]
        for o, lo in zip(out, losses):
            o["loss"] = lo
        return out
    m = co_moments(df, [*xs, y]).get(None) or CoMoments(0, np.zeros(d + 1), np.zeros((d + 1, d + 1)))
    n, mean, cov = m.n, m.mean, m.c
    mx, my, cxx, cxy, cyy = mean[:d], mean[d], cov[:d, :d], cov[:d, d], cov[d, d]
    for e in range(1, epochs + 1):
        off = w @ mx + b - my                  # mean residual
        gw = cxx @ w - cxy + n * off * mx      # sum of (p - y) x
        gb = n * off                           # sum of (p - y)
        w = w - lr * k * gw / n
        b = b - lr * k * gb / n
        off = w @ mx + b - my
        sse = w @ cxx @ w - 2 * (w @ cxy) + cyy + n * off * off
        loss = sse / n / (2.0 if half else 1.0)
        out.append({"epoch": e, "w": w.tolist(), "b": float(b), "loss": float(loss)})
    return out


def _loss_pass(df: DataFrame, xs, y, w, b, half) -> float:
    p = F.lit(float(b))
    for xi, wi in zip(xs, w):
        p = p + xi * F.lit(float(wi))
    r = p - y
    v = df.agg(F.avg(r * r)).first()[0]
    return v / 2.0 if half else v


# -------------------------------------------------------- dense networks

@dataclass
class DenseNet:
    """Linear, ReLU, ..., Linear.  ``weights[i]`` is (out x in), ``biases[i]``
    has length out."""
    weights: list[np.ndarray]
    biases: list[np.ndarray]

    @property
    def dims(self) -> list[int]:
        return [self.weights[0].shape[1]] + [w.shape[0] for w in self.weights]

    def pack(self) -> np.ndarray:
        return np.concatenate([a.ravel() for wb in zip(self.weights, self.biases)
                               for a in wb]).astype(np.float64)

    @staticmethod
    def unpack(vec: np.ndarray, dims: Sequence[int]) -> "DenseNet":
        ws, bs, o = [], [], 0
        for i in range(len(dims) - 1):
            n_in, n_out = dims[i], dims[i + 1]
            ws.append(vec[o:o + n_in * n_out].reshape(n_out, n_in))
            o += n_in * n_out
            bs.append(vec[o:o + n_out].copy())
            o += n_out
        return DenseNet(ws, bs)

    def to_json(self) -> str:
        return json.dumps({"dims": self.dims, "params": self.pack().tolist()})

    @staticmethod
    def from_json(s: str) -> "DenseNet":
        d = json.loads(s)
        return DenseNet.unpack(np.array(d["params"]), d["dims"])


def init_net(dims: Sequence[int], std: float = 0.01, seed: int = 0) -> DenseNet:
    """Weights N(0, std^2), biases 0 (the reference's init hook), from a
    seeded generator on the driver."""
    rng = np.random.default_rng(seed)
    ws = [rng.normal(0.0, std, size=(dims[i + 1], dims[i])) for i in range(len(dims) - 1)]
    bs = [np.zeros(dims[i + 1]) for i in range(len(dims) - 1)]
    return DenseNet(ws, bs)


def forward(net: DenseNet, X: np.ndarray) -> list[np.ndarray]:
    acts = [X]
    h = X
    last = len(net.weights) - 1
    for i, (W, b) in enumerate(zip(net.weights, net.biases)):
        z = h @ W.T + b
        h = np.maximum(z, 0.0) if i < last else z
        acts.append(h)
    return acts


def loss_and_grads(net: DenseNet, X: np.ndarray, y: np.ndarray, loss: str
                   ) -> tuple[float, list[np.ndarray], list[np.ndarray]]:
    """Sum over rows of the loss and its gradient.  ``mse``: (p - y)^2;
    ``half_mse``: (p - y)^2 / 2; ``softmax``: cross entropy of integer y."""
    acts = forward(net, X)
    out = acts[-1]
    if loss == "softmax":
        m = out.max(axis=1, keepdims=True)
        e = np.exp(out - m)
        s = e.sum(axis=1, keepdims=True)
        yi = y.astype(np.int64)
        lsum = float(np.sum(np.log(s[:, 0]) + m[:, 0] - out[np.arange(len(yi)), yi]))
        delta = e / s
        delta[np.arange(len(yi)), yi] -= 1.0
    else:
        r = out[:, 0] - y
        lsum = float(np.sum(r * r)) / (2.0 if loss == "half_mse" else 1.0)
        delta = (r if loss == "half_mse" else 2.0 * r)[:, None]
    gws, gbs = [], []
    for i in range(len(net.weights) - 1, -1, -1):
        gws.append(delta.T @ acts[i])
        gbs.append(delta.sum(axis=0))
        if i > 0:
            delta = (delta @ net.weights[i]) * (acts[i] > 0)
    return lsum, gws[::-1], gbs[::-1]


def _sse(net: DenseNet, X: np.ndarray, y: np.ndarray) -> float:
    r = forward(net, X)[-1][:, 0] - y
    return float(np.sum(r * r))


def _correct(net: DenseNet, X: np.ndarray, y: np.ndarray) -> float:
    pred = np.argmax(forward(net, X)[-1], axis=1)
    return float(np.sum(pred == y.astype(np.int64)))


def _chunks(vec: np.ndarray, n: float, slot: int) -> Iterator[tuple[int, int, float, list]]:
    for c in range(0, max(1, math.ceil(len(vec) / CHUNK))):
        yield c, slot, n, vec[c * CHUNK:(c + 1) * CHUNK].tolist()


OUT_SCHEMA = "chunk int, slot int, n double, vals array<double>"


def _sum_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    vals = np.sum(np.stack(pdf["vals"].to_numpy()), axis=0)
    return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "slot": [0],
                         "n": [float(pdf["n"].sum())], "vals": [vals.tolist()]})


def _combine(emitted: DataFrame, tasks: int) -> dict[int, tuple[float, np.ndarray]]:
    """Sum of the per-task chunks in two grouped rounds: tasks are spread
    over about sqrt(tasks) slots, partial sums per (chunk, slot), then one
    sum per chunk.  No group holds more than about sqrt(tasks) rows, and one
    row per chunk reaches the driver (the model size, independent of the
    number of tasks).  Up to 64 tasks the first round suffices and the
    driver adds the at most 8 partial rows per chunk."""
    partial = emitted.groupBy("chunk", "slot").applyInPandas(_sum_chunks, OUT_SCHEMA)
    if tasks > 64:
        partial = partial.groupBy("chunk").applyInPandas(_sum_chunks, OUT_SCHEMA)
    rows = partial.collect()
    out: dict[int, tuple[float, np.ndarray]] = {}
    for r in rows:
        n, v = out.get(r["chunk"], (0.0, 0.0))
        out[r["chunk"]] = (n + r["n"], v + np.array(r["vals"]))
    return out


def _epoch_task(params_bc, dims, loss: str, lr: float, batch_size: int, train: bool,
                exact: bool, nominal: bool, fcol: str, ycol: str, slots: int,
                summed: bool = False):
    """Builds the ``mapInPandas`` function of one epoch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = DenseNet.unpack(params_bc.value, dims)
        net = DenseNet([w.copy() for w in start.weights], [b.copy() for b in start.biases])
        acc = np.zeros(len(params_bc.value))
        n_fit = n_val = 0
        sse_fit = sse_val = 0.0
        carry_x: list[np.ndarray] = []
        carry_y: list[np.ndarray] = []

        def step(X, y):
            nonlocal net
            _, gws, gbs = loss_and_grads(net, X, y, loss)
            div = 1 if summed else (batch_size if nominal else len(y))
            net = DenseNet([w - lr * g / div for w, g in zip(net.weights, gws)],
                           [b - lr * g / div for b, g in zip(net.biases, gbs)])

        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf[fcol].to_numpy()).astype(np.float64)
            y = pdf[ycol].to_numpy(dtype=np.float64)
            fit = pdf["__fit"].to_numpy(dtype=bool)
            # measure the incoming weights: squared error, or for classes
            # the number of correct predictions (first maximum wins)
            measure = _correct if loss == "softmax" else _sse
            if fit.any():
                sse_fit += measure(start, X[fit], y[fit])
            if (~fit).any():
                sse_val += measure(start, X[~fit], y[~fit])
            n_fit += int(fit.sum())
            n_val += int((~fit).sum())
            if not train or not fit.any():
                continue
            Xf, yf = X[fit], y[fit]
            if exact:
                _, gws, gbs = loss_and_grads(start, Xf, yf, loss)
                acc += DenseNet(gws, gbs).pack()
                continue
            carry_x.append(Xf)
            carry_y.append(yf)
            Xc, yc = np.concatenate(carry_x), np.concatenate(carry_y)
            full = (len(yc) // batch_size) * batch_size
            for s in range(0, full, batch_size):
                step(Xc[s:s + batch_size], yc[s:s + batch_size])
            carry_x, carry_y = [Xc[full:]], [yc[full:]]
        if train and not exact and carry_y and len(carry_y[0]):
            step(carry_x[0], carry_y[0])           # last, short batch
        from pyspark import TaskContext
        slot = TaskContext.get().partitionId() % slots
        rows = [(-1, slot, 0.0, [float(n_fit), sse_fit, float(n_val), sse_val])]
        if train and n_fit:
            vec = acc if exact else net.pack() * n_fit
            rows += list(_chunks(vec, float(n_fit), slot))
        yield pd.DataFrame(rows, columns=["chunk", "slot", "n", "vals"])

    return run


@dataclass
class TrainResult:
    net: DenseNet
    curve: list[dict]


def train_dense(spark: SparkSession, train: DataFrame, features: str, label: str,
                hidden: Sequence[int] = (1024, 512, 256, 64), *, key: str,
                valid: DataFrame | None = None, out_dim: int = 1, loss: str = "mse",
                lr: float = 0.2, epochs: int = 128, batch_size: int = 64,
                step: int = 80, gamma: float = 0.7, mode: str = "local",
                partitions: int | None = None, seed: int = 0, init_std: float = 0.01,
                nominal_batch: bool = False, target_scale: float = 1.0,
                reduction: str = "mean", rows_per_part: int = 100_000) -> TrainResult:
    """M5 / M17.  ``features`` is an ``array<double>`` column, ``label`` a
    number (class index for ``loss='softmax'``).  Learning rate at epoch e
    (0-based) is ``lr * gamma ** (e // step)``.  Returns the network and
    the curve: one dict per epoch with train and validation RMSE after that
    epoch, multiplied by ``target_scale`` (sigma of a scaled target), or
    with ``loss='softmax'`` train and validation accuracy (A10 per epoch).
    ``reduction``: ``mean`` steps by the batch's mean gradient (divided by
    the nominal size with ``nominal_batch``), ``sum`` by its sum (a step
    batch-size times larger, as when the batch loss is summed)."""
    if mode not in ("local", "exact"):
        raise ValueError("mode must be 'local' or 'exact'")
    if reduction not in ("mean", "sum"):
        raise ValueError("reduction must be 'mean' or 'sum'")
    sc = spark.sparkContext
    cols = [qcol(key), qcol(features).cast("array<double>").alias("__x"),
            qcol(label).cast("double").alias("__y")]
    data = train.select(*cols, F.lit(True).alias("__fit"))
    if valid is not None:
        data = data.unionByName(valid.select(*cols, F.lit(False).alias("__fit")))
    # the number of parts belongs to the model (local mode averages over
    # them): given, or from the rows a part is to hold, never from the cluster
    parts = partitions or max(1, -(-data.count() // rows_per_part))
    # parts by a hash of the whole row, not the key alone: a key that holds a
    # third of the rows still spreads evenly, and the split stays a function
    # of the content (same parts on any input partitioning, after recompute).
    # Spark reduces the 64-bit hash to parts itself: reduced before, it would
    # be hashed again and leave parts empty
    spread = F.xxhash64(qcol(key), F.col("__x"), F.col("__y"))
    data = data.repartition(parts, spread).persist(StorageLevel.MEMORY_AND_DISK)
    first = data.select("__x").first()
    if first is None:
        raise ValueError("empty training table")
    dims = [len(first[0]), *hidden, out_dim]
    net = init_net(dims, init_std, seed)
    slots = max(1, math.isqrt(parts))
    curve: list[dict] = []
    try:
        for e in range(epochs + 1):
            train_now = e < epochs
            lr_e = lr * gamma ** (e // step) if step else lr
            bc = sc.broadcast(net.pack())
            fn = _epoch_task(bc, dims, loss, lr_e, batch_size, train_now, mode == "exact",
                             nominal_batch, "__x", "__y", slots, reduction == "sum")
            part = data.sortWithinPartitions(epoch_order(key, e), qcol(key)) \
                if (train_now and mode == "local") else data
            got = _combine(part.mapInPandas(fn, OUT_SCHEMA), parts)
            bc.destroy()
            m = [float(v) for v in got.pop(-1)[1]]
            n_fit, sse_fit, n_val, sse_val = m
            if e > 0 and loss == "softmax":
                curve.append({"epoch": e,
                              "train_accuracy": sse_fit / n_fit if n_fit else None,
                              "valid_accuracy": sse_val / n_val if n_val else None})
            elif e > 0:
                curve.append({
                    "epoch": e,
                    "train_rmse": math.sqrt(sse_fit / n_fit) * target_scale if n_fit else None,
                    "valid_rmse": math.sqrt(sse_val / n_val) * target_scale if n_val else None})
            if not train_now:
                break
            vec = np.concatenate([got[c][1] for c in sorted(got)])
            if mode == "exact":
                div = 1 if reduction == "sum" else (batch_size if nominal_batch else n_fit)
                net = DenseNet.unpack(net.pack() - lr_e * vec / div, dims)
            else:
                net = DenseNet.unpack(vec / n_fit, dims)
    finally:
        data.unpersist()
    return TrainResult(net, curve)


def dense_score(spark: SparkSession, net: DenseNet, features: Column | str,
                classes: bool = False) -> Column:
    """M9: score an ``array<double>`` column with a network, Arrow batches
    through a pandas UDF, weights broadcast once.  Returns a double (the one
    output) or, with ``classes``, the array of class scores."""
    from pyspark.sql.functions import pandas_udf
    bc = spark.sparkContext.broadcast(net.pack())
    dims = net.dims
    x = qcol(features) if isinstance(features, str) else features

    if classes:
        @pandas_udf("array<double>")
        def score_many(col: pd.Series) -> pd.Series:
            n = DenseNet.unpack(bc.value, dims)
            out = forward(n, np.stack(col.to_numpy()).astype(np.float64))[-1]
            return pd.Series(list(out))
        return score_many(x.cast("array<double>"))

    @pandas_udf("double")
    def score_one(col: pd.Series) -> pd.Series:
        n = DenseNet.unpack(bc.value, dims)
        return pd.Series(forward(n, np.stack(col.to_numpy()).astype(np.float64))[-1][:, 0])
    return score_one(x.cast("array<double>"))


def linear_sgd(spark: SparkSession, df: DataFrame, features: Sequence[str], label: str, *,
               key: str, lr: float = 0.03, epochs: int = 3, batch_size: int = 10,
               half: bool = True, nominal_batch: bool = True, partitions: int | None = None,
               valid: DataFrame | None = None, seed: int = 0,
               rows_per_part: int = 100_000) -> TrainResult:
    """M2 with mini-batches: the dense job with no hidden layer.  Batches
    follow each epoch's key-hash order inside every part; the step divides
    the batch's gradient sum by the nominal batch size, also on a short last
    batch, and the loss is halved (the from-scratch variant) unless
    ``half=False``.  With ``partitions=1`` this is plain sequential SGD; with
    more, one epoch per part and the parts' weights averaged."""
    arr = F.array(*[qcol(c).cast("double") for c in features]).alias("__feat")
    data = df.select(qcol(key), arr, qcol(label))
    val = valid.select(qcol(key), arr, qcol(label)) if valid is not None else None
    return train_dense(spark, data, "__feat", label, (), key=key, valid=val,
                       loss="half_mse" if half else "mse", lr=lr, epochs=epochs,
                       batch_size=batch_size, step=0, mode="local", partitions=partitions,
                       rows_per_part=rows_per_part,
                       seed=seed, nominal_batch=nominal_batch)
