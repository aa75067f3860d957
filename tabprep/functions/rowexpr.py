"""Row expressions for scoring and losses (M8, M10-M12, P8), all built-in
array/math functions inside whole-stage codegen, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def relu(x: Column) -> Column:
    """max(x, 0)."""
    return F.greatest(x, F.lit(0.0))


def squared_loss(pred: Column, label: Column, half: bool = True) -> Column:
    """(p - y)^2, halved when ``half`` (the from-scratch loss)."""
    e = pred.cast("double") - label.cast("double")
    return e * e / 2.0 if half else e * e


def affine(x: Column, scale: float, shift: float) -> Column:
    """X * scale + shift."""
    return x * F.lit(float(scale)) + F.lit(float(shift))


def dot(x: Column, w: Sequence[float]) -> Column:
    """x . w for an array column x and literal weights w."""
    wl = F.array(*[F.lit(float(v)) for v in w])
    prods = F.zip_with(x, wl, lambda a, b: a.cast("double") * b)
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def linear_score(x: Column | Sequence[Column], w: Sequence[float], b: float) -> Column:
    """M8: X w + b, for an array column or a list of scalar columns."""
    if isinstance(x, Column):
        return dot(x, w) + F.lit(float(b))
    s = F.lit(float(b))
    for xi, wi in zip(x, w):
        s = s + xi.cast("double") * F.lit(float(wi))
    return s


def class_scores(x: Column, weights: Sequence[Sequence[float]],
                 bias: Sequence[float] | None = None) -> Column:
    """M8 with k outputs: array of k scores x . W_k + b_k."""
    bias = bias or [0.0] * len(weights)
    return F.array(*[dot(x, wk) + F.lit(float(bk)) for wk, bk in zip(weights, bias)])


def argmax(scores: Column) -> Column:
    """0-based index of the largest score; the first maximum wins."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(scores: Column, label: Column) -> Column:
    """Stable per-row cross entropy log(sum(exp(s - max))) + max - s[y]."""
    m = F.array_max(scores)
    lse = F.log(F.aggregate(F.transform(scores, lambda s: F.exp(s - m)),
                            F.lit(0.0), lambda acc, v: acc + v)) + m
    return lse - F.element_at(scores, label.cast("int") + 1)


def dense_layers(x: Column, layers: Sequence[tuple[Sequence[Sequence[float]], Sequence[float]]],
                 hidden: str = "relu") -> Column:
    """M9 for small networks as array expressions: Linear, ReLU, ..., Linear.
    ``layers`` = [(W (out x in), b), ...]; returns the output array."""
    h = x
    for i, (w, b) in enumerate(layers):
        h = class_scores(h, w, b)
        if i < len(layers) - 1:
            h = F.transform(h, relu) if hidden == "relu" else \
                F.transform(h, lambda v: F.lit(1.0) / (F.lit(1.0) + F.exp(-v)))
    return h
