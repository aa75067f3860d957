"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are shares of character classes and
word statistics of the line and of the lines before and after it; the chain
adds weights for label changes.  Forward-backward gives the probability that
each line is good, and the length-weighted mean over the lines is the
document's quality, shifted so that the cut of the calibration rows falls on
the decision threshold.

Training (maximum likelihood, in numpy) uses a bounded sample of labelled
documents, whose label all their lines carry; scoring reads every text whole.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, ship, shipped, text_of
from .labelled import portions, sample
from .toxicity import threshold

by_value(__name__)

# Classes of UTF-8 bytes.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c",
           b".,;:'\"-?()", b"!", b"|", b"*#$%&+=<>@\\^_`~{}[]/", bytes(range(128, 256))]
CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c)] = _i
N_CLASSES = len(CLASSES) + 1
N_OWN = N_CLASSES + 7
N_FEATURES = 3 * N_OWN + 3  # own, before, after; no line before, none after, constant


def lines_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of its own, byte length) of every line that is not blank."""
    found, sizes = [], []
    seen: set[int] = set()
    for portion in portions(text, lines=True):
        lines = [x for x in portion.split("\n") if x and not x.isspace()]
        if not lines:
            continue
        raw = [x.encode("utf-8", "replace") for x in lines]
        size = np.array([len(x) for x in raw])
        owner = np.repeat(np.arange(len(lines)), size)
        classes = CLASS_OF[np.frombuffer(b"".join(raw), np.uint8)]
        shares = np.bincount(owner * N_CLASSES + classes, minlength=len(lines) * N_CLASSES).reshape(-1, N_CLASSES)
        more = np.empty((len(lines), 7))
        for i, line in enumerate(lines):
            words = line.split()
            n = len(words)
            key = hash(line)
            more[i] = (np.log1p(n) / 5, len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n,
                       min(len(line) / n, 30) / 10, line[-1] in ".!?", line[0].isupper(), key in seen)
            seen.add(key)
        found.append(np.concatenate([shares / size[:, None], more], 1))
        sizes.append(size)
    if not found:
        return np.zeros((0, N_OWN)), np.zeros(0)
    return np.concatenate(found), np.concatenate(sizes).astype(float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    n = len(own)
    x = np.zeros((n, N_FEATURES))
    if n:
        x[:, :N_OWN] = own
        x[1:, N_OWN:2 * N_OWN] = own[:-1]
        x[:-1, 2 * N_OWN:3 * N_OWN] = own[1:]
        x[0, -3] = x[-1, -2] = 1
        x[:, -1] = 1
    return x


def padded(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Unary scores of several documents (lines, 2) as (line, document, 2),
    and which places are lines."""
    longest = max(map(len, chains))
    out, real = np.zeros((longest, len(chains), 2)), np.zeros((longest, len(chains)), bool)
    for d, u in enumerate(chains):
        out[:len(u), d], real[:len(u), d] = u, True
    return out, real


def forward_backward(unary: np.ndarray, real: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals (line, document, 2), expected label pairs (2, 2)) of chains
    whose lines stand at the start of each column."""
    n, docs = real.shape
    local = np.exp(unary - unary.max(2, keepdims=True))
    move = np.exp(change - change.max())
    alpha, beta = np.empty_like(local), np.ones_like(local)
    alpha[0] = local[0] / local[0].sum(1, keepdims=True)
    for t in range(1, n):
        a = (alpha[t - 1] @ move) * local[t]
        alpha[t] = np.where(real[t][:, None], a / a.sum(1, keepdims=True), alpha[t - 1])
    pairs = np.zeros((2, 2))
    for t in range(n - 2, -1, -1):
        ahead = local[t + 1] * beta[t + 1]
        b = ahead @ move.T
        beta[t] = np.where(real[t + 1][:, None], b / b.sum(1, keepdims=True), 1.0)
        both = alpha[t][:, :, None] * move * ahead[:, None, :]
        both /= both.sum((1, 2), keepdims=True)
        pairs += both[real[t + 1]].sum(0)
    marginals = alpha * beta
    return marginals / marginals.sum(2, keepdims=True), pairs


@dataclass
class Model:
    weights: np.ndarray  # (features, 2)
    change: np.ndarray  # (2, 2)
    mean: np.ndarray
    scale: np.ndarray
    shift: float = 0.0

    def unary(self, own: np.ndarray) -> np.ndarray:
        return with_neighbours((own - self.mean) / self.scale) @ self.weights

    def logits(self, texts: list[str], most: int = 200_000) -> np.ndarray:
        """Quality of whole texts as logits before the shift; 0 without a
        line.  Documents of like length are taken together."""
        out = np.zeros(len(texts))
        read = [lines_of(t) for t in texts]
        order = sorted((i for i, (own, _) in enumerate(read) if len(own)), key=lambda i: len(read[i][0]))
        while order:
            longest = len(read[order[-1]][0])
            some = order[-max(1, most // longest):]
            del order[-len(some):]
            unary, real = padded([self.unary(read[i][0]) for i in some])
            good = forward_backward(unary, real, self.change)[0][:, :, 1]
            for d, i in enumerate(some):
                size = read[i][1]
                share = float((good[:len(size), d] * size).sum() / size.sum())
                out[i] = np.log((share + 1e-6) / (1 - share + 1e-6))
        return out

    def scores(self, texts: list[str], cut: float) -> np.ndarray:
        z = self.logits(texts) - self.shift + np.log(cut / (1 - cut))
        return 1 / (1 + np.exp(-z))


def train(texts: list[str], y: np.ndarray, rounds: int = 150, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Maximum likelihood of the documents' labels on all their lines, each
    document weighing the same, by Adam on the whole sample."""
    read = [(lines_of(t)[0], label) for t, label in zip(texts, y)]
    read = [(own, int(label)) for own, label in read if len(own)]
    if not read:
        return Model(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(N_OWN), np.ones(N_OWN))
    every = np.concatenate([own for own, _ in read])
    model = Model(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), every.mean(0), every.std(0) + 0.05)
    x = np.concatenate([with_neighbours((own - model.mean) / model.scale) for own, _ in read])
    count = np.array([len(own) for own, _ in read])
    label = np.array([k for _, k in read])
    ends = np.cumsum(count)
    _, real = padded([np.zeros((n, 2)) for n in count])
    at = real.T.nonzero()  # (document, line) of the rows of x
    truth, weight = np.eye(2)[label[at[0]]], (1 / count)[at[0]][:, None]
    weight /= weight.sum()
    moves = np.zeros((2, 2))
    for k in (0, 1):
        moves[k, k] = (count[label == k] - 1).sum()
    total = max(1, moves.sum())
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.change)]
    for step in range(1, rounds + 1):
        unary = np.zeros((*real.shape, 2))
        unary[at[1], at[0]] = x @ model.weights
        marginals, pairs = forward_backward(unary, real, model.change)
        grads = (x.T @ ((marginals[at[1], at[0]] - truth) * weight) + decay * model.weights,
                 (pairs - moves) / total + decay * model.change)
        for p, g, (m, v) in zip((model.weights, model.change), grads, state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    assert ends[-1] == len(x)
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 8000,
        bad_weight: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of labelled rows that are not held out
    (``per_class`` rows of either class, of at most ``max_chars``); every
    fifth row of it sets the cut (``bad_weight``: what a bad document let
    through costs, against a good one lost)."""
    rows = sorted(sample(docs, labels, "quality", per_class, max_chars, id_col, text_col).collect(),
                  key=lambda r: zlib.crc32(str(r["id"]).encode()))
    texts, y = [r["t"] for r in rows], np.array([r["y"] for r in rows], np.float64)
    tuning = np.arange(len(rows)) % 5 == 4
    model = train([t for t, k in zip(texts, tuning) if not k], y[~tuning])
    if tuning.any():
        model.shift = threshold(model.logits([t for t, k in zip(texts, tuning) if k]), y[tuning], bad_weight)
    return model


def score(docs: DataFrame, model: Model, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1, good from ``cut`` on) per document.

    Defined cases: null, empty and blank texts have no line and the score of
    no evidence; texts of any length are read whole; repeated rows get a row
    each; null ids stay null; without rows there are none; other columns are
    ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = ship(docs.sparkSession, model)  # a few hundred numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shipped(shared)
        for batch in batches:
            for a in range(0, len(batch), 500):
                some = batch.iloc[a:a + 500]
                yield pd.DataFrame({"id": some["id"], "score": own.scores(list(some["t"]), cut)})

    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
            .mapInPandas(run, f"id {kind}, score double").withColumnRenamed("id", id_col))
