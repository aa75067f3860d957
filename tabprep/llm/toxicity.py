"""Toxicity by a convolutional text classifier, trained in numpy.

Words are hashed embeddings: a vector for the word plus vectors for its
four-letter parts, so that unseen forms of a known stem are near it.  Filters
of several widths run over the word sequence of the whole text, the maximum
of each is kept and a linear layer makes the score.  Only one position per
filter and text has a gradient, which keeps training cheap.

The score is calibrated by language, as read off the text's own stop words:
each language has the threshold that serves its calibration rows best, and
scores are shifted so that it falls on 0.5.

Training reads every labelled row that is not held out, whole.  Rows are
dealt to shards by their id, each shard is one task that numbers its words
(neither texts nor words are kept) and descends from the
common model, and the changes of all shards are averaged (of an embedding:
over the shards that moved it), a fixed number of times.  The texts are on
disk once, as the files of the one shuffle that deals them: every round reads
these again.  Only the model, of fixed size, meets the driver.  Scoring reads
every text whole.  Filters are linear before the maximum, so scoring adds up
per-word tables instead of multiplying matrices.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import by_value, release, ship, shipped, text_of, trim
from .labelled import labelled, portions

by_value(__name__)

BUCKETS = 1 << 16
WIDTHS = {1: 8, 2: 4, 3: 4}  # filters by width
DIM = 16
CACHED_WORDS = 200_000
LONG_LIST = 64  # row numbers of a list that are summed place by place
HASHED_AT_ONCE = 20_000  # words whose parts are found together
CHARS_AT_ONCE = 200_000  # of short texts scored together
SHARD_CHARS = 32_000_000  # text of one training task
WORDS_AT_ONCE = 200_000  # of a batch in training, so that no text fills a task's memory
ROUNDS = 2  # times that the shards' models are averaged
SLICE = 1024  # buckets of one row of an update
ADDED_AT_ONCE = 64  # updates of a slice that one group adds
FINEST = 1000  # logits are counted to a thousandth for the thresholds
WORD = re.compile(r"[^\W\d_]+")

# Stop words that tell four languages apart.
LANGUAGES = {
    "en": "the of and to is that for it was on are as with be at by this from or".split(),
    "de": "der die das und den von mit sich auf für ist im dem nicht ein eine zu".split(),
    "fr": "le les des du et une est dans pour par sur au avec qui pas".split(),
    "es": "el los las del y que se con su para lo como más una".split(),
}
STOPS = {w: [i for i, (_, ws) in enumerate(LANGUAGES.items()) if w in ws] for ws in LANGUAGES.values() for w in ws}
UNKNOWN = len(LANGUAGES)


LANGUAGE = {w: found[0] for w, found in STOPS.items() if len(found) == 1}
CRC = np.array([zlib.crc32(bytes([b])) ^ 0xFF000000 for b in range(256)], np.uint32)[np.arange(256) ^ 0xFF]  # crc32 by byte


def crc_of(windows: list[np.ndarray]) -> np.ndarray:
    """crc32 of the UTF-8 form of many strings, given the code points at their
    first place, their second and so on."""
    crc = np.full(len(windows[0]), 0xFFFFFFFF, np.uint32)
    for c in windows:
        wide = np.flatnonzero(c > 0x7F)
        if not len(wide):
            crc = CRC[(crc ^ c) & 0xFF] ^ (crc >> 8)
            continue
        before, c_wide = crc[wide], c[wide]
        crc = CRC[(crc ^ c) & 0xFF] ^ (crc >> 8)
        after = before
        for more in (3, 2, 1, 0):  # bytes behind this one
            head = (c_wide > 0xFFFF).astype(int) + (c_wide > 0x7FF) + 1 if more else None
            byte = (c_wide >> (6 * more)) & 0x3F | 0x80
            if more:
                lead = np.array([0, 0xC0, 0xE0, 0xF0], np.uint32)[more]
                byte = np.where(head == more, c_wide >> (6 * more) | lead, byte)
                at = head >= more
                after = np.where(at, CRC[(after ^ byte) & 0xFF] ^ (after >> 8), after)
            else:
                after = CRC[(after ^ byte) & 0xFF] ^ (after >> 8)
        crc[wide] = after
    return ~crc


def parts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their four-letter parts (ends marked, a part
    that a word repeats counted once), and where each word's buckets start."""
    if len(words) > HASHED_AT_ONCE:
        found = [parts_of(words[i:i + HASHED_AT_ONCE]) for i in range(0, len(words), HASHED_AT_ONCE)]
        sizes = np.concatenate([np.diff(starts) for _, starts in found])
        return np.concatenate([flat for flat, _ in found]), np.concatenate([[0], np.cumsum(sizes)])
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    points = np.frombuffer("".join([f"<{w}>   " for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    windows = np.maximum(size - 1, 1)
    first = np.cumsum(size + 5) - (size + 5)
    own = np.repeat(np.arange(n), windows)
    place = np.arange(windows.sum()) + np.repeat(first - (np.cumsum(windows) - windows), windows)
    found = [points[place + j] for j in range(4)]
    crc = crc_of(found)
    if (short := np.flatnonzero(size[own] < 2)).size:  # "<a>" has three letters
        crc[short] = crc_of([x[short] for x in found[:3]])
    whole = np.fromiter((zlib.crc32(f"{w}=".encode()) for w in words), np.int64, n) | np.arange(n) << 33 | 1 << 32
    parts = np.sort(np.concatenate([whole, own << 33 | crc.astype(np.int64)]))
    parts = parts[np.append(True, parts[1:] != parts[:-1])[:len(parts)]]
    buckets = ((parts & 0xFFFFFFFF) % BUCKETS).astype(np.min_scalar_type(BUCKETS - 1))
    return buckets, np.concatenate([[0], np.cumsum(np.bincount(parts >> 33, minlength=n))])


class Vocabulary:
    """Word -> row number; new words are numbered as they come.  Row 0 stands
    beside the ends of a text."""

    def __init__(self) -> None:
        self.rows = defaultdict(count(1).__next__)

    def read(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words))


def sums(table: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row sums of ``table`` over ragged lists of its row numbers: the lists'
    first places together, then their second, longest lists first."""
    size = np.diff(starts)
    order = np.argsort(-size, kind="stable")
    first, total = starts[:-1][order], np.zeros((len(size), table.shape[1]))
    longer = len(size) - np.cumsum(np.bincount(np.minimum(size, LONG_LIST + 1), minlength=LONG_LIST + 2))
    for k in range(LONG_LIST):
        if not longer[k]:
            break
        total[:longer[k]] += table.take(flat[first[:longer[k]] + k], axis=0)
    for i in range(longer[LONG_LIST]):  # of words with very many letters
        rest = flat[first[i] + LONG_LIST:first[i] + size[order[i]]]
        total[i] += table.take(rest, axis=0).sum(0, dtype=np.float64)
    out = np.empty(total.shape, np.float32)
    out[order] = total
    return out


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, DIM, filters)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    shift: np.ndarray = field(default_factory=lambda: np.zeros(UNKNOWN + 1))  # logit threshold by language

    def tables(self) -> np.ndarray:
        """Per bucket, what it adds to each filter at each place of its window."""
        return np.concatenate([self.embedding @ f[j] for f in self.filters.values() for j in range(len(f))], 1)


def respond(rows: np.ndarray, first: np.ndarray, span: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per text of ``rows`` (at ``first``, ``span`` rows long) the largest
    response of every filter."""
    found, at, each = [], 0, table.take(rows, axis=0)
    for width, n in WIDTHS.items():
        best, ends = np.full((len(first), n), -np.inf, np.float32), span - width + 1
        some, last = np.flatnonzero(ends > 0), len(rows) - width + 1
        if len(some):
            total = each[:last, at:at + n]
            for j in range(1, width):
                total = total + each[j:j + last, at + j * n:at + (j + 1) * n]
            cuts = np.stack([first[some], first[some] + ends[some]], 1).ravel()
            best[some] = np.maximum.reduceat(total, cuts[:-1] if cuts[-1] == last else cuts, axis=0)[::2]
        found.append(best)
        at += width * n
    return np.concatenate(found, 1)


def language_of(counts: np.ndarray) -> int:
    """The language with most stop words; unknown without any."""
    return int(counts[:UNKNOWN].argmax()) if counts[:UNKNOWN].any() else UNKNOWN


@dataclass
class State:
    """A model in training: Adagrad keeps the squares of all its gradients."""
    model: Model
    memory: list[np.ndarray]  # as ``parameters``
    out_memory: float = 0.01

    def parameters(self) -> list[np.ndarray]:
        m = self.model
        return [m.embedding, *m.filters.values(), m.bias, m.out]

    def rest(self) -> np.ndarray:
        """All but the embedding, in one row."""
        return np.concatenate([*[p.ravel() for p in self.parameters()[1:]], *[p.ravel() for p in self.memory[1:]],
                               [self.model.out_bias, self.out_memory]]).astype(np.float64)

    def add_rest(self, change: np.ndarray) -> None:
        at = 0
        for p in (*self.parameters()[1:], *self.memory[1:]):
            p += change[at:at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        self.model.out_bias += float(change[at])
        self.out_memory += float(change[at + 1])


def started(seed: int = 3) -> State:
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32),
                  {w: rng.normal(0, 0.3, (w, DIM, n)).astype(np.float32) for w, n in WIDTHS.items()},
                  np.zeros(sum(WIDTHS.values()), np.float32),
                  rng.normal(0, 0.3, sum(WIDTHS.values())).astype(np.float32), 0.0)
    return State(model, [np.full(p.shape, 0.01, np.float32) for p in (model.embedding, *model.filters.values(), model.bias, model.out)])


def strongest(model: Model, flat: np.ndarray, starts: np.ndarray, seq: np.ndarray, first: np.ndarray,
              span: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Per text of ``seq`` (at ``first``, ``span`` rows long) the largest
    response of every filter and, by width, its place in ``seq``."""
    value = {w: np.full((len(first), n), -np.inf, np.float32) for w, n in WIDTHS.items()}
    place = {w: np.zeros((len(first), n), np.int64) for w, n in WIDTHS.items()}
    for at in range(0, len(seq), WORDS_AT_ONCE):
        used, inverse = distinct(seq[at:at + WORDS_AT_ONCE + max(WIDTHS) - 1], len(starts) - 1)
        x = vectors_of(model, flat, starts, used)[0].take(inverse, axis=0)
        for width, f in model.filters.items():
            ends = min(len(x) - width + 1, WORDS_AT_ONCE)
            if ends < 1:
                continue
            r = sum(x[j:j + ends] @ f[j] for j in range(width))
            for d, (a, n) in enumerate(zip(first - at, span)):
                lo, hi = max(0, a), min(ends, a + n - width + 1 - (width == 1))
                if lo < hi:
                    best = r[lo:hi].argmax(0)
                    found = r[lo + best, np.arange(f.shape[2])]
                    better = found > value[width][d]
                    value[width][d, better], place[width][d, better] = found[better], (at + lo + best)[better]
    return np.concatenate(list(value.values()), 1), place


def distinct(numbers: np.ndarray, among: int) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, of numbers below ``among``, unsorted."""
    place = np.zeros(among, np.int32)
    place[numbers] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used), dtype=np.int32)
    return used, place[numbers]


def vectors_of(model: Model, flat: np.ndarray, starts: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of some words, with their buckets and how many each has."""
    sizes = starts[used + 1] - starts[used]
    ends = np.cumsum(sizes)
    pieces = flat[np.repeat(starts[used] - (ends - sizes), sizes) + np.arange(sizes.sum())]
    return sums(model.embedding, pieces, np.concatenate([[0], ends])), pieces, sizes


@dataclass
class Numbered:
    """Texts as the row numbers of their words.  Neither texts nor words are
    kept: what training holds is four bytes a word, and the distinct ones' parts."""
    rows: np.ndarray  # of all words, text after text
    ends: np.ndarray  # of each text in ``rows``
    flat: np.ndarray  # buckets of the distinct words' parts, row after row
    starts: np.ndarray

    @classmethod
    def of(cls, texts: Iterable[str]) -> Numbered:
        words, rows, ends = Vocabulary(), array("i"), array("q")
        for text in texts:
            for portion in portions(text):
                rows.frombytes(words.read(WORD.findall(portion.lower())).tobytes())
            ends.append(len(rows))
        flat, starts = parts_of(list(words.rows))
        # row 0 has no parts
        return cls(np.frombuffer(rows, np.int32), np.frombuffer(ends, np.int64), flat, np.concatenate([[0], starts]))

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, d: int) -> np.ndarray:
        return self.rows[self.ends[d - 1] if d else 0:self.ends[d]]


def descend(state: State, texts: Iterable[str], y: np.ndarray, weight: np.ndarray, epochs: int, seed: int,
            batch: int = 8, rate: float = 0.1) -> None:
    """Adagrad on the logistic loss of some texts, from ``state``."""
    descend_on(state, Numbered.of(texts), y, weight, epochs, seed, batch, rate)


def descend_on(state: State, docs: Numbered, y: np.ndarray, weight: np.ndarray, epochs: int, seed: int,
               batch: int = 8, rate: float = 0.1) -> None:
    """``descend`` on texts that are numbered already."""
    rng, model = np.random.default_rng(seed), state.model
    flat, starts = docs.flat, docs.starts

    def step(i: int, g: np.ndarray, rows=slice(None)) -> None:
        p, memory = state.parameters()[i], state.memory[i]
        memory[rows] += g * g
        p[rows] -= rate * g / np.sqrt(memory[rows])

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for some in (order[i:i + batch] for i in range(0, len(order), batch)):
            # texts of the batch in one sequence, two empty rows between them
            seq = np.concatenate([np.concatenate([[0], docs[d], [0, 0]]) for d in some]).astype(np.int64)
            span = np.array([len(docs[d]) + 3 for d in some])
            first = np.concatenate([[0], np.cumsum(span)[:-1]])
            pooled, places = strongest(model, flat, starts, seq, first, span)
            z = pooled + model.bias
            act = np.maximum(z, 0)
            logit = act @ model.out + model.out_bias
            g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[some]) * weight[some] / len(some)
            gz = np.outer(g, model.out) * (z > 0)
            # only the strongest windows have a gradient
            used = np.unique(np.concatenate([seq[places[w] + j].ravel() for w in WIDTHS for j in range(w)]))
            vectors, pieces, sizes = vectors_of(model, flat, starts, used)
            grad_x, column = np.zeros_like(vectors), 0
            for i, (width, f) in enumerate(model.filters.items(), 1):
                n = f.shape[2]
                gf, part = np.zeros_like(f), gz[:, column:column + n].astype(np.float32)
                for j in range(width):
                    at = np.searchsorted(used, seq[places[width] + j])
                    gf[j] = np.einsum("bfd,bf->df", vectors[at], part)
                    np.add.at(grad_x, at.ravel(), part.reshape(-1, 1) * np.tile(f[j].T, (len(some), 1)))
                step(i, gf)
                column += n
            step(len(WIDTHS) + 2, (act.T @ g).astype(np.float32))
            step(len(WIDTHS) + 1, gz.sum(0).astype(np.float32))
            state.out_memory += float(g.sum() ** 2)
            model.out_bias -= float(rate * g.sum() / np.sqrt(state.out_memory))
            touched = np.repeat(np.arange(len(used)), sizes)
            keep = (np.abs(grad_x).sum(1) > 0)[touched]
            rows, where = distinct(pieces[keep], BUCKETS)
            ge = np.zeros((len(rows), DIM), np.float32)
            np.add.at(ge, where, grad_x[touched[keep]])
            step(0, ge, rows)


class Scorer:
    """Scores texts with a model; keeps a bounded table of known words."""

    def __init__(self, model: Model) -> None:
        self.model, self.per_bucket = model, model.tables().astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.words, self.filled = Vocabulary(), 1
        self.table = np.zeros((1024, self.per_bucket.shape[1]), np.float32)
        self.language = np.full(1024, UNKNOWN)

    def read(self, words: list[str]) -> np.ndarray:
        """Table rows of some words, filled in for the new ones."""
        rows, first = self.words.read(words), self.filled
        n = len(self.words.rows) + 1
        if n > len(self.table):
            more = n + n // 4 - len(self.table)
            self.table = np.concatenate([self.table, np.zeros((more, self.table.shape[1]), np.float32)])
            self.language = np.concatenate([self.language, np.full(more, UNKNOWN)])
        if n > first:
            at = np.flatnonzero(rows >= first)
            new = [words[i] for i in at[np.unique(rows[at], return_index=True)[1]]]
            self.table[first:n] = sums(self.per_bucket, *parts_of(new))
            self.language[first:n] = [LANGUAGE.get(w, UNKNOWN) for w in new]
            self.filled = n
        return rows

    def logits(self, texts: Iterable[str]) -> Iterator[tuple[float, int]]:
        """(score as a logit, language) of whole texts; short ones are read
        some at once."""
        some, size = [], 0
        for text in texts:
            if size + len(text) > CHARS_AT_ONCE and some:
                yield from self.logits_of(some)
                some, size = [], 0
            if len(text) > CHARS_AT_ONCE:
                yield self.logit(text)
            else:
                some.append(text)
                size += len(text) + 1
        if some:
            yield from self.logits_of(some)

    def logits_of(self, texts: list[str]) -> Iterator[tuple[float, int]]:
        if self.filled > CACHED_WORDS:
            self.forget()
        words = [WORD.findall(t.lower()) for t in texts]
        n = np.fromiter(map(len, words), np.int64, len(words))
        read = self.read([w for ws in words for w in ws])
        own, ends = np.repeat(np.arange(len(n)), n), np.cumsum(n)
        # an empty row before and behind each text
        rows = np.zeros(len(read) + 2 * len(n), np.int32)
        rows[np.arange(len(read)) + 2 * own + 1] = read
        counts = np.bincount(own * (UNKNOWN + 1) + self.language[read], minlength=len(n) * (UNKNOWN + 1))
        pooled = respond(rows, ends - n + 2 * np.arange(len(n)), n + 2, self.table)
        for p, c in zip(pooled, counts.reshape(-1, UNKNOWN + 1)):
            yield self.logit_of(p), language_of(c)

    def logit(self, text: str) -> tuple[float, int]:
        """The same of one text of any length, portion by portion: the last
        words of one stand before the next, so no window is lost."""
        pooled = np.full(sum(WIDTHS.values()), -np.inf, np.float32)
        counts, before = np.zeros(UNKNOWN + 1, np.int64), []
        rows, overlap = np.zeros(1, np.int32), max(WIDTHS) - 1

        def largest(rows: np.ndarray) -> np.ndarray:
            return np.maximum(pooled, respond(rows, np.zeros(1, np.int64), np.array([len(rows)]), self.table)[0])

        for portion in portions(text):
            if self.filled > CACHED_WORDS:
                self.forget()
            words = WORD.findall(portion.lower())
            rows = self.read(before + words)
            counts += np.bincount(self.language[rows[len(before):]], minlength=UNKNOWN + 1)
            rows = rows if before else np.concatenate([np.zeros(1, np.int32), rows])
            pooled = largest(rows)
            before = (before + words)[-overlap:]
        pooled = largest(np.append(rows[-overlap:], np.int32(0)))  # the windows over the end of the text
        return self.logit_of(pooled), language_of(counts)

    def logit_of(self, pooled: np.ndarray) -> float:
        z = np.maximum(pooled + self.model.bias, 0)
        return float(z @ self.model.out + self.model.out_bias)

    def scores(self, texts: Iterable[str]) -> list[float]:
        return [float(1 / (1 + np.exp(-np.clip(a - self.model.shift[k], -30, 30)))) for a, k in self.logits(texts)]


def threshold(logits: np.ndarray, y: np.ndarray, clean_weight: float) -> float:
    """The cut with least weighted error, in the middle of its gap."""
    order = np.argsort(logits, kind="stable")
    return cut_of(logits[order], y[order], 1 - y[order], clean_weight)


def cut_of(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, clean_weight: float) -> float:
    """The same from the numbers of rows of each class at ascending logits."""
    missed = np.concatenate([[0], np.cumsum(toxic)])  # cut before place i: toxic rows below it
    alarms = np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    cost = missed + clean_weight * alarms
    best = np.flatnonzero(cost == cost.min())
    width = np.concatenate([[0], x[1:] - x[:-1], [0]])
    return float(edges[best[width[best].argmax()]])


def calibrate(model: Model, rows: RDD[Row], clean_weight: float = 3.0, least: int = 10) -> None:
    """Sets the thresholds by language from all ``rows`` (``t, y``), counted by
    their logits to a thousandth; languages with fewer than ``least`` rows of
    either class take the common one."""
    sent = ship(SparkSession.active(), model)

    def logits(some: Iterator[Row]) -> Iterator[tuple]:
        scorer = Scorer(shipped(sent))
        y = deque()  # of the texts that are read but not yet counted
        for logit, language in scorer.logits(y.append(r["y"]) or r["t"] for r in some):
            yield language, int(np.round(np.clip(logit, -30, 30) * np.float64(FINEST))), y.popleft()
        del scorer
        trim()

    # at most 60,001 places by language
    counted = (rows.mapPartitions(logits).toDF("language int, at int, y int").groupBy("language", "at")
               .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")).collect())
    found = np.array([tuple(r) for r in counted], np.int64).reshape(-1, 4)

    def cut(own: np.ndarray) -> float:
        at, where = np.unique(own[:, 1], return_inverse=True)
        return cut_of(at / FINEST, np.bincount(where, own[:, 2]), np.bincount(where, own[:, 3]), clean_weight)

    model.shift[:] = cut(found) if len(found) else 0.0
    for k in range(UNKNOWN + 1):
        own = found[found[:, 0] == k]
        if len(own) and own[:, 2:].sum(0).min() >= least:
            model.shift[k] = cut(own)


def fit(docs: DataFrame, labels: DataFrame, epochs: int = 6, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on every labelled row that is not held out, whole, but for a
    fifth (by a hash of the id) that calibrates.  Without rows the model
    scores 0.5."""
    tuning = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 4
    lengths = docs.select(id_col, F.length(text_of(text_col)).alias("n"))
    size = (labelled(lengths, labels, "toxic", id_col, "n").where(~tuning)
            .agg(F.count(F.lit(1)), F.sum("y"), F.sum(F.col("t").cast("long") + 1)).first())
    n, toxic = int(size[0]), int(size[1] or 0)
    weight = n / max(1, 2 * (n - toxic)), n / max(1, 2 * toxic)
    shards = max(1, -(-int(size[2] or 0) // SHARD_CHARS))
    # dealt by a hash of the id, in an order of its own: the same on any
    # partitioning.  One RDD for all rounds: its shuffle runs once and its
    # files are read by each, where frames would each shuffle or keep a copy
    rows = (labelled(docs, labels, "toxic", id_col, text_col, shards)
            .sortWithinPartitions(F.xxhash64("id", F.lit(5)), "id", "t").select("t", "y", tuning.alias("tuning"))).rdd
    state = started()
    for k in range(ROUNDS if n else 0):
        averaged(state, rows.filter(lambda r: not r["tuning"]), weight, -(-epochs // ROUNDS), k, k + 1 < ROUNDS)
        release(docs.sparkSession)  # the updates of this round
    calibrate(state.model, rows.filter(lambda r: r["tuning"]))
    return state.model


def averaged(state: State, dealt: RDD[Row], weight: tuple[float, float], epochs: int, seed: int, remember: bool = True) -> None:
    """One round: every partition descends from ``state``, which then moves by
    the mean of their changes; without ``remember``, which no round follows,
    the embedding's memory stays behind."""
    columns = 2 * DIM if remember else DIM
    sent = ship(SparkSession.active(), state)

    def task(some: Iterator[Row]) -> Iterator[tuple]:
        y, shard = array("d"), 0

        def texts() -> Iterator[str]:
            nonlocal shard
            for r in some:
                shard = shard if y else zlib.crc32(r["t"].encode())
                y.append(r["y"])
                yield r["t"]

        docs = Numbered.of(texts())
        if not len(docs):
            return
        y = np.array(y)
        own = shipped(sent)
        descend_on(own, docs, y, np.where(y == 1, weight[1], weight[0]), epochs, seed)
        del docs
        before = shipped(sent)
        for i, a in enumerate(range(0, BUCKETS, SLICE)):
            moved = np.concatenate([own.model.embedding[a:a + SLICE] - before.model.embedding[a:a + SLICE],
                                    own.memory[0][a:a + SLICE] - before.memory[0][a:a + SLICE]], 1)
            moved = np.concatenate([moved[:, :columns], (moved != 0).any(1, keepdims=True)], 1).astype(np.float32)
            yield i, shard, moved.tobytes()
        # the rest is one more slice; the last number counts the shards
        yield i + 1, shard, np.append(own.rest() - before.rest(), 1.0).astype(np.float32).tobytes()
        del own, before, moved
        trim()

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(order=[zlib.crc32(p) for p in group["part"]]).sort_values(["shard", "order"])
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in group["part"]).astype(np.float32)
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "shard": group["shard"].iloc[:1], "part": [total.tobytes()]})

    kind = "slice int, shard long, part binary"
    moved = dealt.mapPartitions(task).toDF(kind)
    # in two steps, so that no group holds the updates of many shards, the
    # second with a small part of the first one's bytes
    groups = -(-dealt.getNumPartitions() // ADDED_AT_ONCE)
    some = moved.groupBy("slice", F.pmod("shard", F.lit(groups))).applyInPandas(lambda g: added(g), kind)
    for r in some.groupBy("slice").applyInPandas(lambda g: added(g), kind).collect():
        total = np.frombuffer(r["part"], np.float32)
        if r["slice"] * SLICE >= BUCKETS:
            state.add_rest(total[:-1] / total[-1])
        else:
            total = total.reshape(SLICE, columns + 1)
            mean, at = total[:, :-1] / np.maximum(total[:, -1:], 1), slice(r["slice"] * SLICE, (r["slice"] + 1) * SLICE)
            state.model.embedding[at] += mean[:, :DIM]
            if remember:
                state.memory[0][at] += mean[:, DIM:]


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each text as column ``out``.

    Defined cases: null and empty texts, and texts without a word, have the
    score of no evidence; texts of any length are read whole; repeated rows
    get a score each; without rows there are none; a column named like
    ``out`` is replaced, all others stay.
    """
    sent = ship(docs.sparkSession, model)  # its size is fixed by BUCKETS and DIM

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shipped(sent))
        for texts in batches:
            yield pd.Series(scorer.scores(texts), dtype="float64")
        scorer = texts = None
        trim()

    return docs.withColumn(out, scored(text_of(text_col)))


def non_toxic(docs: DataFrame, model: Model, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with their columns."""
    mark = "toxic_score_" + "_".join(docs.columns)
    return score(docs, model, text_col, mark).where(F.col(f"`{mark}`") < cut).drop(mark)
