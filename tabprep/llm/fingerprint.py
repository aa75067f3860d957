"""Document fingerprints by invertible Bloom lookup sketches.

A text is a multiset of cells of paragraphs: runs of up to ``RUN`` words that
end at a sentence or line end, repeats told apart by their number.  Its sketch
has a few table cells, each holding a count, a sum of 64-bit digests and a sum
of check values; every digest is added to one cell of each of three parts.
Sketches of two versions subtract cell by cell: what both have cancels, and
peeling (a cell with a count of one and a fitting check is a single digest;
take it out of its other cells and go on) recovers the digests that differ.
If peeling gets stuck, the pair is sketched again with four times the cells.

The likeness of two texts is 1 - (differing digests) / (digests of both).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, text_of

by_value(__name__)

RUN = 8
CELLS = 24  # of the fingerprint itself; three parts
CELL = re.compile(r"(?:\S*[^\s.!?][^\S\n]+){0,%d}\S+" % (RUN - 1))
#: Odd 64-bit numbers that spread digests over the parts and checks.
SPREAD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
BLOCK_CHARS = 2_000_000


def digests(text: str) -> np.ndarray:
    """64-bit digests of the text's cells, all different: a cell's hash,
    mixed with how often the cell came before."""
    seen: Counter = Counter()
    hashes, before = [], []
    for cell in CELL.findall(text):
        hashes.append(xxhash.xxh3_64_intdigest(cell.encode("utf-8", "replace")))
        before.append(seen[cell])
        seen[cell] += 1
    return np.unique(_mixed(np.array(hashes, np.uint64) + np.array(before, np.uint64) * SPREAD[3], 0))


def _mixed(x: np.ndarray, j: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * SPREAD[j]
    return x ^ (x >> np.uint64(32))


def _check(x: np.ndarray) -> np.ndarray:
    return _mixed(x, 3).astype(np.uint32)


class Sketches:
    """Tables of ``n`` sketches with ``cells`` cells each, as flat arrays."""

    def __init__(self, n: int, cells: int) -> None:
        self.n, self.cells, self.part = n, cells, cells // 3
        self.count = np.zeros(n * cells, np.int32)
        self.keys = np.zeros(n * cells, np.uint64)
        self.checks = np.zeros(n * cells, np.uint32)

    def places(self, x: np.ndarray, owner: np.ndarray, j: int) -> np.ndarray:
        return owner * self.cells + j * self.part + (_mixed(x, j) % np.uint64(self.part)).astype(np.int64)

    def add(self, x: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Adds digests (``sign`` 1) or takes them out (-1)."""
        sign = np.broadcast_to(np.asarray(sign, np.int32), x.shape)
        key = np.where(sign > 0, x, np.uint64(0) - x)
        check = np.where(sign > 0, _check(x), np.uint32(0) - _check(x))
        for j in range(3):
            at = self.places(x, owner, j)
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, key)
            np.add.at(self.checks, at, check)

    def text(self, i: int, size: int) -> str:
        """The sketch as base64: number of digests, then counts, sums, checks."""
        a, b = i * self.cells, (i + 1) * self.cells
        return base64.b64encode(struct.pack("<I", size) + self.count[a:b].astype("<i4").tobytes()
                                + self.keys[a:b].astype("<u8").tobytes()
                                + self.checks[a:b].astype("<u4").tobytes()).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """(differing digests per sketch, whether all were recovered); a
        digest has one cell in each part, so a part never yields it twice."""
        found = np.zeros(self.n, np.int64)
        table = np.arange(self.n * self.cells).reshape(self.n, 3, self.part)
        moved = True
        while moved:
            moved = False
            for j in range(3):
                at = table[:, j].ravel()
                at = at[np.abs(self.count[at]) == 1]
                sign = self.count[at]
                x = np.where(sign > 0, self.keys[at], np.uint64(0) - self.keys[at])
                check = np.where(sign > 0, self.checks[at], np.uint32(0) - self.checks[at])
                owner = at // self.cells
                pure = (check == _check(x)) & (self.places(x, owner, j) == at)
                if pure.any():
                    moved = True
                    self.add(x[pure], owner[pure], -sign[pure])
                    found += np.bincount(owner[pure], minlength=self.n)
        left = (self.count != 0) | (self.keys != 0)
        return found, ~left.reshape(self.n, self.cells).any(1)


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Likeness (0 to 1) of pairs of digest sets, from their sketches'
    difference; 1 if both are empty."""
    both = np.array([len(x) + len(y) for x, y in zip(a, b)])
    apart = np.zeros(len(a), np.int64)
    # a pair whose sizes differ by more than a table can hold starts larger
    need = np.array([abs(len(x) - len(y)) for x, y in zip(a, b)])
    cells = np.full(len(a), CELLS)
    while (cells < 1.2 * need).any():
        cells[cells < 1.2 * need] *= 4
    open_ = both > 0
    while open_.any():
        size = int(cells[open_].min())
        # tables of one size together, in groups of bounded memory
        some = np.flatnonzero(open_ & (cells == size))[:max(1, 600_000 // size)]
        table = Sketches(len(some), size)
        for sets, sign in ((a, 1), (b, -1)):
            x = np.concatenate([sets[i] for i in some])
            table.add(x, np.repeat(np.arange(len(some)), [len(sets[i]) for i in some]), sign)
        found, whole = table.peel()
        apart[some[whole]] = found[whole]
        open_[some[whole]] = False
        cells[some[~whole]] *= 4
    return 1 - apart / np.maximum(both, 1)


def compare(rows: list[tuple]) -> pd.DataFrame:
    """(id, text, next text) -> the result's columns."""
    edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for _, t, after in rows]
    known: dict[str, np.ndarray] = {}

    def of(text: str) -> np.ndarray:
        if text not in known:
            known[text] = digests(text)
        return known[text]

    own, new, later = ([of(t) for t in ts] for ts in ([r[1] for r in rows], edited, [r[2] for r in rows]))
    n = len(rows)
    table = Sketches(2 * n, CELLS)
    table.add(np.concatenate(own + new), np.repeat(np.arange(2 * n), [len(x) for x in own + new]))
    prints = [table.text(i, len(x)) for i, x in enumerate(own + new)]
    return pd.DataFrame({
        "id": [r[0] for r in rows], "n_chars": [len(r[1]) for r in rows],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited],
        "fingerprint": prints[:n], "edited_fingerprint": prints[n:],
        "near_edited": likeness(own, new), "near_next": likeness(own, later)})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.  The edited text is the
    first half with the first half of the next document's text (descending
    id; after the last one comes the first).

    The order needs no global sort: documents are dealt to ranges of ids, cut
    at approximate quantiles, and each range also gets the one document that
    follows it, so the text is shuffled once.

    Defined cases: a null text counts as empty (no digests; likeness 1 to
    another empty text, else 0); a null id comes last; documents that repeat
    an id are ordered by text; a single document is its own next; an empty
    table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(lowest))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("k"), text_of(text_col).alias("t"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("k", points, 10_000).alias("cuts")).first()["cuts"] or []
    edges = [-float("inf"), *sorted({float(c) for c in cuts}), float("inf")]
    if len(edges) < 3:
        edges.insert(1, 0.0)
    ranged = Bucketizer(splits=edges, inputCol="kd", outputCol="part").transform(rows.withColumn("kd", F.col("k").cast("double")))
    # one row per range: at most `parts`
    tops = {int(r["part"]): r["top"] for r in ranged.groupBy("part").agg(F.max("k").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    follows = [(tops[b], a) for a, b in zip(order, [*order[1:], *order[:1]])]
    border = (spark.createDataFrame(follows or [(0, -1)], "k long, extra int")
              .groupBy("k").agg(F.collect_list("extra").alias("extra")))
    copies = F.concat(F.array(F.struct(F.col("part").cast("int").alias("part"), F.lit(0).alias("role"))),
                      F.transform(F.coalesce("extra", F.array().cast("array<int>")),
                                  lambda e: F.struct(e.alias("part"), F.lit(1).alias("role"))))
    dealt = (ranged.join(F.broadcast(border), "k", "left")
             .select("id", "k", "t", F.explode(copies).alias("c")).select("c.part", "c.role", "id", "k", "t")
             .repartition(parts, "part").sortWithinPartitions("part", "role", F.desc("k"), "t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, block, chars = None, [], 0
        for batch in batches:
            for part, role, key, text in zip(batch["part"], batch["role"], batch["id"], batch["t"]):
                if last and last[0] == part and not last[1]:
                    block.append((last[2], last[3], text))
                    chars += len(last[3]) + len(text)
                    if chars > BLOCK_CHARS:
                        yield compare(block)
                        block, chars = [], 0
                last = (part, role, None if pd.isna(key) else key, text)
        if block:
            yield compare(block)

    out = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
    kind = docs.schema[id_col].dataType
    return (dealt.select("part", "role", "id", "t").mapInPandas(run, out)
            .withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col))
