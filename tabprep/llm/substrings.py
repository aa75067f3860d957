"""Exact removal of repeated byte strings by a depth-limited radix sort.

Every start of a ``DEPTH``-byte string is a suffix; two of them matter to
each other only through their first ``DEPTH`` bytes.  Suffixes are sorted that
far, most significant digit first, and leave as soon as they stand alone in
their group; what is left at full depth are exactly the repeated strings.  In
each final group the earliest suffix stays and the bytes of the others go.

The first digit makes this affordable.  It is not the first bytes of a string
but its anchor: the ``GRAM``-byte piece inside it that comes first in a fixed
order (the leftmost of equals).  Equal strings have equal anchors at equal
places, and neighbouring suffixes mostly share theirs.  The order is by hash,
but grams that the corpus counts as common come last: a string that holds a
common line and something else is then sorted by what else it holds.  So

1. one row per anchor of a text (three in a hundred bytes), not per suffix,
   is shuffled to find the anchors that occur twice.  An anchor repeated
   inside one batch of texts is known at once and costs its hash one row, so
   frequent anchors are aggregated before the shuffle;
2. suffixes whose anchor is repeated go on, as the bytes around it, to a
   bucket of the anchor; a bucket's size does not depend on the input's.
   There the remaining digits are sorted.  Equal pieces met twice in a task
   are decided there and do not move.  The suffixes of an anchor that still
   has very many texts would overfill its bucket and go one by one, by the
   hash of all their digits.

Equal texts are one text, of the smallest id; later copies go whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import by_value, release, ship, shipped, text_of, utf8, written

by_value(__name__)

DEPTH, GRAM = 100, 32
SPAN = DEPTH - GRAM + 1  # places of a gram in a string
DIGITS = (32, 32, 32, 4)  # bytes per further pass: the whole string again
SEGMENT = 1 << 20  # bytes hashed at a time
PER_BUCKET = 30_000  # anchors sorted together
CELL_BITS, COMMON = 20, 4.0  # counters of grams; how far above the mean a common one's is
FREQUENT = 5_000  # texts from which an anchor's suffixes go one by one
KNOWN_PIECES = 300_000

BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest(), "little") for i in range(256)],
                np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte strings, by doubling."""
    h, m = BYTE[data], 1
    while 2 * m <= size:
        h, m = _mixed(h[:-m] * np.uint64(3) + h[m:]), 2 * m
    return h if m == size else _mixed(h[:len(h) - (size - m)] * np.uint64(5) + h[size - m:])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    m = 1
    while 2 * m <= width:
        x, m = np.minimum(x[:-m], x[m:]), 2 * m
    return x if m == width else np.minimum(x[:len(x) - (width - m)], x[width - m:])


def cells_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def ordered(data: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The place of every gram in the fixed order: its hash, common ones last."""
    h = string_hashes(data, GRAM)
    return (h >> np.uint64(1)) | (common[cells_of(h)].astype(np.uint64) << np.uint64(63))


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many grams fall into each cell, as 256 parts of the table."""
    cells, waiting, size = np.zeros(1 << CELL_BITS, np.int64), [], 0
    for batch in batches:
        for text in batch.column(0):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for a in range(0, max(0, len(data) - GRAM + 1), SEGMENT):
                waiting.append(cells_of(string_hashes(data[a:a + SEGMENT + GRAM - 1], GRAM)))
                size += len(waiting[-1])
            if size > SEGMENT:
                cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
                waiting, size = [], 0
    if waiting:
        cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
    yield pa.record_batch({"part": np.arange(256, dtype=np.int32),
                           "cells": pa.array([c.tobytes() for c in cells.reshape(256, -1)], pa.binary())})


def sum_cells(parts: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in parts["cells"])
    return pd.DataFrame({"part": parts["part"][:1], "cells": [total.tobytes()]})


def common_grams(source: DataFrame) -> np.ndarray:
    """Whether a cell's count over all texts stands out.  The table's size is
    fixed, and it only chooses among anchors: no result depends on it."""
    found = (source.select("data").mapInArrow(count_grams, "part int, cells binary")
             .groupBy("part").applyInPandas(sum_cells, "part int, cells binary").collect())
    cells = np.zeros((256, (1 << CELL_BITS) // 256), np.int64)
    for r in found:
        cells[r["part"]] = np.frombuffer(r["cells"], np.int64)
    return (cells > COMMON * max(1.0, cells.mean())).ravel()


def anchors(data: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, order) of the grams that are the least of some string."""
    n = len(data) - GRAM + 1  # grams
    places, hashes = [], []
    if len(data) >= DEPTH:
        for a in range(0, n, SEGMENT):
            b = min(n, a + SEGMENT)
            left, right = max(0, a - SPAN + 1), min(n, b + SPAN - 1)
            h = ordered(data[left:right + GRAM - 1], common)
            low = _least(h, SPAN)  # of the strings that start here
            edge = np.zeros(SPAN - 1, np.uint64)
            high = ~_least(~np.concatenate([edge, low, edge]), SPAN)  # the largest of those minima around a gram
            own = np.flatnonzero((high == h)[a - left:b - left]) + a
            places.append(own)
            hashes.append(h[own - left])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def owned(places: np.ndarray, hashes: np.ndarray, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the strings of which each anchor is the
    leftmost least gram (first > last where there are none)."""
    n = len(places)
    first = np.maximum(places - SPAN + 1, 0)
    last = np.minimum(places, n_bytes - DEPTH)
    for step in range(1, n):
        gap = places[step:] - places[:-step]
        if not (gap < SPAN).any():
            break
        near = gap < SPAN
        # an anchor as small to the left, or smaller to the right, owns the strings that hold both
        left = near & (hashes[:-step] <= hashes[step:])
        first[step:] = np.where(left, np.maximum(first[step:], places[:-step] + 1), first[step:])
        right = near & (hashes[step:] < hashes[:-step])
        last[:-step] = np.where(right, np.minimum(last[:-step], places[step:] - SPAN), last[:-step])
    return first, last


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as sorted, separate ones (touching ones join)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([new[1:], [True]])] if len(starts) else reach


def anchor_rows(common: Broadcast):
    """Texts -> rows (route, hash, n, place, texts) per anchor.  Anchors alone
    in the batch are routed by hash (``texts`` 1); others are known to be
    repeated and routed by chance (0), with one row by hash that tells how
    many there are (its place is -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped(common)
        for batch in batches:
            seen, found = set(), []
            for n, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if n not in seen:
                    seen.add(n)
                    places, hashes = anchors(np.frombuffer(text.as_buffer(), np.uint8), table)
                    found.append((np.full(len(places), n, np.int64), places, hashes))
            n, place, h = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            fresh = np.concatenate([[True], h[order][1:] != h[order][:-1]])
            group = np.cumsum(fresh) - 1
            count = np.bincount(group)
            known = np.empty(len(h), bool)
            known[order] = (count > 1)[group]
            told = h[order][fresh][count > 1]
            route = np.where(known, _mixed(h ^ _mixed(n.astype(np.uint64) + place.astype(np.uint64))), h)
            none = np.full(len(told), -1)
            yield pa.record_batch({
                "route": np.concatenate([route, told]).view(np.int64), "hash": np.concatenate([h, told]).view(np.int64),
                "n": np.concatenate([n, none]), "place": np.concatenate([place, none]).astype(np.int32),
                "texts": np.concatenate([np.where(known, 0, 1), count[count > 1]]).astype(np.int32)})

    return run


def pieces(n_buckets: int, common: Broadcast):
    """(id, n, text, places of repeated anchors, which are frequent) -> a row
    per anchor with the bytes of the strings it owns, or a row per string of a
    frequent one; what was met before in this task (texts come in order) gives
    the interval that goes instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met = shipped(common), set()
        last_text = None

        def new(mark) -> bool:
            if mark in met:
                return False
            if len(met) < KNOWN_PIECES:
                met.add(mark)
            return True

        for batch in batches:
            out: list[tuple] = []
            for key, n, text, again, often in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                  *(batch.column(i) for i in (2, 3, 4))):
                if (key, n) == last_text:  # a row repeated as a whole
                    continue
                last_text = key, n
                raw = text.as_buffer()
                data = np.frombuffer(raw, np.uint8)
                places, hashes = anchors(data, table)
                repeated = np.isin(places, again.values.to_numpy())
                frequent = np.isin(places, again.values.to_numpy()[often.values.to_numpy(zero_copy_only=False)])
                first, last = owned(places, hashes, len(data))
                gone: list[tuple[int, int]] = []
                strings = None
                for k in np.flatnonzero(repeated & (last >= first)).tolist():
                    a, b = int(first[k]), int(last[k]) + DEPTH
                    if frequent[k]:
                        if strings is None:
                            strings = string_hashes(data, DEPTH)
                        for start, h in enumerate(strings[a:b - DEPTH + 1].tolist(), a):
                            if new(h):
                                out.append((h % n_buckets, h - (1 << 63), key, n, start, start + DEPTH, ALONE, None))
                            else:
                                gone.append((start, start + DEPTH))
                        continue
                    piece = raw[a:b].to_pybytes()
                    if new((places[k] - a, hash(piece), len(piece), piece[:16])):
                        h = int(hashes[k])
                        out.append((h % n_buckets, h - (1 << 63), key, n, a, b, int(places[k]) - a, piece))
                    else:
                        gone.append((a, b))
                if gone:
                    starts, ends = _merged(*np.array(gone, np.int64).T)
                    out += [(key % n_buckets, 0, key, n, a, b, GONE, None) for a, b in zip(starts.tolist(), ends.tolist())]
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    return run


GONE, ALONE = -1, -2  # in place of the anchor's: a decided interval; one string by its hash
PIECE = pa.schema([("bucket", pa.int32()), ("hash", pa.int64()), ("id", pa.int64()), ("n", pa.int64()),
                   ("start", pa.int64()), ("stop", pa.int64()), ("anchor", pa.int32()), ("piece", pa.binary())])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), PIECE)], schema=PIECE)


def sort_digits(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of strings, as offsets in the row's
    piece, that also start in an earlier row or earlier in the same one."""
    size = rows["piece"].map(len).to_numpy()
    data = np.frombuffer(b"".join(rows["piece"]), np.uint8)
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    count = size - DEPTH + 1
    row = np.repeat(np.arange(len(rows)), count)  # suffixes, by document and place
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    where = at[row] + offset
    # the first digit: the anchor, and its place in the string
    digit = _mixed(rows["hash"].to_numpy().view(np.uint64)[row]
                   + (rows["anchor"].to_numpy()[row] - offset).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    alive, group, depth = np.arange(len(row)), np.zeros(len(row), np.uint64), 0
    later = np.zeros(len(row), bool)
    hashes: dict[int, np.ndarray] = {}
    for width in (0, *DIGITS):
        if width:
            if width not in hashes:
                hashes[width] = string_hashes(data, width)
            digit = hashes[width][where[alive] + depth]
            depth += width
        key = _mixed(group + digit)
        order = np.argsort(key, kind="stable")  # earlier suffixes stay first
        fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        number = np.cumsum(fresh) - 1
        keep, group, later = np.empty(len(key), bool), np.empty(len(key), np.uint64), np.empty(len(key), bool)
        keep[order] = (np.bincount(number) > 1)[number]
        group[order] = _mixed(number.astype(np.uint64) + np.uint64(1))
        later[order] = ~fresh
        alive, group, later = alive[keep], group[keep], later[keep]
        if not len(alive):
            break
    hit = alive[later]
    if not len(hit):
        return hit, hit, hit
    cut = np.flatnonzero(np.concatenate([[True], (row[hit][1:] != row[hit][:-1]) | (np.diff(hit) > 1)]))
    final = np.append(cut[1:], len(hit)) - 1
    return row[hit[cut]], offset[hit[cut]], offset[hit[final]]


def later_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket: the further digit passes.  Returns the intervals of strings
    that also start earlier."""
    rows = rows.drop_duplicates(["id", "n", "start", "anchor"]).sort_values(["id", "n", "start"], kind="stable")
    found = [rows[rows["anchor"] == GONE], (alone := rows[rows["anchor"] == ALONE])[alone.duplicated("hash")]]
    some = rows[rows["anchor"] >= 0]
    if len(some):
        row, first, last = sort_digits(some)
        part = some.iloc[row]
        found.append(part.assign(start=part["start"] + first, stop=part["start"] + last + DEPTH))
    return pd.concat([f[["id", "n", "start", "stop"]] for f in found])


def without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(rid, n, text bytes, starts, ends) -> what is left."""
    for batch in batches:
        rows = []
        for rid, n, data, starts, ends in zip(*(batch[c] for c in ("rid", "n", "data", "starts", "ends"))):
            a, b = _merged(np.asarray(starts, np.int64), np.asarray(ends, np.int64))
            left, at = hashlib.sha256(), 0
            for x, y in zip(a.tolist(), b.tolist()):
                left.update(data[at:x])
                at = y
            left.update(data[at:])
            rows.append((rid, n, int((b - a).sum()), len(a), left.hexdigest()))
        yield pd.DataFrame(rows, columns=["rid", "n", "gone", "runs", "left"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256`` of its UTF-8 text without the bytes that lie in a
    ``DEPTH``-byte string which also starts earlier (smaller id, or before in
    the same document).

    Defined cases: a null text counts as empty; texts shorter than ``DEPTH``
    lose nothing; a null id comes last; different texts of one id are ordered
    by a hash of the text, and of rows repeated as a whole one keeps what the
    others lose; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    # rid: the id as a place in the order; n: the text as a number
    source = (docs.select(F.col(id_col).alias("id"), utf8(text_of(text_col)).alias("data"))
              .withColumn("n", F.xxhash64("data"))
              .withColumn("rid", F.coalesce(F.col("id").cast("long"), F.lit((1 << 63) - 1))))
    every = written(source.select("id", "rid", "n", F.octet_length("data").cast("long").alias("n_bytes"),
                                  F.sha2("data", 256).alias("whole")), "texts")
    firsts = written(every.groupBy("n").agg(F.min("rid").alias("rid")), "first-texts")

    common = ship(spark, common_grams(source))
    route = W.partitionBy("route")
    rows = source.where(F.octet_length("data") >= DEPTH).select("n", "data").mapInArrow(
        anchor_rows(common), "route long, hash long, n long, place int, texts int")
    marked = (rows.withColumns({"sum": F.sum("texts").over(route), "one": F.min("n").over(route),
                                "two": F.max("n").over(route)})
              # one text that several batches hold is not repeated by that
              .where((F.col("sum") == 0) | (F.col("one") != F.col("two")))
              .select("hash", "n", "place", "sum"))
    marked = written(marked, "repeated-anchors")
    release(spark)
    # a few hashes for all their texts: written, so that Spark sees their size
    # and does not deal the texts out by hash to look them up
    frequent = written(marked.where(F.col("sum") >= FREQUENT).select("hash").distinct()
                       .withColumn("often", F.lit(True)), "frequent-anchors")
    again = (marked.where("place >= 0").join(frequent, "hash", "left")
             .groupBy("n").agg(F.collect_set(F.struct("place", F.coalesce("often", F.lit(False)).alias("often"))).alias("at"))
             .join(firsts, "n").select("rid", "n", "at.place", "at.often"))
    again = written(again, "repeated-places")
    release(spark)

    total = again.agg(F.sum(F.size("place"))).first()[0] or 0
    moved = (source.join(again, ["rid", "n"]).select("rid", "n", "data", "place", "often")
             .sortWithinPartitions("rid", "n")
             .mapInArrow(pieces(max(1, -(-total // PER_BUCKET)), common),
                         "bucket int, hash long, id long, n long, start long, stop long, anchor int, piece binary"))
    spans = (moved.groupBy("bucket").applyInPandas(later_strings, "id long, n long, start long, stop long")
             .groupBy(F.col("id").alias("rid"), "n")
             .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("ends")))
    spans = written(spans, "removed-spans")
    release(spark)

    cut = written(source.join(spans, ["rid", "n"]).select("rid", "n", "data", "starts", "ends")
                  .mapInPandas(without, "rid long, n long, gone long, runs long, left string")
                  .dropDuplicates(["rid", "n"]), "cut-texts")
    place = F.row_number().over(W.partitionBy("rid", "n").orderBy("whole"))
    first = firsts.select("n", F.col("rid").alias("first"))
    copy = ((F.col("rid") != F.col("first")) | (F.col("place") > 1)) & (F.col("n_bytes") >= DEPTH)
    nothing = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("long")
    return (every.withColumn("place", place).join(first, "n").join(cut, ["rid", "n"], "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("gone", zero)).alias("n_removed"),
                    F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("runs", zero)).alias("n_spans"),
                    F.when(copy, nothing).otherwise(F.coalesce("left", "whole")).alias("kept_sha256")))
