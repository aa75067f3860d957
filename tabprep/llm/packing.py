"""Packing by minimum bin slack.

Documents become token ids, cut into full windows and one remainder each.
What is left to pack is then a multiset of piece lengths: at most
``capacity`` different lengths with counts, however many documents there are.
Windows are filled from that multiset one pattern at a time: the longest
remaining length opens the window and a bitset subset-sum dynamic programme
over the remaining lengths (counts by binary splitting) finds the sum closest
to the space left; backtracking gives how many pieces of each length to take.
A pattern is used as often as the counts allow, so each one uses up at least
one length and their number is bounded by the lengths, not by the documents.

The plan says: of the pieces of length ``l``, numbers ``a`` to ``b`` go to
such windows at such offsets.  Pieces get their numbers in Spark (counts per
hash range, positions inside a range), so nothing but the length counts and
the plan passes through the driver.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import by_value, text_of, top_bits, written

by_value(__name__)

#: Ranges of the hash that numbers pieces of one length: 2**RANGE_BITS each.
RANGE_BITS = 10
#: Entries of a worker's caches; later words and chunks are encoded each time.
CACHED_CHUNKS, CACHED_WORDS = 400_000, 800_000

# The word pattern of the tokenizer file, for characters below
# U+0180 but U+0130 (there a text is its own NFC form, and lower case is one
# character of the same range); other chunks go to the tokenizer.
LETTER, NUMBER = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼½¾"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+"
PLAIN = "[\t\r\x21-\x7e\xa1-įı-ſ]*"

_encoders: dict = {}  # one per worker process, kept between tasks


def encoder(path: str):
    """text -> its ids as uint32 bytes (little-endian), by the tokenizer file.

    The file's pre-tokenizer never joins characters across white space, so a
    text's ids are those of its chunks between spaces; chunks and words are
    remembered, since a corpus repeats them."""
    if path in _encoders:
        return _encoders[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    model, level = tokenizer.model, tokenizer.pre_tokenizer
    find, plain = re.compile(WORD).findall, re.compile(PLAIN).fullmatch
    seen = {w: level.pre_tokenize_str(w) for w in map(chr, range(0x180)) if plain(w) and w.strip()}
    letter = {w: p[0][0] for w, p in seen.items()}  # a character as the file's byte letters

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            form = "".join([letter[c] for c in word])
            ids = np.array([t.id for t in model.tokenize(form)], "<u4").tobytes()
            if len(self) < CACHED_WORDS:
                self[word] = ids
            return ids

    words = Words()

    class Chunks(dict):
        def __missing__(self, chunk: str) -> bytes:
            if plain(chunk) and "<|" not in chunk:
                ids = b"".join([words[w] for w in find(chunk.lower())])
            else:
                ids = np.array(tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
            if len(self) < CACHED_CHUNKS:
                self[chunk] = ids
            return ids

    chunks = Chunks()

    def encode(text: str) -> bytes:
        return b"".join([chunks[c] for c in text.replace("\n", " ").split(" ")])

    _encoders[path] = encode
    return encode


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length come closest to ``room`` from below:
    subset-sum over a bitset of reachable sums, backtracked."""
    bits, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, bits))
            bits |= (bits << length * k) & mask
            left, k = left - k, k * 2
        if bits >> room & 1:
            break
    reached, taken = bits.bit_length() - 1, {}
    for length, k, earlier in reversed(steps):
        if not earlier >> reached & 1:
            taken[length] = taken.get(length, 0) + k
            reached -= length * k
    return taken


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first window, pieces a window,
    offset of the first): all pieces, window by window."""
    left, used, rows, window = dict(counts), dict.fromkeys(counts, 0), [], 0
    for longest in sorted(counts, reverse=True):
        while left[longest]:
            left[longest] -= 1
            pattern = fill(left, capacity - longest)
            left[longest] += 1
            pattern[longest] = pattern.get(longest, 0) + 1
            times = min(left[x] // k for x, k in pattern.items())
            offset = 0
            for x, k in sorted(pattern.items(), reverse=True):
                rows.append((x, used[x], used[x] + k * times, window, k, offset))
                used[x] += k * times
                left[x] -= k * times
                offset += x * k
            window += times
    return rows


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
                  id_col: str, text_col: str) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["t"]):
                ids = encode(text) + end
                n = len(ids) // 4
                rows += [(key, a, min(capacity, n - a), zlib.crc32(ids[4 * a:4 * (a + capacity)]), n)
                         for a in range(0, n, capacity)]
            yield pd.DataFrame(rows, columns=["id", "start", "length", "crc", "n"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("t"))
            .mapInPandas(cut, "id string, start long, length long, crc long, n long")
            .withColumn("id", F.col("id").cast(kind)))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: ``id_col, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``.

    Defined cases: a null or empty text is the end id alone (one token); texts
    of any length are cut every ``capacity`` ids; repeated rows are packed one
    by one; a null id stays null; an empty table gives no rows; other columns
    are ignored.
    """
    pieces = written(cut_documents(docs, tokenizer, capacity, end_id, id_col, text_col), "pack-pieces")
    # at most `capacity` lengths, whatever the input
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows = sorted(plan(counts, capacity))
    # spans of numbers start in increasing order of (length, first number)
    length, first, _, window, each, offset = (np.array(c, np.int64) for c in (zip(*rows) if rows else [[]] * 6))
    wide = max(counts.values(), default=0) + 1  # numbers of one length fit below it
    starts = length * wide + first if rows else first

    @F.pandas_udf("sequence_id long, offset long")
    def place(l: pd.Series, r: pd.Series) -> pd.DataFrame:
        l, r = l.to_numpy(), r.to_numpy()
        k = np.searchsorted(starts, l * wide + r, "right") - 1
        t = r - first[k]
        return pd.DataFrame({"sequence_id": window[k] + t // each[k], "offset": offset[k] + t % each[k] * l})

    ranged = pieces.withColumn("h", F.xxhash64("id", "start", "crc")).withColumn("b", top_bits(F.col("h"), RANGE_BITS))
    before = (ranged.groupBy("length", "b").agg(F.count(F.lit(1)).alias("k"))
              .select("length", "b", (F.sum("k").over(W.partitionBy("length").orderBy("b"))
                                      - F.col("k")).alias("before")))
    within = F.row_number().over(W.partitionBy("length", "b").orderBy("h", "id", "start", "crc"))
    return (ranged.withColumn("r", within - 1).join(before, ["length", "b"])
            .withColumn("at", place("length", F.col("r") + F.col("before")))
            .select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"),
                    F.col("n").alias("doc_tokens"), "at.sequence_id", "at.offset"))
