"""Phrase collocation mining by prefix-free parsing.

Texts are cut into pieces at punctuation and pieces into words.  A window of
``max_words - 1`` words whose hash falls on a fixed residue is a trigger: a
long piece is parsed into chunks that run from one trigger to the next one,
which both chunks share; a short piece is one chunk.  Since the parse depends
on content alone, passages that repeat give the same chunks wherever they
stand, and the dictionary of distinct chunks with their parse frequencies is
all that is looked at again.

Each phrase of up to ``max_words`` words lies in the chunk in which it starts;
phrases that start in a chunk's closing trigger belong to the next chunk, so
overlaps are counted once.  Phrases inside distinct chunks are counted with
the chunk's frequency, from short to long: a phrase that occurs
``least`` times holds two shorter ones that do, so one of three words or more
is counted only if both may.  That is read off a Bloom filter of the frequent
shorter phrases.
Its size has a fixed bound; a filter that is too small for a corpus lets more
phrases through and drops none, so counts are exact at every size.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import by_value, release, ship, shipped, text_of, utf8, written

by_value(__name__)

#: Pieces of up to SHORT words are one chunk; in longer ones one window in
#: EVERY is a trigger, and a chunk without one is cut at LONGEST words.
SHORT, EVERY, LONGEST = 24, 24, 4_096
#: A task's dictionary goes on when it holds so many chunks, and its phrases
#: are counted by so many words at a time.
ENTRIES, WORDS = 400_000, 1_500_000
#: Bytes that a counted word may stand for, and rows sent on at once.
LONG, PART = 128, 50_000
#: Bits of a filter: so many for a phrase, and at most (2**27 bits are 16 MB).
FILTER_EACH, FILTER_MOST = 16, 1 << 27
# What ends a piece, and what stands between words beside space.
ENDS, TAB = b".,;:!?\x0a\x0b\x0c\x0d", 9
#: A-Z in lower case, piece ends as line feeds, tabs as spaces.
PIECES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in ENDS else 32 if b == TAB else b for b in range(256))


def chunks(words: list[bytes], overlap: int, marks: dict) -> list[tuple[bytes, bool]]:
    """The parse of a piece: chunks as joined words, and whether the chunk is
    closed by a trigger (of ``overlap`` words) that the next one shares."""
    out, at, n = [], 0, len(words)
    if n > max(SHORT, overlap):
        windows = codes = [marks.get(w) or marks.setdefault(w, zlib.crc32(w) + 1) for w in words]
        for k in range(1, overlap):
            windows = [a * 31 + b for a, b in zip(windows, codes[k:])]
        stops = [i for i, x in enumerate(windows) if not x * 2654435761 % 4294967291 % EVERY]
        for i in [*stops, n]:
            while min(i, n - overlap) - at > LONGEST:
                out.append((b" ".join(words[at:at + LONGEST + overlap]), True))
                at += LONGEST
            if at < i < n - overlap:
                out.append((b" ".join(words[at:i + overlap]), True))
                at = i
    out.append((b" ".join(words[at:]), False))
    return out


def _parsed(overlap: int):
    """(lang, bytes) -> rows ``lang, chunk, closed, f``."""
    def task(batches):
        counts, marks = {}, {}

        def rows():
            for (lang, closed), mine in counts.items():
                keys, f = list(mine), list(mine.values())
                for a in range(0, len(keys), PART):
                    some = keys[a:a + PART]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang, pa.string()), len(some)), pa.array(some, pa.binary()), pa.repeat(closed, len(some)),
                         pa.array(f[a:a + PART], pa.int64())], ["lang", "chunk", "closed", "f"])
            counts.clear()

        for batch in batches:
            for lang, data in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                whole = counts.setdefault((lang, False), Counter())
                short = []
                for piece in data.as_py().translate(PIECES).split(b"\n"):
                    words = piece.split()
                    if len(words) <= SHORT:
                        if words:
                            short.append(b" ".join(words))
                        continue
                    for chunk, closed in chunks(words, overlap, marks):
                        counts.setdefault((lang, closed), Counter())[chunk] += 1
                whole.update(short)
                if sum(map(len, counts.values())) > ENTRIES:
                    yield from rows()
                if len(marks) > ENTRIES:
                    marks.clear()
        yield from rows()
    return task


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def hashes(lang: str, words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` among the word hashes of a language."""
    out = _mixed(words + np.uint64(xxhash.xxh3_64_intdigest(lang.encode())))
    for i in range(1, k):
        out = _mixed(out[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[i:])
    return out


def _word_hashes(vocabulary) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary], np.uint64)


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter of ``size`` bits."""
    return (h & np.uint64(size - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)


def inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter (64-bit words) may hold."""
    a, b = _bits(h, 64 * len(bits))
    held = lambda p: (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)
    return (held(a) & held(b)).astype(bool)


def filter_of(frequent: DataFrame, k: int) -> np.ndarray:
    """A filter of the frequent phrases of ``k`` words (``lang, phrase``)."""
    n = frequent.count()
    size = min(FILTER_MOST, 1 << max(10, (FILTER_EACH * n).bit_length()))

    def task(batches):
        for batch in batches:
            found: dict[str, list] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, []).append(phrase.split(b" "))
            every = [np.concatenate(_bits(np.concatenate(
                [hashes(lang, _word_hashes(w), k) for w in phrases]), size)) for lang, phrases in found.items()]
            places = np.unique(np.concatenate(every)) if every else np.zeros(0, np.int64)
            slots, first = np.unique(places >> 6, return_index=True)
            words = np.bitwise_or.reduceat(np.uint64(1) << (places & 63).astype(np.uint64), first) if len(places) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(words.view(np.int64))], ["slot", "bits"])

    # at most FILTER_MOST / 64 rows, whatever the corpus
    got = (frequent.select("lang", "phrase").mapInArrow(task, "slot long, bits long")
           .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow())
    bits = np.zeros(size // 64, np.uint64)
    bits[got["slot"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return bits


def _tallies(lang: str, found: pa.Array, closed: np.ndarray, f: np.ndarray, lengths: tuple, overlap: int,
             bits: np.ndarray | None) -> tuple[Iterator[tuple[pa.Array, np.ndarray]], int]:
    """Parts of the distinct phrases of these lengths that start in the chunks
    and may be frequent, with their weighted counts; and the weighted number
    of words.  Arrow numbers the words and joins the phrases."""
    split = pc.split_pattern(found, pattern=b" ")
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    vocabulary, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    weight = np.repeat(f, sizes)
    ends = np.cumsum(sizes)
    place = np.arange(len(ids))
    # a phrase starts before the closing trigger and ends inside its chunk
    own = place < np.repeat(ends - overlap * closed.astype(np.int64), sizes)
    end = np.repeat(ends, sizes)
    hashed = _word_hashes(vocabulary.to_pylist())[ids] if bits is not None else None

    def parts():
        for k in lengths:
            last = max(0, len(ids) - k + 1)
            here = (own & (place + k <= end))[:last]
            if bits is not None and last:
                may = inside(bits, hashes(lang, hashed, k - 1))
                here &= may[:last] & may[1:last + 1]
            starts = np.flatnonzero(here)
            if not len(starts):
                continue
            # exact numbers of the phrases: (number of the shorter one, next word)
            code, most = ids[starts], len(vocabulary)
            for i in range(1, k):
                if most * len(vocabulary) >= 1 << 62:
                    known, code = np.unique(code, return_inverse=True)
                    most = len(known)
                code, most = code * len(vocabulary) + ids[starts + i], most * len(vocabulary)
            order = np.argsort(code)
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            heads = starts[order[first]]
            sums = np.add.reduceat(weight[starts[order]], first)
            for a in range(0, len(heads), PART):
                columns = [vocabulary.take(pa.array(ids[heads[a:a + PART] + j])) for j in range(k)]
                yield (columns[0] if k == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))), sums[a:a + PART]

    return parts(), int(weight[own].sum())


def counted(lang: str, found: list[bytes], closed: list[bool], f: list[int], lengths: tuple, overlap: int,
            bits: np.ndarray | None) -> tuple[list[bytes], np.ndarray, int]:
    """Distinct phrases of these lengths that start in the chunks and may be
    frequent, their weighted counts, and the weighted number of words."""
    parts, total = _tallies(lang, pa.array(found, pa.binary()), np.array(closed, bool), np.array(f, np.int64), lengths, overlap, bits)
    phrases, sums = [], [np.zeros(0, np.int64)]
    for some, n in parts:
        phrases += some.to_pylist()
        sums.append(n)
    return phrases, np.concatenate(sums), total


def _by_lang(batches: list[pa.RecordBatch]):
    """The rows of the batches, one table per language (the first column)."""
    table = pa.Table.from_batches(batches).combine_chunks()
    coded = table.column(0).combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for lang, a, b in zip(coded.dictionary.to_pylist(), bounds, bounds[1:]):
        yield lang, table if b - a == len(table) else table.take(pa.array(order[a:b]))


def _counts(lengths: tuple, overlap: int, sent):
    """Chunks -> rows ``lang, phrase, f`` of the phrases of these lengths; with
    single words the empty phrase counts all words."""
    def task(batches):
        bits, held, size = (shipped(sent) if sent else None), [], 0

        def rows():
            for lang, mine in _by_lang(held):
                found, closed, f = (mine.column(i).combine_chunks() for i in (1, 2, 3))
                parts, total = _tallies(lang, found, closed.to_numpy(zero_copy_only=False), f.to_numpy(zero_copy_only=False), lengths, overlap, bits)
                whole = [(pa.array([b""], pa.binary()), np.array([total]))] if 1 in lengths else []
                for phrases, sums in chain(whole, parts):
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(phrases)), phrases,
                                                      pa.array(sums, pa.int64())], ["lang", "phrase", "f"])
            held.clear()

        for batch in batches:
            words = pc.count_substring(batch.column(1), pattern=b" ").to_numpy(zero_copy_only=False).astype(np.int64) + 1
            enough = words >= min(lengths)
            # a chunk of very long words counts for more of them
            words = np.maximum(words, pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False) // LONG)[enough]
            batch = batch.filter(pa.array(enough))
            so_far = np.concatenate([[0], np.cumsum(words)])
            a = 0
            while a < len(words):  # at least one chunk at a time
                b = max(a + 1, int(np.searchsorted(so_far, so_far[a] + WORDS - size, side="right")) - 1)
                held.append(batch.slice(a, b - a))
                size += int(so_far[b] - so_far[a])
                a = b
                if a < len(words) or size > WORDS:
                    yield from rows()
                    size = 0
        if held:
            yield from rows()
    return task


def phrase_counts(docs: DataFrame, max_words: int = 3, least: int = 1, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, phrase, f`` for every phrase of up to ``max_words`` words that
    occurs ``least`` times; the empty phrase of a language counts its words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), utf8(text_of(text_col)).alias("data"))
    dictionary = written(texts.mapInArrow(_parsed(max_words - 1), "lang string, chunk binary, closed boolean, f long")
                         .groupBy("lang", "chunk", "closed").agg(F.sum("f").alias("f")), "chunks")
    every, sent = None, None
    # single words and pairs in one pass: a filter of words holds back too few pairs to pay for another
    for lengths in [tuple(range(1, min(2, max_words) + 1)), *((k,) for k in range(3, max_words + 1))]:
        release(docs.sparkSession)  # the shuffles of the step before go
        found = (dictionary.mapInArrow(_counts(lengths, max_words - 1, sent), "lang string, phrase binary, f long")
                 .groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.length("phrase") == 0)))
        found = written(found.withColumn("k", F.size(F.split(F.col("phrase").cast("string"), " "))), "phrases")
        every = found if every is None else every.unionAll(found)
        if lengths[-1] < max_words:
            sent = ship(docs.sparkSession, filter_of(found.where(F.col("k") == lengths[-1]), lengths[-1]))
    return every.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to
    ``max_words`` words of each language.  A phrase of ``a`` occurrences, cut
    into two parts of ``l`` and ``r`` occurrences, scores ``a * a / (l * r)``
    in millionths, floored; the lowest cut counts.  A phrase goes if a longer
    one that contains it has at least ``inside_percent`` of its occurrences.

    Defined cases: a null language reads as ``und``, a null text as empty; a
    language without words has no rows; ties in the score are ordered by count,
    then by UTF-8 bytes; ties between cuts go to the first; repeated rows count
    each time; an empty table gives no rows; other columns are ignored.
    """
    frequent = phrase_counts(docs, max_words, least, text_col, lang_col)
    known = frequent.where("phrase != ''")
    words = F.split("phrase", " ")
    found = known.withColumn("w", words).withColumn("k", F.size("w")).where("k >= 2")
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")

    cuts = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.col("k") - 1),
        lambda i: F.struct(i.alias("cut"), part(F.lit(1), i).alias("first"), part(i + 1, F.col("k") - i).alias("rest")))).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.*")
    # the parts of a frequent phrase are frequent, so both joins find them
    sized = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
             .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    score = F.expr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
                   " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    scored = (sized.withColumn("score", score)
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
              .select("lang", "phrase", "a", "m.l", "m.r", "m.score"))

    inner = found.where("k >= 3").select("lang", F.col("f").alias("longer"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: part(i, n))))).alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside_percent) * F.col("a")))
    ranked = left.withColumn("rank", F.row_number().over(
        W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    n = frequent.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                         F.col("score").cast("long").alias("score"))
