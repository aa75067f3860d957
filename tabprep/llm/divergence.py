"""Source divergence audit: how far the sources of a language are apart.

Every (language, source) group gives each kept term of its language a smoothed
share in billionths; two groups differ by the sum of absolute differences over
all kept terms.

1. Tasks count the terms of their documents (occurrences and documents per
   group), so what is shuffled is one row per group, term and flush.
2. Terms of enough documents are kept, dealt into blocks by a hash and numbered
   inside their block: a group is one sorted array of (term id, count) per
   block, whose size does not depend on the input.
3. Pair tasks: the arrays of two tiles of sources are co-grouped per block.
   For each unordered pair the shorter array gallops through the longer one;
   terms of both, of one and of neither side are priced with exact integers.
   An array travels once per tile of partners, not once per partner.
4. Pair values are summed over blocks and returned both ways.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import by_value, text_of, utf8, written

by_value(__name__)

#: A task's counts go on when it holds so many.
ENTRIES = 200_000
#: Terms to a block and sources to a tile, about: they bound a pair task.
BLOCK, TILE = 16_384, 32
#: Long texts are split into words by portions of so many bytes.
PORTION = 1 << 20
BILLION = 1_000_000_000


def term_table(keep: range | tuple = ()) -> bytes:
    """Bytes to bytes: letters and bytes beyond ASCII stay, A-Z in lower case,
    those in ``keep`` too; all others become spaces."""
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or b in keep else 32 for b in range(256))


TERMS = term_table()


def words_by_portion(data: bytes, table: bytes, size: int = 0) -> Iterator[list[bytes]]:
    """The words of a text in lists; a word is never cut."""
    data, size, at = data.translate(table), size or PORTION, 0
    while at < len(data):
        cut = data.find(b" ", at + size)
        cut = cut if cut >= 0 else len(data)
        yield data[at:cut].split()
        at = cut


def _counted(batches):
    """Rows ``lang, source, term, n, docs``; the empty term of a group says
    that the group occurs."""
    names = ["lang", "source", "term", "n", "docs"]
    n, docs = {}, {}

    def rows():
        for (lang, source), mine in n.items():
            terms = [b"", *sorted(mine)]
            seen = docs[lang, source]
            for a in range(0, len(terms), 50_000):
                some = terms[a:a + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                    pa.array(some, pa.binary()), pa.array([mine[t] for t in some], pa.int64()),
                    pa.array([seen[t] for t in some], pa.int64())], names)
        n.clear()
        docs.clear()

    for batch in batches:
        for lang, source, data in zip(*(batch.column(i) for i in range(3))):
            group = lang.as_py(), source.as_py()
            if group not in n:
                n[group], docs[group] = Counter(), Counter()
            distinct = set()
            for words in words_by_portion(data.as_py(), TERMS):
                n[group].update(words)
                distinct.update(words)
            docs[group].update(distinct)
            if sum(map(len, n.values())) > ENTRIES:
                yield from rows()
    yield from rows()


def shares(counts: np.ndarray, total: int, v: int) -> np.ndarray:
    """``1 + floor(10**9 * (count + 5) / (total + 5 * v))``, by long division
    in three steps of a thousand, exact while the divisor is below 9e15 (more
    words than any corpus has; beyond it Python's own integers are used)."""
    d = int(total) + 5 * int(v)
    rest = np.asarray(counts, np.int64) + 5
    if d >= 9 * 10 ** 15:
        return np.array([1 + BILLION * int(x) // d for x in rest], np.int64)
    out = np.zeros(len(rest), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // d, rest % d
    return out + 1


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each id of the sorted ``short`` its place in the sorted ``long``,
    or -1.  The search of an id begins where the one before it ended."""
    if not len(long):
        return np.full(len(short), -1)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    return np.where(long[at] == short, at, -1)


def distance(a: tuple, b: tuple) -> int:
    """Price of two groups in one block.  Each: (ids, shares, share of an
    absent term).  Relative to all terms being absent on both sides."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = gallop(a[0], b[0])
    both = at >= 0
    other = np.full(len(at), b[2], np.int64)
    other[both] = b[1][at[both]]
    alone = np.ones(len(b[0]), bool)
    alone[at[both]] = False
    base = abs(a[2] - b[2])
    return int(np.abs(a[1] - other).sum() + np.abs(b[1][alone] - a[2]).sum() - base * (len(at) + int(alone.sum())))


def _pairs(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Pair tasks of one block: every pair of a source of the first tile and
    a later source of the second one."""
    lang, block = key[0], key[1]

    def side(rows):
        return [(r.num, r.source, np.array([x for x in r.ids], np.int64),
                 shares(np.array([x for x in r.ns], np.int64), r.total, r.v) if len(r.ids) else np.zeros(0, np.int64),
                 int(shares([0], r.total, r.v)[0]) if r.v else 0, int(r.v)) for r in rows.itertuples()]

    out = []
    tile = side(right)
    for n, source, *a, v in side(left):
        for m, item, *b, _ in tile:
            if n < m:
                # block 0 prices all terms of the language as absent ones
                out.append((lang, source, item, distance(a, b) + (v * abs(a[2] - b[2]) if block == 0 else 0)))
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def _over(top: int):
    """Per block, the terms in which a group exceeds its language most."""
    def task(frames):
        for rows in frames:
            out = []
            for r in rows.itertuples():
                p = shares(np.array(list(r.ns), np.int64), r.total, r.v)
                gain = p - shares(np.array(list(r.totals), np.int64), r.lang_total, r.v)
                first = np.argsort(-gain, kind="stable")[:top]  # ids are in the terms' order: ties go to the lesser
                out += [(r.lang, r.source, r.terms[i], int(gain[i])) for i in first if gain[i] > 0]
            yield pd.DataFrame(out, columns=["lang", "source", "item", "value"])
    return task


def audit(docs: DataFrame, least_docs: int = 30, top_terms: int = 50, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other
    source of the language with its distance, part ``term`` the ``top_terms``
    terms whose share exceeds the language's most.

    Defined cases: null text, language and source read as the empty string;
    a group without terms counts like one whose counts are all 0; a language
    without kept terms has pairs of value 0 and no terms; repeated rows count
    each time; ties go to the lesser item by UTF-8 bytes; an empty table gives
    no rows; other columns are ignored.
    """
    texts = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), utf8(text_of(text_col)).alias("data"))
    counts = (texts.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
              .withColumn("term", F.col("term").cast("string")))
    counts = written(counts, "term-counts")

    kept = (counts.where("term != ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least_docs).select("lang", "term", "total"))
    kept = written(kept, "kept-terms")
    langs = written(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
                    .withColumn("blocks", F.ceil(F.col("v") / BLOCK)), "kept-langs")
    # a language may hold most terms: its one row is joined as 64 salted ones
    salted = langs.select("lang", "blocks", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("salt"))
    hashed = F.xxhash64("term")
    numbered = (kept.withColumn("salt", F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")).join(salted, ["lang", "salt"])
                .withColumn("block", F.pmod(hashed, "blocks"))
                .withColumn("id", F.row_number().over(W.partitionBy("lang", "block").orderBy("term")))
                .select("lang", "term", "total", "block", "id"))
    entry = F.struct("id", "n", "total", "term")
    arrays = (counts.join(numbered, ["lang", "term"])
              .groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(entry)).alias("e")))
    arrays = written(arrays.select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("ns"),
                                   F.col("e.total").alias("totals"), F.col("e.term").alias("terms")), "term-arrays")

    by_lang = W.partitionBy("lang")
    sums = arrays.groupBy("lang", "source").agg(F.sum(F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"))
    zero = F.lit(0).cast("long")
    groups = (counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("v", zero).alias("v"),
                      F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("blocks", zero).alias("blocks"))
              .withColumn("num", F.row_number().over(by_lang.orderBy("source")) - 1)
              .withColumn("tile", F.floor(F.col("num") / TILE).cast("int"))
              .withColumn("last", F.floor((F.count("*").over(by_lang) - 1) / TILE).cast("int")))
    groups = written(groups, "groups")

    held = (groups.withColumn("block", F.explode(F.sequence(zero, F.greatest(zero, F.col("blocks") - 1))))
            .join(arrays.select("lang", "source", "block", "ids", "ns"), ["lang", "source", "block"], "left")
            .withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
            .withColumn("ns", F.coalesce("ns", F.array().cast("array<bigint>"))))
    held = held.select("lang", "block", "tile", "last", "num", "source", "total", "v", "ids", "ns")
    left = held.withColumn("other", F.explode(F.sequence(F.col("tile"), F.col("last"))))
    again = held.select(*[F.col(c).alias("other" if c == "tile" else c) for c in held.columns])  # columns of its own
    right = again.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("other"))))
    key = ["lang", "block", "tile", "other"]
    priced = (left.groupBy(*key).cogroup(right.groupBy(*key))
              .applyInPandas(_pairs, "lang string, source string, item string, value long")
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    both = (priced.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"), "value")
            .select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value"))

    over = (arrays.select("lang", "source", "ns", "totals", "terms")
            .join(groups.select("lang", "source", "total", "v", "lang_total"), ["lang", "source"])
            .mapInPandas(_over(top_terms), "lang string, source string, item string, value long")
            .select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return both.withColumn("rank", F.row_number().over(order)).unionByName(best)
