"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item (all of them for
a shorter item).  The fingerprint of a window is the least hash of the
``k``-word grams inside it, so equal windows have equal fingerprints wherever
they stand and every shared span of at least ``window`` words is found, while
neighbouring windows mostly share theirs: a text has about
``2 / (window - k + 2)`` distinct fingerprints per word.

1. Documents are read once: word counts and distinct fingerprints go to a
   table.  Fingerprints that the benchmark has (a left semi join on the hash,
   of distinct values) name the candidate documents.
2. Candidates are extended: their windows whose fingerprint was hit are
   compared word for word with the items' windows (a join on the text of the
   window), and overlapping hits merge into covered spans.

Everything is built-in functions and joins; nothing pairs documents with
items, and joins are broadcast only where Spark sees a small enough table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_az, text_of, written

#: What stands between words: fixed by the definition of a word.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case.  ``lower`` does the same on plain
    ASCII and is faster."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(lower_az(text))
    return F.array_remove(F.split(low, GAP), "")


def _grams(words: Column, size: int, seed: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(1), F.size(words) - (size - 1)),
        lambda i: F.xxhash64(F.lit(seed), F.slice(words, i, size)))).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(grams: Column, per_window: int) -> Column:
    """The fingerprint of every window, in order."""
    return F.when(F.size(grams) >= per_window, F.transform(
        F.sequence(F.lit(1), F.size(grams) - (per_window - 1)),
        lambda i: F.array_min(F.slice(grams, i, per_window)))).otherwise(F.array().cast("array<bigint>"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5,
                 id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit`` (words inside any
    occurrence of a window), ``items`` (ids of the items with occurring
    windows, as strings in order) and ``text_hash`` (xxhash64 of the text,
    which tells apart documents that repeat an id).

    Defined cases: a null text has no words; an item without words has no
    window; items that repeat an id count once and a null item id reads as
    the empty string; repeated documents get a row each; empty tables are
    allowed on either side; other columns are ignored.
    """
    per_window = window - k + 1
    item = (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         words_of(text_of(item_text)).alias("w")).where(F.size("w") > 0))
    # at most window - 1 lengths, whatever the benchmark holds
    short = sorted(r["n"] for r in item.where(F.size("w") < window).select(F.size("w").alias("n")).distinct().collect())

    whole = F.array(F.xxhash64(F.size("w"), F.col("w")))
    grams = _grams(F.col("w"), k, 0)
    item_prints = written(
        item.withColumn("g", grams)
        .select(F.explode(F.when(F.size("w") < window, whole).otherwise(_fingerprints(F.col("g"), per_window))).alias("fp"))
        .distinct(), "bench-prints")
    joined = lambda start, n: F.array_join(F.slice(F.col("w"), start, n), " ")
    item_windows = written(
        item.select("item", F.explode(F.when(F.size("w") < window, F.array(joined(F.lit(1), F.size("w"))))
                                      .otherwise(F.transform(F.sequence(F.lit(1), F.size("w") - (window - 1)),
                                                             lambda i: joined(i, window)))).alias("text"))
        .groupBy("text").agg(F.collect_set("item").alias("items")), "bench-windows")

    doc = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")) \
        .withColumn("h", F.xxhash64("t"))
    # the fingerprints of windows, then of each short length present
    prints = {window: _fingerprints(F.col("g"), per_window)} | {n: _grams(F.col("w"), n, n) for n in short}

    def with_prints(df: DataFrame) -> DataFrame:
        return (df.withColumn("w", words_of(F.col("t"))).withColumn("g", grams)
                .withColumns({f"p{n}": p for n, p in prints.items()}))

    every = written(with_prints(doc).select(
        "id", "h", F.size("w").cast("long").alias("n_words"),
        F.array_distinct(F.concat(*[F.col(f"p{n}") for n in prints])).alias("fps")), "doc-prints")
    hit = written(every.select("id", "h", F.explode("fps").alias("fp"))
                  .join(item_prints, "fp", "left_semi")
                  .groupBy("id", "h").agg(F.collect_set("fp").alias("hit")), "doc-hits")

    d, c = doc.alias("d"), hit.alias("c")
    candidates = with_prints(d.join(c, F.expr("d.h = c.h and d.id <=> c.id")).select("d.id", "d.h", "d.t", "c.hit"))

    def starts(n: int) -> Column:
        at = F.transform(F.col(f"p{n}"), lambda fp, i: F.struct(
            (i + 1).alias("start"), F.lit(n).alias("n"), fp.alias("fp")))
        return F.filter(at, lambda x: F.array_contains("hit", x["fp"]))

    found = (candidates.select("id", "h", "w", F.explode(F.concat(*map(starts, prints))).alias("at"))
             .select("id", "h", "at.start", "at.n",
                     F.array_join(F.slice("w", F.col("at.start"), F.col("at.n")), " ").alias("text")).distinct())
    spans = (found.join(item_windows, "text")
             .groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("spans"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.expr("""aggregate(spans, named_struct('end', 0, 'hit', 0L), (a, s) -> named_struct(
        'end', greatest(a.end, s.start + s.n),
        'hit', a.hit + greatest(0, s.start + s.n - greatest(a.end, s.start))), a -> a.hit)""")
    spans = written(spans.select("id", "h", covered.alias("n_hit"), "items"), "doc-spans")
    e, s = every.select("id", "h", "n_words").alias("e"), spans.alias("s")
    return (e.join(s, F.expr("e.h = s.h and e.id <=> s.id"), "left")
            .select(F.col("e.id").alias(id_col), "n_words",
                    F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.col("e.h").alias("text_hash")))


def clean(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all
    their columns."""
    found = contaminated(docs, items, window, k, id_col, text_col, item_col, item_text)
    hit = written(found.where("n_hit > 0").select(F.col(id_col).alias("id"), F.col("text_hash").alias("h")).distinct(),
                  "contaminated").alias("c")
    d = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].alias("id"),
                    F.xxhash64(text_of(text_col)).alias("h")).alias("d")
    return d.join(hit, F.expr("d.h = c.h and d.id <=> c.id"), "left_anti").select("row.*")
