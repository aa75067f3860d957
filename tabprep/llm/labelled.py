"""Labelled rows for training, and text pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, text_of, utf8

by_value(__name__)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id's text is a multiple of 5.
    A null id is held out."""
    return F.coalesce(F.crc32(utf8(F.col(id_col).cast("string"))) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text",
             partitions: int | None = None) -> DataFrame:
    """``id, t, y`` of every row with a label 0 or 1 (the larger of several)
    that is not held out, whatever its length; dealt by a hash of the id to
    ``partitions``, if given, with the one shuffle of the texts that finds
    their labels (a join would raise a smaller number to Spark's own)."""
    if partitions:
        own = labels.where(~held_out(id_col) & F.col(target).isin(0, 1)).select(
            F.col(id_col).alias("id"), F.lit(None).cast("string").alias("t"), F.col(target).cast("int").alias("y"))
        texts = docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), text_of(text_col).alias("t"), F.lit(None).cast("int").alias("y"))
        return (texts.unionByName(own).repartition(partitions, "id").withColumn("y", F.max("y").over(Window.partitionBy("id")))
                .where("t is not null and y is not null"))
    known = (labels.where(~held_out(id_col) & F.col(target).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(target).cast("int").alias("y")))
    texts = docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    return texts.join(known, "id").select("id", "t", "y")


def sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, max_chars: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Training rows ``id, t, y``: of each class of ``labels.<target>`` the
    ``per_class`` rows that come first by a hash of their id, less those
    without a text of at most ``max_chars``.  Held-out rows never take part.
    Both bounds only limit what is trained on."""
    known = (labels.where(~held_out(id_col) & F.col(target).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(target).alias("y")))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id", F.lit(5)), "id").limit(per_class) for y in (0, 1)]
    rows = picked[0].unionAll(picked[1])
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).where(F.length("t") <= max_chars)
    # at most 2 * per_class rows
    return texts.join(F.broadcast(rows), "id").select("id", "t", F.col("y").cast("int").alias("y"))


def portions(text: str, size: int = 1_000_000, lines: bool = False) -> Iterator[str]:
    """A text in runs of about ``size`` characters, so that one text never
    fills a task's memory.  Cuts fall behind line ends (``lines``), or behind
    characters that are no part of a word; a longer line or word is not cut
    but makes its run as long, so nothing depends on ``size``."""
    at, n = 0, len(text)
    while n - at > size:
        if lines:
            cut = text.rfind("\n", at, at + size) + 1 or text.find("\n", at + size) + 1 or n
        else:
            cut = at + size
            while cut > at and text[cut - 1].isalnum():
                cut -= 1
            if cut == at:
                cut = at + size
                while cut < n and text[cut - 1].isalnum():
                    cut += 1
        yield text[at:cut]
        at = cut
    if at < n or not n:
        yield text[at:]
