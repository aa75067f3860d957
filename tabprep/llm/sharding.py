"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there; the
rank divided by the source's size places the row on a common line from 0 to
1, and the line is cut into runs of equal counts.  Every run then holds each
source in proportion, and run sizes differ by at most one row.

No step sorts a whole source or the whole table in one task.  The hash (first
ranking) and the fractional rank (second one) are spread evenly whatever the
sizes of the sources are, so a fixed number of ranges of either value holds
even shares of the rows; ranks are positions inside a range plus the counted
rows before it.  Only counts cross between ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .common import text_of, top_bits, utf8, written

#: Ranges of the hash and of the fractional rank: 2**RANGE_BITS each.
RANGE_BITS = 11


def shard_rows(docs: DataFrame, n_shards: int = 40, seed: int = 17, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (0 .. n_shards - 1) and its
    ``slot`` in it (gapless from 0): columns ``id_col, size, text_crc32,
    source, shard, slot``.

    Defined cases: a null text counts as empty (size 16, crc32 of nothing); a
    null source is a source of its own; a null id is hashed like any value;
    repeated rows are placed one by one; an empty table gives no rows; other
    columns of ``docs`` are ignored, so their names cannot clash.
    """
    spread = F.xxhash64(F.lit(seed), F.col("id"), F.col("size"), F.col("crc"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                        text_of(text_col).alias("t"))
            .select("id", F.coalesce(F.concat(F.lit("="), F.col("src")), F.lit("")).alias("source"),
                    (F.octet_length("t").cast("long") + 16).alias("size"),
                    F.crc32(utf8(F.col("t"))).alias("crc"))
            .withColumn("h", spread).withColumn("b", top_bits(F.col("h"), RANGE_BITS)))
    rows = written(rows, "shard-rows")

    counts = rows.groupBy("source", "b").agg(F.count(F.lit(1)).alias("n"))
    by_source = W.partitionBy("source")
    before = counts.select(
        "source", "b",
        F.coalesce(F.sum("n").over(by_source.orderBy("b").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.sum("n").over(by_source).alias("total"))
    in_range = F.row_number().over(W.partitionBy("source", "b").orderBy("h", "id", "size", "crc"))
    ranges = 1 << RANGE_BITS
    # each source starts at its own fraction of a step, so that many sources of
    # one row spread over the whole line instead of meeting at its middle
    start = (top_bits(F.xxhash64(F.lit(seed + 1), F.col("source")), 31) + F.lit(0.5)) / F.lit(float(1 << 31))
    placed = (rows.withColumn("r", in_range - 1).join(before, ["source", "b"])
              .select("id", "source", "size", "crc", "h",
                      ((F.col("r") + F.col("before") + start) / F.col("total")).alias("f"))
              .withColumn("fb", F.least(F.floor(F.col("f") * ranges), F.lit(ranges - 1)).cast("int")))
    placed = written(placed, "shard-placed")

    # at most `ranges` counts, whatever the input
    line = (placed.groupBy("fb").agg(F.count(F.lit(1)).alias("n"))
            .select("fb", (F.sum("n").over(W.orderBy("fb")) - F.col("n")).alias("before"),
                    F.sum("n").over(W.partitionBy()).alias("total")))
    on_line = F.row_number().over(W.partitionBy("fb").orderBy("f", "source", "h", "id", "size", "crc"))
    at = placed.withColumn("r", on_line - 1).join(F.broadcast(line), "fb") \
        .withColumn("i", F.col("r") + F.col("before"))
    shard = F.expr(f"(i * {n_shards}) div total")
    first = F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}")  # of the shard's rows on the line
    return (at.withColumn("shard", shard)
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.expr("if(source = '', null, substring(source, 2))").alias("source"),
                    F.col("shard").cast("int").alias("shard"), (F.col("i") - first).alias("slot")))
