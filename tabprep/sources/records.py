"""CSV records that hold line breaks inside quotes, read in splits.

A line break ends a record only if the quotes before it are even in number,
which a task that starts inside a file can't see.  So:

1. every split counts its quotes (one aggregate over the lines, read as text);
2. a running sum over the splits of a file, a small table, says of each split
   whether it starts inside quotes;
3. with that, each task joins the lines of its splits to records.  What a split
   begins with inside quotes, and the record it leaves open, are fragments, at
   most two a split, put together by a small second job.

Text is never brought into one task, and a file is read by as many tasks as it
has splits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Up to so many splits the table of their starts is sent to every task.
MOST_SPLITS = 500_000


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, at, line``: the lines of a split in order of ``at``."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a line holds an odd number of quotes: one narrow scan."""
    return not spark.read.option("lineSep", "\n").text(path).where(_quotes(F.col("value")) % 2 == 1).isEmpty()


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines in order -> records and fragments of each split.  ``kind``:
    ``record``, ``rest`` (of a record begun in an earlier split) or ``open``."""
    here, parts, kind, odd, number = None, [], "", 0, 0

    def ended():
        return [(*here, number, kind if odd == 0 or kind == "rest" else "open", "\n".join(parts))] if parts else []

    for frame in frames:
        out = []
        for file, split, line, inside in zip(frame["file"], frame["split"], frame["line"], frame["inside"]):
            if (file, split) != here:
                out += ended()
                here, parts, odd, number = (file, split), [], int(inside), 0
                kind = "rest" if odd else "record"
            parts.append(line)
            odd = (odd + line.count('"')) % 2
            if not odd:
                out.append((*here, number, kind, "\n".join(parts)))
                parts, kind, number = [], "record", number + 1
        if out:
            yield pd.DataFrame(out, columns=["file", "split", "number", "kind", "text"])
    if last := ended():
        yield pd.DataFrame(last, columns=["file", "split", "number", "kind", "text"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, number, text``: every record, line breaks inside quotes
    kept; the first one of a file has split 0 and number 0.  An empty file has
    none; a quote that is never closed is an error."""
    lines = lines_of(spark, path)
    counts = lines.groupBy("file", "split").agg(F.sum(_quotes(F.col("line"))).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    where = scratch_path(spark, "splits")
    counts.select("file", "split", "n", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int").alias("inside")).write.parquet(where)
    starts = spark.read.parquet(where)
    if not starts.groupBy("file").agg((F.sum("n") % 2).alias("odd")).where("odd = 1").isEmpty():
        raise ValueError(f"a quote is never closed in {path}")
    starts = starts.select("file", "split", "inside")
    if starts.count() <= MOST_SPLITS:  # keeps the lines where and as they are
        known = lines.join(F.broadcast(starts), ["file", "split"])
    else:
        known = lines.join(starts.hint("merge"), ["file", "split"]).sortWithinPartitions("file", "split", "at")
    found = scratch_path(spark, "records")
    (known.select("file", "split", "line", "inside")
     .mapInPandas(_joined, "file string, split long, number long, kind string, text string").write.parquet(found))
    every = spark.read.parquet(found)
    # fragments follow each other by split: an open one, then its rests
    ordered = Window.partitionBy("file").orderBy("split", "number")
    parts = (every.where("kind <> 'record'")
             .withColumn("head", F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(ordered))
             .groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("split", "number", "text"))).alias("p")))
    crossing = parts.select("file", F.col("p")[0]["split"].alias("split"), F.col("p")[0]["number"].alias("number"),
                            F.array_join(F.col("p.text"), "\n").alias("text"))
    return every.where("kind = 'record'").select("file", "split", "number", "text").unionByName(crossing)


def parsed(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """The records below the header as text columns, parsed by ``from_csv``;
    blank lines are no records."""
    schema = ", ".join("`{}` string".format(c.replace("`", "``")) for c in columns)
    body = records(spark, path).where(~((F.col("split") == 0) & (F.col("number") == 0)))
    text = F.regexp_replace("text", "\r$", "")
    row = F.from_csv(text, schema, {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return body.where(F.length(F.trim(text)) > 0).select(row.alias("r")).select("r.*")
