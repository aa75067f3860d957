"""Scoring new rows as they arrive (Structured Streaming).

Every fitted step here (imputer, encoder, MLlib model, dense network score)
is a stateless projection, so the same objects fitted on a batch table apply
unchanged to a streaming DataFrame: no state store, no watermark, each
micro-batch is a narrow stage.  Progress is kept in a checkpoint folder under
the session's ``spark.checkpoint.dir`` (shared on a cluster), so a restarted
query resumes without rescoring or skipping files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabprep.functions.missing import qcol
from tabprep.session import scratch_path

Step = Callable[[DataFrame], DataFrame]


def read_table_stream(spark: SparkSession, path: str, schema: StructType,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None
                      ) -> DataFrame:
    """A folder of files as a stream (file sources need the schema up front)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def apply_steps(df: DataFrame, steps: Sequence[Step], keep: Sequence[str] = ()) -> DataFrame:
    """Run fitted transforms in order (batch or streaming input alike)."""
    out = df
    for s in steps:
        out = s(out)
    if keep:
        out = out.select(*[qcol(c) for c in keep])
    return out


def score_stream(spark: SparkSession, source: DataFrame, steps: Sequence[Step], sink: str,
                 keep: Sequence[str] = (), checkpoint: str | None = None,
                 fmt: str = "parquet", once: bool = True) -> StreamingQuery:
    """Append the scored rows of every new file to ``sink``.  With ``once``
    the query processes what is there now and stops (``availableNow``)."""
    scored = apply_steps(source, steps, keep)
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", ckpt).option("path", sink))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")
    return w.start()
