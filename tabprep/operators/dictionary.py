"""Category dictionaries as tables, and one-hot encoding into sparse vectors
(A9, F10, F11 for any number of categories).

``fit_dictionary`` gives every non-missing value of every category column its
place among the column's sorted values.  The dictionary stays a distributed
table: values are counted (combined before the shuffle), numbered by P6, and
written; the driver receives one width per column.

``VectorEncoder`` is ``encode.TableEncoder`` with a vector output: scaled
numeric columns first, then one slot per train category of each column.  A row
finds its slots by one join per category column.  Values that hold a large
share of the train rows ("hot") are in the dictionary several times, each under
a salt, and rows carrying them pick a salt, so no join key holds more than
about HOT_SHARE of the rows.  The plan has one join per category *column*,
whatever the number of categories; small dictionaries are broadcast by Spark
itself (it sees the written table's size).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.kinds import split_kinds
from tabprep.functions.missing import MISSING_LABEL, qcol
from tabprep.operators import stats
from tabprep.operators.align import consecutive_index
from tabprep.operators.encode import NUMERIC_METHODS, _scale_params
from tabprep.session import scratch_path

#: Columns of a dictionary's table, beside the column number.
ENTRY = "v string, place long, n long, copies int"
#: A value above this share of its column's rows is dealt to several salts.
HOT_SHARE = 1 / 256


def category_text(df: DataFrame, column: str) -> Column:
    """The category of a cell as text; missing and empty become the label."""
    text = stats.as_category_string(df, column)
    return F.coalesce(F.when(text == "", F.lit(MISSING_LABEL)).otherwise(text), F.lit(MISSING_LABEL))


@dataclass
class FittedDictionary:
    """``path`` holds ``c, v, place, n, copies``: column number, value, place
    among the column's sorted values, train rows, salts (1 unless hot)."""
    path: str
    columns: list[str]
    widths: list[int]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{ENTRY}, c int").parquet(self.path)

    def of_column(self, spark: SparkSession, column: str) -> DataFrame:
        """The entries of one column.  Its folder is read by itself, so
        that Spark sees this column's size when it picks a join."""
        i = self.columns.index(column)
        if not self.widths[i]:
            return spark.createDataFrame([], ENTRY)
        return spark.read.schema(ENTRY).parquet(f"{self.path}/c={i}")

    def placed(self, df: DataFrame, out: dict[str, str], text: dict[str, Column]) -> DataFrame:
        """``df`` with the place of each column's value (NULL when the train
        rows had none of it).  ``text`` gives the value of a column."""
        spark, d = df.sparkSession, df
        whole = F.xxhash64(*[qcol(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
        any_hot = {r["c"] for r in self.table(spark).where("copies > 1").select("c").distinct().collect()}
        d = d.withColumn("__row", whole)
        for i, c in enumerate(self.columns):
            mine = self.of_column(spark, c)
            d = d.withColumn("__v", text[c])
            if i in any_hot:
                # at most 1 / HOT_SHARE values, whatever the table
                hot = mine.where("copies > 1").select(F.col("v").alias("__hv"), F.col("copies").alias("__hc"))
                d = (d.join(F.broadcast(hot), F.col("__v") == F.col("__hv"), "left")
                     .withColumn("__s", F.pmod("__row", F.coalesce("__hc", F.lit(1)).cast("long"))).drop("__hv", "__hc"))
                mine = mine.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies").cast("long") - 1)))
            else:
                d, mine = d.withColumn("__s", F.lit(0).cast("long")), mine.withColumn("salt", F.lit(0).cast("long"))
            mine = mine.select(F.col("v").alias("__v"), F.col("salt").alias("__s"), F.col("place").alias(out[c]))
            d = d.join(mine, ["__v", "__s"], "left").drop("__v", "__s")
        return d.drop("__row")


def fit_dictionary(df: DataFrame, columns: Sequence[str], text: dict[str, Column] | None = None) -> FittedDictionary:
    """A9 as a table: the sorted distinct non-missing values of each column.
    Values are compared as text (see ``stats.as_category_string``)."""
    spark, columns = df.sparkSession, list(columns)
    cells = [F.struct(F.lit(i).alias("c"), (text[c] if text else stats.as_category_string(df, c)).alias("v")) for i, c in enumerate(columns)]
    path = scratch_path(spark, "dictionary")
    if not columns:
        spark.createDataFrame([], f"{ENTRY}, c int").write.partitionBy("c").parquet(path)
        return FittedDictionary(path, [], [])
    counts = (df.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull())
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    numbered = consecutive_index(counts, ["c", "v"], out="number")
    numbers_path = scratch_path(spark, "numbered-values")
    numbered.write.parquet(numbers_path)
    numbered = spark.read.parquet(numbers_path)
    # one row per column
    heads = numbered.groupBy("c").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("width"), F.sum("n").alias("rows"))
    found = {r["c"]: r for r in heads.collect()}
    first, rows = ([int(found[i][x]) if i in found else 0 for i in range(len(columns))] for x in ("first", "rows"))
    at = lambda xs: F.element_at(F.array(*[F.lit(x).cast("long") for x in xs]), F.col("c") + 1)
    copies = F.ceil(F.col("n") / F.greatest(F.lit(1.0), at(rows) * F.lit(HOT_SHARE))).cast("int")
    # only large tables need it: a salt stands for at least 10,000 rows
    copies = F.greatest(F.lit(1), F.least(copies, F.ceil(F.col("n") / F.lit(10_000)).cast("int")))
    (numbered.select("v", (F.col("number") - at(first)).alias("place"), "n", copies.alias("copies"), "c")
     .write.partitionBy("c").parquet(path))
    return FittedDictionary(path, columns, [int(found[i]["width"]) if i in found else 0 for i in range(len(columns))])


@dataclass
class FittedVectorEncoder:
    numeric_method: str
    numeric: list[str]
    shift: dict[str, float]
    scale: dict[str, float]
    dictionary: FittedDictionary
    target: str | None
    target_scaled: bool
    sigma: float = 1.0
    mu: float = 0.0
    key: str | None = None
    passthrough: list[str] = field(default_factory=list)

    @property
    def size(self) -> int:
        return len(self.numeric) + sum(self.dictionary.widths)

    def names(self, spark: SparkSession) -> DataFrame:
        """F11 as a table: ``slot, name`` of every output slot."""
        numeric = spark.createDataFrame([(i, f"num__{n}") for i, n in enumerate(self.numeric)], "slot long, name string")
        cats = spark.createDataFrame([(i, c, o) for i, (c, o) in enumerate(zip(self.dictionary.columns, self._offsets()))],
                                     "c int, column string, start long")
        slots = self.dictionary.table(spark).join(F.broadcast(cats), "c").select(
            (F.col("start") + F.col("place")).alias("slot"), F.concat(F.lit("cat__"), "column", F.lit("_"), "v").alias("name"))
        return numeric.unionByName(slots)

    def _offsets(self) -> list[int]:
        out, at = [], len(self.numeric)
        for w in self.dictionary.widths:
            out.append(at)
            at += w
        return out

    def transform(self, df: DataFrame, output: str = "vector", out: str = "features") -> DataFrame:
        """Key (if any), the features, passthrough columns, the target (when
        the table has it).  ``output``: ``vector`` (one sparse MLlib vector)
        or ``arrays`` (``size, indices, values``).  A category unseen in train
        has no entry.  A numeric NULL becomes NaN in the vector."""
        if output not in ("vector", "arrays"):
            raise ValueError("output must be 'vector' or 'arrays'")
        cols = self.dictionary.columns
        places = {c: f"__p{i}" for i, c in enumerate(cols)}
        d = self.dictionary.placed(df, places, {c: category_text(df, c) for c in cols})
        numbers = []
        for n in self.numeric:
            x = qcol(n).cast("double")
            if self.numeric_method != "none":
                x = (x - F.lit(self.shift[n])) / F.lit(self.scale[n])
            numbers.append(F.coalesce(x, F.lit(float("nan"))))
        slots = [(F.col(places[c]) + F.lit(o)).cast("int") for c, o in zip(cols, self._offsets())]
        hits = F.filter(F.array(*slots), lambda s: s.isNotNull()) if slots else F.array().cast("array<int>")
        indices = F.concat(F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>"), hits)
        values = F.concat(F.array(*numbers).cast("array<double>"), F.transform(hits, lambda _: F.lit(1.0)))
        size = F.lit(self.size)
        if output == "arrays":
            features = [size.alias("size"), indices.alias("indices"), values.alias("values")]
        else:
            features = [sparse_vector(size, indices, values).alias(out)]
        keep = [qcol(self.key)] if self.key and self.key in df.columns else []
        rest = [qcol(p) for p in self.passthrough if p in df.columns]
        if self.target and self.target in df.columns:
            y = qcol(self.target).cast("double")
            rest.append(((y - F.lit(self.mu)) / F.lit(self.sigma) if self.target_scaled else y).alias(self.target))
        return d.select(*keep, *features, *rest)


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """An MLlib sparse vector from arrays, built in the JVM: Spark has no
    function for it, but reads its own vectors back from JSON."""
    from pyspark.ml.linalg import VectorUDT
    parts = F.struct(F.lit(0).alias("type"), size.alias("size"), indices.alias("indices"), values.alias("values"))
    whole = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), whole)["v"]


@dataclass
class VectorEncoder:
    """Arguments as ``encode.TableEncoder`` has them, without a limit on the
    number of categories."""
    numeric_method: str = "standardize"
    keep_target_separate: bool = True
    target: str | None = None
    key: str | None = None
    kinds: dict[str, str] | None = None
    passthrough: Sequence[str] = ()

    def __post_init__(self):
        if self.numeric_method not in NUMERIC_METHODS:
            raise ValueError(f"numeric_method must be one of {NUMERIC_METHODS}")

    def fit(self, train: DataFrame) -> FittedVectorEncoder:
        target = self.target or train.columns[-1]
        feats = [c for c in train.columns if c not in (target, self.key) and c not in self.passthrough]
        num, cat = split_kinds(train, feats, self.kinds)
        scaled_target = not self.keep_target_separate and self.numeric_method != "none"
        need = [*num, target] if scaled_target else list(num)
        mom = stats.moments(train, need) if need and (self.numeric_method != "none" or scaled_target) else {}
        params = {n: _scale_params(self.numeric_method, mom[n]) if mom else (0.0, 1.0) for n in num}
        mu, sigma = _scale_params(self.numeric_method, mom[target]) if scaled_target else (0.0, 1.0)
        dictionary = fit_dictionary(train, cat, {c: category_text(train, c) for c in cat})
        return FittedVectorEncoder(self.numeric_method, num, {n: p[0] for n, p in params.items()},
                                   {n: p[1] for n, p in params.items()}, dictionary, target, scaled_target,
                                   sigma, mu, self.key, list(self.passthrough))
