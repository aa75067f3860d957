"""Driver tables and the views derived from them.

``house_like`` is the house-price-shaped table the oracle checks run on: the
driver tables hold no missing values, so missing values are placed by key
arithmetic, identically in Spark and in SQL.  Every row of ``orders`` is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.hashing import key_normal, sql_key_normal

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- house_like

HOUSE_COLUMNS = ("id", "acctbal", "nation", "segment", "priority", "status",
                 "rare", "const", "target", "origin")
HOUSE_FEATURES = ("acctbal", "nation", "segment", "priority", "status", "rare", "const")


def house_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer; train/test tag in ``origin``; target last
    among the features."""
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # customer is the dimension side; Spark broadcasts it only when its
    # measured size is under spark.sql.autoBroadcastJoinThreshold, else
    # both sides are shuffled on the customer key.
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    is_train = (F.pmod(k, F.lit(10)) < 8)
    null_s = F.lit(None).cast("string")
    return j.select(
        k.alias("id"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.col("c_nationkey").alias("nation"),
        F.when(F.pmod(k, F.lit(11)) == 0, null_s)
         .when(is_train & (F.col("c_mktsegment") == "MACHINERY"), null_s)
         .otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit(""))
         .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.pmod(k, F.lit(4)) != 0, null_s)
         .otherwise(F.col("o_orderpriority")).alias("rare"),
        F.lit(1.0).alias("const"),
        F.when(F.pmod(k, F.lit(97)) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("target"),
        F.when(is_train, F.lit("train")).otherwise(F.lit("test")).alias("origin"),
    )


HOUSE_LIKE_SQL = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_acctbal END AS acctbal,
       c_nationkey AS nation,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            WHEN o_orderkey % 10 < 8 AND c_mktsegment = 'MACHINERY' THEN NULL
            ELSE c_mktsegment END AS segment,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS priority,
       o_orderstatus AS status,
       CASE WHEN o_orderkey % 4 <> 0 THEN NULL ELSE o_orderpriority END AS rare,
       CAST(1.0 AS DOUBLE) AS const,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS target,
       CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'test' END AS origin
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def house_train_test(spark: SparkSession, sf_dir: str,
                     drop_missing_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test): train keeps ``target`` last, test has no target."""
    h = house_like(spark, sf_dir)
    train = h.where(F.col("origin") == "train").drop("origin")
    if drop_missing_target:
        train = train.where(F.col("target").isNotNull())
    test = h.where(F.col("origin") == "test").drop("origin", "target")
    return train, test


# ------------------------------------------------------------------- images

IMAGE_SIDE = 8


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled images: ``embeddings`` (64 floats) mapped to an 8x8 grid of
    byte pixels, so pixel scaling and flattening have real input."""
    e = load(spark, sf_dir, "embeddings")
    px = F.transform(
        "embedding",
        lambda x: F.least(F.lit(255), F.greatest(F.lit(0),
                          F.round(x.cast("double") * 255.0 + 128.0).cast("int"))))
    grid = F.transform(F.sequence(F.lit(0), F.lit(IMAGE_SIDE - 1)),
                       lambda i: F.slice(px, i * IMAGE_SIDE + 1, IMAGE_SIDE))
    return e.select(F.col("vec_id"), F.col("label"), grid.alias("pixels"))


IMAGES_SQL = f"""
SELECT vec_id, label,
       [list_slice(p, i * {IMAGE_SIDE} + 1, i * {IMAGE_SIDE} + {IMAGE_SIDE})
        FOR i IN range({IMAGE_SIDE})] AS pixels
FROM (SELECT vec_id, label,
             list_transform(embedding, lambda x: CAST(least(255, greatest(0,
                 CAST(round(CAST(x AS DOUBLE) * 255.0 + 128.0) AS INTEGER))) AS INTEGER)) AS p
      FROM embeddings)
"""


# ----------------------------------------------------- synthetic regression

def synthetic_regression(base: DataFrame, key: str, w: list[float], b: float,
                         noise: float = 0.01) -> DataFrame:
    """``synthetic_data(w, b, n)`` over the rows of a keyed table: one row per
    key, features x_j ~ N(0, 1), y = x.w + b + N(0, noise^2).  Draws are key
    hashes, so the table is the same on any partitioning and in SQL."""
    xs = [key_normal(key, salt=j + 1) for j in range(len(w))]
    eps = key_normal(key, salt=len(w) + 1)
    y = F.lit(float(b))
    for j, wj in enumerate(w):
        y = y + F.lit(float(wj)) * xs[j]
    y = y + F.lit(float(noise)) * eps
    return base.select(F.col(key).alias("id"),
                       *[x.alias(f"x{j}") for j, x in enumerate(xs)], y.alias("y"))


def synthetic_regression_sql(table: str, key: str, w: list[float], b: float,
                             noise: float = 0.01) -> str:
    xs = [sql_key_normal(key, salt=j + 1) for j in range(len(w))]
    eps = sql_key_normal(key, salt=len(w) + 1)
    y = f"{float(b)!r}"
    for j, wj in enumerate(w):
        y += f" + {float(wj)!r} * {xs[j]}"
    y += f" + {float(noise)!r} * {eps}"
    cols = ", ".join(f"{x} AS x{j}" for j, x in enumerate(xs))
    return f"SELECT {key} AS id, {cols}, {y} AS y FROM {table}"
