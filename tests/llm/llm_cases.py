"""Small tables for the tests of the llm operators."""

import random

from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside must not clash with columns of the input.
CLASHES = ("t", "h", "id", "n", "row", "node", "root", "score", "key", "keys", "spans", "part", "data", "rid", "k", "new")


def messy(spark, texts=()):
    """Nulls in every column, empty, blank and long texts, repeated rows, ids
    and texts, and extra columns with clashing names."""
    long = " ".join(f"w{i % 997}x" for i in range(40_000))
    rows = [(1, "one two three four five six", "en", "a", 1), (1, "one two three four five six", "en", "a", 1),
            (2, None, None, None, None), (None, "no id here at all", "en", None, 3), (None, None, "en", "a", 2),
            (3, "", "", "", 0), (4, " \n\t ", "en", "b", 4), (5, long, "de", "a", None), (6, long, "de", "a", None),
            (7, "ünïcödé 😀 ́ text", "fr", "c", 7), (8, "one two three four five six", "en", "a", 1),
            (8, "another text of the same id", "en", "a", 1)]
    rows += [(100 + i, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], T.StructType.fromDDL(schema))


def prose(seed, n, words=400):
    """Random words with sentence ends and line breaks."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    out = []
    for i in range(n):
        w = rng.choice(vocab)
        out.append(w + rng.choice([" ", " ", " ", " ", " ", " ", ", ", ". ", ".\n"]))
    return "".join(out).strip()


def small_families(count=100):
    """Pairs of edited copies around one passage that all of them share."""
    passage, texts = prose(31, 160, 2000).split(" "), []
    for family in range(count):
        own = prose(5000 + family, 20, 3000).split(" ")
        for k in range(2):
            w = passage + own
            rng = random.Random(10 * family + k)
            for i in rng.sample(range(len(w)), 2):
                w[i] = f"new{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w))
    return texts
