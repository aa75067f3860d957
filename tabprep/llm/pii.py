"""Personal data by weak supervision.

Patterns propose candidate spans.  Labelers of three sorts vote on each one
(+1 personal, -1 not, 0 no opinion): regular expressions on its form,
gazetteers of known words and prefixes, and the words around it.
Expectation-maximisation over the counts of vote vectors estimates how
reliable every labeler is and gives each vector a probability; a logistic
span classifier is trained on those probabilities from the candidate's own
features and decides which spans are added.  Spans of the four base kinds
follow their definitions exactly and always stay.

Text is read once, with built-in functions only.  Matching and splitting by
the same pattern give the matches and the gaps between them, so positions are
running sums of lengths.  Vote vectors and features have few values, hence
their counts (never the candidates) go to the driver for training.

Patterns are written so that a failed match is not tried again from every
later character of the same run (a start is the previous match's end or the
start of a run, runs are possessive): a text without white space costs no
more than any other.  A repeated group is possessive too: the JVM matches it in
a loop, where a plain one recurses and runs out of stack on long chains.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import text_of, written

# The forms of the base kinds.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Forms that the method may add.
ADDED = {
    "secret": r"(?:AKIA[0-9A-Z]{16}(?![0-9A-Z])|(?i:password|passwd|pwd|token|secret|api[_-]?key)[\x20\t]?[=:]"
              r"[\x20\t]?[\"']?[A-Za-z0-9+/_.-]{8,}+[\"']?)",
    "mail_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++[\x20]?(?:\(at\)|\[at\]|\{at\})[\x20]?[A-Za-z0-9-]++"
                  r"(?:[\x20]?(?:\(dot\)|\[dot\]|\.)[\x20]?[A-Za-z0-9-]++)++",
    "local_phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])",
    "person_id": r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9.-])",
}
PATTERNS = BASE | ADDED
#: A text without this cannot match the kind (cheap tests before the pattern).
NEEDS = {"email": "contains(t, '@')", "phone": "contains(t, '+')",
         "ip": "t rlike '[0-9][.][0-9]'", "card": "t rlike '[0-9][ -]?[0-9]'",
         "secret": "t rlike '[=:]|AKIA'", "mail_words": "t rlike '[(\\\\[{]at[)\\\\]}]'",
         "local_phone": "t rlike '[0-9]{3}[). -]'", "person_id": "t rlike '[0-9]-[0-9]'"}
ORDER = list(PATTERNS)

# Gazetteers and context words (four languages), as alternatives.
KNOWN_PREFIXES = "^(AKIA|ASIA|(?i:password|passwd|token))"
KNOWN_DOMAINS = r"(?i)(gmail|outlook|yahoo|hotmail|example|gmx|web|mail)[a-z]*[\x20]?(\.|\(dot\)|\[dot\])|\.(com|org|net|edu|de|fr|es|io|info)$"
CONTEXT = ("(?i)(mail|contact|kontakt|contacto|correo|phone|tel|call|fon|telefono|mobile|fax|card|karte|carte|tarjeta|"
           "visa|ssn|social security|ip|host|server|address|password|token|secret|key|credential)[^a-z]{0,12}$")
NUMBERING = "(?i)(version|release|section|chapter|figure|table|page|isbn|issn|doi|no|nr)[.:#]?[ ]{0,2}$"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _valid(kind: Column, m: Column) -> Column:
    """The conditions of the base kinds beyond their forms."""
    d = _digits(m)
    luhn = F.aggregate(
        F.sequence(F.lit(0), F.length(d) - 1), F.lit(0),
        lambda total, i: total + F.aggregate(
            F.array(F.substring(F.reverse(d), i + 1, F.lit(1)).cast("int") * (F.lit(1) + i % 2)), F.lit(0),
            lambda a, x: a + x - F.when(x > 9, 9).otherwise(0))) % 10 == 0
    parts = F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
        "^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.when(kind == "email", True).when(kind == "ip", parts)
            .when(kind == "card", F.when(F.length(d).between(14, 19), luhn).otherwise(False))
            .when(kind == "phone", F.length(d).between(10, 15)).otherwise(False))


def _spans(kind: str) -> Column:
    """Matches with the gap before each one and the text around it, from the
    columns of matches and gaps (evaluated once, not per match)."""
    found, gaps = F.col(f"m_{kind}"), F.col(f"g_{kind}")
    spans = F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(gaps, i)).alias("gap"), m.alias("m"),
        F.right(F.get(gaps, i), F.lit(40)).alias("pre"), F.left(F.get(gaps, i + 1), F.lit(8)).alias("post")))
    return F.coalesce(spans, F.array())


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(a row ``id, h`` per document, its candidate spans as rows
    ``id, h, kind, m, pre, post, start, end``)."""
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    matches = base.withColumns({f"m_{k}": F.when(F.expr(NEEDS[k]), F.regexp_extract_all("t", F.lit(p), F.lit(0)))
                                for k, p in PATTERNS.items()})
    gaps = matches.withColumns({f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.split("t", p, -1))
                                for k, p in PATTERNS.items()})
    per_doc = written(gaps.select("id", "h", F.concat(*map(_spans, PATTERNS)).alias("found")), "pii-candidates")
    so_far = W.partitionBy("id", "h", "kind").orderBy("i")
    rows = (per_doc.select("id", "h", F.explode("found").alias("c")).select("id", "h", "c.*").distinct()
            .withColumn("end", F.sum(F.col("gap") + F.length("m")).over(so_far))
            .withColumn("start", F.col("end") - F.length("m")))
    return per_doc.select("id", "h"), rows


def votes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``valid``, the labelers' votes ``v0..v5`` and the
    classifier's features ``f0..f4`` (small integers)."""
    kind, m, d = F.col("kind"), F.col("m"), _digits(F.col("m"))
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    rows = rows.withColumn("valid", _valid(kind, m))
    share = F.length(d) / F.length(m)
    number_like = kind.isin("ip", "card", "phone", "local_phone", "person_id")
    return rows.withColumns({
        # regular expressions on the form
        "v0": F.when(kind.isin(*BASE), F.when(F.col("valid"), yes).otherwise(no)).otherwise(none),
        "v1": F.when(kind == "secret", F.when(m.rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]"), yes).otherwise(no))
        .when(kind == "person_id", F.when(m.rlike("^(000|666|9)|-00-|-0000$"), no).otherwise(yes))
        .when(kind == "local_phone", F.when(m.rlike(r"^\(?[2-9]"), yes).otherwise(no)).otherwise(none),
        "v2": F.when(number_like & _digits(F.col("m")).rlike(r"^([0-9])\1*$"), no)
        .when(number_like & m.rlike("^(19|20)[0-9]{2}[-. ]"), no).otherwise(none),
        # gazetteers
        "v3": F.when(kind.isin("email", "mail_words"), F.when(m.rlike(KNOWN_DOMAINS), yes).otherwise(none))
        .when(kind == "secret", F.when(m.rlike(KNOWN_PREFIXES), yes).otherwise(none)).otherwise(none),
        # the words around
        "v4": F.when(F.col("pre").rlike(CONTEXT), yes).otherwise(none),
        "v5": F.when(F.col("pre").rlike(NUMBERING) | F.col("post").rlike("^([0-9]|[.,][0-9]|%)"), no).otherwise(none),
        "f0": F.array_position(F.array(*[F.lit(k) for k in ORDER]), kind).cast("int") - 1,
        "f1": F.least(F.lit(4), F.floor(F.length(m) / 8)).cast("int"),
        "f2": F.floor(share * F.lit(3.99)).cast("int"),
        "f3": (F.col("pre") == "").cast("int") + 2 * F.col("pre").rlike("[^A-Za-z0-9]$").cast("int"),
        "f4": F.col("valid").cast("int"),
    })


N_VOTES, SIZES = 6, (len(ORDER), 5, 4, 4, 2)


def estimate(vote_rows: np.ndarray, count: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Probability of each vote vector (rows of -1, 0, 1) that its candidates
    are personal data: a two-class model in which labelers are independent,
    fitted by expectation-maximisation from the majority vote."""
    p = 1 / (1 + np.exp(-1.5 * vote_rows.sum(1)))
    for _ in range(rounds):
        weight = np.stack([count * (1 - p), count * p])
        prior = np.log((weight.sum(1) + 1) / (weight.sum() + 2))
        score = np.repeat(prior[:, None], len(p), 1)
        for j in range(vote_rows.shape[1]):
            table = np.stack([(weight * (vote_rows[:, j] == v)).sum(1) for v in (-1, 0, 1)], 1)
            table += [[2, 1, 0.5], [0.5, 1, 2]]  # a labeler is taken to be better than chance
            score += np.log(table / table.sum(1, keepdims=True))[:, vote_rows[:, j] + 1]
        p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
    return p


def train(features: np.ndarray, p: np.ndarray, count: np.ndarray, rounds: int = 300) -> list[np.ndarray]:
    """Weights of a logistic classifier over one-hot features, fitted to the
    probabilities ``p`` of ``count`` candidates per row."""
    starts = np.cumsum((0, *SIZES[:-1]))
    x = np.zeros((len(p), sum(SIZES)))
    x[np.arange(len(p))[:, None], features + starts] = 1
    w, step = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-(x @ w)))
        grad = x.T @ (count / max(count.sum(), 1) * (guess - p)) + 1e-4 * w
        step += grad ** 2
        w -= 0.5 * grad / np.sqrt(step + 1e-12)
    return [w[a:a + n] for a, n in zip(starts, SIZES)]


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: ``id, h`` (xxhash64 of its text), ``base`` and
    ``spans``, arrays of ``(start, rank, kind, end)`` in order (code points,
    end exclusive; ``rank`` is the kind's place in the list).

    Defined cases: a null text counts as empty and has no spans; repeated
    documents get a row each; an added span that overlaps a base span of the
    document is left out; without any candidate nothing is trained; a null id
    stays null; other columns are ignored.
    """
    every, rows = candidates(docs, id_col, text_col)
    rows = written(votes(rows), "pii-votes")
    names = [f"v{i}" for i in range(N_VOTES)] + [f"f{i}" for i in range(len(SIZES))]
    # few values each: the counts are bounded by the labelers and features
    counted = rows.groupBy(*names).count().collect()
    chance = F.lit(0.0)
    if counted:
        table = np.array([list(r) for r in sorted(counted)], np.int64)
        p = estimate(table[:, :N_VOTES], table[:, -1].astype(float))
        model = train(table[:, N_VOTES:-1], p, table[:, -1].astype(float))
        logit = sum((F.get(F.array(*[F.lit(float(x)) for x in w]), F.col(f"f{i}")) for i, w in enumerate(model)), F.lit(0.0))
        chance = 1 / (1 + F.exp(-logit))
    is_base = F.col("kind").isin(*BASE)
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("f0").alias("rank"),
                    F.when(F.col("kind") == "mail_words", "email").when(F.col("kind") == "local_phone", "phone")
                    .otherwise(F.col("kind")).alias("kind"), F.col("end").cast("long").alias("end"))
    kept = (rows.withColumn("base", is_base & F.col("valid"))
            .where(F.col("base") | (~is_base & (chance >= least)))
            .groupBy("id", "h").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
                                    F.collect_list(F.when(~F.col("base"), span)).alias("more"))
            .withColumn("more", F.filter("more", lambda x: ~F.exists(
                "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))
            .select("id", "h", "base", F.sort_array(F.concat("base", "more")).alias("spans")))
    e, k = every.alias("e"), kept.alias("k")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return (e.join(k, F.expr("e.h = k.h and e.id <=> k.id"), "left")
            .select("e.id", "e.h", F.coalesce("base", empty).alias("base"), F.coalesce("spans", empty).alias("spans")))


def listed(array: str) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets (of
    overlapping spans, the first one's); rows without spans stay as they are,
    null texts too.  All columns are kept."""
    found = written(spans(docs, id_col, text_col).where(F.size("spans") > 0).select("id", "h", "spans").distinct(),
                    "pii-spans")
    d = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")) \
        .withColumn("h", F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")))).alias("d")
    text = F.col(f"d.row.`{text_col}`")
    # spans in order with overlaps merged; `done` is what is copied so far
    merged = F.aggregate(
        "k.spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("done")),
        lambda a, s: F.when(s["start"] >= a["done"], F.struct(
            F.concat(a["out"], F.substring(text, (a["done"] + 1).cast("int"), (s["start"] - a["done"]).cast("int")),
                     F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("done")))
        .otherwise(F.struct(a["out"].alias("out"), F.greatest(a["done"], s["end"]).alias("done"))),
        lambda a: F.concat(a["out"], F.substring(text, (a["done"] + 1).cast("int"), F.length(text))))
    new = F.when(F.col("k.spans").isNotNull(), merged).otherwise(text)
    # a merge join at every size: what it costs follows the texts alone
    return (d.join(found.hint("merge").alias("k"), F.expr(f"d.h = k.h and d.row.`{id_col}` <=> k.id"), "left")
            .withColumn("new", new)
            .select(*[(F.col("new") if c == text_col else F.col(f"d.row.`{c}`")).alias(c) for c in docs.columns]))
