"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontaminate, divergence, fingerprint, htmltext, licenses, neardup, packing, pii,
               quality, sharding, substrings, toxicity)
from .common import read
from .labelled import held_out

PACK_TOKENIZER = "word_bpe_49k.json"


def op1_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


OP2_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS text
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
gram AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS text
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, gram.n, item FROM gram JOIN win USING (text)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return (pii.spans(read(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), *[count(k) for k in pii.BASE],
                    F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return (quality.score(docs, model, cut=0.3)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.shard_rows(read(spark, sf_dir, "documents"), n_shards=40)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT row_id, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM word GROUP BY ALL HAVING count(DISTINCT row_id) >= 30),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
tot AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
share AS (
  SELECT lang, source, term, coalesce(cnt.n, 0) AS n,
         1 + (1000000000 * (coalesce(cnt.n, 0) + 5)) // (tot.total + 5 * v) AS p,
         1 + (1000000000 * (kept.n + 5)) // (size.total + 5 * v) AS q
  FROM kept JOIN size USING (lang) JOIN tot USING (lang) LEFT JOIN cnt USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
term AS (SELECT lang, source, term AS item, p - q AS value FROM share WHERE n > 0 AND p > q),
every AS (SELECT *, 'pair' AS part FROM pair UNION ALL BY NAME SELECT *, 'term' AS part FROM term)
SELECT * FROM (SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= 50
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
words AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM gram GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (
  SELECT c.lang, c.k, c.phrase, a, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000000 * a * a) // (x.f * y.f), c) AS best
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = first JOIN f y ON y.lang = c.lang AND y.phrase = rest),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE k = 3)
  GROUP BY ALL)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
         l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
  FROM scored JOIN n USING (lang) LEFT JOIN inside USING (lang, phrase)
  WHERE best = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
WHERE rank <= 2000
"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


_LABELLED = ", ".join("('{}', '{}')".format(*x) for x in licenses.TEMPLATES)
_PHRASES = ", ".join(f"('{label}', '{phrase}')" for phrase, label in licenses.PHRASES.items())
_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP13_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
template AS (SELECT DISTINCT label, list_sort(list_distinct({_WORDS.format("t")})) AS words FROM (VALUES {_LABELLED}) x(label, t)),
phrase AS (SELECT label, {_WORDS.format("t")} AS words FROM (VALUES {_PHRASES}) x(label, t)),
sentence AS (
  SELECT row_id, {_WORDS.format("s")} AS w
  FROM (SELECT row_id, unnest(regexp_split_to_array(t, '[.!?]+[\x09-\x0D\x20]|\n[\x09-\x0D\x20]*\n')) AS s FROM doc)),
block AS (
  SELECT row_id, list_distinct(w[i + 1:i + 64]) AS words
  FROM (SELECT row_id, w, unnest(list_concat([0], range(32, greatest(len(w) - 32, 32), 32))) AS i FROM sentence WHERE len(w) > 0)),
met AS (
  SELECT row_id, label, len(list_intersect(block.words, template.words)) AS n, len(template.words) AS size FROM block, template),
alike AS (SELECT row_id, label, max(n / size) AS share FROM met WHERE 10 * n >= 8 * size GROUP BY ALL),
place AS (
  SELECT row_id, label, i - 1 AS place
  FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc) JOIN phrase ON w[i:i + len(words) - 1] = words),
base AS (
  SELECT row_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY row_id),
every AS (
  SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share
  FROM (SELECT row_id, label, share FROM alike UNION ALL SELECT row_id, label, 1.0 FROM place) GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM doc LEFT JOIN base USING (row_id) LEFT JOIN every USING (row_id)
"""


QUERIES = {f.__name__: f for f in (op1_repeated_substrings, op2_decontamination, op3_fingerprints, op4_pii, op5_quality, op6_packing, op7_sharding,
                                  op8_html_text, op9_toxicity, op10_near_duplicates, op11_source_divergence, op12_collocations, op13_license_scan)}
ORACLE = {"op2_decontamination": OP2_SQL, "op11_source_divergence": OP11_SQL, "op12_collocations": OP12_SQL,
          "op13_license_scan": OP13_SQL}
