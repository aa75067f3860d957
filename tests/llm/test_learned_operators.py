"""Classifiers by held-out accuracy, the pipeline by planted documents."""

import weakref
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from conftest import SMALL
from llm_cases import DOCS, empty, messy, prose, small_families
from pyspark.sql import functions as F

import corpus_pipeline
from tabprep.llm import neardup, packing, pii, quality, queries, toxicity
from tabprep.llm.common import read
from tabprep.llm.labelled import held_out, labelled, portions, sample

LARGER = SMALL.replace("sf0.001", "sf0.1")


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name,target,least", [("op9_toxicity", "toxic", 0.95), ("op5_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, target, least):
    labels = read(spark, LARGER, "labels").select("doc_id", target)
    rows = (queries.QUERIES[name](spark, LARGER).where("held_out").join(labels, "doc_id")).toPandas()
    assert len(rows) > 500 and auc(rows["score"].to_numpy(), rows[target].to_numpy()) > 0.98
    assert (rows["predicted"] == rows[target]).mean() > least


def test_held_out_rows_are_by_crc32(spark):
    got = {r["doc_id"]: r["h"] for r in spark.range(300).select(F.col("id").alias("doc_id")).select("doc_id", held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)}
    nulls = spark.createDataFrame([(None,)], "doc_id bigint").select(held_out().alias("h"))
    assert nulls.first()["h"] is True


def test_sample_leaves_held_out_rows_alone(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    rows = sample(docs, labels, "toxic", 20, 8000).collect()
    assert rows and all(zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)
    assert all(sum(r["y"] == y for r in rows) <= 20 for y in (0, 1))


def test_portions_lose_nothing():
    text = prose(1, 400) + "x" * 500 + prose(2, 100)
    parts = list(portions(text, 97))
    assert "".join(parts) == text and sorted(map(len, parts))[-2] <= 97
    assert [w for p in parts for w in toxicity.WORD.findall(p)] == toxicity.WORD.findall(text)  # the longest word is whole
    assert list(portions("")) == [""]
    for text in ("a\n" * 300 + "b" * 400 + "\nc\n\n" * 90, "x" * 300, "\n" * 300, "ab\t" * 200 + "1²_é" * 80):
        assert [x for p in portions(text, 50, lines=True) for x in p.split("\n") if x] == [x for x in text.split("\n") if x]
        assert [w for p in portions(text, 50) for w in toxicity.WORD.findall(p)] == toxicity.WORD.findall(text)


def test_size_of_portions_decides_nothing(models, monkeypatch):
    """A text of three million characters, in portions and whole."""
    long = "\n".join([prose(i, 400) for i in range(900)] + ["tab\t" * 300_000, "<x>" * 200_000]) + "\n"
    assert len(long) > 3_000_000
    in_parts = toxicity.Scorer(models[0]).logit(long), quality.lines_of(long)
    monkeypatch.setattr(toxicity, "portions", lambda t: [t])
    monkeypatch.setattr(quality, "portions", lambda t, lines: [t])
    whole = toxicity.Scorer(models[0]).logit(long), quality.lines_of(long)
    assert in_parts[0][1] == whole[0][1] and in_parts[0][0] == pytest.approx(whole[0][0], abs=1e-4)
    lines = sum(bool(x.strip()) for x in long.split("\n"))
    assert len(in_parts[1][1]) == lines and all((a == b).all() for a, b in zip(in_parts[1], whole[1]))


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    return toxicity.fit(docs, labels, epochs=2), quality.fit(docs, labels)


def test_scores_of_messy_rows(spark, models):
    df = messy(spark)
    tox, good = toxicity.score(df, models[0], out="score"), quality.score(df, models[1])
    for out in (tox, good):
        rows = out.select("doc_id", "score").collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
        by = {r["doc_id"]: r["score"] for r in rows}
        assert by[5] == by[6] and by[2] == by[3] == by[4]
    kept = toxicity.non_toxic(df, models[0], cut=1.1)
    assert kept.columns == df.columns and kept.count() == 12
    assert toxicity.score(empty(spark), models[0]).collect() == [] and quality.score(empty(spark), models[1]).collect() == []


def test_models_without_labels(spark):
    docs, none = read(spark, SMALL, "documents"), empty(spark, "doc_id bigint, quality int, toxic int")
    assert 0 <= toxicity.score(docs.limit(3), toxicity.fit(docs, none)).first()["score"] <= 1
    assert 0 <= quality.score(docs.limit(3), quality.fit(docs, none)).first()["score"] <= 1


def test_long_texts_score_as_whole(models, monkeypatch):
    scorer = toxicity.Scorer(models[0])
    text = prose(5, 3000)
    whole = scorer.logit(text)
    monkeypatch.setattr(toxicity, "portions", lambda t: portions(t, 501))
    again = toxicity.Scorer(models[0]).logit(text)
    assert again[1] == whole[1] and again[0] == pytest.approx(whole[0], abs=1e-4)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    change = rng.normal(size=(2, 2))
    chains = [rng.normal(size=(n, 2)) for n in (1, 4, 6)]
    marginals, pairs = quality.forward_backward(*quality.padded(chains), change)
    want_pairs = np.zeros((2, 2))
    for d, u in enumerate(chains):
        n, total, at = len(u), 0.0, np.zeros((len(u), 2))
        moves = np.zeros((2, 2))
        for code in range(2 ** n):
            y = [code >> i & 1 for i in range(n)]
            p = np.exp(sum(u[i, y[i]] for i in range(n)) + sum(change[a, b] for a, b in zip(y, y[1:])))
            total += p
            for i in range(n):
                at[i, y[i]] += p
            for a, b in zip(y, y[1:]):
                moves[a, b] += p
        assert marginals[:n, d] == pytest.approx(at / total)
        want_pairs += moves / total
    assert pairs == pytest.approx(want_pairs)


def test_pipeline_on_planted_documents(spark):
    """Every stage's decision shows: toxic documents, near copies and
    benchmark passages go, personal data is masked, the rest is packed."""
    docs = read(spark, SMALL, "documents")
    bench = read(spark, SMALL, "benchmark").first()["text"]
    clean = [prose(700 + i, 150, 3000) for i in range(6)]
    rows = [(10_000 + i, t, "en", "x", len(t)) for i, t in enumerate(clean)]
    rows += [(10_100, clean[0] + " moron", "en", "x", 1), (10_101, clean[1] + " " + bench, "en", "x", 1),
             (10_102, clean[2] + " mail me@some.example.org", "en", "x", 1)]
    out, kept = docs.unionByName(spark.createDataFrame(rows, DOCS)), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, out, SMALL).collect(), DOCS)
        kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
    assert set(range(10_000, 10_006)) <= set(kept["personal_data"])
    assert 10_102 not in kept["near_duplicates"] or 10_002 in kept["near_duplicates"]
    assert 10_101 not in kept["decontamination"]
    assert not any("@some.example.org" in t for t in kept["personal_data"].values())
    assert len(kept["near_duplicates"]) < len(kept["toxicity"]) < docs.count() + 9
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SMALL).collect()
    assert {r["doc_id"] for r in pieces} == set(kept["personal_data"])


def test_pipeline_equals_its_operators(spark):
    run = {tuple(r)[:5] for r in corpus_pipeline.run(spark, SMALL).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()}
    docs = read(spark, SMALL, "documents")
    docs = toxicity.non_toxic(docs, toxicity.fit(docs, read(spark, SMALL, "labels")))
    classes = neardup.classes(docs)
    least = {r["class_id"] for r in classes.collect()}
    hit = {r["doc_id"] for r in queries.op2_decontamination(spark, SMALL).where("contaminated").collect()}
    docs = docs.where(F.col("doc_id").isin(list(least - hit)))
    masked = pii.redact(docs)
    want = {tuple(r)[:5] for r in packing.pack(masked, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()}
    assert run == want


def test_stage_leaves_no_near_copies_around_a_shared_passage(spark):
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in enumerate(small_families())], DOCS)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SMALL).collect()
    left = [neardup.runs(r["text"]) for r in kept]
    keys = [set(neardup.sketches(r).tolist()) for r in left]
    assert 100 < len(left) < 200
    assert not [1 for i, r in enumerate(left) for j in range(i)
                if keys[i] & keys[j] and neardup.similarity(r, left[j]) >= 0.8]


def test_stages_drop_the_planted_documents(spark):
    """A toxic document, no copy of another, goes at the first stage, a near
    copy at the second."""
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    toxic = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id").orderBy("doc_id").collect()
    clean = prose(702, 300, 3000)
    rows = [(10_002, clean, "en", "x", 1), (10_100, " ".join(r["text"] for r in toxic), "en", "x", 1),
            (10_102, clean + " mail me@some.example.org", "en", "x", 1)]
    out, kept, stages = docs.unionByName(spark.createDataFrame(rows, DOCS)), {}, dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "near_duplicates"):
        out = spark.createDataFrame(stages[name](spark, out, SMALL).collect(), DOCS)
        kept[name] = {r["doc_id"] for r in out.collect()}
    assert 10_100 not in kept["toxicity"] and {10_002, 10_102} <= kept["toxicity"]
    assert 10_002 in kept["near_duplicates"] and 10_102 not in kept["near_duplicates"]


def _toxic_rows(spark, n=240):
    """Every fourth row says "venom" once, behind more than 8,000 characters."""
    texts = [prose(900 + i, 40) + (" " + prose(i, 1500) + " venom" if i % 4 == 0 else "") for i in range(n)]
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in enumerate(texts)], DOCS)
    return docs, spark.range(n).selectExpr("id as doc_id", "cast(id % 4 = 0 as int) as toxic")


def test_every_labelled_row_trains(spark, monkeypatch):
    """Texts beyond 8,000 characters and rows beyond 1,500 a class used to be
    left out; the model depends on no partitioning."""
    docs, labels = _toxic_rows(spark)
    assert docs.where("length(text) > 8000").count() == 60
    rows = labelled(docs, labels, "toxic").collect()
    assert sorted(r["id"] for r in rows) == [i for i in range(240) if zlib.crc32(str(i).encode()) % 5]
    seen = []
    real = toxicity.averaged
    monkeypatch.setattr(toxicity, "averaged", lambda state, dealt, *a: seen.append(dealt.count()) or real(state, dealt, *a))
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 200_000)
    one = toxicity.fit(docs, labels, epochs=2)
    tuned = len(rows) - seen[0]
    assert len(seen) == toxicity.ROUNDS and 0 < tuned < len(rows) / 2
    two = toxicity.fit(docs.repartition(7), labels.repartition(3), epochs=2)
    assert np.allclose(one.embedding, two.embedding, atol=1e-5) and np.allclose(one.out, two.out, atol=1e-5)


def test_training_keeps_the_texts_once(spark, monkeypatch):
    """The rounds read the files of one shuffle: nothing is persisted beside
    them, and the texts are made for the sizes and for that shuffle only."""
    docs, labels = _toxic_rows(spark)
    made, kept = spark.sparkContext.accumulator(0), []

    def read_again(t):
        made.add(1)
        return t

    docs = docs.withColumn("text", F.udf(read_again, "string")("text"))
    real = toxicity.averaged
    monkeypatch.setattr(toxicity, "averaged", lambda *a: kept.append(spark.sparkContext._jsc.getPersistentRDDs().size()) or real(*a))
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 200_000)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    toxicity.fit(docs, labels, epochs=2)
    assert kept == [before] * toxicity.ROUNDS and made.value <= 2 * docs.count()


def test_parts_are_crc32_of_each_word(monkeypatch):
    words = ["a", "ab", "abc", "é", "ßßßß", "aaaaaaaa", "𝒳𝒴z", "日本語テキスト", "ananananan", "x" * 50]
    words += list(dict.fromkeys(toxicity.WORD.findall(prose(3, 300).lower())))

    def plain(word):
        marked = f"<{word}>"
        parts = {word + "=", *(marked[i:i + 4] for i in range(max(1, len(marked) - 3)))}
        return sorted(zlib.crc32(p.encode()) % toxicity.BUCKETS for p in parts)

    for n in (20_000, 7):
        monkeypatch.setattr(toxicity, "HASHED_AT_ONCE", n)
        flat, starts = toxicity.parts_of(words)
        assert [sorted(flat[a:b].tolist()) for a, b in zip(starts, starts[1:])] == [plain(w) for w in words]
    assert [len(x) for x in toxicity.parts_of([])] == [0, 1]


def test_sums_of_ragged_rows():
    rng = np.random.default_rng(2)
    table, size = rng.normal(size=(50, 3)).astype(np.float32), np.array([0, 3, 1, 0, 64, 65, 200, 2, 0])
    flat, starts = rng.integers(0, 50, size.sum()), np.concatenate([[0], np.cumsum(size)])
    want = [table[flat[a:b]].sum(0, dtype=np.float64) for a, b in zip(starts, starts[1:])]
    assert np.allclose(toxicity.sums(table, flat, starts), want, atol=1e-6)
    assert toxicity.sums(table, flat[:0], starts[:1]).shape == (0, 3)


def test_scores_together_equal_scores_alone(models, monkeypatch):
    texts = [prose(i, 5 * i) for i in range(40)] + ["", "one", "one two", "x" * 300, "7 8 9"]
    alone = [toxicity.Scorer(models[0]).logit(t) for t in texts]
    for n in (200_000, 400):
        monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", n)
        together = list(toxicity.Scorer(models[0]).logits(texts))
        assert [k for _, k in together] == [k for _, k in alone]
        assert np.allclose([a for a, _ in together], [a for a, _ in alone], atol=1e-5)


def test_training_shards_follow_the_labelled_text(spark, monkeypatch):
    """The join with the labels used to raise their number to Spark's own, so
    that updates grew with it."""
    docs, labels = _toxic_rows(spark)
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 200_000)
    broadcast, seen = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        want = sorted((r["id"], r["t"], r["y"]) for r in labelled(docs, labels, "toxic").collect())
        for n in (2, 3):
            rows = labelled(docs, labels, "toxic", partitions=n)
            assert sorted((r["id"], r["t"], r["y"]) for r in rows.collect()) == want
            seen.append(rows.select("t", "y").rdd.getNumPartitions())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert seen == [2, 3]


def test_updates_add_up_in_any_groups(spark, monkeypatch):
    docs, labels = _toxic_rows(spark)
    monkeypatch.setattr(toxicity, "SHARD_CHARS", 200_000)
    found = []
    for n in (64, 2):
        monkeypatch.setattr(toxicity, "ADDED_AT_ONCE", n)
        found.append(toxicity.fit(docs, labels, epochs=2))
    assert np.allclose(found[0].embedding, found[1].embedding, atol=1e-5) and np.allclose(found[0].out, found[1].out, atol=1e-5)


def test_training_reads_long_texts_in_pieces(monkeypatch):
    texts, y = [prose(i, 30 + 40 * i) for i in range(12)], np.arange(12) % 2.0
    found = []
    for n in (200_000, 50):
        monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", n)
        state = toxicity.started()
        toxicity.descend(state, texts, y, np.ones(12), 2, 0)
        found.append(state)
    assert np.allclose(found[0].model.embedding, found[1].model.embedding, atol=1e-4)
    assert np.allclose(found[0].rest(), found[1].rest(), rtol=1e-2, atol=1e-3)


def test_training_keeps_no_text(spark):
    """A training task numbers its texts as they come and holds none of them."""
    class Text(str):
        """A string that can be watched."""

    class Dealt:
        def mapPartitions(self, task):
            self.task = task
            raise StopIteration

    texts = [prose(i, 60) for i in range(40)]
    seen, most = [], []

    def rows():
        for i, text in enumerate(texts):
            own = Text(text)
            seen.append(weakref.ref(own))
            yield {"t": own, "y": i % 2}
            del own
            most.append(sum(r() is not None for r in seen))

    state, dealt = toxicity.started(), Dealt()
    with pytest.raises(StopIteration):
        toxicity.averaged(state, dealt, (1.0, 2.0), 2, 0)
    parts = [np.frombuffer(part, np.float32) for _, _, part in dealt.task(rows())]
    assert max(most) <= 2 and all(r() is None for r in seen)
    y = np.arange(40) % 2.0
    toxicity.descend(state, texts, y, np.where(y == 1, 2.0, 1.0), 2, 0)
    moved = np.concatenate([p.reshape(toxicity.SLICE, -1) for p in parts[:-1]])[:, :toxicity.DIM]
    assert np.array_equal(moved, state.model.embedding - toxicity.started().model.embedding)


def test_numbered_texts_are_their_words():
    texts = ["", "A b a", "1 2", "b c", ""]
    docs = toxicity.Numbered.of(iter(texts))
    assert [docs[d].tolist() for d in range(len(docs))] == [[], [1, 2, 1], [], [2, 3], []]
    flat, starts = toxicity.parts_of(["a", "b", "c"])
    assert np.array_equal(docs.flat, flat) and docs.starts.tolist() == [0, *starts] and flat.dtype == np.uint16
    assert len(toxicity.Numbered.of([])) == 0


def test_a_finished_task_keeps_no_words():
    """The table of word hashes goes with the task that filled it."""
    class Docs:
        def select(self, *_):
            return self

        def mapInPandas(self, task, _):
            self.task = task
            raise StopIteration

    docs = Docs()
    with pytest.MonkeyPatch.context() as patch, pytest.raises(StopIteration):
        patch.setattr(neardup, "node_of", lambda _: F)
        patch.setattr(neardup, "text_of", lambda _: F)
        patch.setattr(F, "alias", lambda _: None, raising=False)
        neardup.links(docs)
    batch = pd.DataFrame({"node": [b"1", b"2"], "t": ["a b c d e f g", ""]})
    found = list(docs.task(iter([batch])))
    assert [len(k) for k in found[0]["keys"]] == [neardup.SKETCHES, 0] and not neardup._words
