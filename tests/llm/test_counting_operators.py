"""Source divergence, collocations and license scans against brute force."""

import itertools
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import DOCS, empty, messy, prose
from tabprep.llm import collocations, divergence, licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def varied(spark, seed=1, n=300):
    """Texts of few words in three languages; a source holds a third."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["big", "big", "b", "c", "é", None])
        rows.append((i, prose(i % 40, rng.randrange(60), 40).upper() if i % 7 else prose(i, 200, 3000), lang, source, 1))
    rows += [(n + 1, "!!!", "en", "without terms", 0), (n + 2, "alone here", "xx", "s", 0), (n + 3, None, "xx", "t", 0)]
    return messy(spark).select("doc_id", "text", "lang", "source", "n_chars").unionAll(spark.createDataFrame(rows, DOCS)).repartition(5)


# ------------------------------------------------------------- 11 divergence

def audit_by_force(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        words = term.findall((r["text"] or "").translate(LOWER))
        counts[r["lang"] or "", r["source"] or ""].update(words)
        docs[r["lang"] or ""].update(set(words))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = {w for w, n in docs[lang].items() if n >= least}
        groups = {s: Counter({w: n for w, n in c.items() if w in kept}) for (x, s), c in counts.items() if x == lang}
        every = sum(groups.values(), Counter())
        share = lambda c, w: 1 + 10 ** 9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in groups.items():
            pair = [(-sum(abs(share(c, w) - share(d, w)) for w in kept), t.encode(), t) for t, d in groups.items() if t != s]
            out |= {(lang, s, "pair", t, -v, k) for k, (v, _, t) in enumerate(sorted(pair), 1)}
            over = sorted((share(every, w) - share(c, w), w.encode(), w) for w in kept if c[w] and share(c, w) > share(every, w))
            out |= {(lang, s, "term", w, -v, k) for k, (v, _, w) in enumerate(over[:top], 1)}
    return out


@pytest.mark.parametrize("block, tile, entries", [(16_384, 32, 200_000), (3, 2, 50)])
def test_audit_equals_brute_force(spark, monkeypatch, block, tile, entries):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    docs = varied(spark)
    got = [tuple(r) for r in divergence.audit(docs, least_docs=8, top_terms=6).collect()]
    want = audit_by_force(docs.collect(), 8, 6)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[2] == "term" for r in got) and any(r[1] == "without terms" for r in got)


def test_audit_of_messy_and_empty_tables(spark):
    docs = messy(spark)
    got = [tuple(r) for r in divergence.audit(docs, least_docs=2).collect()]
    assert len(got) == len(set(got)) and set(got) == audit_by_force(docs.collect(), 2, 50)
    none = [r for r in divergence.audit(docs, least_docs=1000).collect()]
    assert none and all(r["part"] == "pair" and r["value"] == 0 for r in none)
    assert divergence.audit(empty(spark)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10 ** 14), min_size=1, max_size=5), st.integers(0, 10 ** 16), st.integers(1, 10 ** 6))
def test_shares_are_exact(counts, more, v):
    total = sum(counts) + more
    assert divergence.shares(np.array(counts), total, v).tolist() == [1 + 10 ** 9 * (c + 5) // (total + 5 * v) for c in counts]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.integers(1, 9)), st.dictionaries(st.integers(0, 30), st.integers(1, 9)),
       st.integers(0, 9), st.integers(0, 9))
def test_distance_prices_both_one_and_neither(a, b, a0, b0):
    side = lambda d, absent: (np.array(sorted(d), np.int64), np.array([d[k] for k in sorted(d)], np.int64), absent)
    want = sum(abs(a.get(k, a0) - b.get(k, b0)) for k in range(31))
    for x, y in itertools.permutations([side(a, a0), side(b, b0)]):
        assert divergence.distance(x, y) + 31 * abs(a0 - b0) == want


def test_long_texts_are_counted_by_portions():
    data = prose(5, 3000).encode() + b"x" * 5000 + b" end"
    whole = data.translate(divergence.TERMS).split()
    assert [w for p in divergence.words_by_portion(data, divergence.TERMS, 100) for w in p] == whole


# ----------------------------------------------------------- 12 collocations

def collocations_by_force(rows, least, top, longest=3):
    f, n, out = defaultdict(Counter), Counter(), set()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r["text"] or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        known = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in known.items():
            for k in range(2, len(p)):
                gone |= {p[i:i + k] for i in range(len(p) - k + 1) if 100 * a >= 50 * c[p[i:i + k]]}
        found = []
        for p, a in known.items():
            if p not in gone:
                score, cut = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        out |= {(lang, k, p.decode(), -a, x, y, n[lang], -s) for k, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)}
    return out


@pytest.mark.parametrize("every, longest, entries, most", [(24, 4096, 400_000, 1 << 27), (2, 3, 40, 1 << 10), (10 ** 9, 5, 100, 1 << 12)])
def test_collocations_equal_brute_force(spark, monkeypatch, every, longest, entries, most):
    """Also with a filter too small for the phrases."""
    for name, value in (("EVERY", every), ("LONGEST", longest), ("ENTRIES", entries), ("WORDS", entries), ("FILTER_MOST", most),
                        ("SHORT", min(every, 24))):
        monkeypatch.setattr(collocations, name, value)
    docs = varied(spark, 2, 200)
    rows = docs.collect()
    got = [tuple(r) for r in collocations.collocations(docs, least=5, top=30).collect()]
    assert len(got) == len(set(got)) and set(got) == collocations_by_force(rows, 5, 30)
    got = [tuple(r) for r in collocations.collocations(docs, max_words=5, least=4, top=500).collect()]
    assert len(got) == len(set(got)) and set(got) == collocations_by_force(rows, 4, 500, 5)


def test_collocations_of_messy_and_empty_tables(spark):
    docs = messy(spark, ["a\tb  c, a b\vc", "a b c"] * 9)
    got = [tuple(r) for r in collocations.collocations(docs, least=3).collect()]
    assert len(got) == len(set(got)) and set(got) == collocations_by_force(docs.collect(), 3, 2000)
    assert collocations.collocations(empty(spark)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=1, max_size=60), st.integers(1, 4), st.integers(1, 3))
def test_chunks_hold_every_phrase_once(words, overlap, times):
    short, collocations.SHORT, collocations.EVERY = collocations.SHORT, 3, 3
    try:
        found = collocations.chunks(words, overlap, {})
    finally:
        collocations.SHORT, collocations.EVERY = short, 24
    for k in range(1, overlap + 2):
        got, sums, total = collocations.counted("en", *map(list, zip(*found)), [times] * len(found), (k,), overlap, None)
        want = Counter(b" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
        assert dict(zip(got, sums.tolist())) == {g: times * n for g, n in want.items()} and total == times * len(words)


def test_counting_calls_nothing_per_chunk(monkeypatch):
    """Calls follow the vocabulary and the batches, not the chunks; long words
    count for more of them, so what is held at once is bounded in bytes too."""
    def batch(chunks):
        n = len(chunks)
        return pa.RecordBatch.from_arrays([pa.array(["en"] * n), pa.array(chunks, pa.binary()), pa.array([False] * n), pa.array([2] * n)],
                                          ["lang", "chunk", "closed", "f"])

    def calls(n):
        made, rng = Counter(), random.Random(n)
        some = batch([b" ".join(b"w%d" % rng.randrange(30) for _ in range(rng.randrange(1, 9))) for _ in range(n)])
        task = collocations._counts((1, 2), 2, None)
        sys.setprofile(lambda frame, event, arg: made.update([event]))
        try:
            for _ in task(iter([some])):
                pass
        finally:
            sys.setprofile(None)
        return made["call"] + made["c_call"]

    calls(100)  # what is set up with the first call
    assert calls(4000) < 2 * calls(1000)
    long = [b"%d" % i * 4000 + b" " + b"%d" % i * 3000 for i in range(30)]
    monkeypatch.setattr(collocations, "WORDS", 100_000)
    got = list(collocations._counts((1, 2), 2, None)(iter([batch(long * 100)])))
    assert sum(b.num_rows for b in got) > 2 * 91
    f = Counter()
    for b in got:
        for p, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            f[p] += n
    assert f == Counter({b"": 12_000}) + Counter({x: 200 for c in long for x in (c, *c.split())})


def test_filter_holds_all_it_was_given(spark):
    rng = random.Random(5)
    phrases = [("en" if i % 2 else "de", b"w%d w%d" % (rng.randrange(900), rng.randrange(900))) for i in range(3000)]
    df = spark.createDataFrame([(a, bytearray(b)) for a, b in phrases], "lang string, phrase binary").repartition(4)
    bits = collocations.filter_of(df, 2)
    found = lambda lang, w: collocations.inside(bits, collocations.hashes(lang, collocations._word_hashes(w), 2)).all()
    assert all(found(a, b.split(b" ")) for a, b in phrases)
    assert sum(found("en", [b"x%d" % i, b"y"]) for i in range(2000)) < 200


def test_repeated_passages_share_their_chunks():
    rng = random.Random(3)
    passage = [b"w%d" % rng.randrange(500) for _ in range(400)]
    parse = lambda lead: [c for c, _ in collocations.chunks([b"x%d" % i for i in range(lead)] + passage, 2, {})]
    assert len(set(parse(3)) & set(parse(50))) > 8


# --------------------------------------------------------------- 13 licenses

def scan_by_force(text, threshold=0.8):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall(t.translate(LOWER))
    w = words(text or "")
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    base, labels, best = {x for _, x in places}, set(), 0.0
    for sentence in re.split(r"[.!?]+[\x09-\x0D\x20]|\n[\x09-\x0D\x20]*\n", text or ""):
        v = words(sentence)
        for at in [0, *range(32, len(v) - 32, 32)]:
            block = set(v[at:at + 64])
            for label, template in licenses.TEMPLATES:
                t = set(words(template))
                if 10 * len(t & block) >= 8 * len(t):
                    labels.add(label)
                    best = max(best, len(t & block) / len(t))
    return (len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best)


def noticed():
    """Texts around whole, cut, shuffled and wrapped notices."""
    rng, out = random.Random(7), []
    for i in range(150):
        notice = rng.choice(licenses.TEMPLATES)[1].split(" ")
        for _ in range(rng.randrange(4)):
            notice.pop(rng.randrange(len(notice))) if len(notice) > 1 else None
        if i % 3 == 0:
            rng.shuffle(notice)
        out.append(prose(i, rng.randrange(90)) + rng.choice([" ", ". ", "\n\n", "\n"]) + rng.choice([" ", "\n", "-"]).join(notice)
                   + rng.choice([". ", " ", "!\n"]) + prose(i, rng.randrange(90)))
    return [*out, "CC BY cc by-nc", "all rights  reserved. All\nrights reserved", "the license under mit released " * 40, "cc. By"]


def test_scan_equals_brute_force(spark):
    docs = messy(spark, noticed()).repartition(5)
    out = licenses.scan(docs).collect()
    got = sorted((str(r["doc_id"]), *(str(x) for x in r[1:])) for r in out)
    want = sorted((str(r["doc_id"]), *(str(x) for x in scan_by_force(r["text"]))) for r in docs.collect())
    assert got == want
    assert sum(bool(r["labels"]) for r in out) > 40 and any(r["labels"] and not r["base_labels"] for r in out)


def test_scan_of_any_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("x", "Released under the MIT License."), (None, None)], "doc_id string, text string")
    assert [(r["doc_id"], r["labels"], r["score"]) for r in licenses.scan(docs).collect()] == [("x", "mit", 1.0), (None, "", 0.0)]
    assert licenses.scan(empty(spark)).collect() == []
    assert {r["labels"] for r in licenses.scan(docs, templates=[("none", "--")], phrases={}).collect()} == {""}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.sampled_from([b"a", b"b", b"c", b"d", b"e", b"f", b"g"]), min_size=1), min_size=1, max_size=6),
       st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"other"]), max_size=12), st.sampled_from([0.5, 0.8, 1.0]))
def test_filters_lose_no_template(sets, block, threshold):
    templates = [(str(i), frozenset(s)) for i, s in enumerate(sets)]
    order = sorted(set().union(*sets), reverse=True)
    got = sorted(licenses.Index(templates, order, threshold).matches(block))
    want = [(i, len(s & set(block)) / len(s)) for i, s in enumerate(sets) if len(s & set(block)) >= threshold * len(s)]
    assert got == want
