"""License scan by an exact set-similarity join of text blocks with templates.

A block is a sentence (it ends at ``. ! ?`` before white space, or at an empty
line); longer ones are read as overlapping windows.  A template is the word set
of one sentence of a notice.  A block has the template's label if it holds at
least ``threshold`` of the template's words.

1. One aggregate counts in how many documents each word of a template occurs:
   the global order, rarest first.
2. Of a template with ``t`` words, ``need = ceil(threshold * t)`` must be met,
   so one of its first ``t - need + 1`` words (its prefix) is in every matching
   block.  Prefix words are indexed; most documents hold none and are done.
3. Blocks with a prefix word are cut down to template words in global order.
   The length filter drops templates that need more words than are left, the
   positional filter those that cannot be met from the two positions on; what
   is left is verified on the sets.  The filters lose nothing.

Documents are read in two narrow passes without a shuffle of text; templates
are a parameter whose size is checked before they are sent to the tasks.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, ship, shipped, text_of, utf8
from .divergence import term_table, words_by_portion

by_value(__name__)

# Phrases whose places are counted, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Sentences of well-known notices, with their labels.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License"),
    ("apache", "You may obtain a copy of the License at http www apache org licenses"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Licensed under the BSD 3-Clause License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("public-domain", "This work has been dedicated to the public domain"),
    ("reserved", "All rights reserved"),
    ("reserved", "No part of this publication may be reproduced without the prior written permission of the publisher"),
]

#: Words in a window of a long block: any half of it lies inside one window.
WINDOW = 64
#: Words of all templates together, at most: what is sent to every task.
MOST_TEMPLATE_WORDS = 2_000_000

WORDS = term_table(range(0x30, 0x3A))  # digits are part of words here
SENTENCE_END = re.compile(rb"[.!?]+[\x09-\x0D\x20]|\n[\x09-\x0D\x20]*\n")


def words_of(data: bytes) -> list[bytes]:
    return [w for words in words_by_portion(data, WORDS) for w in words]


def sentences(data: bytes):
    """The words of every sentence, in order."""
    at = 0
    for end in SENTENCE_END.finditer(data):
        if words := words_of(data[at:end.start()]):
            yield words
        at = end.end()
    if words := words_of(data[at:]):
        yield words


def windows(words: list[bytes], size: int = WINDOW):
    """A sentence as blocks of at most ``size`` words, each starting half of
    that after the one before."""
    yield words[:size]
    for at in range(size // 2, len(words) - size // 2, size // 2):
        yield words[at:at + size]


def order_of(texts: DataFrame, vocabulary: set[bytes]) -> list[bytes]:
    """Template words by the number of documents that hold them, rarest first
    (ties by the word)."""
    sent = ship(texts.sparkSession, vocabulary)

    def task(batches):
        wanted, seen = shipped(sent), Counter()
        for batch in batches:
            for data in batch.column(0):
                found = set()
                for words in words_by_portion(data.as_py(), WORDS):
                    found |= wanted.intersection(words)
                seen.update(found)
        words = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([seen[w] for w in words], pa.int64())], ["word", "n"])

    counted = texts.mapInArrow(task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {bytes(r["word"]): r["n"] for r in counted}  # at most the templates' words
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


class Index:
    """Templates by their prefix words in the global order."""

    def __init__(self, templates: list[tuple[str, frozenset]], order: list[bytes], threshold: float):
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in templates]
        self.sets = [words for _, words in templates]
        self.need = [needed(len(words), threshold) for words in self.sets]
        self.least = min(self.need, default=0)
        self.prefix = defaultdict(list)
        for t, words in enumerate(self.sets):
            for i, w in enumerate(sorted(words, key=self.rank.get)[:len(words) - self.need[t] + 1]):
                self.prefix[w].append((t, i))

    def matches(self, block: list[bytes]) -> list[tuple[int, float]]:
        """(template, share of its words) of every template that is met."""
        held = sorted(self.rank.keys() & set(block), key=self.rank.get)
        if len(held) < self.least:  # length filter for all templates
            return []
        met = Counter()
        for j, w in enumerate(held):
            for t, i in self.prefix.get(w, ()):
                size, need = len(self.sets[t]), self.need[t]
                # length, then what can still follow behind both positions
                if len(held) >= need and met[t] + 1 + min(size - i - 1, len(held) - j - 1) >= need:
                    met[t] += 1
        held = set(held)
        shared = [(t, len(self.sets[t] & held)) for t, n in met.items() if n]
        return [(t, n / len(self.sets[t])) for t, n in shared if n >= self.need[t]]


def needed(size: int, threshold: float) -> int:
    """Words that must be shared; the threshold counts in ten-thousandths, so
    that no rounding of the product decides."""
    return max(1, -(-size * round(threshold * 10_000) // 10_000))


def _scan(sent, phrases: dict[str, str]):
    """Per text: words, places of the phrases, labels, best share."""
    wanted = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]

    def one(data: bytes, index: Index):
        words, places, base, labels, best = words_of(data), [], set(), set(), 0.0
        line = b" " + b" ".join(words) + b" "
        for phrase, label in wanted:
            at = line.find(phrase)
            while at >= 0:
                places.append(line.count(b" ", 0, at))
                base.add(label)
                at = line.find(phrase, at + 1)
        if not index.prefix.keys().isdisjoint(words):
            for sentence in sentences(data):
                if not index.prefix.keys().isdisjoint(sentence):
                    for block in windows(sentence):
                        for t, share in index.matches(block):
                            labels.add(index.labels[t])
                            best = max(best, share)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best)

    def task(batches):
        index = shipped(sent)
        for batch in batches:
            found = [one(data.as_py(), index) for data in batch.column(1)]
            columns = zip(*found) if found else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()))]],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return task


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_words, n_base`` (places of the
    phrases), ``first_word, last_word`` (the least and greatest start),
    ``base_labels``, ``labels`` (also those of templates met by a block) and
    ``score`` (1 with a base label, else the greatest share of a met template,
    else 0).

    Defined cases: a null text counts as empty (no words, empty labels, score
    0); without places first and last are null; repeated documents get a row
    each; ids are returned as they are, of any type; templates without words
    are ignored, equal ones count once; an empty table gives no rows; other
    columns are ignored.  More than MOST_TEMPLATE_WORDS template words raise
    an error: scan in several calls then.
    """
    sets = sorted({(label, frozenset(words_of(t.encode()))) for label, t in templates}, key=lambda x: (x[0], sorted(x[1])))
    sets = [(label, words) for label, words in sets if words]
    if sum(len(words) for _, words in sets) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"more than {MOST_TEMPLATE_WORDS} template words: scan in several calls")
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), utf8(text_of(text_col)).alias("data"))
    order = order_of(texts.select("data"), set().union(*(words for _, words in sets)))
    sent = ship(docs.sparkSession, Index(sets, order, threshold))
    phrases = {" ".join(w.decode() for w in words_of(p.encode())): label for p, label in phrases.items()}
    out = texts.mapInArrow(_scan(sent, phrases), f"id {id_type}, n_words long, n_base long, first_word long, last_word long, "
                           "base_labels string, labels string, score double")
    return out.withColumnRenamed("id", id_col)
