"""Near-duplicates by order MinHash.

A text is the sequence of its ``K``-word runs, each labelled with its
occurrence number.  One sketch takes the ``PICK`` runs with the least hashes
and keeps them in text order; texts that agree on one of ``SKETCHES``
sketches are candidates.  Unlike plain MinHash this notices reordered text:
the least hashes and their order must agree.  Candidates are verified by a
banded alignment of the two sequences: the longest common subsequence inside
the band that the asked similarity leaves, over the runs of both.

How work follows the input:

* equal texts are one node, told by a 128-bit digest;
* a group of texts with a common sketch is not paired up: each is first
  compared with the group's two centres, the texts whose sketches most others
  share (the original of a family of edited copies, or the least edited ones).
  Where that leaves a group in more than one class, its texts are joined on
  their rarest runs.  Two texts that are alike enough share one of these, at
  a place that leaves room for the runs they must have in common, so no pair
  of a group is passed over unless it cannot be alike or is in one class
  already.  Texts with common rare runs that are not alike are all compared,
  however many they are.
  Classes are the connected parts of
  the verified links, found by star contraction;
* every other step groups with partial aggregates or joins that Spark can split.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, release, ship, shipped, text_of, top_bits, trim, utf8, written

by_value(__name__)

K, SKETCHES, PICK, SIMILAR = 5, 16, 3, 0.8
WORD = re.compile(r"\w+")
CACHED_WORDS = 500_000
CELL_BITS = 20  # counters of runs; they only order runs, no result depends on them

_words: dict[str, int] = {}  # hashes of words, one table per worker process


def forget_words() -> None:
    """At the end of a task: the steps that follow are joins, beside which its
    idle worker would keep the table."""
    _words.clear()
    trim()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def runs(text: str, k: int = K) -> np.ndarray:
    """Hashes of the labelled k-word runs of a text in order, all different; a
    shorter text is one run."""
    if len(_words) > CACHED_WORDS:
        _words.clear()
    words = WORD.findall(text.lower())
    for w in words:
        if w not in _words:
            _words[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
    h = np.array([_words[w] for w in words], np.uint64)
    n = len(h)
    size = min(k, n)
    if not n:
        return h
    r = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        r = _mixed(r + h[j:n - size + 1 + j])
    order = np.argsort(r, kind="stable")
    first = np.concatenate([[True], r[order][1:] != r[order][:-1]])
    place = np.arange(len(r))
    occurrence = np.empty(len(r), np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return _mixed(r + _mixed(occurrence + np.uint64(1)))


def sketches(r: np.ndarray, count: int = SKETCHES, pick: int = PICK) -> np.ndarray:
    """One number per sketch: its least runs, in text order."""
    pick = min(pick, len(r))
    seeds = _mixed(np.arange(1, count + 1, dtype=np.uint64))
    hashed = _mixed(r[None, :] ^ seeds[:, None])
    least = np.sort(np.argpartition(hashed, pick - 1, axis=1)[:, :pick], axis=1)
    key = seeds.copy()
    for j in range(pick):
        key = _mixed(key + r[least[:, j]])
    return key


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """Aligned share of two run sequences, common / (either), where the
    alignment stays in the band that ``least`` allows; 0 if it cannot reach it."""
    n = len(a) + len(b)
    band = int(n * (1 - least) / (1 + least) + 1e-9)  # runs that may stay unaligned
    if not len(a) or not len(b) or abs(len(a) - len(b)) > band:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    inside = np.abs(i - j) <= band
    if 2 * inside.sum() < n - band:
        return 0.0
    # runs are unique, so the common subsequence is the longest rising one
    tails: list[int] = []
    for x in j[inside][np.argsort(i[inside])].tolist():
        if not tails or x > tails[-1]:
            tails.append(x)
        else:
            tails[bisect_left(tails, x)] = x
    return len(tails) / (n - len(tails))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the least node of the connected part) for the nodes of
    ``edges`` (columns ``a``, ``b``): large-star and small-star rounds."""
    pair = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    state, now = None, written(pair, "parts")
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(found)
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        now = written(small, "parts")
        release(edges.sparkSession)


def rarest(cells: Broadcast, least: float):
    """(node, root, runs) -> a row per run that two texts alike enough must
    have one of in common: the first ones in a fixed order, rare ones first,
    with their place in that order and the text's number of runs ``n``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shipped(cells)
        for batch in batches:
            heads, places, sizes = [], [], []
            for r in batch["runs"]:
                r = np.asarray(r, np.int64)
                often = counts[(r.view(np.uint64) >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                head = np.lexsort((r, often))[:len(r) - int(np.ceil(least * len(r) - 1e-6)) + 1]
                place = np.flatnonzero(often[head] > 1)  # a run of one text is shared by none
                heads.append(r[head[place]])
                places.append(place)
                sizes.append(len(place))
            if not sum(sizes):
                continue
            yield pd.DataFrame({"node": np.repeat(batch["node"].to_numpy(), sizes),
                                "root": np.repeat(batch["root"].to_numpy(), sizes),
                                "n": np.repeat(batch["runs"].map(len).to_numpy(np.int32), sizes),
                                "place": np.concatenate(places).astype(np.int32), "run": np.concatenate(heads)})

    return run


def uncompared(grouped: DataFrame, found: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs ``a, b`` of texts of different classes (by the links ``found``)
    that may be alike, among the texts whose sketch groups (``key, node``) hold
    more than one class.  None that is alike is left out."""

    def run_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "root": batch["root"],
                                "runs": [runs(t).astype(np.int64) for t in batch["t"]]})
        batch = None
        forget_words()

    of_class = written(grouped.select("key", "node").join(components(found).hint("merge"), "node", "left")
                       .select("key", "node", F.coalesce("root", "node").alias("root")), "classed-groups")
    split = of_class.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    nodes = written(of_class.join(split.select("key").hint("merge"), "key", "left_semi").select("node", "root").distinct(),
                    "split-nodes")
    listed = written(texts.join(nodes.hint("merge"), "node").mapInPandas(run_lists, "node binary, root binary, runs array<long>"),
                     "split-runs")
    counted = (listed.select(F.explode("runs").alias("run")).groupBy(top_bits(F.col("run"), CELL_BITS).alias("cell"))
               .agg(F.count(F.lit(1)).alias("n")).toArrow())
    cells = np.zeros(1 << CELL_BITS, np.int64)
    cells[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    heads = written(listed.mapInPandas(rarest(ship(grouped.sparkSession, cells), least),
                                       "node binary, root binary, n int, place int, run long"), "rarest-runs")
    x, y = (heads.select("run", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "n", "place")]) for side in "ab")
    # the first common run of two texts alike enough leaves both this room
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    may = (F.col("node_a") > F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & (
        room * (1 + least) >= (F.col("n_a") + F.col("n_b")) * least - 1e-6)
    return written(x.join(y.hint("merge"), "run").where(may)
                   .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "uncompared")


def node_of(text_col: str):
    """The node of a text: its 128-bit digest."""
    return F.unhex(F.md5(utf8(text_of(text_col))))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """Verified links ``a, b`` between different texts (nodes)."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["t"]:
                r = runs(text)
                found.append(sketches(r).astype(np.int64).tolist() if len(r) else [])
            yield pd.DataFrame({"node": batch["node"], "keys": found})
        batch = found = None
        forget_words()

    texts = docs.select(node_of(text_col).alias("node"), text_of(text_col).alias("t"))
    keys = written(texts.mapInPandas(sketch, "node binary, keys array<long>"), "sketches")
    rows = keys.dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    rows = written(rows, "sketch-rows")
    # written, so that the joins below are planned (and split, where a sketch
    # is hot) for themselves and not upon the exchange of the aggregate
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-sketches")
    grouped = written(rows.join(shared, "key"), "sketch-groups")
    support = grouped.groupBy("node").agg(F.sum("n").alias("support"))
    supported = written(grouped.join(support, "node").select("key", "support", "node"), "supported")
    best = F.max(F.struct("support", "node")).alias("best")
    first = written(supported.groupBy("key").agg(best).select("key", F.col("best.node").alias("first")), "centres")
    second = written(supported.join(first, "key").where("node <> first").groupBy("key").agg(best)
                     .select("key", F.col("best.node").alias("second")), "second-centres")
    pairs = written(grouped.join(first.join(second, "key"), "key")
                    .select("node", F.explode(F.array("first", "second")).alias("centre")).where("node <> centre")
                    .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct(),
                    "candidates")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    # a merge join at every size: what it costs follows the texts alone
    needed = written(texts.join(ends.hint("merge"), "node", "left_semi").dropDuplicates(["node"]), "candidate-texts")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}  # of the last texts; centres come often
        for batch in batches:
            near = []
            for node_a, node_b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                if len(known) > 100:
                    known.clear()
                for node, text in ((node_a, ta), (node_b, tb)):
                    if node not in known:
                        known[node] = runs(text)
                near.append(similarity(known[node_a], known[node_b], least) >= least)
            yield batch.loc[near, ["a", "b"]]
        known.clear()
        batch = None
        forget_words()

    def verified(pairs: DataFrame) -> DataFrame:
        sides = (pairs.join(needed.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
                 .join(needed.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b"))
        return written(sides.select("a", "b", "ta", "tb").mapInPandas(verify, "a binary, b binary"), "links")

    found = verified(pairs)
    release(docs.sparkSession)  # many small plans: what finished ones left in the driver goes
    return found.unionAll(verified(uncompared(grouped, found, needed, least)))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """One row per document: ``id_col, class_id`` (the least id of its class),
    ``n_links`` (verified links of its text to group centres and to texts of
    other classes; not all texts that are like it), ``node`` and ``root``
    (digests of its text and of its class).

    Defined cases: null texts count as empty; texts without words are like
    equal texts only; a null id gets its class's least other id, or null;
    repeated rows get a row each; an empty table gives no rows; other columns
    are ignored.
    """
    found = links(docs, id_col, text_col, least)
    part = components(found)
    degree = (found.select(F.col("a").alias("node")).unionAll(found.select("b"))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    members = written(docs.select(F.col(id_col).alias("id"), node_of(text_col).alias("node")), "members")
    nodes = (members.groupBy("node").agg(F.min("id").alias("least_id"))
             .join(part, "node", "left").join(degree, "node", "left")
             .select("node", "least_id", F.coalesce("root", "node").alias("root"),
                     F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    nodes = written(nodes, "nodes")
    ids = nodes.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return (members.join(nodes.join(ids, "root"), "node")
            .select(F.col("id").alias(id_col), "class_id", "n_links", "node", "root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILAR) -> DataFrame:
    """``docs`` with one document per class: the one with the least id (any
    one row if that id is repeated or all ids of the class are null).  All
    columns are kept."""
    found = written(classes(docs, id_col, text_col, least), "classes")
    gone = found.where(~F.col(id_col).eqNullSafe(F.col("class_id")))
    # ids that name several kept rows: one row of each class stays
    again = (found.where(F.col(id_col).eqNullSafe(F.col("class_id")))
             .groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.first("node").alias("node"), F.first(id_col).alias("id"))
             .where("n > 1").select("root", "id", "node"))
    again = written(again, "repeated")
    d = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), node_of(text_col).alias("node"),
                    docs[f"`{id_col}`"].alias("id"))
    out = gone.select(F.col(id_col).alias("id"), "node").distinct()
    same = (d["id"].eqNullSafe(out["id"])) & (d["node"] == out["node"])
    kept = d.join(out.hint("merge"), same, "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    doubled = (found.join(again.select("root"), "root", "left_semi")
               .select("node", "root").distinct())
    marked = kept.join(doubled, "node", "left")
    one = marked.where("root IS NOT NULL").groupBy("root").agg(F.first("row").alias("row")).select("row")
    return marked.where("root IS NULL").select("row").unionAll(one).select("row.*")
