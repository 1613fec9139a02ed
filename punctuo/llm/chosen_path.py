"""N-gram Jaccard join by chosen paths.

A text is the set of its five-word shingles (words lower-cased in A-Z). Texts
with equal sets are one node. Each node keeps ``width`` MinHash values, so two
sets of similarity J agree at a share J of the places. Every one of ``runs``
runs is a recursion: a bucket (at first all nodes) is split on a place drawn
from its path, and on a second one with chance 1/threshold - 1, so that similar
sets keep meeting while the others part. Only the paths' counts decide: a
bucket of at most ``small`` nodes is compared by brute force on the MinHash
values, a larger one is split again, several times in a pass over the nodes that
are left; after ``deepest`` splits it is cut into blocks that share one pivot, and then every pair of the bucket that is not yet in
one class is compared, in pairs of bounded blocks. ``runs`` is chosen from the
wanted recall.

The buckets give candidate classes (components of the pairs that look similar,
with a margin of four standard errors). Inside a class every pair is compared
exactly, on the shingle sets, in pairs of bounded blocks; exact links give the
classes and each text's number of links. So nothing is lost or added inside a
class, and pairs are counted, never listed.

Defined results: null text is an empty text; texts without words form one class
(equal sets); a text of fewer than five words is one shingle; repeated rows get
the same class; a null id stays null and never names a class unless all ids of
the class are null; empty table: no rows; other columns are ignored here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm import near_sets as N
from punctuo.llm.graph import components, joined
from punctuo.llm.prefilter import likely
from punctuo.operators.util import checkpoint_table


def runs_for(recall: float, threshold: float, depth: float = 3.0) -> int:
    """Runs after which a pair at the threshold has met with the given chance, if it meets ``depth`` splits on average."""
    one = 1 - (1 - threshold) * (1 - (1 / threshold - 1) * threshold)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - one**depth)))


def text_key(text_col: str):
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def signatures(rows: DataFrame, width: int, seed: int = 11) -> DataFrame:
    """(key, id, node, places): the hash of the shingle set and its MinHash values of each (key, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = N.multipliers(width, seed)
        for batch in batches:
            nodes, places = [], []
            for t in batch.column("text"):
                s = N.shingles(N.words_of(t.as_py().lower())[2])
                nodes.append(int(N.mix(np.array([N.mix(s).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].astype(np.int64)))
                places.append(N.minhash(s, a, b).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("id"), pa.array(nodes, pa.int64()), pa.array(places, pa.binary())],
                                             names=["key", "id", "node", "places"])

    return rows.select("key", "id", "text").mapInArrow(run, f"key string, id {rows.schema['id'].dataType.simpleString()}, node long, places binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, weight, shingles) of each (node, weight, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [N.shingles(N.words_of(t.as_py().lower())[2]).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("weight"), pa.array(sets, pa.binary())], names=["node", "weight", "shingles"])

    return texts.select("node", "weight", "text").mapInArrow(run, "node long, weight long, shingles binary")


def _splits(rows: DataFrame, width: int, threshold: float, levels: int) -> DataFrame:
    """(path, node, places) -> (level, path, node) of the next ``levels`` splits; places drawn from the path, one or two of them."""
    draw = lambda i: F.pmod(F.xxhash64("path", F.lit(i)), F.lit(width)).cast("int")
    two = F.pmod(F.xxhash64("path", F.lit(-1)), F.lit(1_000_000)) < (1 / threshold - 1) * 1_000_000
    chosen = F.when(two, F.array_distinct(F.array(draw(0), draw(1)))).otherwise(F.array(draw(0)))
    split = F.xxhash64("path", "at", F.col("places").substr(F.col("at") * 4 + 1, F.lit(4)))
    stay, stays = F.array(F.lit(-1)), F.col("at") < 0  # a path of this pass stays beside its children
    r = rows.select(F.lit(0).alias("level"), "path", "node", "places")
    for level in range(1, levels + 1):
        ways = chosen if level == 1 else F.when(F.col("level") == level - 1, F.concat(stay, chosen)).otherwise(stay)
        r = r.select("level", "path", "node", "places", F.explode(ways).alias("at"))
        r = r.select(F.when(stays, F.col("level")).otherwise(level).alias("level"), F.when(stays, F.col("path")).otherwise(split).alias("path"), "node", "places")
    return r.drop("places")


def _alike(leaves: DataFrame, least: float) -> DataFrame:
    """(a, b): links that join the nodes of a bucket that look similar, each to the smallest; leaves: (path, node, places)."""

    def run(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        node = t.column("node").to_numpy()
        p = np.stack([np.frombuffer(x.as_py(), dtype="<u4") for x in t.column("places")])
        alike = np.zeros((len(p), len(p)), dtype=bool)
        for i in range(len(p)):
            alike[i] = (p == p[i]).mean(1) >= least
        np.fill_diagonal(alike, False)
        root = N.roots(alike)
        keep = np.flatnonzero(root != np.arange(len(p)))
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(node[root[keep]])], names=["a", "b"])

    return N.by_group(leaves, ["path"], run, "a long, b long", ["node"])


def _rest(crowds: DataFrame, found: DataFrame, small: int) -> DataFrame:
    """(path, node): groups of about 2 * ``small`` nodes that hold every pair of a crowded bucket that ``found`` does not join.

    Of each bucket, the nodes of its largest component so far need no pairs among
    themselves; all other nodes meet each other and them, in pairs of bounded blocks."""
    at = crowds.join(found, "node", "left").select("path", "node", F.coalesce("root", "node").alias("root"))
    parts = at.groupBy("path", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("path").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("held"), F.sum("n").alias("n")).filter("held < n")
    blocks = lambda n: F.ceil(n / F.lit(small)).cast("int")
    main = main.select("path", "main", blocks(F.col("n") - F.col("held")).alias("others"), blocks(F.col("held")).alias("mains"))
    inside = F.col("root") == F.col("main")
    deal = lambda n: F.pmod(F.xxhash64("node", "path"), n).cast("int")
    cut = at.join(main, "path").select("path", "node", "others", "mains", inside.alias("inside"),
                                       F.when(inside, F.col("others") + deal(F.col("mains"))).otherwise(deal(F.col("others"))).alias("own"))
    last = F.when(F.col("inside"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    met = cut.select("path", "node", "own", F.explode(F.sequence(F.lit(0), last)).alias("other")).filter("own <> other")
    return met.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("path"), "node")


def _buckets(nodes: DataFrame, threshold: float, runs: int, width: int, small: int, rounds: list[int]) -> tuple[DataFrame, DataFrame | None]:
    """(path, node) of the small buckets, and of those that are still large after the last split.

    ``rounds``: the splits made in each pass over the nodes of large buckets. Within a pass small
    buckets are split too; their parts hold only pairs that the bucket itself holds. A small
    bucket is named by the hash of its nodes, so those of equal nodes are one."""
    start = nodes.select("node", "places", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run"))
    rows = start.select(F.xxhash64("run").alias("path"), "node", "places")
    leaves = large = left = None
    for levels in rounds:
        if large is not None:
            left = checkpoint_table(likely(nodes, large, "node")) if left is None else left
            rows = large.join(left, "node").select("path", "node", "places")
        met = checkpoint_table(_splits(rows, width, threshold, levels))
        counts = met.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("level").alias("level"), F.bit_xor(F.xxhash64("node")).alias("name"))
        counts = counts.filter((F.col("n") > 1) & ((F.col("n") <= small) | (F.col("level") == levels))).select("path", "n", "name")
        is_small = F.col("n") <= small
        met = checkpoint_table(met.select("path", "node").join(counts, "path").select(F.when(is_small, F.col("name")).otherwise(F.col("path")).alias("path"), "node", "n"))
        done = met.filter(is_small).select("path", "node")
        leaves = done if leaves is None else leaves.unionByName(done)
        large = met.filter(~is_small)
        if large.isEmpty():
            large = None
            break
    return leaves.distinct(), large


def rounds_of(deepest: int) -> list[int]:
    """1, 2, 3 ... splits a pass: the first leaves few nodes in large buckets, the next passes make more splits of them at once."""
    out: list[int] = []
    while sum(out) < deepest:
        out.append(min(len(out) + 1, deepest - sum(out)))
    return out


def candidate_classes(nodes: DataFrame, threshold: float, runs: int, width: int, small: int, deepest: int) -> DataFrame:
    """(node, root): components of the pairs that met in a bucket and look similar."""
    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / width)
    leaves, large = _buckets(nodes, threshold, runs, width, small, rounds_of(deepest))
    alike = lambda b, of=nodes: _alike(b.join(of, "node").select("path", "node", "places"), least)
    if large is None:
        return components(alike(leaves))
    pivot = large.groupBy("path").agg(F.min("node").alias("pivot"), F.ceil(F.max("n") / small).cast("int").alias("blocks"))
    block = large.join(pivot, "path").filter("node <> pivot").select(F.pmod(F.xxhash64("node", "path"), F.col("blocks")).cast("int").alias("block"), "path", "node")
    every = pivot.select(F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "path", F.col("pivot").alias("node"))
    found = components(alike(leaves.unionByName(block.unionByName(every).select(F.xxhash64("path", "block").alias("path"), "node"))))
    return joined(found, alike(_rest(large.select("path", "node"), found, small), likely(nodes, large, "node")))


def join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text", width: int = 128,
         small: int = 128, deepest: int = 6) -> DataFrame:
    """(key, class_id, n_links, n_copies) of every distinct text; key is the md5 of the text.

    class_id is the smallest id of the class; n_links counts the other distinct
    texts with a similarity of at least ``threshold``; n_copies the rows."""
    keyed = docs.select(text_key(text_col).alias("key"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    signed = signatures(keyed, width).groupBy("key").agg(F.first("node").alias("node"), F.first("places").alias("places"), F.min("id").alias("id"),
                                                    F.count(F.lit(1)).alias("n_copies"))
    signed = checkpoint_table(signed)
    nodes = checkpoint_table(signed.groupBy("node").agg(F.first("places").alias("places"), F.min("key").alias("key"), F.count(F.lit(1)).alias("weight")))
    candidates = candidate_classes(nodes.select("node", "places"), threshold, runs_for(recall, threshold), width, small, deepest)
    asked = checkpoint_table(candidates.select("node").join(nodes.select("node", "key", "weight"), "node"))
    texts = likely(keyed, asked, "key").groupBy("key").agg(F.first("text").alias("text"))  # copies are dropped before the shuffle
    sets = checkpoint_table(shingle_sets(texts.join(asked, "key")))
    links, classes = N.verify(candidates, sets, threshold)
    out = signed.select("key", "node", "id", "n_copies").join(nodes.select("node", "weight"), "node").join(links, "node", "left")
    out = out.join(classes.withColumnRenamed("root", "class"), "node", "left")
    out = checkpoint_table(out.select("key", "id", "n_copies", F.coalesce("class", "node").alias("class"),
                                      (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    first = out.groupBy("class").agg(F.min("id").alias("class_id"), F.min_by("key", F.struct(F.col("id").isNull(), "id", "key")).alias("first_key"))
    return out.join(first, "class").select("key", "class_id", "n_links", "n_copies", "first_key")


def labelled(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_copies."""
    d = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("key"))
    return d.join(classes, "key").select("doc_id", "class_id", "n_links", "n_copies")


def first_of_each(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id (nulls last), all columns as they are."""
    firsts = classes.filter(F.col("key") == F.col("first_key")).select("key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    d = docs.select(text_key(text_col).alias("key"), F.struct(F.col(id_col).isNull(), F.col(id_col)).alias("order"), row.alias("row"))
    kept = d.join(firsts, "key").groupBy("key").agg(F.min_by("row", "order").alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
