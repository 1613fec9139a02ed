"""Matches between texts, checked once more and extended word by word.

A match says that ``words`` words of a text from ``place`` on equal as many of
another (or the same) text from ``first_place`` on. ``extended`` compares a
second hash of these words, then the words before and after them on both sides,
in rounds that look eight times further each, until every match ends at a
differing word, at an end of a text or at its given room. A text is read once a
round, with all its places together; texts without an open match are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm import near_sets as N
from punctuo.llm.prefilter import likely
from punctuo.llm.spread import join_hot
from punctuo.operators.util import checkpoint_table

SPOT = ["doc", "place", "words"]
FIRST = ["first_doc", "first_place", "words"]
CONTEXT = "doc long, place int, words int, proof long, left array<long>, right array<long>, begins array<int>, ends array<int>"


def contexts(texts: DataFrame, spots: DataFrame, skip: int, width: int, batch: int = 2048) -> DataFrame:
    """Of every spot (doc, place, words), from ``skip`` words away on: hashes of up to ``width`` words before it (nearest
    first) with their begins, and after it with their ends (bytes from the spot's begin and end); proof: a second hash of its own words."""
    at = spots.groupBy("doc").agg(F.collect_list(F.struct("place", "words")).alias("spots"))  # bounded by the text's length
    one = likely(texts, at, "doc").groupBy("doc").agg(F.first("text").alias("text"))

    def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts), kind))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        doc, place, words, proof, *parts = zip(*rows, strict=True)
        cols = [pa.array(doc, pa.int64()), pa.array(place, pa.int32()), pa.array(words, pa.int32()), pa.array(proof, pa.int64())]
        return pa.RecordBatch.from_arrays([*cols, *(lists(p, k) for p, k in zip(parts, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True))], names=[*SPOT, "proof", "left", "right", "begins", "ends"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, cells = [], 0
        for b in batches:
            for doc, text, here in zip(b.column("doc").to_pylist(), b.column("text"), b.column("spots").to_pylist(), strict=True):
                starts, ends, h = N.words_of(text.as_py().lower())
                again, h = N.mix(h ^ np.uint64(0xA0761D6478BD642F)), h.view(np.int64)
                odd = np.arange(max((s["words"] for s in here), default=0), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                for s in here:
                    lo, hi = s["place"], s["place"] + s["words"]
                    a, z = max(0, lo - skip), min(len(h), hi + skip)
                    before, after = slice(max(0, a - width), a), slice(z, z + width)
                    proof = int(N.mix(again[lo:hi] * odd[:hi - lo]).sum(dtype=np.uint64).view(np.int64))
                    rows.append((doc, lo, s["words"], proof, h[before][::-1], h[after], starts[lo] - starts[before][::-1], ends[after] - ends[hi - 1]))
                    cells += 4 * width
                    if cells >= batch * 64:
                        yield batch_of(rows)
                        rows, cells = [], 0
        if rows:
            yield batch_of(rows)

    return one.join(at, "doc").mapInArrow(run, CONTEXT)


def same(own: str, other: str):
    """How many leading items of array ``own`` are those of array ``other``."""
    differs = F.array_position(F.zip_with(own, F.slice(F.col(other), 1, F.size(own)), lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(own)).cast("int")


def extended(matches: DataFrame, texts: DataFrame, width: int = 16) -> DataFrame:
    """``matches`` (doc, place, words, begin, end (bytes), first_doc, first_place, room_before, room_after (words)) that hold,
    with low, high (words, high exclusive), begin and end of the extended match. ``texts``: doc, text (bytes).

    A match of a (doc, place) may occur once; room is what the match may grow by on its side (null: to the text's end)."""
    todo = matches.select(*SPOT, "first_doc", "first_place", F.coalesce("room_before", F.lit(2**31 - 1)).alias("before"),
                          F.coalesce("room_after", F.lit(2**31 - 1)).alias("after"))
    skip, rounds = 0, []
    while not todo.isEmpty():
        spots = todo.select(*SPOT).unionByName(todo.select(F.col("first_doc").alias("doc"), F.col("first_place").alias("place"), "words")).distinct()
        ctx = checkpoint_table(contexts(texts, spots, skip, width))
        other = ctx.select(F.col("doc").alias("first_doc"), F.col("place").alias("first_place"), "words", F.col("proof").alias("first_proof"),
                           F.col("left").alias("first_left"), F.col("right").alias("first_right"))
        mine = todo.join(ctx, SPOT)
        for side, room in (("left", "before"), ("right", "after")):
            mine = mine.withColumn(side, F.slice(F.col(side), 1, F.greatest(F.least(F.col(room) - skip, F.lit(width)), F.lit(0))))
        met = join_hot(mine, other, FIRST, ["doc", "place"]).filter(F.col("proof") == F.col("first_proof"))
        met = met.select(*SPOT, "first_doc", "first_place", "before", "after", "begins", "ends", same("left", "first_left").alias("n_left"),
                         same("right", "first_right").alias("n_right"))
        met = checkpoint_table(met.select("*", F.get("begins", F.col("n_left") - 1).alias("begin_"), F.get("ends", F.col("n_right") - 1).alias("end_")).drop("begins", "ends"))
        rounds.append(met.select("doc", "place", "n_left", "n_right", "begin_", "end_"))
        # a side that ended gets no room in the next round
        todo = met.filter(F.greatest("n_left", "n_right") == width).select(
            *SPOT, "first_doc", "first_place", *[F.when(F.col(n) == width, F.col(room)).otherwise(F.lit(0)).alias(room)
                                                 for n, room in (("n_left", "before"), ("n_right", "after"))])
        skip, width = skip + width, min(8 * width, 1 << 13)
    if not rounds:
        return matches.select("*", F.col("place").alias("low"), (F.col("place") + F.col("words")).alias("high"))
    grown = rounds[0]
    for r in rounds[1:]:
        grown = grown.unionAll(r)
    grown = grown.groupBy("doc", "place").agg(F.sum("n_left").cast("int").alias("n_left"), F.sum("n_right").cast("int").alias("n_right"),
                                              F.max("begin_").alias("begin_"), F.max("end_").alias("end_"))
    out = matches.join(grown, ["doc", "place"])
    return out.withColumns({"low": F.col("place") - F.col("n_left"), "high": F.col("place") + F.col("words") + F.col("n_right"),
                            "begin": F.col("begin") - F.coalesce("begin_", F.lit(0)), "end": F.col("end") + F.coalesce("end_", F.lit(0))}).drop("n_left", "n_right", "begin_", "end_")
