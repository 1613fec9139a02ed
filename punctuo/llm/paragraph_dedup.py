"""Substring dedup by paragraphs: MinHash banding, exact verification, components.

A paragraph is a line of at least ``least_words`` words. Its five-word shingles
give MinHash values in bands; ``tune_bands`` picks the longest bands whose
chance to collide at the threshold reaches the wanted recall. Paragraphs that
share a band are joined through the smallest one of the band (the graph has the
same components as all pairs), and inside the components so found every pair is
compared exactly, in pairs of bounded blocks (see ``near_sets.verify``).

A passage can also stand inside longer lines. So the words are cut a second time,
at line starts and where a hash of two neighbours is the smallest of its
surroundings, so at places that only nearby words decide; equal pieces are copies
of one another, wherever the lines begin. Adjacent pieces that repeat adjacent
pieces of one other text are one match; it is extended word by
word to both sides if the words beside it may be equal, and a second hash confirms it
(``extension``; a match of several pieces that cannot grow is proved by their keys). Matches that overlap or touch count if
they have ``least_words`` words together.

In every class of paragraphs or pieces the first occurrence stays (smallest id,
null ids last, then place in the text); the others are removed. Documents,
paragraphs and pieces are named by 64-bit hashes, the last two with their number of words.
A passage is found by a piece that lies wholly in it: in random words 0.2 % of the
passages of 51 words have none, 5 % of those of 40 words.
Lines of ``least_line`` words that repeat exactly go too, if that is below ``least_words``.

Defined results: null and empty texts have no paragraph; rows repeated with the
same id and text are one document and get the same result; the same paragraph
twice in one document: the first stays; empty table: no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuo.llm import near_sets as N
from punctuo.llm.extension import extended
from punctuo.llm.graph import components
from punctuo.llm.prefilter import likely
from punctuo.llm.spread import join_hot
from punctuo.operators.util import checkpoint_table

LINE, PIECE = 0, 1


def tune_bands(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the longest bands, then the fewest, that reach ``recall`` with at most ``most`` values."""
    for rows in range(most, 0, -1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches the recall")


def pieces(hashes: np.ndarray, owner: np.ndarray, firsts: np.ndarray, radius: int) -> np.ndarray:
    """First words of the pieces: line starts, and words whose hash with the next one is below the ``radius`` hashes before
    it and not above those behind (so a run of one word is not cut). ``owner``: the text of each word; texts don't see each other."""
    most, n = np.iinfo(np.uint64).max, len(hashes)
    v = np.full(n, most, dtype=np.uint64)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    v[inside] = N.mix(hashes[inside] * np.uint64(3) + hashes[inside + 1])
    at = np.arange(n) + radius * (owner - owner[0] + 1)
    wide = np.full(int(at[-1]) + 2 * radius + 1, most, dtype=np.uint64)
    wide[at] = v
    low = np.lib.stride_tricks.sliding_window_view(wide, radius).min(1)  # low[i]: of wide[i:i + radius]
    return np.union1d(firsts, np.flatnonzero((v < low[at - radius]) & (v <= low[at + 1])))


def units(docs: DataFrame, bands: int, rows: int, least_words: int, radius: int, least_line: int, seed: int = 23, chunk: int = 1 << 20) -> DataFrame:
    """Every paragraph and piece: doc, kind, place and words (in words), begin, end (bytes), key, bands (paragraphs only), beside:
    16 bits of the word before the unit in its upper half, of the word behind it in its lower one (0: none).
    Lines below ``least_words`` words, from ``least_line`` on, are paragraphs without bands."""
    names = ["doc", "kind", "place", "words", "begin", "end", "key", "beside", "bands"]

    def of(ids: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        """Texts of bounded size together, in one pass over their words."""
        raw = b"\n".join(texts)
        starts, ends, h = N.words_of(raw.lower())
        if not len(h):
            return
        offset = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        owner = np.searchsorted(offset, starts, side="right") - 1
        line = np.searchsorted(np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10), starts)
        firsts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        lasts = np.concatenate([firsts[1:], [len(h)]])
        first_word = np.searchsorted(owner, owner)  # of the word's text
        few = np.concatenate([[0], (h >> np.uint64(48)).astype(np.int64) | 1, [0]])  # few[i + 1]: of word i
        inner = np.concatenate([[False], owner[1:] == owner[:-1], [False]])  # inner[i]: words i - 1 and i are of one text
        full = lasts - firsts >= least_words

        def batch(kind: int, base: np.ndarray, use: np.ndarray, bins: pa.Array) -> pa.RecordBatch:
            order = np.arange(len(h)) - np.repeat(base, np.diff(np.concatenate([base, [len(h)]])))
            sums = np.add.reduceat(N.mix(h + (order + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), base)
            stop = np.concatenate([base[1:], [len(h)]])
            lo, hi, sums = base[use], stop[use], sums[use]
            key = N.mix(sums + (hi - lo).astype(np.uint64)).view(np.int64)
            at = offset[owner[lo]]
            cols = (np.asarray(ids)[owner[lo]], np.full(len(lo), kind, dtype=np.int32), (lo - first_word[lo]).astype(np.int32), (hi - lo).astype(np.int32),
                    starts[lo] - at, ends[hi - 1] - at, key,
                    (((few[lo] * inner[lo]) << 16) | (few[hi + 1] * inner[hi])).astype(np.uint32).view(np.int32))
            return pa.RecordBatch.from_arrays([*map(pa.array, cols), bins], names=names)

        cuts = pieces(h, owner, firsts, radius)
        yield batch(PIECE, cuts, np.ones(len(cuts), dtype=bool), pa.nulls(len(cuts), pa.list_(pa.int64())))
        if full.any():
            n = N.SHINGLE
            s = np.zeros(len(h) - n + 1, dtype=np.uint64)
            for j in range(n):
                s = N.mix(s * np.uint64(3) + h[j:len(h) - n + 1 + j])
            number = np.repeat(np.arange(len(firsts)), lasts - firsts)
            ok = np.flatnonzero(full[number[:len(s)]] & (line[:len(s)] == line[n - 1:]))
            begin = np.flatnonzero(np.concatenate([[True], np.diff(number[ok]) > 0]))
            a, b = N.multipliers(bands * rows, seed)
            v = np.stack([np.minimum.reduceat(s[ok] * x + y, begin) for x, y in zip(a, b, strict=True)], axis=1) >> np.uint64(32)
            v = v.reshape(-1, bands, rows)
            key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(v), 1))
            for j in range(rows):
                key = N.mix(key * np.uint64(5) + v[:, :, j])
            bins = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel()))
            yield batch(LINE, firsts, full, bins)
        short = (lasts - firsts >= least_line) & ~full
        if short.any():
            yield batch(LINE, firsts, short, pa.nulls(int(short.sum()), pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, size = [], [], 0
            for doc, t in zip(b.column("doc").to_pylist(), b.column("text"), strict=True):
                ids.append(doc)
                texts.append(t.as_py())
                size += len(texts[-1])
                if size >= chunk:
                    yield from of(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield from of(ids, texts)

    return docs.select("doc", "text").mapInArrow(run, "doc long, kind int, place int, words int, begin long, end long, key long, beside int, bands array<long>")


def line_sets(texts: DataFrame) -> DataFrame:
    """(node, weight, shingles) of (text, spans: array of (key, begin, end))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, sets = [], []
            for t, spans in zip(b.column("text"), b.column("spans").to_pylist(), strict=True):
                raw = t.as_py()
                for s in spans:
                    nodes.append(s["key"])
                    sets.append(N.shingles(N.words_of(raw[s["begin"]:s["end"]].lower())[2]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.ones(len(nodes), dtype=np.int64)), pa.array(sets, pa.binary())],
                                             names=["node", "weight", "shingles"])

    return texts.mapInArrow(run, "node long, weight long, shingles binary")


def removals(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text", least_words: int = 20,
             radius: int = 5, least_line: int | None = None) -> DataFrame:
    """One row per distinct (id, text): id, key (md5 of the text), n_paragraphs, and removed: array of
    (begin, end (bytes), kind, class_id, first_id), sorted; first_id is the document whose occurrence stays,
    class_id of a passage that of its first piece. ``least_line``: of shorter lines that repeat exactly (null: ``least_words``)."""
    bands, rows = tune_bands(threshold, recall)
    keyed = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    texts = keyed.withColumn("doc", F.xxhash64("text_key", "id"))
    ids = texts.groupBy("doc").agg(F.first("id").alias("id"), F.first("text_key").alias("text_key"))
    made = checkpoint_table(units(texts, bands, rows, least_words, radius, least_line or least_words))
    ends = [f("doc").alias(f"{n}_doc") for n, f in (("low", F.min), ("high", F.max))] + [f("place").alias(f"{n}_place") for n, f in (("low", F.min), ("high", F.max))]
    twice = (F.col("low_doc") != F.col("high_doc")) | (F.col("low_place") != F.col("high_place"))
    lines = made.filter(F.col("kind") == LINE).groupBy("key", "words").agg(F.min(F.struct("doc", "begin", "end")).alias("at"), *ends)
    lines = checkpoint_table(lines)
    bins = made.filter(F.col("kind") == LINE).select("key", F.explode("bands").alias("band"))
    shared = bins.groupBy("band").agg(F.min("key").alias("b"), F.max("key").alias("last")).filter("b <> last").drop("last")
    candidates = components(bins.join(shared, "band").select(F.col("key").alias("a"), "b"))
    spans = candidates.join(lines, candidates["node"] == lines["key"]).groupBy("at.doc").agg(F.collect_list(F.struct("key", "at.begin", "at.end")).alias("spans"))
    spans = checkpoint_table(spans)
    unique = likely(texts, spans, "doc").groupBy("doc").agg(F.first("text").alias("text")).join(spans, "doc")
    sets = checkpoint_table(line_sets(unique.select("text", "spans")).dropDuplicates(["node"]))
    _, classes = N.verify(candidates, sets, threshold)

    near = lines.join(classes, lines["key"] == classes["node"], "left").withColumn("class", F.coalesce("root", "key"))
    seen = near.groupBy("class").agg(F.min("low_doc").alias("low_doc"), F.max("high_doc").alias("high_doc"), F.min("low_place").alias("low_place"),
                                     F.max("high_place").alias("high_place")).filter(twice).select("class")
    named = near.join(seen, "class").select(F.lit(LINE).alias("kind"), "key", "words", "class")
    same = made.filter(F.col("kind") == PIECE).groupBy("key", "words").agg(*ends).filter(twice)
    named = checkpoint_table(named.unionByName(same.select(F.lit(PIECE).alias("kind"), "key", "words", F.col("key").alias("class"))))

    occurs = made.drop("bands").join(named, ["kind", "key", "words"]).distinct()
    occurs = checkpoint_table(occurs.join(ids.select("doc", "id"), "doc"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "doc", "place", "beside")
    first = occurs.groupBy("kind", "class").agg(F.min(order).alias("first"))
    gone = join_hot(occurs, first, ["kind", "class"], ["doc", "place"]).filter(
        ~((F.col("doc") == F.col("first.doc")) & (F.col("place") == F.col("first.place"))))
    gone = gone.select("doc", "kind", "place", "words", "begin", "end", "class", F.col("first.id").alias("first_id"),
                       F.col("first.doc").alias("first_doc"), F.col("first.place").alias("first_place"), same_beside(F.shiftrightunsigned("beside", 16), F.shiftrightunsigned("first.beside", 16)).alias("before"),
                       same_beside(F.col("beside").bitwiseAND(0xFFFF), F.col("first.beside").bitwiseAND(0xFFFF)).alias("after"))
    gone = checkpoint_table(matches_of(gone.filter(F.col("kind") == PIECE)).unionByName(gone.filter(F.col("kind") == LINE), allowMissingColumns=True))
    open_ = read_again(least_words)
    found = gone.filter((F.col("kind") == PIECE) & ~open_).withColumns({"low": F.col("place"), "high": F.col("place") + F.col("words")})
    found = found.unionByName(extended(gone.filter((F.col("kind") == PIECE) & open_), texts))
    found = long_enough(found, least_words).withColumn("kind", F.lit("piece"))
    gone = gone.filter(F.col("kind") == LINE).withColumn("kind", F.lit("paragraph"))
    span = F.struct("begin", "end", "kind", F.col("class").alias("class_id"), "first_id")
    gone = gone.select("doc", span.alias("span")).unionAll(found.select("doc", span.alias("span")))
    gone = gone.groupBy("doc").agg(F.array_sort(F.collect_list("span")).alias("removed"))
    n = made.filter((F.col("kind") == LINE) & (F.col("words") >= least_words)).groupBy("doc").agg(F.countDistinct("place").alias("n_paragraphs"))
    out = ids.join(n, "doc", "left").join(gone, "doc", "left")
    none = F.array().cast("array<struct<begin:bigint,end:bigint,kind:string,class_id:bigint,first_id:" + ids.schema["id"].dataType.simpleString() + ">>")
    return out.select("id", F.col("text_key").alias("key"), F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"), F.coalesce("removed", none).alias("removed"))


def same_beside(own, other):
    """Whether two neighbouring words may be equal (0: there is none)."""
    return (own == other) & (own != 0)


def read_again(least_words: int):
    """Matches whose texts are read: those that may grow, by the words beside them; and those of one piece only that may count as
    they are, for its 64 bits alone don't prove them. The others end where they end, and two or more keys agree."""
    grows = (F.col("before") & (F.coalesce("room_before", F.lit(1)) > 0)) | (F.col("after") & (F.coalesce("room_after", F.lit(1)) > 0))
    touches = (F.coalesce("room_before", F.lit(1)) == 0) | (F.coalesce("room_after", F.lit(1)) == 0)
    return grows | ((F.col("n_pieces") == 1) & (touches | (F.col("words") >= least_words)))


def matches_of(pieces: DataFrame) -> DataFrame:
    """Removed pieces as matches: pieces next to one another that repeat pieces next to one another are one.
    room_before and room_after: words up to the neighbouring matches (null: none on that side)."""
    w = Window.partitionBy("doc").orderBy("place")
    behind = F.lag("words").over(w)
    goes_on = ((F.lag("place").over(w) + behind == F.col("place")) & (F.lag("first_doc").over(w) == F.col("first_doc"))
               & (F.lag("first_place").over(w) + behind == F.col("first_place")))
    p = pieces.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("number", F.sum("new").over(w))
    m = p.groupBy("doc", "number").agg(F.first("kind").alias("kind"), F.min_by("class", "place").alias("class"), F.first("first_id").alias("first_id"),
                                       F.first("first_doc").alias("first_doc"), F.min("first_place").alias("first_place"), F.min("place").alias("place"),
                                       F.sum("words").cast("int").alias("words"), F.min("begin").alias("begin"), F.max("end").alias("end"),
                                       F.min_by("before", "place").alias("before"), F.max_by("after", "place").alias("after"), F.count(F.lit(1)).alias("n_pieces"))
    own_end = F.col("place") + F.col("words")
    return m.withColumns({"room_before": F.col("place") - F.lag(own_end).over(w), "room_after": F.lead("place").over(w) - own_end}).drop("number")


def long_enough(found: DataFrame, least_words: int) -> DataFrame:
    """Matches without the groups of overlapping and touching ones that have fewer than ``least_words`` words."""
    w = Window.partitionBy("doc").orderBy("low", "high", "place")
    reach = F.max("high").over(w.rowsBetween(Window.unboundedPreceding, -1))
    f = found.withColumn("new", F.when(F.col("low") <= reach, 0).otherwise(1)).withColumn("number", F.sum("new").over(w))
    group = Window.partitionBy("doc", "number")
    f = f.withColumn("total", F.max("high").over(group) - F.min("low").over(group))
    return f.filter(F.col("total") >= least_words).drop("new", "number", "total")


def merged(spans):
    """Overlapping and touching spans of ``removed`` as one: array of (begin, end)."""
    first = F.array().cast("array<struct<begin:bigint,end:bigint>>")

    def step(a, s):
        last = F.try_element_at(a, F.lit(-1))
        joined = F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
                          F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (s["begin"] <= last["end"]), joined).otherwise(
            F.concat(a, F.array(F.struct(s["begin"].alias("begin"), s["end"].alias("end")))))

    return F.aggregate(spans, first, step)


def cleaned(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed bytes cut out of the text; all columns and rows stay."""
    r = removed.select(F.col("id").alias("punctuo_id"), F.col("key").alias("punctuo_key"), merged(F.col("removed")).alias("punctuo_spans"))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    d = docs.join(r, F.col(id_col).eqNullSafe(F.col("punctuo_id")) & (F.md5(text) == F.col("punctuo_key")), "left")
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    part = lambda a, to: F.substring(text, (a["at"] + 1).cast("int"), (to - a["at"]).cast("int")).cast("string")
    step = lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["parts"], F.array(part(a, s["begin"]))).alias("parts"))
    end = lambda a: F.array_join(F.concat(a["parts"], F.array(part(a, F.octet_length(text)))), "")
    clean = F.when(F.size("punctuo_spans") > 0, F.aggregate("punctuo_spans", first, step, end)).otherwise(F.col(text_col))
    return d.withColumn(text_col, clean).select(*[F.col(f"`{c}`") for c in docs.columns])
