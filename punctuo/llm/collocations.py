"""Phrase collocations: word sequences that stand together more often than their parts would.

Every word occurrence is a suffix pointer into its piece of text. In each task the
pointers are sorted by multikey three-way quicksort, word by word to the depth
wanted: a partition is split at a pivot into words below, equal to and above it, and
an equal partition goes one word deeper. The sizes of the equal partitions are the
task's counts. All segments of a depth are partitioned in the same numpy pass.

Depth by depth the counts are routed by their leading words to one place each and
added up; partitions that turn out infrequent over all texts are abandoned: the
next depth only follows pointers whose leading words, and those of the next pointer,
are frequent. Tasks test this in a bitmap of ``BITS`` bits, whatever the size of the
corpus (a wrong hit costs work, the exact counts decide). As tasks add up equal
phrases before the shuffle, no phrase has more rows there than there are tasks.

Texts are cut into pieces at marks and line ends, pieces into words at blanks and
tabs; A to Z count as a to z. All counts are per language.

Defined results: a null text is empty, a null language is `und`; empty texts have no
words; repeated rows count each time; equal scores and counts are ordered by the
phrase's bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuo.operators.util import checkpoint_table

#: Bits of the bitmap of frequent phrases, which goes to every task.
BITS = 1 << 26
#: Words sorted at once in a task.
WORDS = 1 << 20
#: Bytes of one text that are cut into words at once.
STRIP = 1 << 22
END, EMPTY = 0, 1
#: Of the hash of a phrase: the product stays below 2^63.
MULTIPLIER, MODULUS = 1_000_003, 4_294_967_291
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


# ---------------------------------------------------------------- sorting
def split_equal(order: np.ndarray, starts: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One depth of the quicksort: pointers and starts of partitions that are also equal in ``key``.

    ``order``: suffix pointers, partition after partition; ``starts``: where these
    begin; ``key``: the next word by pointer."""
    order, bound = order.copy(), np.zeros(len(order) + 1, dtype=bool)
    bound[starts] = True
    k = key[order]
    begin, size = starts, np.diff(np.append(starts, len(order)))
    while True:
        begin, size = begin[size > 1], size[size > 1]
        if not len(begin):
            return order, np.flatnonzero(bound[:-1])
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(begin - first, size)
        here, pointers = k[at], order[at]
        pivot = np.repeat(k[begin + size // 2], size)
        below, equal = here < pivot, here == pivot
        n_below, n_equal = (np.add.reduceat(x, first, dtype=np.int64) for x in (below, equal))
        up_below, up_equal = np.cumsum(below), np.cumsum(equal)
        before_below, before_equal = (np.repeat(x[first] - y[first], size) for x, y in ((up_below, below), (up_equal, equal)))
        nth_below, nth_equal = up_below - before_below, up_equal - before_equal  # of the segment, up to here
        place = np.arange(len(at)) - np.repeat(first, size)
        to = np.where(below, nth_below - 1, np.where(equal, np.repeat(n_below, size) + nth_equal - 1,
                                                     place - nth_below - nth_equal + np.repeat(n_below + n_equal, size))) + np.repeat(begin, size)
        order[to], k[to] = pointers, here
        low, high = begin + n_below, begin + n_below + n_equal
        bound[low] = True
        bound[high] = True  # the end of a segment is a start already, or the end of all
        begin, size = np.concatenate([begin, high]), np.concatenate([n_below, size - n_below - n_equal])


def leading(seq: np.ndarray, pointers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers dealt into partitions by their first word."""
    order = pointers[np.argsort(seq[pointers], kind="stable")]
    first = seq[order]
    return order, np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(order) else np.empty(0, dtype=np.int64)


# ---------------------------------------------------------------- words of a task
class Words:
    """Word occurrences of some texts as numbers, ``END`` behind each piece; a number is a word of one language."""

    def __init__(self):
        self.number = count(2)
        self.ids: dict[str, defaultdict] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.ids:
            self.ids[lang] = defaultdict(self.number.__next__, {b"\n": END, b"": EMPTY})
        ids, at = self.ids[lang], 0
        while at < len(text):
            to = min(len(text), at + STRIP)
            if to < len(text):  # a strip of a very long text ends behind a blank, or is as long as its last word
                blank = max(text.rfind(b" ", at, to), text.rfind(b"\n", at, to))
                if blank < 0:
                    more = [x for x in (text.find(b" ", to), text.find(b"\n", to)) if x >= 0]
                    blank = min(more, default=len(text) - 1)
                to = blank + 1
            words = text[at:to].translate(_LOWER).replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(ids.__getitem__, words), dtype=np.int32, count=len(words))
            self.parts.append(found[found != EMPTY])
            self.size += len(self.parts[-1])
            at = to
        self.parts.append(np.zeros(1, dtype=np.int32))
        self.size += 1

    def spelled(self) -> tuple[list[str], list[bytes]]:
        """Language and word by number."""
        n = next(self.number)
        langs, words = [""] * n, [b""] * n
        for lang, ids in self.ids.items():
            for w, i in ids.items():
                if i > EMPTY:
                    langs[i], words[i] = lang, w
        return langs, words


def step(hashed, word):
    """The hash of a phrase with one more word (numbers of Spark or of numpy below 2^32): the same in the driver's plan and in the tasks."""
    return (hashed * MULTIPLIER + word) % MODULUS


def is_frequent(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    at = hashed % np.uint64(BITS)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def phrases(held: Words, depth: int, bitmaps: list[np.ndarray]) -> tuple[list[str], list[bytes], np.ndarray]:
    """Language, phrase and count of the phrases of ``depth`` words whose shorter ones are in the bitmaps."""
    seq = np.concatenate([*held.parts, np.zeros(depth, dtype=np.int32)])
    langs, words = held.spelled()
    counts = np.bincount(seq, minlength=len(words))
    counts[:EMPTY + 1] = 0
    if depth == 1:
        some = np.flatnonzero(counts)
        return [langs[i] for i in some.tolist()], [words[i] for i in some.tolist()], counts[some]
    word_hash = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    of_lang = {g: crc32(g.encode()) for g in held.ids}
    hashed = step(np.fromiter((of_lang.get(g, 0) for g in langs), dtype=np.uint64, count=len(words)), word_hash)  # of phrases of one word, by word
    alive = (is_frequent(bitmaps[0], hashed) & (counts > 0))[seq]
    order, starts = leading(seq, np.flatnonzero(alive[:-1] & alive[1:]))
    hashed = hashed[seq[order[starts]]]
    for deep in range(2, depth + 1):
        heads = starts
        order, starts = split_equal(order, starts, seq[deep - 1:])
        sizes = np.diff(np.append(starts, len(order)))
        first = order[starts]
        if deep == depth:
            spelled = [[words[i] for i in seq[first + j].tolist()] for j in range(deep)]
            return [langs[i] for i in seq[first].tolist()], [*map(b" ".join, zip(*spelled, strict=True))], sizes
        hashed = step(hashed[np.searchsorted(heads, starts, side="right") - 1], word_hash[seq[first + deep - 1]])
        alive = np.zeros(len(seq), dtype=bool)
        alive[order[np.repeat(is_frequent(bitmaps[deep - 1], hashed), sizes)]] = True
        part = np.repeat(np.arange(len(starts)), sizes)
        keep = alive[order] & alive[order + 1]
        order, part = order[keep], part[keep]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(order) else starts[:0]
        hashed = hashed[part[starts]]
    raise AssertionError


def partial_counts(texts: DataFrame, depth: int, bitmaps: list[np.ndarray]) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``depth`` words, added up per task of about ``WORDS`` words."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            langs, found, sizes = phrases(held, depth, sent.value)
            for at in range(0, len(found), 1 << 16):
                to = at + (1 << 16)
                yield pa.RecordBatch.from_arrays([pa.array(langs[at:to], pa.string()), pa.array(found[at:to], pa.binary()), pa.array(sizes[at:to], pa.int64())],
                                                 names=["lang", "phrase", "n"])

        held = Words()
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                held.add(lang, text.as_py())
                if held.size >= WORDS:
                    yield from out()
                    held = Words()
        yield from out()

    return texts.mapInArrow(run, "lang string, phrase binary, n long").select("lang", F.col("phrase").cast("string").alias("phrase"), "n")


def bitmap_of(frequent: DataFrame) -> np.ndarray:
    """Bits of the phrases of ``frequent``; made in the cluster, ``BITS`` / 64 numbers at most come to the driver."""
    first = F.crc32(F.col("lang").cast("binary"))
    bit = F.aggregate(F.split("phrase", " "), first, lambda h, w: step(h, F.crc32(w.cast("binary")))) % BITS
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    rows = frequent.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("slot")).agg(F.bit_or(one).alias("mask")).toArrow()
    out = np.zeros(BITS // 64, dtype=np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, max_words: int, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``max_words`` words with f >= ``least``, and (lang, n): all word occurrences."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    levels, bitmaps, total = [], [], None
    for depth in range(1, max_words + 1):
        counted = partial_counts(texts, depth, bitmaps).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        if depth == 1:
            counted = checkpoint_table(counted)
            total = counted.groupBy("lang").agg(F.sum("f").alias("n"))
            level = counted.filter(F.col("f") >= least)
        else:
            level = checkpoint_table(counted.filter(F.col("f") >= least))
        levels.append(level.select("lang", "phrase", F.lit(depth).alias("words"), "f"))
        if depth < max_words:
            bitmaps = [*bitmaps, bitmap_of(level)]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, total


# ---------------------------------------------------------------- scores
def _joined(first, size):
    return F.array_join(F.slice("part", first, size), " ")


def collocations(docs: DataFrame, max_words: int = 3, least: int = 10, inside: int = 50, scale: int = 1_000_000, top: int = 2000, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase with ``a`` occurrences that is cut behind its first words into parts with
    l and r occurrences scores floor(scale * a * a / (l * r)), exactly; its lowest cut
    counts (the shortest first part of equal ones). Phrases of which a longer one holds
    at least ``inside`` percent are dropped."""
    known, total = frequent_phrases(docs, max_words, least, text_col, lang_col)
    cand = known.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("part"))
    sides = F.flatten(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit("l").alias("side"), _joined(F.lit(1), k).alias("half")),
        F.struct(k.alias("k"), F.lit("r").alias("side"), _joined(k + 1, F.col("words") - k).alias("half")))))
    sides = cand.select("lang", "phrase", "words", "a", F.explode(sides).alias("s")).select("lang", "phrase", "words", "a", "s.*")
    halves = known.select("lang", F.col("phrase").alias("half"), "f")
    cuts = [k for k in range(1, max_words)]
    both = sides.join(halves, ["lang", "half"]).groupBy("lang", "phrase", "words", "a").agg(
        *[F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}") for k in cuts for s in "lr"])
    big = lambda c: F.col(c).cast("decimal(15,0)")  # noqa: E731  exact: products of 38 digits
    for k in cuts:
        both = both.withColumn(f"up{k}", F.lit(scale).cast("decimal(8,0)") * (big("a") * big("a"))).withColumn(f"down{k}", big(f"l{k}") * big(f"r{k}"))
        both = both.withColumn(f"cut{k}", F.when(F.col("words") > k, F.struct(F.expr(f"up{k} div down{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    lowest = F.least(*[F.col(f"cut{k}") for k in cuts]) if len(cuts) > 1 else F.col("cut1")
    both = both.select("lang", "phrase", "a", lowest.alias("cut"))
    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _joined(i, n))))
    held = cand.filter("words > 2").select("lang", F.explode(F.array_distinct(shorter)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = both.join(held, ["lang", "phrase"], "left").filter(F.expr(f"longer is null or 100 * longer < {inside} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return kept.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                                                        F.col("cut.score").cast("long").alias("score"))
