"""Exact substring dedup with suffix arrays: bytes in long strings that occur twice.

A string of ``length`` bytes that starts at two places (of one document or of
two) contains the same anchor in both: the ``gram`` with the smallest hash among
its grams. So every document is winnowed to anchors, and two equal strings meet
under their anchor's hash. Around each repeated anchor stands a segment of at
most 2 * length - gram bytes, which holds every such string with this anchor.
Equal segments are settled by counting; the different segments of an anchor form
shards of bounded size: a suffix array by prefix doubling that only re-sorts
unsorted groups (Larsson-Sadakane), common prefixes by Kasai's scan, run in many
lanes at once, and classes of equal strings read off the common prefixes.

Shards need no merging, except where more than ``most`` documents have one
anchor. Such a group would be cut into many shards, each to be searched for the
others' strings; instead of that search the group's strings are merged by two
64-bit hashes in one distributed count, which stays linear in the group.

Strings are judged on the input; overlapping strings are all removed. Defined
results: null text is an empty text; texts shorter than ``length`` lose nothing;
equal texts of at least ``length`` bytes and repeated rows lose everything; ids
may be null or repeated; empty table: no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm import near_sets as N
from punctuo.llm.prefilter import likely
from punctuo.operators.util import checkpoint_table

SHARD = 1 << 20
STOP = 255  # no byte of UTF-8: stands between segments
_PLACE = np.uint64((1 << 24) - 1)
STRIP = 1 << 22
#: At most so many segments are settled by a broadcast.
HOT = 100_000
#: Bytes of short texts whose anchors are found in one vector pass.
BLOCK = 1 << 17


# ---------------------------------------------------------------- anchors
def _eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros behind the end."""
    n = len(text)
    wide = np.zeros(n + 16, dtype=np.uint8)
    wide[:n] = text
    out = np.empty(n, dtype=np.uint64)
    for j in range(min(8, n)):
        out[j::8] = wide[j:j + 8 * -(-(n - j) // 8)].view(">u8")
    return out


class Hashes:
    """64-bit hashes of any strings of at least eight bytes in a text, from running sums over mixed runs of eight."""

    def __init__(self, eights: np.ndarray, salt: int):
        up, self.down = N._powers(len(eights) + 1)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(N.mix(eights ^ np.uint64(salt)) * up[:len(eights)], dtype=np.uint64)])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return N.mix((self.sums[end - 7] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def _window_minima(v: np.ndarray, wide: int) -> np.ndarray:
    """The smallest of every ``wide`` neighbours, by minima from both ends of blocks of that size."""
    m = len(v)
    blocks = np.concatenate([v, np.full(-m % wide, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, wide)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:m - wide + 1], left[wide - 1:m])


def _winnow(h: np.ndarray, wide: int) -> np.ndarray:
    """Places of the smallest of every ``wide`` neighbours (the first of equal ones)."""
    low = _window_minima((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), wide)
    return (low[np.concatenate([[True], low[1:] != low[:-1]])] & _PLACE).astype(np.int64)


def anchors_of(text: bytes, length: int, gram: int) -> list[np.ndarray]:
    """Columns (anchor, segment (two hashes), left, right, begin, at, end) of the anchors of a text: in each string of
    ``length`` bytes, the first gram with the smallest hash. 0 in left and right: the text ends before."""
    b = np.frombuffer(text, dtype=np.uint8)
    half, out = -(-(length - gram) // 2), []
    for at in range(0, len(b) - length + 1, STRIP):  # strips of a very long text overlap
        lo = max(0, at - (length - gram))
        part = b[lo:at + STRIP + 2 * length]
        eights = _eights(part)
        one, two = Hashes(eights, 0x5851F42D4C957F2D), Hashes(eights, 0x14057B7EF767814F)
        starts = np.arange(at - lo, min(at + STRIP - 1 + length, len(b)) - gram + 1 - lo)
        grams = one(starts, starts + gram)
        w = _winnow(grams, length - gram + 1)
        p = w + (at - lo)
        begin, end = np.maximum(p - (length - gram), 0), np.minimum(p + length, len(part))
        side = [np.where((x >= begin) & (y <= end), one(np.clip(x, 0, len(part) - 8), np.clip(y, 8, len(part))), np.uint64(0))
                for x, y in ((p - half, p + gram), (p, p + gram + half))]
        names = [grams[w], one(begin, end) + (p - begin).astype(np.uint64), two(begin, end), *side]
        out.append([*[x.view(np.int64) for x in names], begin + lo, p + lo, end + lo])
    if not out:
        return [np.empty(0, dtype=np.int64)] * 8
    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
    _, first = np.unique(cols[6], return_index=True)
    return [c[first] for c in cols]


def anchors_of_block(texts: list[bytes], length: int, gram: int) -> tuple[list[np.ndarray], np.ndarray]:
    """``anchors_of`` of many short texts of at least ``length`` bytes in one pass: the columns, and the text of each anchor."""
    part = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.asarray([len(t) for t in texts])
    ends = np.cumsum(sizes)
    eights = _eights(part)
    one, two = Hashes(eights, 0x5851F42D4C957F2D), Hashes(eights, 0x14057B7EF767814F)
    starts = np.arange(len(part) - gram + 1)
    grams = one(starts, starts + gram)  # some reach into the next text, but no window that counts holds these
    wide = length - gram + 1
    h = (grams & ~_PLACE) | starts.astype(np.uint64)
    inside = np.repeat(ends, sizes)[:len(part) - length + 1] - np.arange(len(part) - length + 1) >= length
    low = _window_minima(h, wide)[inside]
    w = (low[np.concatenate([[True], low[1:] != low[:-1]])] & _PLACE).astype(np.int64)
    which = np.searchsorted(ends, w, side="right")
    lo, hi = (ends - sizes)[which], ends[which]
    half = -(-(length - gram) // 2)
    begin, end = np.maximum(w - (length - gram), lo), np.minimum(w + length, hi)
    side = [np.where((x >= begin) & (y <= end), one(np.clip(x, 0, len(part) - 8), np.clip(y, 8, len(part))), np.uint64(0))
            for x, y in ((w - half, w + gram), (w, w + gram + half))]
    names = [grams[w], one(begin, end) + (w - begin).astype(np.uint64), two(begin, end), *side]
    return [*[x.view(np.int64) for x in names], begin - lo, w - lo, end - lo], which


def anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, seg_a, seg_b, left, right, begin, at, end, key) of every anchor of (key, text).

    seg_a and seg_b are hashes of the bytes begin..end and of at - begin. A string
    of ``length`` bytes around the anchor reaches at least half of what it has
    beyond the anchor to one side: left and right are hashes of that much."""
    names = ["anchor", "seg_a", "seg_b", "left", "right", "begin", "at", "end"]

    def found(keys: list[bytes], texts: list[bytes]) -> pa.RecordBatch:
        if len(texts) == 1:
            cols = anchors_of(texts[0], length, gram)
            which = np.zeros(len(cols[0]), dtype=np.int64)
        else:
            cols, which = anchors_of_block(texts, length, gram)
        return pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], pa.array(keys, pa.binary()).take(pa.array(which))], names=[*names, "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size = [], [], 0
        for b in batches:
            for key, t in zip(b.column("key").to_pylist(), b.column("text"), strict=True):
                text = t.as_py()
                if len(text) < length:
                    continue
                if held and size + len(text) > BLOCK:
                    yield found(keys, held)
                    keys, held, size = [], [], 0
                keys.append(key)
                held.append(text)
                size += len(text)
        if held:
            yield found(keys, held)

    return texts.select("key", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", key binary")


def cut_out(texts: DataFrame) -> DataFrame:
    """The bytes of the segments of (key, text, places: array of (anchor, many, large, begin, end)).

    Overlapping segments of one anchor in one text (a repetitive text has many) become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for key, t, places in zip(b.column("key").to_pylist(), b.column("text"), b.column("places").to_pylist(), strict=True):
                raw, out = t.as_py(), []
                for s in sorted(places, key=lambda s: (s["anchor"], s["many"], s["begin"], s["end"])):
                    name = [s["anchor"], s["many"], s["large"]]
                    if out and out[-1][:3] == name and s["begin"] <= out[-1][4]:
                        out[-1][4] = max(out[-1][4], s["end"])
                    else:
                        out.append([*name, s["begin"], s["end"]])
                for anchor, many, large, begin, end in out:
                    for col, value in zip(cols, (anchor, many, large, key, begin, raw[begin:end]), strict=True):
                        col.append(value)
            kinds = (pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["group", "many", "large", "key", "begin", "bytes"])

    return texts.select("key", "text", "places").mapInArrow(run, "group long, many boolean, large boolean, key binary, begin long, bytes binary")


# ---------------------------------------------------------------- suffix arrays
def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; after the first eight bytes only unsorted groups are sorted again, by twice as many bytes each time."""
    n = len(text)
    first = _eights(text)
    sa = np.argsort(first)
    value = first[sa]
    rank = np.empty(n, dtype=np.int64)
    new = np.concatenate([[True], value[1:] != value[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = start
    h = 8
    open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    while len(open_):
        s = sa[open_]
        behind = np.where(s + h < n, rank[np.minimum(s + h, n - 1)] + 1, 0)
        both = rank[s] * (n + 1) + behind
        order = np.argsort(both)
        s, both = s[order], both[order]
        sa[open_] = s
        new = np.concatenate([[True], both[1:] != both[:-1]])
        rank[s] = open_[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
        open_ = open_[~(new & np.concatenate([new[1:], [True]]))]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int, lanes: int = 8192) -> np.ndarray:
    """Common prefix, up to ``most``, of each suffix in ``sa`` with the one before it.

    Kasai's scan in text order: the value falls by at most one from a place to
    the next. ``lanes`` stretches of the text are scanned at the same time."""
    n = len(text)
    before = np.empty(n, dtype=np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    eights = np.concatenate([_eights(text), np.zeros(most + 8, dtype=np.uint64)])
    steps = -(-n // lanes)
    at = np.arange(lanes, dtype=np.int64) * steps
    got, out = np.zeros(lanes, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for k in range(steps):
        i = at + k
        live = i < np.minimum(at + steps, n)
        j = before[np.minimum(i, n - 1)]
        got = np.maximum(got - 1, 0)
        got[~live | (j < 0)] = 0
        go = np.flatnonzero(live & (j >= 0) & (got < most))
        while len(go):
            differ = eights[i[go] + got[go]] ^ eights[j[go] + got[go]]
            same = np.full(len(go), 8, dtype=np.int64)
            odd = differ != 0
            same[odd] = sum((differ[odd] < np.uint64(1 << (8 * e))).astype(np.int64) for e in range(1, 8))
            got[go] = np.minimum(got[go] + same, most)
            limit = n - np.maximum(i[go], j[go])
            over = got[go] > limit
            got[go] = np.minimum(got[go], limit)
            go = go[~odd & ~over & (got[go] < most)]
        out[i[live]] = got[live]
    return out[sa]


def repeated(segments: list[bytes], own: np.ndarray, many: np.ndarray, length: int) -> list[np.ndarray]:
    """Offsets in each segment at which a string starts that occurs elsewhere.

    ``own``: (document number, place of the segment's first byte); ``many``: the segment itself occurs elsewhere."""
    text = np.frombuffer(b"".join([x for s in segments for x in (s, bytes([STOP]))]), dtype=np.uint8)
    sizes = np.asarray([len(s) for s in segments])
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    which = np.repeat(np.arange(len(segments)), sizes + 1)
    offset = np.arange(len(text)) - first[which]
    sa = suffix_array(text)
    prefix = common_prefixes(text, sa, length)
    w = which[sa]
    fits = offset[sa] + length <= sizes[w]
    run = np.cumsum(prefix < length)  # equal strings in a row; a suffix that ends earlier is in no row with one that fits
    sa, w, run = sa[fits], w[fits], run[fits]
    if not len(sa):
        return [np.empty(0, dtype=np.int64)] * len(segments)
    begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    name = (own[w, 0] << 40) | (own[w, 1] + offset[sa])  # the same place may be in two segments
    twice = (np.minimum.reduceat(name, begins) != np.maximum.reduceat(name, begins)) | np.logical_or.reduceat(many[w], begins)
    hit = sa[np.repeat(twice, np.diff(np.concatenate([begins, [len(sa)]])))]
    hit.sort()
    cuts = np.searchsorted(hit, first)
    return [offset[x] for x in np.split(hit, cuts[1:])]


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The union of the strings that begin at the sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.concatenate([[True], np.diff(starts) > length]))
    return starts[new], np.concatenate([starts[new[1:] - 1], starts[-1:]]) + length


def in_shards(cut: DataFrame, length: int) -> DataFrame:
    """(key, begin, end) covered by repeated strings; groups of ``cut`` (group, many, key, begin, bytes) share shards of bounded size."""

    def solve(tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables)
        segments = [x.as_py() for x in t.column("bytes")]
        keys = t.column("key").to_pylist()
        number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        begin = t.column("begin").to_numpy()
        own = np.stack([np.asarray([number[k] for k in keys]), begin], axis=1)
        cols: list[list] = [[], [], []]
        for key, b, found in zip(keys, begin.tolist(), repeated(segments, own, t.column("many").to_numpy(), length), strict=True):
            lo, hi = spans(found, length)
            cols[0] += [key] * len(lo)
            cols[1] += (lo + b).tolist()
            cols[2] += (hi + b).tolist()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["key", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in N.groups(batches, ["group"]):
            held.append(t)
            size += t.column("bytes").nbytes
            if size >= SHARD:
                yield solve(held)
                held, size = [], 0
        if held:
            yield solve(held)

    return cut.repartition("group").sortWithinPartitions("group").mapInArrow(run, "key binary, begin long, end long")


# ---------------------------------------------------------------- anchors of more documents than a shard holds
def by_strings(cut: DataFrame, length: int) -> DataFrame:
    """(key, begin, end) of the strings of ``cut``'s segments that occur twice, merged over all of them by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], []]
            keys, many = [], []
            for key, flag, begin, part in zip(b.column("key").to_pylist(), b.column("many").to_pylist(), b.column("begin").to_pylist(), b.column("bytes"), strict=True):
                eights = _eights(np.frombuffer(part.as_py(), dtype=np.uint8))
                at = np.arange(max(0, len(eights) - length + 1))
                for col, salt in zip(cols, (0x5851F42D4C957F2D, 0x14057B7EF767814F), strict=False):
                    col.append(Hashes(eights, salt)(at, at + length).view(np.int64))
                cols[2].append(at + begin)
                cols[3].append(np.full(len(at), int.from_bytes(key[:8], "little", signed=True)))
                keys += [key] * len(at)
                many += [flag] * len(at)
            if keys:
                yield pa.RecordBatch.from_arrays([*[pa.array(np.concatenate(c)) for c in cols], pa.array(keys, pa.binary()), pa.array(many)],
                                                 names=["a", "b", "begin", "doc", "key", "many"])

    rows = checkpoint_table(cut.select("key", "many", "begin", "bytes").mapInArrow(run, "a long, b long, begin long, doc long, key binary, many boolean"))
    twice = rows.groupBy("a", "b").agg(*[f(c).alias(f"{n}_{c}") for c in ("doc", "begin") for n, f in (("low", F.min), ("high", F.max))], F.bool_or("many").alias("many"))
    twice = twice.filter((F.col("low_doc") != F.col("high_doc")) | (F.col("low_begin") != F.col("high_begin")) | F.col("many")).select("a", "b")
    return rows.join(twice, ["a", "b"]).select("key", "begin", (F.col("begin") + length).alias("end"))


def repeats(docs: DataFrame, length: int = 400, text_col: str = "text", gram: int = 128, most: int = 1024) -> DataFrame:
    """(key, spans): for every distinct text (key: its md5 as bytes) that loses bytes, the maximal removed spans (begin, end)."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    made = checkpoint_table(anchors(keyed, length, gram))
    segment = ["anchor", "seg_a", "seg_b"]
    segments = made.groupBy(*segment).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("key", "begin", "at", "end", "left", "right")).alias("place"))
    groups = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    # segments with so many rows that there can be no more than HOT of them; a large group of copies has some
    hot_from = max(4096, made.count() // HOT)
    hot, many = segments.filter(F.col("n") > hot_from).select(*segment), segments.filter(f"n > 1 and n <= {hot_from}").select(*segment)
    long_ = made.filter(F.col("end") - F.col("begin") >= length)
    cold = likely(long_, many, "seg_a").join(F.broadcast(hot), segment, "left_anti").join(many, segment)
    settled = long_.join(F.broadcast(hot), segment).select("key", "begin", "end").unionByName(cold.select("key", "begin", "end"))
    covers = [settled.select("key", "begin", "end").distinct()]

    several = checkpoint_table(segments.join(groups.filter("kinds > 1"), "anchor"))
    shared = [several.groupBy(F.col(f"place.{side}").alias("probe")).agg(F.count(F.lit(1)).alias("n")).filter("probe <> 0 and n > 1").select("probe")
              for side in ("left", "right")]
    probes = several.select(*segment, F.explode(F.array("place.left", "place.right")).alias("probe"))
    open_ = probes.join(shared[0].unionByName(shared[1]), "probe").select(*segment).distinct()
    several = several.join(open_, segment)
    wide = several.groupBy("anchor", "place.key").agg(F.count(F.lit(1)).alias("n")).groupBy("anchor").agg(F.count(F.lit(1)).alias("documents"))
    several = several.drop("kinds").join(wide, "anchor")
    places = several.select("place.key", F.struct("anchor", (F.col("n") > 1).alias("many"), (F.col("documents") > most).alias("large"), "place.begin",
                                                  "place.end").alias("place"))
    places = places.groupBy("key").agg(F.collect_list("place").alias("places"))  # one document's anchors
    texts = likely(keyed, places, "key").groupBy("key").agg(F.first("text").alias("text"))
    cut = checkpoint_table(cut_out(texts.join(places, "key")))
    covers.append(checkpoint_table(in_shards(cut.filter(~F.col("large")), length)))
    covers.append(checkpoint_table(by_strings(cut.filter("large"), length)))
    out = covers[0]
    for c in covers[1:]:
        out = out.unionByName(c)
    whole = keyed.filter(F.octet_length("text") >= length).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first(F.octet_length("text")).alias("end"))
    out = out.unionByName(whole.filter("n > 1").select("key", F.lit(0).cast("long").alias("begin"), F.col("end").cast("long").alias("end")))
    out = out.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("found"))
    first = F.array().cast("array<struct<begin:bigint,end:bigint>>")

    def step(a, s):
        last = F.try_element_at(a, F.lit(-1))
        joined = F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (s["begin"] <= last["end"]), joined).otherwise(F.concat(a, F.array(s)))

    return out.select("key", F.aggregate("found", first, step).alias("spans"))


def kept(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, n_removed, n_spans, kept (bytes)) of each distinct text that loses bytes."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    found = checkpoint_table(found)
    texts = likely(docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text")), found, "key").groupBy("key").agg(F.first("text").alias("text"))
    part = lambda begin, end: F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int"))
    gaps = F.transform("spans", lambda s, i: part(F.coalesce(F.get("spans", i - 1)["end"], F.lit(0).cast("long")), s["begin"]))
    rest = part(F.element_at("spans", -1)["end"], F.octet_length("text"))
    whole = F.aggregate(F.concat(gaps, F.array(rest)), F.lit(b""), lambda a, x: F.concat(a, x))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return texts.join(found, "key").select("key", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), whole.alias("kept"))
