"""Language-model scores by context-tree weighting over bytes.

A symbol is a byte of the lower-cased (A-Z) text or the end of the text; it is
split into eight binary decisions, each made in the context of the bytes before
it. All contexts up to ``depth`` bytes are mixed: with Krichevsky-Trofimov
estimates P_e of a node's zeros and ones,

    P_w(node) = 1/2 P_e(node) + 1/2 prod P_w(children),

computed from the counts bottom up; top down, the weight that a node stops at
its own estimate turns the counts into one probability per context and symbol.

The tree keeps every context of the training texts; it grows with them and is
nowhere in one place. Texts are dealt into chunks of about ``chunk`` bytes by a
hash of the row; a chunk asks for its distinct (depth + 1)-grams, with their
counts in training, at the buckets of their latest ``TOP + 1`` context bytes. A
bucket holds whole subtrees. It adds up the counts of all chunks, weights its
contexts and gives what reaches depth ``TOP``; those short contexts (65,536 at
most) are weighted together and sent back. Then each bucket answers every chunk
with a log probability per gram, and the chunk's texts are scored with them.

The baseline, smoothed word frequencies: a word that makes up at least
``word_share`` of all tokens is looked up in a broadcast table of at most
1/word_share words; the others are joined by a shuffle in which no word is
hotter than that.

Defined results: null text is an empty text (one end token); an id null or
repeated: each row is scored on its own, a null id counts as neither training
nor held out; empty table: no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuo.llm.near_sets import mix
from punctuo.operators.util import checkpoint_table

END = 255  # no byte of UTF-8: stands before the first byte and after the last one
END_TOKEN = b"\n"  # no word holds white space
TOP = 2  # bytes of the longest contexts that are weighted together
SMALL = 4096


def symbols(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, each with ``depth`` ends before and one behind it; and where each one's symbols start."""
    pad, end = bytes([END]) * depth, bytes([END])
    buf = np.frombuffer(b"".join([x for t in texts for x in (pad, t, end)]), dtype=np.uint8)
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    starts = np.concatenate([[0], np.cumsum(n + depth)[:-1]]) + depth
    return buf, np.stack([starts, n], axis=1)


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (depth + 1)-grams, the latest byte lowest, and their counts."""
    buf, spans = symbols(texts, depth)
    key = np.zeros(len(buf) - depth, dtype=np.int64)
    for j in range(depth + 1):
        key = (key << 8) | buf[j:len(buf) - depth + j]
    real = np.ones(len(buf), dtype=bool)  # not the ends before a text
    for j in range(1, depth + 1):
        real[spans[:, 0] - j] = False
    return np.unique(key[real[depth:]], return_counts=True)


def dealt(rows: DataFrame) -> DataFrame:
    """(chunk, pack): the rows of a batch that go to one chunk, as a compressed Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunk = b.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            cuts = [*np.flatnonzero(np.diff(chunk[order], prepend=-1)).tolist(), len(order)]
            packs = []
            for i, k in zip(cuts, cuts[1:]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(b.take(pa.array(order[i:k])))
                packs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(chunk[order][cuts[:-1]]), pa.array(packs, pa.binary())], names=["chunk", "pack"])

    return rows.mapInArrow(run, "chunk long, pack binary")


def opened_rows(t: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in t.column("pack")])


def asked(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (depth + 1)-gram of each symbol (latest context byte highest, symbol lowest), and the number of symbols of each text."""
    buf, spans = symbols(texts, depth)
    m = len(buf) - depth
    key = np.zeros(m, dtype=np.int64)
    for j in range(1, depth + 1):
        key <<= 8
        key |= buf[depth - j:depth - j + m]
    key <<= 8
    key |= buf[depth:]
    real = np.ones(len(buf), dtype=bool)  # not the ends before a text
    for j in range(1, depth + 1):
        real[spans[:, 0] - j] = False
    return key[real[depth:]], spans[:, 1]


def firsts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


def places(keys: np.ndarray, wanted: np.ndarray, block: int = 1 << 18) -> Iterator[tuple[slice, np.ndarray]]:
    """The place of every wanted gram among the sorted ``keys`` that hold it, a block at a time; a block is searched in sorted order, which
    reads the keys from front to back and not all over."""
    for i in range(0, len(wanted), block):
        part = wanted[i:i + block]
        order = np.argsort(part)
        at = np.empty(len(part), dtype=np.int64)
        at[order] = np.searchsorted(keys, part[order])
        yield slice(i, i + len(part)), at


def bucket_order(keys: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted grams by bucket, and each one's bucket in that order."""
    own = (mix((keys >> (8 * (depth - min(TOP, depth - 1)))).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(own, kind="stable")
    return order, own[order]


def packed(x: np.ndarray) -> bytes:
    """Integers as columns of bytes, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(x: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(x, 8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<i8").ravel()


def count_words(train: DataFrame) -> DataFrame:
    """(token, n) of all tokens of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()

        def of_words():
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], names=["token", "n"])

        for b in batches:
            for t in b.column("text"):
                words.update(t.as_py().lower().split())
                words[END_TOKEN] += 1
                if len(words) > 400_000:
                    yield of_words()
                    words = Counter()
        if words:
            yield of_words()

    return train.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - np.log(np.pi) - _log_gamma(n0 + n1 + 1)


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 binary nodes (1..255) of each context's symbol counts."""
    n0, n1 = np.zeros(counts.shape), np.zeros(counts.shape)
    for j in range(8) if len(counts) else ():
        s = counts.reshape(len(counts), 2**j, 2, -1).sum(-1)
        n0[:, 2**j:2 ** (j + 1)], n1[:, 2**j:2 ** (j + 1)] = s[..., 0], s[..., 1]
    return n0, n1


@dataclass
class ContextTree:
    """``goes[d]``: from a context of d bytes and the byte before it to the context of d + 1 bytes (the last row: none);
    ``logs``: log10 probability of each symbol after each context, ``first[d]`` is the first row of depth d."""

    goes: list[np.ndarray]
    first: list[int]
    logs: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each (lower-cased) text with its end."""
        depth = len(self.goes)
        buf, spans = symbols(texts, depth)
        m = len(buf) - depth
        at, state = np.zeros(m, dtype=np.int32), np.zeros(m, dtype=np.int32)
        for d, go in enumerate(self.goes):
            at = go[at, buf[depth - 1 - d:depth - 1 - d + m]]
            state = np.where(at < (self.first[d + 2] - self.first[d + 1]), at + self.first[d + 1], state)
        p = np.concatenate([[0.0], np.cumsum(self.logs[state, buf[depth:]], dtype=np.float64)])
        begin = spans[:, 0] - depth
        return p[begin + spans[:, 1]] - p[begin]


@dataclass
class Level:
    """The kept contexts of one depth: sorted keys (latest byte lowest) and the symbol counts as (context number, symbol, n)."""

    keys: np.ndarray
    context: np.ndarray
    symbol: np.ndarray
    n: np.ndarray

    def dense(self, lo: int, hi: int, owner: np.ndarray | None = None) -> np.ndarray:
        """Counts of contexts lo..hi, a row of 256 each; with ``owner`` summed by the owner of each context instead."""
        at = self.context if owner is None else owner[self.context]
        use = (at >= lo) & (at < hi)
        flat = (at[use] - lo) * 256 + self.symbol[use]
        return np.bincount(flat, self.n[use], minlength=(hi - lo) * 256).reshape(hi - lo, 256)


def weigh(levels: list[Level], block: int = 4096) -> ContextTree:
    """Weights the contexts of ``levels[d]`` (d bytes each), a block of contexts in memory at a time; for a corpus of one process, and the
    tests hold the buckets against it."""
    depth = len(levels) - 1
    half = np.log(0.5)
    size = [len(v.keys) for v in levels]
    parent = [None] + [np.searchsorted(levels[d - 1].keys, levels[d].keys & ((1 << (8 * (d - 1))) - 1)) for d in range(1, depth + 1)]
    blocks = lambda d: [(lo, min(lo + block, size[d])) for lo in range(0, size[d], block)]

    def left_over(d: int, lo: int, hi: int, own: np.ndarray) -> np.ndarray:
        """Counts of the contexts' children that are not kept."""
        return own - levels[d + 1].dense(lo, hi, parent[d + 1]) if d < depth and size[d + 1] else own

    stop, below = [np.ones((n, 256), dtype=np.float32) for n in size], None
    for d in range(depth, -1, -1):
        weighted = np.empty((size[d], 256))
        order = np.argsort(parent[d + 1], kind="stable") if d < depth else np.empty(0, dtype=np.int64)
        for lo, hi in blocks(d):
            counts = levels[d].dense(lo, hi)
            own = _log_kt(*_bits(counts))
            weighted[lo:hi] = own
            kids = order[slice(*np.searchsorted(parent[d + 1][order], [lo, hi]))] if len(order) else order
            if not len(kids):
                continue
            mine, first = np.unique(parent[d + 1][kids], return_index=True)
            split = half + np.add.reduceat(below[kids], first) + _log_kt(*_bits(left_over(d, lo, hi, counts)[mine - lo]))
            own = half + own[mine - lo]
            weighted[mine] = np.logaddexp(own, split)
            stop[d][mine] = np.exp(own - weighted[mine])
        below = weighted
    del below, weighted
    logs = np.empty((sum(size), 256), dtype=np.float32)
    first = np.concatenate([[0], np.cumsum(size)]).tolist()
    s = np.arange(256)
    reach, mixed, up = (np.full((size[0], 256), x, dtype=np.float32) for x in (1.0, 0.0, 0.5))
    for d in range(depth + 1):
        if d:  # what reaches a context past the shorter ones, what they have decided, and the nearest estimate
            mixed = (mixed + reach * stop[d - 1] * up)[parent[d]]
            reach, up = (reach * (1 - stop[d - 1]))[parent[d]], up[parent[d]]
        for lo, hi in blocks(d):
            counts = levels[d].dense(lo, hi)
            n0, n1 = _bits(counts)
            kt = np.where(n0 + n1 > 0, (n1 + 0.5) / (n0 + n1 + 1), up[lo:hi])  # what was never seen here is taken from the shorter context
            up[lo:hi] = kt
            r0, r1 = _bits(left_over(d, lo, hi, counts))
            other = np.where(r0 + r1 > 0, (r1 + 0.5) / (r0 + r1 + 1), kt)
            one = np.clip(mixed[lo:hi] + reach[lo:hi] * (stop[d][lo:hi] * kt + (1 - stop[d][lo:hi]) * other), 1e-12, 1 - 1e-9)
            log = np.zeros((hi - lo, 256))
            for j in range(8):
                p = one[:, (1 << j) + (s >> (8 - j))]
                log += np.log10(np.where((s >> (7 - j)) & 1, p, 1 - p))
            logs[first[d] + lo:first[d] + hi] = log
    goes = []
    for d in range(depth):
        go = np.full((size[d] + 1, 256), size[d + 1], dtype=np.int32)
        go[parent[d + 1], (levels[d + 1].keys >> (8 * d)) & 255] = np.arange(size[d + 1])
        goes.append(go)
    return ContextTree(goes, first, logs)


def _small(shift: float) -> np.ndarray:
    return _log_gamma(np.arange(SMALL) + shift)


_HALF, _ONE = _small(0.5), _small(1.0)


def _log_kt_counts(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """``_log_kt`` of integers; most are small."""

    def of(n, table, shift):
        out = table[np.minimum(n, SMALL - 1)]
        big = np.flatnonzero(n >= SMALL)
        out[big] = _log_gamma(n[big] + shift)
        return out

    return of(n0, _HALF, 0.5) + of(n1, _HALF, 0.5) - np.log(np.pi) - of(n0 + n1, _ONE, 1.0)


@dataclass
class Nodes:
    """Binary nodes of one depth that ``j`` bits of the symbol lead to: the first gram of each, the node of each gram, zeros and ones, and
    (once weighted) the weight to stop here."""

    first: np.ndarray
    at: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    stop: np.ndarray | None = None

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, j: int) -> Nodes:
        prefix = keys >> (8 - j)
        new = np.ones(len(prefix), dtype=bool)
        new[1:] = prefix[1:] != prefix[:-1]
        first = np.flatnonzero(new)
        ones = np.add.reduceat(n * ((keys >> (7 - j)) & 1), first)
        return cls(first, np.cumsum(new) - 1, np.add.reduceat(n, first) - ones, ones)

    def weigh(self, split: np.ndarray | None) -> np.ndarray:
        """log P_w; ``split``: sum of the children's, None at full depth."""
        own = _log_kt_counts(self.n0, self.n1)
        if split is None:
            self.stop = np.ones(len(own))
            return own
        both = np.log(0.5) + np.logaddexp(own, split)
        self.stop = np.exp(np.log(0.5) + own - both)
        return both

    def down(self, mixed: np.ndarray, reach: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From what the shorter contexts have decided, what passes them and their estimate to the same after these contexts."""
        kt = (self.n1 + 0.5) / (self.n0 + self.n1 + 1)
        p = np.where(self.n0 + self.n1 > 0, mixed + reach * kt, p)  # what was never seen here is taken from the shorter context
        return mixed + reach * self.stop * kt, reach * (1 - self.stop), p


@dataclass
class Subtree:
    """Distinct (context, symbol) grams of the depths ``low`` to ``depth`` with counts; ``up[d]``: the gram of depth d - 1 of each one of depth d."""

    low: int
    depth: int
    keys: dict[int, np.ndarray]
    n: dict[int, np.ndarray]
    up: dict[int, np.ndarray]

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, low: int, depth: int) -> Subtree:
        all_keys, all_n, up = {depth: keys}, {depth: n}, {}
        for d in range(depth, low, -1):
            all_keys[d - 1], up[d] = np.unique(shorter(all_keys[d]), return_inverse=True)
            all_n[d - 1] = np.bincount(up[d], all_n[d], len(all_keys[d - 1])).astype(np.int64)
        return cls(low, depth, all_keys, all_n, up)

    def weigh(self, j: int, split: np.ndarray | None = None) -> tuple[dict[int, Nodes], np.ndarray]:
        """The nodes of all depths, and log P_w of those of the lowest; ``split``: what is below the full depth here."""
        nodes, w = {}, None
        for d in range(self.depth, self.low - 1, -1):
            nodes[d] = Nodes.of(self.keys[d], self.n[d], j)
            if d < self.depth:
                split = np.bincount(self.parents(nodes, d + 1), w, len(nodes[d].first))
            w = nodes[d].weigh(split)
        return nodes, w

    def parents(self, nodes: dict[int, Nodes], d: int) -> np.ndarray:
        return nodes[d - 1].at[self.up[d][nodes[d].first]]

    def down(self, nodes: dict[int, Nodes], state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """``state`` of the nodes of the lowest depth, carried to those of the full one."""
        for d in range(self.low, self.depth + 1):
            if d > self.low:
                up = self.parents(nodes, d)
                state = tuple(x[up] for x in state)
            state = nodes[d].down(*state)
        return state


def shorter(keys: np.ndarray) -> np.ndarray:
    """Grams without the earliest byte of their context."""
    return ((keys >> 16) << 8) | (keys & 255)


def node_keys(keys: np.ndarray, j: int) -> np.ndarray:
    """Context and binary node (1..255; 256 and more: the symbol itself) of grams."""
    return ((keys >> 8) << 9) | (1 << j) | ((keys & 255) >> (8 - j))


def opened(parts: list[dict]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket: first gram of each chunk's part, distinct grams, counts, and the place of every part's grams among them."""
    starts = np.cumsum([0, *[x["n"] for x in parts]]).tolist()

    def column(name: str) -> np.ndarray:
        out = np.empty(starts[-1], dtype=np.int64)
        for x, i, k in zip(parts, starts, starts[1:]):
            out[i:k] = unpacked(x[name], x["n"])
        return out

    keys = column("keys")
    order = np.argsort(keys)
    keys = keys[order]
    first = firsts(keys)
    keys = keys[first]
    n = np.add.reduceat(column("counts")[order], first)
    at = np.empty(len(order), dtype=np.int32)
    at[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(order)))
    return starts, keys, n, at


def subtrees(keys: np.ndarray, depth: int, most: int = 1 << 18) -> Iterator[slice]:
    """Sorted grams in runs of whole subtrees, of about ``most`` grams or one subtree; subtrees do not depend on each other."""
    first = firsts(keys >> (8 * (depth - min(TOP, depth - 1))))
    cuts = np.append(first, len(keys))
    i = 0
    while i < len(first):
        k = max(i + 1, int(np.searchsorted(cuts, cuts[i] + most, side="right")) - 1)
        yield slice(int(cuts[i]), int(cuts[k]))
        i = k


def bottom(keys: np.ndarray, n: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, n, w) that a bucket adds to the short contexts: counts of symbols, log P_w below binary nodes."""
    top = min(TOP, depth - 1)
    node, count, weight = [], [], []
    for part in subtrees(keys, depth):
        t = Subtree.of(keys[part], n[part], top + 1, depth)
        own = shorter(t.keys[top + 1])
        node.append(node_keys(own, 8))
        count.append(t.n[top + 1])
        weight.append(np.zeros(len(own)))
        for j in range(8):
            nodes, w = t.weigh(j)
            node.append(node_keys(own[nodes[top + 1].first], j))
            count.append(np.zeros(len(w), dtype=np.int64))
            weight.append(w)
    node, at = np.unique(np.concatenate(node), return_inverse=True)
    return node, np.bincount(at, np.concatenate(count)).astype(np.int64), np.bincount(at, np.concatenate(weight))


def weigh_top(node: np.ndarray, n: np.ndarray, w: np.ndarray, depth: int) -> list[tuple[np.ndarray, tuple[np.ndarray, ...]]]:
    """For each bit the nodes of the longest short contexts, and what they hand down, from the sums of all buckets."""
    order = np.argsort(node)
    node, n, w = node[order], n[order], w[order]
    leaf = (node & 256) > 0
    top = min(TOP, depth - 1)
    t = Subtree.of(((node[leaf] >> 9) << 8) | (node[leaf] & 255), n[leaf], 0, top)
    out = []
    for j in range(8):
        own = node[(node & 511) >> j == 1]
        first = Nodes.of(t.keys[top], t.n[top], j).first
        nodes, _ = t.weigh(j, w[np.searchsorted(node, node_keys(t.keys[top][first], j))])
        size = len(nodes[0].first)
        out.append((own, t.down(nodes, (np.zeros(size), np.ones(size), np.full(size, 0.5)))))
    return out


def answer(keys: np.ndarray, n: np.ndarray, depth: int, tops: list[tuple[np.ndarray, tuple[np.ndarray, ...]]]) -> np.ndarray:
    """log10 probability of each gram's symbol after its context."""
    low = min(TOP, depth - 1) + 1
    logs = np.zeros(len(keys))
    for part in subtrees(keys, depth):
        t = Subtree.of(keys[part], n[part], low, depth)
        for j, (own, state) in enumerate(tops):
            nodes, _ = t.weigh(j)
            up = np.searchsorted(own, node_keys(shorter(t.keys[low][nodes[low].first]), j))
            p = np.clip(t.down(nodes, tuple(x[up] for x in state))[2], 1e-12, 1 - 1e-9)[nodes[depth].at]
            logs[part] += np.log10(np.where((keys[part] >> (7 - j)) & 1, p, 1 - p))
    return logs


def gather(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(bucket, parts): the chunks' distinct grams and training counts, a row for each bucket."""

    def ask(t: pa.Table) -> pa.Table:
        held = opened_rows(t)
        key, size = asked([x.as_py().lower() for x in held.column("text")], depth)
        key <<= 1
        key |= np.repeat(held.column("training").to_numpy(), size)
        key.sort()
        first = firsts(key >> 1)
        keys, n = key[first] >> 1, np.add.reduceat((key & 1), first)
        del key
        order, own = bucket_order(keys, depth, buckets)
        keys, n = keys[order], n[order]
        cuts = [*np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])).tolist(), len(own)]
        spans = list(zip(cuts, cuts[1:]))
        cols = ([int(own[a]) for a, _ in spans], [t.column("chunk")[0].as_py()] * len(spans), [b - a for a, b in spans], [packed(keys[a:b]) for a, b in spans],
                [packed(n[a:b]) for a, b in spans])
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table({k: pa.array(c, type=x) for k, c, x in zip(("bucket", "chunk", "n", "keys", "counts"), cols, kinds, strict=True)})

    made = dealt(rows.select("chunk", "training", "text")).groupBy("chunk").applyInArrow(ask, "bucket int, chunk long, n long, keys binary, counts binary")
    return checkpoint_table(made.groupBy("bucket").agg(F.collect_list(F.struct("chunk", "n", "keys", "counts")).alias("parts")))


def answers(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """(chunk, bucket, logs): log10 probabilities (float32) of each chunk's grams of a bucket, in the order of ``asked``."""
    spark = rows.sparkSession
    table = gather(rows, depth, buckets)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for parts in b.column("parts"):
                _, keys, n, _ = opened(parts.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in bottom(keys, n, depth)], names=["node", "n", "w"])

    short = table.mapInArrow(sums, "node long, n long, w double").groupBy("node").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).toPandas()
    tops = spark.sparkContext.broadcast(weigh_top(*[short[c].to_numpy() for c in ("node", "n", "w")], depth))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, parts in zip(b.column("bucket").to_pylist(), b.column("parts"), strict=True):
                parts = parts.as_py()
                starts, keys, n, at = opened(parts)
                logs = answer(keys, n, depth, tops.value).astype(np.float32)[at]
                yield pa.RecordBatch.from_arrays([pa.array([x["chunk"] for x in parts], pa.int64()), pa.array([bucket] * len(parts), pa.int32()),
                                                  pa.array([logs[i:k].tobytes() for i, k in zip(starts, starts[1:])], pa.binary())], names=["chunk", "bucket", "logs"])

    return table.mapInArrow(run, "chunk long, bucket int, logs binary")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 6, word_share: float = 2.0**-20,
          chunk: int = 8 << 20) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte of each row.

    ``training`` is a condition on the columns of ``docs``; ``depth``: 1 to 6 bytes."""
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6 bytes")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    chunks = max(1, -(-size // chunk))
    buckets = max(16, chunks // 4)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("long"))
    words = checkpoint_table(count_words(rows.filter("training")))
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    below = n + 0.1 * (v + 1)
    log = lambda c: np.log10((c + 0.1) / below)
    frequent = words.filter(F.col("n") >= word_share * n)
    known = spark.sparkContext.broadcast({bytes(t): float(log(c)) for t, c in frequent.toPandas().itertuples(index=False)})
    names = ("row", "doc_id", "training", "n_bytes", "n_tokens", "n_known", "base", "score", "token", "n")
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    kinds = ("long", id_kind, "boolean", "long", "long", "long", "double", "double", "binary", "long")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        table, left = known.value, opened_rows(left)
        types = (pa.int64(), left.schema.field("doc_id").type, pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64(), pa.binary(), pa.int64())
        texts = [t.as_py().lower() for t in left.column("text")]
        key, size = asked(texts, depth)
        keys = np.sort(key)
        keys = keys[firsts(keys)]
        order, _ = bucket_order(keys, depth, buckets)
        logs = np.empty(len(keys), dtype=np.float32)
        logs[order] = np.frombuffer(b"".join(x.as_py() for x in right.sort_by("bucket").column("logs")), dtype=np.float32)
        each = np.empty(len(key), dtype=np.float32)
        for part, at in places(keys, key):
            each[part] = logs[at]
        scores = np.add.reduceat(each, np.cumsum(size) - size, dtype=np.float64)
        del key, keys, logs, order, each
        row = left.column("chunk")[0].as_py() << 32
        head: list[list] = [[], [], [], [], []]
        rare: list[list] = [[], [], []]
        for t in texts:
            c = Counter(t.split())
            base, n_known, n_tokens = 0.0, 0, 1 + sum(c.values())
            c[END_TOKEN] = 1
            for w, k in c.items():
                if w in table:
                    base += k * table[w]
                    n_known += k
                else:
                    rare[0].append(row)
                    rare[1].append(w)
                    rare[2].append(k)
            for col, x in zip(head, (row, len(t), n_tokens, n_known, base), strict=True):
                col.append(x)
            row += 1
        k, m = len(texts), len(rare[0])
        cols = (head[0], left.column("doc_id"), left.column("training"), *head[1:], scores, pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()))
        heads = pa.table({a: c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=t) for a, c, t in zip(names, cols, types, strict=True)})
        cols = (pa.array(rare[0], pa.int64()), *[pa.nulls(m, t) for t in types[1:8]], pa.array(rare[1], pa.binary()), pa.array(rare[2], pa.int64()))
        return pa.concat_tables([heads, pa.table(dict(zip(names, cols, strict=True)))])

    scored = dealt(rows).groupBy("chunk").cogroup(answers(rows, depth, buckets).groupBy("chunk"))
    made = checkpoint_table(scored.applyInArrow(run, ", ".join(f"{a} {k}" for a, k in zip(names, kinds, strict=True))))
    rare = made.filter("token is not null").select("row", "token", F.col("n").alias("times"))
    rare = rare.join(words.filter(F.col("n") < word_share * n), "token", "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10((c + F.lit(0.1)) / F.lit(float(below)))).alias("rare_base"),
                                   F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    out = made.filter("token is null").drop("token", "n").join(rare, "row", "left")
    return out.select("doc_id", "training", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                      F.lit(int(n)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score",
                      "n_bytes", (-F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
