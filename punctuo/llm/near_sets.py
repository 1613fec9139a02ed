"""Sets of word shingles: hashes, MinHash values, and exact verification in classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm.graph import components
from punctuo.operators.util import checkpoint_table

SHINGLE = 5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of ``text``."""
    b = np.frombuffer(text, dtype=np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    up, down = _powers(len(b) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], dtype=np.uint64)])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct hashes (sorted) of all runs of five words; of all words together if there are fewer."""
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = mix(out * np.uint64(3) + words[j:len(words) - n + 1 + j])
    return np.unique(out)


def multipliers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def minhash(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value (its upper 32 bits) of the set under each hash function; in blocks of bounded size."""
    if not len(s):
        return np.full(len(a), np.iinfo(np.uint32).max, dtype=np.uint32)
    parts = [(s[i:i + 4096, None] * a + b).min(0) for i in range(0, len(s), 4096)]
    return (np.minimum.reduce(parts) >> np.uint64(32)).astype(np.uint32)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        if last is not None and last != tuple(c[0] for c in cols):
            new[0] = True
        cuts = [*np.flatnonzero(new), b.num_rows]
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(b.slice(at, cut - at))
            if cut < b.num_rows and held:
                yield pa.Table.from_batches(held)
                held = []
            at = cut
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def by_group(df: DataFrame, keys: list[str], run: Callable[[pa.Table], pa.RecordBatch | None], schema: str, order: Sequence[str] = ()) -> DataFrame:
    """``run`` on every group of bounded size, its rows sorted by ``order``; many small groups share a task and an Arrow batch."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = [], 0
        for t in groups(batches, keys):
            r = run(t)
            if r is not None and r.num_rows:
                out.append(r)
                rows += r.num_rows
                if rows >= 4096:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out, rows = [], 0
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order).mapInArrow(part, schema)


def overlaps(sets: list[np.ndarray], cells: int = 20_000_000) -> np.ndarray:
    """Sizes of all intersections, from a 0/1 matrix in column blocks of bounded size."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True) if len(owner) else (np.empty(0), np.empty(0, dtype=np.int64))
    shared = np.bincount(column, minlength=len(values)) > 1  # the others are in no intersection of two
    place = np.cumsum(shared) - 1
    use = shared[column] if len(owner) else np.empty(0, dtype=bool)
    owner, column = owner[use], place[column[use]]
    out = np.zeros((m, m), dtype=np.float64)
    width = max(1, cells // max(1, m))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((m, min(width, int(shared.sum()) - at)), dtype=np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        out += x @ x.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return np.rint(out).astype(np.int64)


def roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's component in a boolean matrix."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            front = np.zeros(len(linked), dtype=bool)
            front[i] = True
            while front.any():
                root[front] = i
                front = linked[front].any(0) & (root < 0)
    return root


def verify(candidates: DataFrame, sets: DataFrame, threshold: float = 0.8, block: int = 256) -> tuple[DataFrame, DataFrame]:
    """Exact links inside candidate classes.

    ``candidates``: (node, root); ``sets``: (node, weight, shingles as bytes).
    A class is cut into blocks, every pair of blocks is one group of bounded
    size, so classes of any size spread over tasks. Returns (node, links), the
    weights of all nodes linked to it, and (node, root), the components by
    exact links of the nodes that have any."""
    sized = candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    c = candidates.join(sized, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    c = c.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    c = c.select("root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "weight", "shingles")

    def run(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        nodes, own, weight = (t.column(k).to_numpy() for k in ("node", "own", "weight"))
        s = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in t.column("shingles")]
        both = overlaps(s)
        n = np.diag(both)
        linked = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        root = roots(linked)
        if t.column("low")[0].as_py() != t.column("high")[0].as_py():  # links inside a block are counted in the block's own group
            linked &= own[:, None] != own[None, :]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array((linked * weight[None, :]).sum(1).astype(np.int64)), pa.array(nodes[root])],
                                          names=["node", "links", "root"])

    found = checkpoint_table(by_group(c, ["root", "low", "high"], run, "node long, links long, root long", ["node"]))
    links = found.groupBy("node").agg(F.sum("links").alias("links")).filter("links > 0")
    return links, components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
