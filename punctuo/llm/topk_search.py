"""Exact top-k by integer inner product over an impact-ordered index.

Rows are dealt into blocks of candidates and blocks of queries; every pair of
blocks is one group. Per group, each dimension's postings are ordered by impact
(the component above the block's smallest, or below its largest for a negative
query weight) and cut into quantised segments. A query takes the segments of
all dimensions by descending quantised impact and adds them to accumulators.
After each round nothing left can add more than the round's bound per open
dimension, so ``accumulator + bound * open dimensions`` limits every candidate.
The best accumulators are scored exactly, and the scan ends once few candidates
can still reach the k-th of these; exactly those are rescored. The result is
exact: a candidate is only left out on that proof.

Defined results: see ``vectors.valid`` for rows that take no part; equal scores
go by smaller id; a repeated row is a candidate each time, a repeated query row
is answered once; vectors of other lengths are never compared; scores are exact
while they fit in a long; other columns are ignored; empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm import vectors as V
from punctuo.operators.util import checkpoint_table

FOUND = "query_id long, query_key long, vec_id long, copies long, score long"
LEVELS = 64
#: Rounds end where the share of the largest impact falls to these values; the last takes all.
ROUNDS = (0.6, 0.45, 0.33, 0.22, 0.12, 0.0)


class ImpactIndex:
    """The postings of one block of integer vectors, rows by ascending id."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.low, self.high = vectors.min(0), vectors.max(0)
        self.range = (self.high - self.low).astype(np.float64)
        self.order = np.argsort(-vectors, axis=0, kind="stable").T.copy()  # by dimension, largest first
        sorted_up = np.take_along_axis(vectors, self.order.T, axis=0).T - self.low[:, None]
        self.up = sorted_up.astype(np.float64)  # impacts for positive weights, in posting order
        step = np.maximum(self.range, 1)[:, None] / LEVELS
        level = np.minimum((self.up / step).astype(np.int64), LEVELS - 1)
        # postings of levels >= l are the first ``until[d, l]`` ones; for negative weights the order and levels turn round
        self.until = np.stack([(level >= lv).sum(1) for lv in range(LEVELS + 1)], axis=1)
        down = np.minimum(((self.range[:, None] - self.up) / step).astype(np.int64), LEVELS - 1)
        self.until_down = np.stack([(down >= lv).sum(1) for lv in range(LEVELS + 1)], axis=1)

    def search(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of the k best, without the rows ``own``."""
        n = len(self.vectors)
        k = min(k, n - len(own))
        if k <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        dims = np.flatnonzero((q != 0) & (self.range > 0))
        weight = np.abs(q[dims]).astype(np.float64)
        top = weight * self.range[dims]
        base = float(np.where(q > 0, q * self.low, q * self.high).sum())
        acc, seen = np.zeros(n), np.zeros(n)
        done = np.zeros(len(dims), dtype=np.int64)
        alive = np.arange(n)
        for share in ROUNDS if len(dims) else ():
            # levels whose every impact is above the round's limit; what is left stays below ``bound``
            level = np.clip(np.ceil(share * top.max() / top * LEVELS), 0, LEVELS).astype(np.int64) if share else np.zeros(len(dims), dtype=np.int64)
            ids, add = [], []
            for i, d in enumerate(dims):
                until = int((self.until if q[d] > 0 else self.until_down)[d, level[i]])
                if until > done[i]:
                    if q[d] > 0:
                        ids.append(self.order[d, done[i]:until])
                        add.append(self.up[d, done[i]:until] * weight[i])
                    else:
                        ids.append(self.order[d, n - until:n - done[i]])
                        add.append((self.range[d] - self.up[d, n - until:n - done[i]]) * weight[i])
                    done[i] = until
            if ids:
                at = np.concatenate(ids)
                acc += np.bincount(at, np.concatenate(add), n)
                seen += np.bincount(at, minlength=n)
            bound = float((level / LEVELS * top).max()) if share else 0.0
            acc[own] = -np.inf
            lead = np.argpartition(-acc, k - 1)[:k]
            floor = self._exact(lead, q).min()
            alive = np.flatnonzero(base + acc + bound * (len(dims) - seen) >= floor - 0.5)  # scores are integers
            if len(alive) <= max(4 * k, n // 64):
                break
        alive = alive[~np.isin(alive, own)]
        scores = self._exact(alive, q)
        pick = np.lexsort((alive, -scores))[:k]
        return alive[pick], scores[pick]

    def _exact(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        return self.vectors[rows] @ q


def _group(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in FOUND.split(", ")]
        cols: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            index = ImpactIndex(V.matrix(left, np.int64))
            ids, copies = left.column("vec_id").to_numpy(), left.column("copies").to_numpy()
            for query, key, q in zip(right.column("vec_id").to_pylist(), right.column("query_key").to_pylist(), V.matrix(right, np.int64), strict=True):
                rows, scores = index.search(q, np.arange(*np.searchsorted(ids, [query, query + 1])), k)
                for c, v in zip(cols, ([query] * len(rows), [key] * len(rows), ids[rows], copies[rows], scores), strict=True):
                    c.extend(v)
        return pa.table({n: pa.array(c, type=pa.int64()) for n, c in zip(names, cols, strict=True)})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024,
          block: int = 4096, query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of floor(scale * x) for each row of ``queries``.

    A candidate with the query's own id takes no part."""
    whole = lambda x: F.floor(F.lit(float(scale)) * x)
    cand = checkpoint_table(V.valid(vectors, id_col, vec_col, whole, "long"))
    ask = checkpoint_table(V.valid(queries, id_col, vec_col, whole, "long").withColumn("query_key", F.xxhash64("vec")))
    parts, asks = max(1, -(-cand.count() // block)), max(1, -(-ask.count() // query_block))
    keys = ["dims", "part", "asked"]
    left = cand.select("vec_id", "vec", "copies", F.size("vec").alias("dims"), V.spread(parts).alias("part"), V.over(asks).alias("asked"))
    right = ask.select("vec_id", "query_key", "vec", F.size("vec").alias("dims"), V.spread(asks).alias("asked"), V.over(parts).alias("part"))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_group(k), FOUND)
    return V.best(found, k, [F.desc("score")]).select("query_id", "rank", "vec_id", "score")
