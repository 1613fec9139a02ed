"""Approximate nearest neighbours by an adaptive dimension scan.

A bounded sample of rows fits the coarse lists (k-means) and tells how many of
them hold the wanted share of a query's neighbours. All rows are rotated by a fixed random rotation and filed under their nearest
centre; a long list is cut into parts of about ``block`` rows, so a list never
meets in one task. A query probes that many nearest lists, and more until they hold
``k`` rows besides its own. In each part
the rotated vectors are read in column blocks: after d of D dimensions the
partial distance, scaled by D/d, is tested against the k-th distance known so
far times ``(1 + slack / sqrt(d))``; a candidate that fails is abandoned. The
survivors' distances are computed on the original vectors in double precision.

Defined results: see ``vectors.valid``; zero vectors take no part either; equal
distances go by smaller id; repeated rows are candidates each time, a repeated
query row is answered once; only vectors of one length are compared (the sample's
most frequent one files the lists; other lengths share one list of their own);
other columns are ignored; empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm import vectors as V
from punctuo.operators.evaluate import hash_sample
from punctuo.operators.util import checkpoint_table

FOUND = "query_id long, query_key long, vec_id long, copies long, score double"


def fit_centres(x: np.ndarray, n_lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means; an empty list keeps its centre."""
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))]
    centres = x[:n_lists].copy()
    for _ in range(rounds):
        near = nearest(x, centres, 1)[:, 0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first."""
    out = []
    for part in np.array_split(x, max(1, len(x) // 4096)):
        d = (centres**2).sum(1) - 2 * part @ centres.T
        top = np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(centres) else np.tile(np.arange(len(centres)), (len(part), 1))
        out.append(np.take_along_axis(top, np.argsort(np.take_along_axis(d, top, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def probes_for(recall: float, x: np.ndarray, centres: np.ndarray, k: int, asked: int = 256) -> int:
    """Lists to probe so that a share ``recall`` of the true neighbours inside the sample ``x`` is in one of them."""
    q = x[:asked]
    order = nearest(q, centres, len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], axis=1)
    d = (x**2).sum(1) - 2 * q @ x.T
    d[np.arange(len(q)), np.arange(len(q))] = np.inf
    near = np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k] if len(x) > 1 else np.zeros((len(q), 1), dtype=np.int64)
    own = nearest(x, centres, 1)[:, 0]
    return int(np.quantile(np.take_along_axis(place, own[near], 1), recall, method="higher")) + 1


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]


def scan(rotated: np.ndarray, q: np.ndarray, exact, own: np.ndarray, k: int, columns: int, slack: float) -> np.ndarray:
    """Rows whose distance to the rotated query ``q`` was computed to the end."""
    dims = rotated.shape[1]
    first = ((rotated[:, :columns] - q[:columns]) ** 2).sum(1)
    first[own] = np.inf
    lead = np.argpartition(first, k - 1)[:k] if k < len(first) else np.arange(len(first))
    limit = np.sort(exact(lead))[-1] ** 2 if len(lead) >= k else np.inf
    rows, part, d = np.arange(len(first)), first, columns
    while True:
        keep = part * (dims / d) <= (1 + slack / np.sqrt(d)) ** 2 * limit if d < dims else part <= limit * (1 + 1e-9)
        rows, part = rows[keep], part[keep]
        if d >= dims or not len(rows):
            return np.union1d(rows, lead)  # the first ones may have been abandoned by the test too
        to = min(dims, d + columns)
        part = part + ((rotated[rows, d:to] - q[d:to]) ** 2).sum(1)
        d = to


def _group(k: int, columns: int, slack: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in FOUND.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.float64()]
        cols: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            x, asked = V.matrix(left, np.float64), V.matrix(right, np.float64)
            turn = rotation(x.shape[1])
            turned, turned_q = x @ turn, asked @ turn
            ids, copies = left.column("vec_id").to_numpy(), left.column("copies").to_numpy()
            for i, (query, key) in enumerate(zip(right.column("vec_id").to_pylist(), right.column("query_key").to_pylist(), strict=True)):
                far = lambda rows, q=asked[i]: np.sqrt(((x[rows] - q) ** 2).sum(1))
                own = np.arange(*np.searchsorted(ids, [query, query + 1]))
                kk = min(k, len(ids) - len(own))
                if not kk:
                    continue
                rows = scan(turned, turned_q[i], far, own, kk, columns, slack)
                rows = rows[~np.isin(rows, own)]
                d = far(rows)
                pick = np.lexsort((rows, d))[:k]
                rows, d = rows[pick], d[pick]
                for c, v in zip(cols, ([query] * len(rows), [key] * len(rows), ids[rows], copies[rows], d), strict=True):
                    c.extend(v)
        return pa.table({n: pa.array(c, type=t) for n, c, t in zip(names, cols, kinds, strict=True)})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", max_fit: int = 20_000,
           max_lists: int = 1024, recall: float = 0.96, columns: int = 16, slack: float = 2.1, block: int = 4096,
           query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the nearest rows found for each row of ``queries``."""
    spark = vectors.sparkSession
    rows = checkpoint_table(V.valid(vectors, id_col, vec_col, keep_zero=False))
    n = rows.count()
    sample = hash_sample(rows.select("vec_id", "vec"), "vec_id", max_fit).toPandas()["vec"]
    dims = int(sample.map(len).mode().iloc[0]) if len(sample) else 0
    x = np.stack([v for v in sample if len(v) == dims]).astype(np.float64) if len(sample) else np.zeros((0, 0))
    n_lists = max(1, min(max_lists, round(n**0.5 / 4), len(x)))
    fitted = fit_centres(x, n_lists) if len(x) else x
    probes = probes_for(recall, x, fitted, k) if len(x) else 1
    centres = spark.sparkContext.broadcast(fitted)

    def lists(count: int, held: np.ndarray | None = None):
        """The ``count`` nearest lists; with ``held`` (rows of each list) more until they hold ``least`` rows."""

        @F.pandas_udf("array<int>")
        def run(vec: pd.Series, least: pd.Series) -> pd.Series:
            same = vec.map(len).to_numpy() == dims
            out = [np.array([-1], dtype=np.int32)] * len(vec)
            if same.any():
                x = np.stack(vec[same].to_list())
                near = list(nearest(x, centres.value, count).astype(np.int32))
                if held is not None:
                    need = least[same].to_numpy()
                    for i in np.flatnonzero([held[lists].sum() < n for lists, n in zip(near, need, strict=True)]):
                        order = nearest(x[i:i + 1], centres.value, len(centres.value))[0].astype(np.int32)
                        near[i] = order[:max(count, np.searchsorted(np.cumsum(held[order]), need[i]) + 1)]
                for i, row in zip(np.flatnonzero(same), near, strict=True):
                    out[i] = row
            return pd.Series(out, dtype=object)

        return run("vec", "least")

    filed = checkpoint_table(rows.select("vec_id", "vec", "copies", F.lit(0).cast("long").alias("least")).select(
        "vec_id", "vec", "copies", F.size("vec").alias("dims"), lists(1)[0].alias("list")))
    held = np.zeros(n_lists, dtype=np.int64)
    for r in filed.filter(F.col("dims") == dims).groupBy("list").agg(F.sum("copies").alias("n")).collect():
        held[r["list"]] = r["n"]
    own = filed.filter(F.col("dims") == dims).groupBy("vec_id").agg(F.sum("copies").alias("own"))
    ask = V.valid(queries, id_col, vec_col, keep_zero=False).withColumn("query_key", F.xxhash64("vec")).join(own, "vec_id", "left")
    ask = ask.withColumn("least", F.coalesce("own", F.lit(0)) + F.lit(k))
    ask = checkpoint_table(ask.select("vec_id", "vec", "query_key", F.size("vec").alias("dims"), F.explode(lists(probes, held)).alias("list")))
    keys = ["dims", "list", "part", "asked"]
    parts = filed.groupBy("dims", "list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    sizes = parts.join(ask.groupBy("dims", "list").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("asks")), ["dims", "list"])
    sizes = checkpoint_table(sizes.coalesce(1))  # a row for each list and length
    left = filed.join(sizes, ["dims", "list"]).select("vec_id", "vec", "copies", "dims", "list", V.spread(F.col("parts")).alias("part"),
                                                      V.over(F.col("asks")).alias("asked"))
    right = ask.join(sizes, ["dims", "list"]).select("vec_id", "query_key", "vec", "dims", "list", V.spread(F.col("asks")).alias("asked"),
                                                     V.over(F.col("parts")).alias("part"))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_group(k, columns, slack), FOUND)
    return V.best(found, k, [F.asc("score")]).select("query_id", "rank", "vec_id", "score")
