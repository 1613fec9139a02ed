"""Vector searches against brute force, with nulls, ties, copies and odd lengths."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctuo.llm import ann_scan, topk_search
from punctuo.llm.workers import importable


@pytest.fixture(scope="module")
def vectors(spark):
    importable(spark)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 12) + 2 * (i % 4)).round(1).tolist(), "x") for i in range(600)]
    rows[50] = (50, rows[100][1], "x")
    rows += [(900, None, "x"), (901, [1.0, None], "x"), (902, [float("nan")] * 12, "x"), (903, [0.0] * 12, "x"), (None, rows[3][1], "x"), (1000, [1.0, 2.0, 3.0], "x"),
             (1001, [1.0, 2.0, 4.0], "x"), (904, [float("inf")] + [0.0] * 11, "x"), (905, [], "x")]
    rows += [(2000 + i, rows[200][1], "x") for i in range(300)]  # a very common vector
    rows.append(rows[10])  # a repeated row
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(3)


def usable(rows, zero):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))
    return [(r.vec_id, r.embedding) for r in rows if r.vec_id is not None and ok(r.embedding)]


def test_top_k_is_exact(spark, vectors):
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in usable(vectors.collect(), True)]
    got = topk_search.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), block=128, query_block=4).collect()
    want = []
    for q, v in {(q, tuple(v)) for q, v in rows if q % 100 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for i, x in rows if i != q and len(x) == len(v))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    none = vectors.filter("vec_id < 0")
    assert topk_search.top_k(none, none).collect() == []


def test_nearest_recall_and_scores(vectors):
    rows = usable(vectors.collect(), False)
    got = ann_scan.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), block=128, query_block=4).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hit = total = 0
    vec = {}
    for i, v in rows:
        vec.setdefault(i, v)
    for q, v in {(q, tuple(v)) for q, v in rows if q % 100 == 0}:
        best = sorted((math.dist(v, x), i) for i, x in rows if i != q and len(x) == len(v))[:10]
        found = sorted(by.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert all(abs(r.score - math.dist(v, vec[r.vec_id])) < 1e-9 for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        hit += sum(r.score <= best[-1][0] + 1e-9 for r in found)
        total += len(best)
    assert hit / total >= 0.9
    none = vectors.filter("vec_id < 0")
    assert ann_scan.search(none, none).collect() == []


def test_every_query_finds_k_rows(spark):
    """Tight clusters and a few scattered rows, some alone in their list."""
    importable(spark)
    rng = np.random.default_rng(6)
    middles = rng.normal(0, 10, (40, 8))
    rows = np.concatenate([np.repeat(middles, 500, axis=0) + rng.normal(0, 0.01, (20_000, 8)), rng.normal(0, 60, (200, 8))])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>").repartition(4)
    got = ann_scan.search(table, table.filter("vec_id % 500 = 0 or vec_id >= 20000")).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {i: 10 for i in [*range(0, 20_000, 500), *range(20_000, 20_200)]}
    few = table.filter("vec_id >= 20193")
    got = ann_scan.search(few, few).groupBy("query_id").count().collect()
    assert sorted((r.query_id, r["count"]) for r in got) == [(i, 6) for i in range(20_193, 20_200)]
