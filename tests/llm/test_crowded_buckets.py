"""No pair of a bucket that can't be split further is left out."""

import random

import numpy as np

from punctuo.llm import chosen_path, graph

WIDTH, COMMON = 128, 80  # equal at 80 places: 0.625, below the 0.659 that looks like 0.8


def classes(spark, places, small, runs=1):
    rows = [(random.Random(i).getrandbits(62), np.array(p, dtype="<u4").tobytes()) for i, p in enumerate(places)]
    nodes = spark.createDataFrame([(n, bytearray(p)) for n, p in rows], "node long, places binary")
    root = {r.node: r.root for r in chosen_path.candidate_classes(nodes, 0.8, runs, WIDTH, small, 1).collect()}
    return [root.get(n, n) for n, _ in rows]


def test_pairs_in_different_blocks_of_a_crowded_bucket_meet(spark):
    for first in (0, 40):  # the places that all share; whichever place a run draws, it is among them for one layout
        owner = lambda place, pair: 1 if (place - first) % WIDTH < COMMON else 2 + pair
        for crowd in (0, 30):  # without and with one large class beside the pairs
            pairs = [*range(30), *range(30), *[99] * crowd]
            got = classes(spark, [[owner(k, p) for k in range(WIDTH)] for p in pairs], small=4)
            assert all(got[i] == got[i + 30] for i in range(30))
            assert len(set(got)) == 30 + (crowd > 0)


def near_copies(spark, n):
    """``n`` nodes that agree at nine tenths of their places, in one large bucket after any split."""
    rng = random.Random(3)
    rows = [(rng.getrandbits(62), bytearray(np.array([1 if rng.random() < 0.9 else 2 + i for _ in range(WIDTH)], dtype="<u4").tobytes())) for i in range(n)]
    return spark.createDataFrame(rows, "node long, places binary")


def test_several_splits_in_a_pass_give_the_buckets_of_single_splits(spark):
    nodes, small = near_copies(spark, 60), 20
    sets = lambda b: {frozenset(r.nodes) for r in b.groupBy("path").agg({"node": "collect_list"}).toDF("path", "nodes").collect()}
    ones, crowds = chosen_path._buckets(nodes, 0.8, 2, WIDTH, small, [1] * 6)
    more, large = chosen_path._buckets(nodes, 0.8, 2, WIDTH, small, chosen_path.rounds_of(6))
    assert chosen_path.rounds_of(6) == [1, 2, 3] and chosen_path.rounds_of(1) == [1] and chosen_path.rounds_of(4) == [1, 2, 1]
    ones, more = sets(ones), sets(more)
    assert crowds and large and sets(crowds) == sets(large) and ones <= more
    assert all(any(b <= a for a in ones) for b in more)  # what else there is are parts of these


def test_a_crowded_bucket_takes_few_tables(spark, monkeypatch):
    """Every table and pass costs its tasks' time, whatever its rows."""
    made, write = [], chosen_path.checkpoint_table
    for module in (chosen_path, graph):
        monkeypatch.setattr(module, "checkpoint_table", lambda df: made.append(1) or write(df))
    got = chosen_path.candidate_classes(near_copies(spark, 60), 0.8, 2, WIDTH, 20, 6).select("root").distinct().count()
    assert got == 1 and len(made) <= 14


def test_joined_components(spark):
    edges = lambda *e: spark.createDataFrame(list(e), "a long, b long")
    found = graph.components(edges((1, 2), (3, 4), (5, 6)))
    for more, groups in ((edges((2, 4), (7, 8), (8, 9)), [{1, 2, 3, 4}, {5, 6}, {7, 8, 9}]), (edges((2, 1)), [{1, 2}, {3, 4}, {5, 6}]), (edges((9, 6)), [{1, 2}, {3, 4}, {5, 6, 9}])):
        out = [(r.node, r.root) for r in graph.joined(found, more).collect()]
        assert len(out) == len({n for n, _ in out})
        assert sorted(sorted(n for n, r in out if r == root) for root in {r for _, r in out}) == sorted(map(sorted, groups))
