"""Physical-plan properties (read from ``explain``) that matter at scale."""

import tempfile

import pytest

from conftest import SF001
import __spark_entry__ as E
from punctuo.operators import features as FE
from punctuo.operators import reports as RP
from punctuo.sources import bindings as B
from punctuo.sources.files import write_fact

MODEL_KEYS = {"ladder", "minutes_model", "importance", "scored_test", "whatif_hours", "whatif_places"}


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("key", sorted(set(E.queries()) - MODEL_KEYS))
def test_no_cartesian_or_nested_loop_join(spark, capsys, key):
    p = plan(E.queries()[key](spark, SF001), capsys)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_load_features_broadcast_no_fact_shuffle(spark, capsys):
    p = plan(FE.add_load_features(B.flights_ev(spark, SF001)), capsys)
    top = p.split("\n\n")[0]                          # the tree, before the node details
    assert "BroadcastHashJoin" in top
    assert "SortMergeJoin" not in top and "ShuffledHashJoin" not in top


def test_lookup_is_broadcast(spark, capsys):
    p = plan(E.queries()["two_key_lookup"](spark, SF001), capsys)
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_scan_reads_only_needed_columns(spark, capsys):
    p = plan(RP.summary(B.flights_ev(spark, SF001), ["direction", "hour"]), capsys)
    schemas = [line for line in p.splitlines() if line.strip().startswith("ReadSchema")]
    assert schemas and all("user_id" not in s and "props" not in s and "event_type" not in s for s in schemas)


def test_year_filter_prunes_partitions(spark, capsys):
    out = tempfile.mkdtemp(prefix="punctuo-plan-") + "/fact"
    write_fact(B.flights_or(spark, SF001), out)
    fact = spark.read.parquet(out).filter("year = 1999")
    p = plan(RP.headline(fact, exact=False), capsys)
    assert "PartitionFilters: [isnotnull(year" in p and "= 1999)" in p


def final_plan(df) -> str:
    """The plan as run: the adaptive plans' final parts, subqueries included."""
    df.collect()
    keep, skip = [], False
    for line in df._jdf.queryExecution().executedPlan().treeString().splitlines():
        if "== Initial Plan ==" in line:
            skip, depth = True, line.index("+-")
        elif skip and len(line) - len(line.lstrip(" :")) <= depth:
            skip = False
        if not skip:
            keep.append(line)
    return "\n".join(keep)


@pytest.mark.parametrize("key", ["headline", "headline_delta", "year_compare", "year_delta", "area_year"])
def test_distinct_places_expand_no_row(spark, capsys, key):
    assert "Expand" not in plan(E.queries()[key](spark, SF001), capsys)


def test_median_and_distinct_places_share_one_scan(spark, tmp_path):
    B.flights_or(spark, SF001).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    for report in (RP.by_year(fact), RP.headline_delta(fact, 1999, 2000)):
        p = final_plan(report)
        assert p.count("Scan parquet") == 1 and "ReusedExchange" in p


def test_place_summary_edge_cases(spark):
    rows = [(1, "A", 10.0, False), (1, "A", None, None), (1, None, 30.0, True), (1, "B", 10.0, False), (2, None, None, None)]
    df = spark.createDataFrame(rows, "year int, place_code string, delay_min double, is_late boolean")
    got = {r.year: tuple(r)[1:] for r in RP.by_year(df).collect()}
    assert got == {1: (4, pytest.approx(100 / 3), pytest.approx(50 / 3), 10.0, 2), 2: (1, None, None, None, 0)}
    assert tuple(RP.headline(df).first()) == (5, pytest.approx(100 / 3), pytest.approx(50 / 3), 10.0, 2)
    assert tuple(RP.headline(df.filter("year = 9")).first()) == (0, None, None, None, 0)
    d = RP.headline_delta(df, 1, 9).first()
    assert (d.n_sel, d.n_places_sel, d.diff_n, d.diff_n_places) == (4, 2, None, None)
