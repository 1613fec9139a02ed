"""Counters collected by the write of the build."""

from conftest import SF001
from punctuo.operators import clean as CL
from punctuo.plans import queries as Q
from punctuo.plans.build import build_fact, build_with_report
from punctuo.sources import bindings as B


def test_report_agrees_with_the_metrics_and_the_fact(spark, tmp_path):
    raw, places, daily = B.raw_ev(spark, SF001, duplicates=True), Q.places_geo(spark, SF001), B.weather_ev(spark, SF001)
    fact, report = build_with_report(raw, places, daily, path=str(tmp_path / "fact"))
    r, m = report.first(), CL.clean_metrics(raw).first()
    for c in ("raw_rows", "duplicate_rows", "rollovers", "min_before", "min_after", "max_after"):
        assert r[c] == m[c], c
    assert r.rows == fact.count() == r.via_key_a + r.via_key_b + r.without_code + r.code_unknown
    plain = build_fact(raw, places, daily)
    assert fact.columns[:3] == plain.columns[:3] and sorted(fact.columns) == sorted(plain.columns)


def test_report_of_an_empty_table(spark):
    raw = B.raw_ev(spark, SF001).limit(0)
    r = build_with_report(raw, Q.places_geo(spark, SF001))[1].first()
    assert (r.raw_rows, r.rows, r.duplicate_rows, r.rollovers, r.via_key_a, r.avg_delay, r.max_after) == (0, 0, 0, 0, 0, None, None)
