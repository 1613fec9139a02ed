"""Invariants on the test tables."""

from pyspark.sql import functions as F

from conftest import SF001, SF01
from punctuo.operators import clean as CL
from punctuo.operators import evaluate as EV
from punctuo.operators import reports as RP
from punctuo.plans import queries as Q
from punctuo.sources import bindings as B


def test_rollover_recovers_delay_exactly(spark):
    """Encode to date + clock strings, lose the actual date, repair: delay = floor(value·60)/60."""
    c = CL.clean_flights(B.raw_ev(spark, SF01))
    ev = B.table(spark, SF01, "events").select(F.col("event_id").cast("string").alias("Identifier"), "value")
    j = c.join(ev, "Identifier")
    bad = j.filter(F.abs(F.col("delay_min") - F.floor(F.col("value") * 60) / 60) > 1e-9).count()
    assert bad == 0 and j.count() == 10_000
    assert c.filter("rolled_over").count() == 326


def test_lookup_keeps_rows(spark):
    assert Q.enriched_or(spark, SF001).count() == B.flights_or(spark, SF001).count()


def test_group_sizes_sum_to_non_null_rows(spark):
    f = B.flights_or(spark, SF001)
    s = RP.summary(f, "direction").agg(F.sum("n")).first()[0]
    assert s == f.filter(F.col("direction").isNotNull()).count()


def test_split_disjoint_and_calibration_total(spark):
    s = B.scored_ev(spark, SF01)
    j = EV.with_split(s, EV.day_split(s))
    days = j.groupBy("day").agg(F.countDistinct("is_test").alias("k"))
    assert days.filter("k > 1").count() == 0
    test = j.filter("is_test")
    assert EV.calibration(test).agg(F.sum("n")).first()[0] == test.count()
    cells = EV.confusion_sweep(test).select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("t")).distinct()
    assert [r.t for r in cells.collect()] == [test.count()]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "late_pct" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
