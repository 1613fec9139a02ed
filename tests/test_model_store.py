"""Models kept in a store: fitted once per parameters, columns and training rows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from punctuo.config import DEFAULTS
from punctuo.operators import predict as PD
from punctuo.plans import jobs
from punctuo.sources import bindings as B
from punctuo.sources.models import fingerprint, fitted_or_stored, load_models, model_key


def test_fitted_once_then_loaded_and_refitted_on_a_change(spark, tmp_path):
    train = B.flights_ev(spark, SF001).persist()
    params = DEFAULTS.with_(max_iter=2, max_depth=2, categorical=("direction",))
    cols, calls, store = ["hour", "weekday", "direction"], [], str(tmp_path / "models")

    def run(rows=train, p=params, c=cols):
        def fit():
            calls.append(p)
            return {"late": PD.fit_classifier(rows, c, p)}
        return fitted_or_stored(store, rows, c, fit, p)["late"]

    chance = lambda m: [r.p_late for r in PD.score(m, train, cols, params).orderBy("flight_id").select("p_late").collect()]
    first, second = run(), run()
    assert len(calls) == 1 and chance(first) == chance(second)
    run(rows=train.repartition(3))
    assert len(calls) == 1
    run(p=params.with_(seed=7))
    run(c=["hour", "direction"])
    run(rows=train.withColumn("delay_min", F.when(F.col("flight_id") == 5, 99.0).otherwise(F.col("delay_min"))))
    run(rows=train.filter("flight_id > 0"))
    assert len(calls) == 5
    train.unpersist()


def test_an_entry_without_metadata_is_none(spark, tmp_path):
    (tmp_path / "k" / "late").mkdir(parents=True)
    assert load_models(spark, str(tmp_path), "k") is None
    assert load_models(spark, str(tmp_path / "nowhere"), "k") is None


def test_fingerprint_sees_repeated_rows_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "n int, s string")
    assert fingerprint(a, ["n", "s"]) == fingerprint(a.orderBy(F.desc("n")), ["n", "s"])
    assert fingerprint(a, ["n", "s"]) != fingerprint(a.union(a.filter("n = 2")), ["n", "s"])
    swapped = spark.createDataFrame([(None, 1), (5, 2)], "n int, s int")
    assert fingerprint(swapped, ["n", "s"]) != fingerprint(swapped.select(F.col("s").alias("n"), F.col("n").alias("s")), ["n", "s"])
    assert fingerprint(a.limit(0), ["n"]) == (0, "")
    assert model_key(DEFAULTS, ["n"], "x") != model_key(DEFAULTS, ["s"], "x")


def test_score_job(spark, tmp_path, monkeypatch):
    fact = B.flights_ev(spark, SF001).withColumns({"hour_load": F.lit(3), "day_load": F.lit(30)})
    fact.write.parquet(str(tmp_path / "fact"))
    args = ["score", "--fact", str(tmp_path / "fact"), "--models", str(tmp_path / "models"), "--out", str(tmp_path / "out"), "--rounds", "2"]
    jobs.main(args)
    monkeypatch.setattr(PD, "fit_classifier", lambda *a: pytest.fail("fitted again"))
    first = sorted((r.flight_id, r.p_late, r.pred_min) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    jobs.main(args)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.flight_id, r.p_late, r.pred_min) for r in out.collect()) == first and len(first) > 0
    assert out.filter("p_late is null or not is_test").isEmpty()
