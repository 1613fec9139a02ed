"""Model fits: rows-only in the registry; here they must beat the constant
baseline on a synthetic signal (SURVEY §5 item 5)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from punctuo.config import DEFAULTS
from punctuo.operators import evaluate as EV
from punctuo.operators import predict as PD


def test_classifier_beats_constant_on_signal(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        hour = rnd.randint(5, 22)
        load = rnd.randint(5, 60)
        late = rnd.random() < (0.05 + 0.6 * (hour >= 17) * (load > 40))
        rows.append((i, dt.date(2019, 1, 1) + dt.timedelta(days=i % 40), hour, load,
                     "departure" if i % 2 else "arrival", None if i % 7 == 0 else float(load) / 2,
                     30.0 if late else 0.0, late))
    df = spark.createDataFrame(rows, "flight_id long, day date, hour int, hour_load int, direction string, "
                                     "wpgt double, delay_min double, is_late boolean")
    split = EV.with_split(df, EV.day_split(df))
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    params = DEFAULTS.with_(max_iter=5, max_depth=3, categorical=("direction",))
    cols = ["hour", "hour_load", "direction", "wpgt"]
    model = PD.fit_classifier(train, cols, params)
    scored = PD.score(model, test, cols, params)
    auc = EV.auc(scored).first().auc
    assert auc > 0.8
    brier = scored.agg(F.avg(F.pow(F.col("p_late") - F.col("is_late").cast("double"), 2))).first()[0]
    const = EV.baseline(split).first().brier_const
    assert brier < const
    imp = {r.feature: r.auc_drop for r in PD.permutation_importance(model, test, cols, params).collect()}
    assert imp["hour"] > 0.01 and imp["hour_load"] > 0.01
    sweep = {r.hour: r.pred_pct for r in PD.hour_sweep(model, test, cols, params=params).collect()}
    assert sweep[20] > sweep[8]


def test_year_split(spark):
    rows = [(i, dt.date(2019 + i % 3, 1 + i % 12, 1), 2019 + i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "flight_id long, day date, year int")
    s = EV.split_for_model(df, "year", years=(2019, 2020))
    got = {r.year: r.is_test for r in s.select("year", "is_test").distinct().collect()}
    assert got == {2019: False, 2020: True}
    d = EV.split_for_model(df, "days")
    assert d.count() == 300 and d.filter("is_test").count() > 0
