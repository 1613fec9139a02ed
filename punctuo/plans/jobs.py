"""Command-line jobs for ``spark-submit`` (E1 build, E2 reports).

    spark-submit --py-files punctuo.zip punctuo/plans/jobs.py build --flights s3://in/schedule/ \\
        --airports s3://in/airports.csv --weather s3://in/weather.csv --out s3://lake/fact
    spark-submit --py-files punctuo.zip punctuo/plans/jobs.py report --fact s3://lake/fact --out s3://lake/reports \\
        --year 2019 --direction departure
    spark-submit --py-files punctuo.zip punctuo/plans/jobs.py score --fact s3://lake/fact --models s3://lake/models \\
        --out s3://lake/scored

The session comes from the cluster (its ``spark.checkpoint.dir``, shuffle
partitions and AQE settings are used as configured). Reports read the written
fact, so year filters prune Parquet partitions.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from punctuo.config import DEFAULTS
from punctuo.operators import reports as RP
from punctuo.operators.util import released


def build(spark: SparkSession, args) -> None:
    from punctuo.plans.build import build_from_files, report_of
    from punctuo.sources.files import write_fact
    counters = Observation("build")
    # the pre-feature table is written next to (not inside) the output, which
    # the final overwrite replaces
    fact = build_from_files(spark, args.flights, args.airports, args.weather, DEFAULTS,
                            home_code=args.home, path=f"{args.out.rstrip('/')}_base", counters=counters)
    report_of(spark, counters).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}_report")
    write_fact(fact, args.out)


def report(spark: SparkSession, args) -> None:
    fact = spark.read.parquet(args.fact)
    sel = RP.apply_filters(fact, direction=args.direction, airlines=args.airline or (), aircraft=args.aircraft or (),
                           year=args.year)
    exact = not args.approx
    out = args.out.rstrip("/")
    outputs = {
        "by_direction_hour": RP.summary(sel, ["direction", "hour"], min_n=args.min_n, exact=exact),
        "by_weekday_hour": RP.heat_grid(sel, min_n=30, exact=exact),
        "timeline_week": RP.timeline(RP.apply_filters(fact, direction=args.direction), "week", "direction"),
        "by_year": RP.by_year(RP.apply_filters(fact, direction=args.direction), exact=exact),
        "delay_histogram": RP.histogram(sel),
    }
    for name, df in outputs.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def score(spark: SparkSession, args) -> None:
    """Fits on the training days of the fact unless the store has these models, and scores the test days."""
    from punctuo.operators import evaluate as EV
    from punctuo.operators import features as FE
    from punctuo.operators import predict as PD
    from punctuo.operators.util import checkpoint_table
    from punctuo.sources.models import fitted_or_stored
    params = DEFAULTS.with_(**({"max_iter": args.rounds} if args.rounds else {}))
    fact = spark.read.parquet(args.fact)
    params = params.with_(feature_steps=tuple((step, tuple(c for c in new if c in fact.columns)) for step, new in params.feature_steps),
                          categorical=tuple(c for c in params.categorical if c in fact.columns))
    cols = PD.ladder_columns(params)[-1][1]
    split = EV.with_split(fact, EV.day_split(fact, params.test_share, params.seed))
    top = FE.top_categories(split.filter(~F.col("is_test")), list(params.categorical), params.max_categories)
    rows = checkpoint_table(PD.cap_categories(split, top, params))
    train = rows.filter(~F.col("is_test"))

    def fit():
        prep = PD.fit_preprocess(train, cols, params)
        return {"late": PD.fit_classifier(train, cols, params, prep), "minutes": PD.fit_regressor(train, cols, params, prep)}

    models = fitted_or_stored(args.models, train, cols, fit, params)
    scored = PD.drop_work(PD.score(models["late"], rows.filter("is_test"), cols, params))
    scored = PD.drop_work(PD.predict_minutes(models["minutes"], scored, cols, params))
    scored.write.mode("overwrite").parquet(args.out)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="punctuo")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--flights", required=True)
    b.add_argument("--airports", required=True)
    b.add_argument("--weather", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--home", default=None)
    r = sub.add_parser("report")
    r.add_argument("--fact", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--year", type=int, default=None)
    r.add_argument("--direction", default=None)
    r.add_argument("--airline", action="append")
    r.add_argument("--aircraft", action="append")
    r.add_argument("--min-n", dest="min_n", type=int, default=100)
    r.add_argument("--approx", action="store_true", help="sketches for medians and distinct counts")
    m = sub.add_parser("score")
    m.add_argument("--fact", required=True)
    m.add_argument("--models", required=True, help="folder of the fitted models")
    m.add_argument("--out", required=True)
    m.add_argument("--rounds", type=int, default=None)
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"punctuo-{args.cmd}").getOrCreate()
    with released(spark):  # outputs are written inside; working tables and caches go
        {"build": build, "report": report, "score": score}[args.cmd](spark, args)


if __name__ == "__main__":
    main()
