"""Prediction (M1, M2, M6–M9, M17, M18) with Spark ML.

Per ladder step one ``Pipeline``: StringIndexer on the capped categories
(``other`` for the tail), median ``Imputer`` fitted on train plus a missing
indicator per numeric feature (Spark's GBT rejects NaN/NULL, the surveyed
learner takes them natively), ``VectorAssembler`` and a gradient-boosted tree
model. Scores come back as a ``p_late`` column; every metric is then an
ordinary distributed query (``evaluate``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.config import DEFAULTS, Params
from punctuo.functions import columns as X
from punctuo.operators import evaluate as EV
from punctuo.operators import features as FE
from punctuo.operators.util import materialize


VALIDATION = "_validation"


def _stopping(params: Params) -> dict:
    """Early stopping: ``max_iter`` rounds are an upper bound, as in the surveyed learner."""
    return {"validationIndicatorCol": VALIDATION, "validationTol": params.validation_tol} if params.validation_share > 0 else {}


def ladder_columns(params: Params = DEFAULTS) -> list[tuple[str, list[str]]]:
    """M2: cumulative feature sets, one per step."""
    out, cols = [], []
    for step, new in params.feature_steps:
        cols = cols + list(new)
        out.append((step, list(cols)))
    return out


def cap_categories(df: DataFrame, top: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Tail values and NULL → ``other`` (top list from T5)."""
    return FE.encode_other(df, top, list(params.categorical), C.OTHER, params)


def _features(cols: Sequence[str], params: Params) -> list[str]:
    cats = [c for c in cols if c in params.categorical]
    nums = [c for c in cols if c not in params.categorical]
    return [f"{c}__idx" for c in cats] + [f"{c}__imp" for c in nums] + [f"{c}__miss" for c in nums]


def fit_preprocess(train: DataFrame, cols: Sequence[str], params: Params = DEFAULTS) -> PipelineModel:
    """StringIndexer (all categorical columns in one pass) + median Imputer (all
    numeric columns in one pass), fitted on train only. Fitted once on the
    widest feature set and shared by every model of the ladder."""
    cats = [c for c in cols if c in params.categorical]
    nums = [c for c in cols if c not in params.categorical]
    stages = []
    if cats:
        stages.append(StringIndexer(inputCols=cats, outputCols=[f"{c}__idx" for c in cats],
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
    if nums:
        stages.append(Imputer(inputCols=[f"{c}__num" for c in nums], outputCols=[f"{c}__imp" for c in nums],
                              strategy="median"))
    return Pipeline(stages=stages).fit(prepare(train, cols, params))


def _fit(train: DataFrame, cols: Sequence[str], estimator, label: str, params: Params,
         prep: PipelineModel | None) -> PipelineModel:
    prep = prep or fit_preprocess(train, cols, params)
    head = Pipeline(stages=[VectorAssembler(inputCols=_features(cols, params), outputCol="features",
                                            handleInvalid="keep"), estimator])
    ready = prep.transform(prepare(train, cols, params)).filter(F.col(label).isNotNull())
    if params.validation_share > 0:
        ready = with_validation(ready, params)
    return PipelineModel(stages=list(prep.stages) + list(head.fit(ready).stages))


def prepare(df: DataFrame, cols: Sequence[str], params: Params = DEFAULTS) -> DataFrame:
    """Numeric features as double + missing indicators; label columns.

    Inputs are built for every feature of the ladder present in ``df`` (not
    only ``cols``) so one fitted preprocessing serves every step."""
    wanted = list(cols) + [c for _, new in params.feature_steps for c in new if c in df.columns]
    nums = list(dict.fromkeys(c for c in wanted if c not in params.categorical))
    extra = {}
    for c in nums:
        extra[f"{c}__num"] = F.col(c).cast("double")
        extra[f"{c}__miss"] = F.col(c).isNull().cast("double")
    extra["label"] = F.col("is_late").cast("double")
    extra["label_min"] = X.clip("delay_min", params.clip_lo, params.clip_hi)
    return df.withColumns(extra)


def with_validation(df: DataFrame, params: Params = DEFAULTS, day: str = "day") -> DataFrame:
    """Marks ``validation_share`` of the training days (by hash): boosting stops once they no longer improve."""
    part = F.pmod(F.xxhash64(F.col(day).cast("string"), F.lit(params.seed)), F.lit(1000))
    return df.withColumn(VALIDATION, part < F.lit(int(1000 * params.validation_share)))


def _max_bins(params: Params) -> int:
    return max(32, params.max_categories + 2)


def fit_classifier(train: DataFrame, cols: Sequence[str], params: Params = DEFAULTS,
                   prep: PipelineModel | None = None) -> PipelineModel:
    """M6: gradient-boosted classifier on one feature set (``prep`` shared if given)."""
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=params.max_iter, **_stopping(params),
                        stepSize=params.learning_rate, maxDepth=params.max_depth, maxBins=_max_bins(params),
                        seed=params.seed)
    return _fit(train, cols, gbt, "label", params, prep)


def fit_regressor(train: DataFrame, cols: Sequence[str], params: Params = DEFAULTS,
                  prep: PipelineModel | None = None) -> PipelineModel:
    """M7: minutes model on the clipped label."""
    gbt = GBTRegressor(featuresCol="features", labelCol="label_min", maxIter=params.max_iter, **_stopping(params),
                       stepSize=params.learning_rate, maxDepth=params.max_depth, maxBins=_max_bins(params),
                       seed=params.seed)
    return _fit(train, cols, gbt, "label_min", params, prep)


def score(model: PipelineModel, df: DataFrame, cols: Sequence[str], params: Params = DEFAULTS,
          name: str = "p_late") -> DataFrame:
    """Batch scoring — chance of being late as a column."""
    out = model.transform(prepare(df, cols, params))
    return out.withColumn(name, vector_to_array("probability")[1])


def predict_minutes(model: PipelineModel, df: DataFrame, cols: Sequence[str], params: Params = DEFAULTS,
                    name: str = "pred_min") -> DataFrame:
    return model.transform(prepare(df, cols, params)).withColumnRenamed("prediction", name)


def drop_work(df: DataFrame) -> DataFrame:
    """Drop the pipeline's working columns (indices, imputed values, vectors)."""
    return df.drop(*[c for c in df.columns if "__" in c or c in ("features", "label", "label_min", "rawPrediction",
                                                                 "probability", "prediction")])


def fit_ladder(train: DataFrame, params: Params = DEFAULTS) -> tuple[list, PipelineModel]:
    """M6: one classifier per cumulative feature set; (models, preprocessing).

    The preprocessing is fitted once on the widest set and shared."""
    steps = ladder_columns(params)
    prep = fit_preprocess(train, steps[-1][1], params)
    return [(step, cols, fit_classifier(train, cols, params, prep)) for step, cols in steps], prep


def ladder(train: DataFrame, test: DataFrame, params: Params = DEFAULTS):
    """M6: the fitted ladder on ``test``; (models, metrics rows, preprocessing)."""
    models, prep = fit_ladder(train, params)
    return models, ladder_rows(models, test, params), prep


def ladder_rows(models, test: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """AUC and Brier score of every step of a fitted ladder."""
    rows = None
    for i, (step, cols, m) in enumerate(models):
        scored = score(m, test, cols, params)
        brier = scored.select(F.avg(F.pow(F.col("p_late") - F.col("is_late").cast("double"), 2))).scalar()
        row = EV.auc(scored).select(F.lit(i + 1).alias("step_no"), F.lit(step).alias("step"), "auc",
                                    brier.alias("brier"), F.lit(len(cols)).alias("n_features"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def permutation_importance(model: PipelineModel, test: DataFrame, cols: Sequence[str], params: Params = DEFAULTS,
                           key: str = "flight_id") -> DataFrame:
    """M8: AUC drop when one feature's values are shuffled: among all test rows
    (``evaluate.permuted_auc_drop``), or among ``importance_rows`` sampled ones if that is set.

    The sample is the ≤ n rows with the smallest key hash (``hash_sample``:
    threshold pre-filter, no k × partitions merge); all feature × repeat
    permutations are built as ONE table (a join on a permuted row number),
    scored in one ``transform`` and evaluated with a grouped AUC."""
    if params.importance_rows is None:
        return EV.permuted_auc_drop(test, cols, lambda rows: score(model, rows, cols, params), key, params.importance_repeats, params.seed)
    seed = str(params.seed)
    h = F.xxhash64(F.col(key), F.lit(params.seed))
    sample = EV.hash_sample(test, key, params.importance_rows, params.seed)
    sample = materialize(sample.withColumn("_rid", F.row_number().over(Window.orderBy(h, key))))
    combos = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(r).alias("repeat"))
                       for c in cols for r in range(params.importance_repeats)])
    fan = sample.select("*", F.explode(combos).alias("_fr")).select("*", "_fr.feature", "_fr.repeat").drop("_fr")
    perm = F.md5(F.concat_ws("|", F.col("_rid").cast("string"), F.col("feature"), F.col("repeat").cast("string"), F.lit(seed)))
    fan = fan.withColumn("_src", F.row_number().over(Window.partitionBy("feature", "repeat").orderBy(perm, "_rid")))
    donor = sample.select(F.col("_rid").alias("_src"), F.struct(*[F.col(c) for c in cols]).alias("_donor"))
    shuffled = fan.join(donor, "_src")
    for c in cols:
        shuffled = shuffled.withColumn(c, F.when(F.col("feature") == c, F.col(f"_donor.{c}")).otherwise(F.col(c)))
    scored = score(model, shuffled.drop("_donor", "_src"), cols, params)
    per = EV.auc_by_group(scored, ["feature", "repeat"])
    base = EV.auc(score(model, sample, cols, params)).select("auc").scalar()
    drop = per.groupBy("feature").agg(F.avg("auc").alias("_perm"))
    return drop.select("feature", (base - F.col("_perm")).alias("auc_drop")).orderBy(F.desc("auc_drop"), "feature")


def whatif_defaults(scenarios: DataFrame, pres: float = 1017.0) -> DataFrame:
    """Conditions a scenario does not give are derived: tmin = tavg − 5,
    wspd = wpgt / 3.5, pres = 1017 (only where the column is missing or NULL)."""
    out = scenarios
    derived = {"tmin": F.col("tavg") - F.lit(5.0), "wspd": F.col("wpgt") / F.lit(3.5), "pres": F.lit(pres)}
    for c, e in derived.items():
        out = out.withColumn(c, F.coalesce(F.col(c), e) if c in out.columns else e)
    return out


def hour_sweep(model: PipelineModel, rows: DataFrame, cols: Sequence[str], hours: Sequence[int] = tuple(range(6, 23)),
               params: Params = DEFAULTS) -> DataFrame:
    """The same flights scored at every hour (mean chance per hour, %)."""
    swept = rows.withColumn("hour", F.explode(F.array(*[F.lit(h) for h in hours])))
    return score(model, swept, cols, params).groupBy("hour").agg((F.avg("p_late") * 100).alias("pred_pct"))
