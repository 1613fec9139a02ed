"""A store of fitted models (M6, M7, M17): later sessions score without fitting.

A store is a folder on shared storage; an entry is a folder in it named by a key over
everything that decides the fit: all parameters, the feature columns and a fingerprint of
the training rows. It holds one Spark ML pipeline per name and, written last, a one-row
metadata table, so an entry whose writing was cut off does not count as one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.config import DEFAULTS, Params

META = "key string, params string, columns array<string>, models array<string>, train_rows long, fingerprint string"


def fingerprint(rows: DataFrame, cols: Sequence[str]) -> tuple[int, str]:
    """(number of rows, a text) of ``cols`` of ``rows``, in whatever order and partitions they come.

    One aggregation: the sums of two differently seeded row hashes, as 38-digit numbers.
    (NULLs leave a hash as it was, so their places are hashed too.)"""
    values = [v for c in cols for v in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    n, text = rows.agg(F.count(F.lit(1)), F.concat_ws("/", *sums)).first()
    return n, text


def model_key(params: Params, cols: Sequence[str], data: str) -> str:
    """The name of an entry: any change of a parameter, a column or the training rows gives another."""
    return hashlib.sha256(json.dumps([asdict(params), list(cols), data], sort_keys=True, default=str).encode()).hexdigest()[:32]


def load_models(spark: SparkSession, store: str, key: str) -> dict[str, PipelineModel] | None:
    """The pipelines of a complete entry by name, None if there is none."""
    at = f"{store.rstrip('/')}/{key}"
    try:
        meta = spark.read.schema(META).json(f"{at}/metadata").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if meta is None else {name: PipelineModel.load(f"{at}/{name}") for name in meta["models"]}


def save_models(spark: SparkSession, store: str, key: str, models: dict[str, PipelineModel], params: Params, cols: Sequence[str], train_rows: int, data: str) -> None:
    """Write an entry, metadata last; what an interrupted writing left is replaced."""
    at = f"{store.rstrip('/')}/{key}"
    for name, model in models.items():
        model.write().overwrite().save(f"{at}/{name}")
    row = (key, json.dumps(asdict(params), sort_keys=True, default=str), list(cols), list(models), train_rows, data)
    spark.createDataFrame([row], META).coalesce(1).write.mode("overwrite").json(f"{at}/metadata")


def fitted_or_stored(store: str, train: DataFrame, cols: Sequence[str], fit: Callable[[], dict[str, PipelineModel]], params: Params = DEFAULTS,
                     labels: Sequence[str] = ("is_late", "delay_min", "day")) -> dict[str, PipelineModel]:
    """The pipelines of ``fit()``, from the store if these rows were fitted with these parameters before.

    ``labels``: the columns that the fit reads besides the features. Pipelines that were
    just fitted are returned as read back, so first and later sessions score alike."""
    spark = train.sparkSession
    n, data = fingerprint(train, [*cols, *[c for c in labels if c in train.columns]])
    key = model_key(params, cols, f"{n}:{data}")
    found = load_models(spark, store, key)
    if found is None:
        save_models(spark, store, key, fit(), params, cols, n, data)
        found = load_models(spark, store, key)
    return found
