"""Lets Python workers import this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Adds the folder that holds the package to the workers' path.

    It serves where driver and workers see the same installation; on a cluster
    the package is installed or sent with ``--py-files`` and the entry is idle."""
    env = spark.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in path:
        env["PYTHONPATH"] = os.pathsep.join([*path, ROOT])
