"""punctuo — on-time-performance analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions (``pyspark.sql.functions``), so Catalyst prunes columns, pushes
filters into the Parquet scan and plans joins and aggregations itself.

Sub-packages
------------
functions  column expressions (cleaning, time, bins, geo, formatting)
sources    file readers, Parquet sink, bindings of the driver's test tables
operators  clean, lookup, features, reports, profile, evaluate, predict
plans      named queries (the registry used by ``__spark_entry__``) + oracle SQL
streaming  incremental ingest of arriving schedule files
"""

from punctuo.config import Params, DEFAULTS

__version__ = "0.1.0"
__all__ = ["Params", "DEFAULTS", "__version__"]
