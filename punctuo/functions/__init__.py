"""Column expressions (``pyspark.sql.functions`` compositions, no UDFs)."""

from punctuo.functions.columns import *  # noqa: F401,F403
