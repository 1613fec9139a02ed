"""Small plan helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuo.session import ensure_checkpoint_dir


#: No broadcast side may have more bytes than this (texts as stored, 16 for any other value).
MAX_BROADCAST_BYTES = 512 << 20


#: What the innermost ``released`` block has to give back: tables (paths) and cached DataFrames.
_HELD: ContextVar[list | None] = ContextVar("punctuo_held", default=None)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Whatever operators cache or write to the shared folder inside the block is given back at its end.

    DataFrames made inside must be written (or collected) before the end: their tables are
    deleted then, also after an error. Blocks nest; each gives back what was made in it.
    Only folders that ``shared_path`` named are deleted, never an output of the caller."""
    held: list = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        for item in reversed(held):
            if isinstance(item, str):
                path = spark._jvm.org.apache.hadoop.fs.Path(item)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            else:
                item.unpersist()


def _hold(item):
    held = _HELD.get()
    if held is not None:
        held.append(item)
    return item


def _row_bytes(df: DataFrame):
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.lit(16 * (len(df.columns) + 1)).cast("long")
    for t in texts:
        size = size + t
    return size


def fits_rows(df: DataFrame, max_rows: int) -> bool:
    """Bounded size proof: at most ``max_rows`` rows (reads ≤ max_rows + 1 rows) of at most ``MAX_BROADCAST_BYTES`` bytes."""
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return n <= max_rows and size <= MAX_BROADCAST_BYTES


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The proof is a bounded count (``limit(max_rows + 1)``), so it never scans
    more than ``max_rows + 1`` rows of the side. Beyond the bound the side is
    returned as is and Spark plans a shuffle join (AQE splits skewed keys).
    Call it on small, materialised sides (a dimension, a persisted aggregate).
    """
    return F.broadcast(df) if fits_rows(df, max_rows) else df


def materialize(df: DataFrame) -> DataFrame:
    """Keep a SMALL table (a per-(day, hour) or per-day table, a dimension, a
    top list, a bounded sample) that is size-checked and then broadcast:
    computed once, reused by the join.

    Its partitions are left to AQE, which merges small ones in cached plans too,
    so the stage that reduces the large side keeps all its tasks. Lost blocks are recomputed from lineage, and once broadcast the table no
    longer depends on executors, so executor loss is harmless."""
    return _hold(df.persist(StorageLevel.MEMORY_AND_DISK))


def persist_table(df: DataFrame) -> DataFrame:
    """Keep a LARGE table that an iterative algorithm scans repeatedly (the
    model's train/test sides), partitioning unchanged."""
    return _hold(df.persist(StorageLevel.MEMORY_AND_DISK))


def shared_path(spark: SparkSession) -> str:
    """A new folder name inside the session's shared ``spark.checkpoint.dir`` (deleted by a surrounding ``released``)."""
    return _hold(f"{ensure_checkpoint_dir(spark).rstrip('/')}/punctuo-tables/{uuid.uuid4().hex}")


def checkpoint_table(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table inside the session's
    shared ``spark.checkpoint.dir`` and reading it back.

    Compared with ``DataFrame.checkpoint`` (row-serialised files) the written
    table is read with column pruning and predicate pushdown, and nothing is
    parked on executor disks. It survives executor loss (shared storage) and
    is written once."""
    path = shared_path(df.sparkSession)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


#: Rows of a partition that an iterative fit or a scoring pass reads in one task.
DEALT_ROWS = 100_000


def deal_rows(df: DataFrame, by, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of about ``rows`` (``DEALT_ROWS``) rows, however its files are cut (one row group
    is one task): as many as the rows ask for, so that no task's share grows with the
    table. ``by``: columns that together tell most rows apart. A small table stays as it is."""
    parts = -(-df.count() // (rows or DEALT_ROWS))
    return df.repartition(parts, *[F.col(c) for c in by]) if parts > 1 else df


def non_null(df: DataFrame, cols) -> DataFrame:
    """P6 / pandas ``groupby`` semantics: rows with a NULL key are dropped."""
    cond = None
    for c in cols:
        cnd = F.col(c).isNotNull()
        cond = cnd if cond is None else cond & cnd
    return df if cond is None else df.filter(cond)


def require_rows(df: DataFrame, source: DataFrame, minimum: int) -> DataFrame:
    """Empty result when ``source`` has fewer than ``minimum`` rows.

    Expressed as a scalar subquery (planned once, no join)."""
    n = source.select(F.count(F.lit(1))).scalar()
    return df.filter(n >= F.lit(minimum))
