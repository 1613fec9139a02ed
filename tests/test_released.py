"""Working tables and caches are given back at the end of a block."""

from pathlib import Path
from urllib.parse import urlparse

import pytest

from punctuo.operators import util
from punctuo.session import ensure_checkpoint_dir


def tables(spark):
    at = Path(urlparse(ensure_checkpoint_dir(spark)).path) / "punctuo-tables"
    return {p.name for p in at.iterdir()} if at.exists() else set()


def cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_block_deletes_its_tables_and_caches_only(spark, tmp_path):
    kept = util.checkpoint_table(spark.range(3))
    before, rdds = tables(spark), cached(spark)
    with util.released(spark):
        t = util.checkpoint_table(spark.range(5))
        m = util.materialize(t.selectExpr("id * 2 AS x"))
        with util.released(spark):
            inner = util.checkpoint_table(spark.range(2))
            assert inner.count() == 2 and len(tables(spark)) == len(before) + 2
        assert len(tables(spark)) == len(before) + 1 and cached(spark) >= rdds
        m.write.parquet(str(tmp_path / "out"))
        assert cached(spark) > rdds
    assert tables(spark) == before and cached(spark) == rdds
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5 and kept.count() == 3


def test_block_gives_back_after_an_error(spark):
    before = tables(spark)
    with pytest.raises(ValueError), util.released(spark):
        util.checkpoint_table(spark.range(5))
        raise ValueError
    assert tables(spark) == before
