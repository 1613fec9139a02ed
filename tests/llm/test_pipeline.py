"""The pipeline: stages in order, columns kept, every decision takes effect."""

import corpus_pipeline
from punctuo.llm import chosen_path
from punctuo.operators.util import checkpoint_table
from test_documents import shingles

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "sequences"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, SF).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    bad = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0")
    assert good.join(bad, "doc_id").count() <= 0.1 * bad.count()
    one = corpus_pipeline.near_duplicates(spark, good, SF).cache()
    assert one.columns == docs.columns
    assert one.count() == chosen_path.labelled(good, chosen_path.join(good)).select("class_id").distinct().count()
    safe = corpus_pipeline.secrets(spark, one, SF).cache()
    assert safe.count() == one.count() and safe.filter("text rlike 'AKIA[A-Z0-9]{16}|[0-9a-f]{24}'").count() == 0
    mixed = corpus_pipeline.mixture(spark, safe, SF)
    assert mixed.columns == docs.columns and mixed.filter("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.sequences(spark, mixed, SF)
    assert pieces.groupBy("sequence_id").sum().count() > 0


def test_run_keeps_one_of_each_group(spark):
    """Groups rebuilt in plain Python: one row of each stays, and no other document reaches the sequences."""
    small = "/root/testdata/sf0.001"
    good = checkpoint_table(corpus_pipeline.quality(spark, spark.read.parquet(f"{small}/documents.parquet"), small))
    rows = [(r.doc_id, shingles(r.text)) for r in good.collect()]
    root = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a == b or a and b and len(a & b) >= 0.8 * len(a | b):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    group = {d: root[i] for i, (d, _) in enumerate(rows)}
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, good, small).select("doc_id").collect()]
    assert len(group) == len(rows) and sorted(group[d] for d in kept) == sorted(set(root))
    pieces = corpus_pipeline.run(spark, small).collect()
    assert pieces and {r.doc_id for r in pieces} <= set(kept)
    assert all(0 <= r.start and r.start + len(r.ids) // 4 <= r.doc_tokens for r in pieces)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
