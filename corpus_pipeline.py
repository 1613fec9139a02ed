"""The corpus pipeline: documents are filtered, de-duplicated, redacted, mixed and packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's rows as Parquet in the
shared checkpoint folder and gives the next stage the rows read back.

Defined results: null texts are empty texts, which the quality model scores like
any other; repeated rows and equal texts are one group, of which one row stays;
ids, sources and labels may be null; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.llm import chosen_path, mixing, packing, quality_gam, secret_scan
from punctuo.llm.queries import labelled, word_tokenizer_path
from punctuo.llm.workers import importable
from punctuo.operators.util import checkpoint_table

#: The stages fit models, verify sets and run a tokenizer: SQL can't express them. What tests/llm holds against brute force: see README.
ORACLE_SQL: str | None = None
#: A document with a lower chance of label 1 goes.
KEEP_FROM = 0.5


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, doesn't reject."""
    importable(spark)
    labels, _ = labelled(spark, sf_dir)
    model = quality_gam.train(docs, labels)
    score = secret_scan.fresh(docs, "quality_score")
    return quality_gam.score(docs, model, out=score).filter(F.col(score) >= KEEP_FROM).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    importable(spark)
    return chosen_path.first_of_each(docs, chosen_path.join(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked."""
    return _measured(secret_scan.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: documents left out, taken once or more than once, the last one of a source cut."""
    return _measured(mixing.mixed_documents(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the training sequences: doc_id, start, ids, doc_tokens, sequence_id, offset."""
    importable(spark)
    return packing.pack(docs, word_tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("sequences", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpoint_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
