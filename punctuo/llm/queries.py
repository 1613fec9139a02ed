"""The thin ``opN_*`` queries: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.llm.workers import importable

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    REGISTRY[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer_path() -> str:
    """The public word-level vocabulary installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op9_order_preserving_packing(spark, sf_dir):
    """Pieces of all documents in windows of 2048 tokens."""
    from punctuo.llm.packing import pack

    p = pack(table(spark, sf_dir, "documents"), word_tokenizer_path())
    return p.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                    F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_trigram_secret_scan(spark, sf_dir):
    """Secrets of all documents: base kinds counted and hashed, all spans listed."""
    from punctuo.llm import secret_scan as S

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = S.scan(docs)
    base = F.filter(F.col("secret_spans"), lambda s: s["order"] < sum(r.base for r in S.RULES))
    n = lambda kind: F.size(F.filter(F.col("secret_spans"), lambda s: s["kind"] == kind)).cast("long")
    return df.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                     F.sha2(S.span_text(base), 256).alias("base_sha256"), S.span_text(F.col("secret_spans")).alias("spans"))


@query
def op3_curriculum_mix(spark, sf_dir):
    """All documents mixed to 150 % of their words, in training order."""
    from punctuo.llm import mixing as M

    m = M.by_position(M.mix(table(spark, sf_dir, "documents")))
    return m.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


def labelled(spark, sf_dir, remainder: int = 2):
    """Labels but for the held-out quarter, and the remainder of every id."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return table(spark, sf_dir, "labels").filter(rest != remainder), rest


@query
def op2_quality_gam(spark, sf_dir):
    """Quality scores of all documents."""
    from punctuo.llm import quality_gam as G

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels, rest = labelled(spark, sf_dir)
    df = G.score(docs, G.train(docs, labels))
    return df.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op1_impact_ordered_topk(spark, sf_dir):
    """The 10 largest inner products of every hundredth vector with all others."""
    from punctuo.llm.topk_search import top_k

    v = table(spark, sf_dir, "embeddings")
    return top_k(v, v.filter(F.col("vec_id") % 100 == 0))


@query
def op6_adaptive_dimension_scan(spark, sf_dir):
    """The 10 nearest vectors found for every hundredth vector."""
    from punctuo.llm.ann_scan import search

    v = table(spark, sf_dir, "embeddings")
    return search(v, v.filter(F.col("vec_id") % 100 == 0))


@query
def op5_context_tree_weighting(spark, sf_dir):
    """Log10 probabilities of all texts, learnt from nine tenths of them."""
    from punctuo.llm.context_tree import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    s = score(docs, rest != 0)
    return s.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                    "n_bytes", "bits_per_byte")


@query
def op7_chosen_path_join(spark, sf_dir):
    """Near-duplicate classes of all documents and each one's number of links."""
    from punctuo.llm import chosen_path as C

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.labelled(docs, C.join(docs))


@query
def op4_paragraph_minhash_dedup(spark, sf_dir):
    """Repeated paragraphs and passages of all documents, but for the first occurrence of each."""
    from punctuo.llm import paragraph_dedup as D

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = D.removals(docs).withColumn("spans", D.merged(F.col("removed")))
    r = r.select("id", "key", "n_paragraphs", F.size("removed").alias("n_removed"),
                 F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"]).alias("removed_bytes"),
                 F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["begin"], s["end"])), ",").alias("removed_spans"),
                 F.array_sort(F.array_distinct(F.transform("removed", lambda x: x["class_id"]))).alias("class_ids"),
                 F.array_sort(F.array_distinct(F.transform("removed", lambda x: x["first_id"]))).alias("first_ids"))
    d = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("key"))
    return d.join(r, d["doc_id"].eqNullSafe(r["id"]) & (d["key"] == r["key"])).select(
        "doc_id", "n_paragraphs", "n_removed", "removed_bytes", "removed_spans", "class_ids", "first_ids")


@query
def op8_suffix_array_dedup(spark, sf_dir):
    """Bytes of all documents in strings of 400 bytes that occur twice."""
    from punctuo.llm import suffix_dedup as S

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lost = S.kept(docs, S.repeats(docs)).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    d = docs.select("doc_id", F.unhex(F.md5(text)).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    none = F.lit(0).cast("long")
    return d.join(lost, "key", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
                                              F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


@query
def op11_rank_array_bpe(spark, sf_dir):
    """Ids of all texts and what they decode to, as hashes."""
    from punctuo.llm import bpe_codec as C

    path = word_tokenizer_path()
    ids = C.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    ids = ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return C.decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query
def op12_token_alignment(spark, sf_dir):
    """All texts' tokens by two tokenizers aligned over their bytes, and how common their links are."""
    import public_tokenizers

    from punctuo.llm import token_alignment as A
    from punctuo.operators.util import checkpoint_table

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    al = A.align(table(spark, sf_dir, "documents").select("doc_id", "text"), *paths)
    al = al.withColumn("groups", F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))).withColumnRenamed("groups", "groups_sha256")
    al = checkpoint_table(al)
    s = A.scored(al, A.best_counts(A.link_counts(al, *paths)), *paths)
    return s.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_quicksort_collocations(spark, sf_dir):
    """The best 2,000 phrases of two and three words of each language."""
    from punctuo.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))
