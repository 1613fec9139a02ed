"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1, piecewise linear
between evenly spaced knots. Its integral is the source's weight in the whole
mix: the mix takes ``share`` times all words, dealt by weight; a source gives at
most ``cap`` times its own words and what it cannot give is dealt to the others
by weight (closed form: with sources by rising size/weight, the water level
stands at the first source that stays under its cap).

Inside a source, documents stand in a fixed random order (md5 of id and text).
Running sums over a source would put a large source in one task, so the order
is cut into ``buckets`` ranges of the hash: running sums inside a bucket, plus
the sums of the buckets before it, which are a small table. The k-th pass over
the source continues the stream, and a document's place in the stream is
inverted through the source's cumulative demand (a quadratic per segment) to
its training position; documents are range-sorted by position. The document at
the end of a source's demand is cut after the words that are still wanted.

Only built-in Spark functions. Defined results: null text has size 0; documents
of size 0 are never taken; a null source is a source of its own, the last one;
repeated rows are documents of their own; empty table: no rows. With ``carry``
all columns of the input stay, whatever their names, in the struct ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuo.operators.util import checkpoint_table

WORD = r"[^\x20\x09-\x0D]+"
#: Weights at the knots, for the sources in turn: means 3, 1 and 2; the first fades, the second grows.
SCHEDULES = ((3.75, 3.0, 2.25), (0.75, 1.0, 1.25), (2.0, 2.0, 2.0))


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of ``text``, joined by blanks."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, n.cast("int")), " ")


def source_targets(totals: DataFrame, schedules=SCHEDULES, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``totals``: a row (source_key, source_size) for each source, in the order of source_key.

    Adds target, curve (weights at the knots) and demand (their integral up to each knot)."""
    knots = len(schedules[0])
    integral = [[sum((s[i] + s[i + 1]) / 2 for i in range(k)) / (knots - 1) for k in range(knots)] for s in schedules]
    pick = lambda values, i: F.element_at(F.array(*[F.array(*map(F.lit, v)) for v in values]), i)
    turn = (F.row_number().over(Window.orderBy("source_key")) - 1) % len(schedules) + 1
    t = totals.withColumn("turn", turn.cast("int"))
    t = t.select("source_key", "source_size", pick([tuple(map(float, s)) for s in schedules], F.col("turn")).alias("curve"),
                 pick(integral, F.col("turn")).alias("demand"))
    t = t.withColumn("weight", F.element_at("demand", -1)).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    every, before = Window.orderBy("ratio", "source_key"), Window.orderBy("ratio", "source_key").rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    level = (share * F.sum("source_size").over(whole) - cap * full("source_size")) / (F.sum("weight").over(whole) - full("weight"))
    t = t.withColumn("level", level)
    # the first source that stays under its cap has the lowest such ratio; before it the level is still above the ratio
    t = t.withColumn("water", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True).over(whole))
    target = F.when(F.col("ratio") <= F.col("water"), cap * F.col("source_size")).otherwise(F.col("water") * F.col("weight"))
    return t.select("source_key", "source_size", F.coalesce(target, cap * F.col("source_size").cast("double")).alias("target"),
                    "curve", "demand")


def position_at(place: Column, target: Column, curve: Column, demand: Column) -> Column:
    """Training time at which a source's cumulative demand reaches ``place`` of its ``target`` words."""
    steps = F.size(curve) - 1
    y = place / target * F.element_at(demand, -1)
    seg = F.least(F.size(F.filter(demand, lambda d: d <= y)), steps)
    w0, w1 = F.element_at(curve, seg), F.element_at(curve, seg + 1)
    left = y - F.element_at(demand, seg)
    root = F.sqrt(F.greatest(w0 * w0 + 2 * (w1 - w0) * steps * left, F.lit(0.0)))
    return F.least((seg - 1) / steps + F.when(left > 0, 2 * left / (w0 + root)).otherwise(0.0), F.lit(1.0))


def mix(docs: DataFrame, schedules=SCHEDULES, share: float = 1.5, cap: float = 2.0, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", buckets: int = 1024, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken
    (words over all passes), passes (array of (words, position), one for each
    pass that takes words of it), position (of the first pass), [row]."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
                       order.alias("order"), F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col))).alias("source_key"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    docs = docs.withColumn("bucket", F.floor(F.conv(F.substring("order", 1, 6), 16, 10).cast("long") * buckets / 2**24).cast("int"))
    if not carry:
        docs = checkpoint_table(docs)
    sums = checkpoint_table(docs.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size")).coalesce(8))
    targets = source_targets(sums.groupBy("source_key").agg(F.sum("bucket_size").alias("source_size")), schedules, share, cap)
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("before"))
    sums = sums.join(targets, "source_key")

    inside = Window.partitionBy("source_key", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["source_key", "bucket"])
    d = d.withColumn("place", F.col("before") + F.col("inside")).withColumn("wanted", F.round("target").cast("long"))
    start = lambda k: k * F.col("source_size") + F.col("place")
    words = lambda k: F.least(F.greatest(F.col("wanted") - start(k), F.lit(0)), F.col("size"))
    at = lambda k: position_at(start(k), F.col("target"), F.col("curve"), F.col("demand"))
    copies = F.transform(F.sequence(F.lit(0), F.lit(int(-(-cap // 1)) - 1)),
                         lambda k: F.struct(words(k).alias("words"), F.when(words(k) > 0, at(k)).alias("position")))
    d = d.withColumn("passes", F.filter(copies, lambda c: c["words"] > 0))
    d = d.withColumn("taken", F.aggregate("passes", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
    d = d.withColumn("position", F.try_element_at("passes", F.lit(1)).getField("position"))
    return d.select("doc_id", "source", "size", "source_size", "target", "taken", "passes", "position", "place", "order",
                    *(["row"] if carry else []))


def by_position(mixed: DataFrame) -> DataFrame:
    """Range sort by training position; documents that the mix doesn't take come last, by their place."""
    last = 1 + F.col("place") / F.greatest(F.col("source_size"), F.lit(1))
    return mixed.orderBy(F.coalesce("position", last), "order")


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: ``docs``' columns, a row for each pass that takes a document, in training order.

    A document that is cut keeps its first words."""
    m = mix(docs, text_col=text_col, carry=True, **options)
    m = m.select("row", "size", "order", F.explode("passes").alias("pass")).orderBy(F.col("pass.position"), "order")
    text = F.col("row").getField(text_col)
    cut = F.when(F.col("pass.words") < F.col("size"), first_words(text, F.col("pass.words"))).otherwise(text)
    return m.select(*[(cut if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
