"""Splits and evaluation on a scored table.

Scalars that the reference computes on the driver (train share, train median —
exact, via ``quantiles``) are scalar subqueries here: Spark evaluates them once and inlines the value —
no join. Quantile edges (a parameter-bounded handful of numbers) are fetched
once and used as a literal array, as Spark ML's QuantileDiscretizer does.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuo import config as C
from punctuo.functions import columns as X
from punctuo.operators.quantiles import bounded_array as _bounded_array
from punctuo.operators.quantiles import exact_quantiles, median_scalar
from punctuo.operators.util import checkpoint_table, materialize, sized_broadcast


def _y(label: str) -> Column:
    return F.col(label).cast("double")


# --------------------------------------------------------------------------
# M3, M4: splits
# --------------------------------------------------------------------------
def day_split(df: DataFrame, test_share: float = C.TEST_SHARE, seed: int = C.SEED, day: str = "day") -> DataFrame:
    """M3: whole days to test — the first ceil(share · n_days) days in md5(day ‖ seed)
    order. Runs on the distinct days (bounded by the calendar), not on rows."""
    days = df.select(day).filter(F.col(day).isNotNull()).distinct()
    n_days = days.select(F.count(F.lit(1))).scalar()
    h = F.md5(F.concat(F.col(day).cast("string"), F.lit(str(seed))))
    w = Window.orderBy(h, F.col(day))
    return (days.withColumn("_rank", F.row_number().over(w))
                .select(day, (F.col("_rank") <= F.ceil(n_days * F.lit(test_share))).alias("is_test")))


def hash_sample(df: DataFrame, key: str, k: int, seed: int = C.SEED, oversample: float = 3.0) -> DataFrame:
    """Exactly the ``k`` rows with the smallest ``xxhash64(key, seed)`` (a
    reproducible sample without replacement).

    A plain ``orderBy(h).limit(k)`` merges k rows from EVERY partition in one
    task (k × partitions rows at scale). Here rows are first filtered by a hash
    threshold that keeps ≈ ``oversample`` · k rows; every dropped row hashes
    above every kept one, so the top-k of the kept rows is the global top-k."""
    h = F.xxhash64(F.col(key), F.lit(seed))
    n = df.count()
    cut = -(2 ** 63) + int(min(1.0, oversample * k / max(n, 1)) * 2 ** 64) - 1
    # hashes at or below the cut; the k-th smallest lies beyond it only by the rare chance that the count shows
    near = df.filter(h <= F.lit(min(cut, 2 ** 63 - 1)))
    while cut < 2 ** 63 - 1 and near.limit(k).count() < k:
        cut = min(cut + 2 ** 62, 2 ** 63 - 1)
        near = df.filter(h <= F.lit(cut))
    return near.orderBy(h, F.col(key)).limit(k)


def split_for_model(df: DataFrame, method: str = "days", test_share: float = C.TEST_SHARE, seed: int = C.SEED,
                    years: tuple[int, int] | None = None) -> DataFrame:
    """M3 / M4: ``is_test`` by whole days (default) or train-one-year / test-the-next."""
    if method == "year":
        if years is None:
            raise ValueError("years=(train_year, test_year) is required for the year split")
        return year_split(df, *years)
    return with_split(df, day_split(df, test_share, seed))


def with_split(df: DataFrame, split: DataFrame, day: str = "day", max_rows: int = 2_000_000) -> DataFrame:
    """Attach ``is_test`` by day: the split table (one row per day) is persisted,
    size-checked and broadcast, so the fact side is not shuffled."""
    return df.join(sized_broadcast(materialize(split), max_rows), day, "inner")


def year_split(df: DataFrame, train_year: int, test_year: int) -> DataFrame:
    """M4: train one year, test the next (rows of other years are left out)."""
    y = F.col("year")
    return df.filter(y.isin(train_year, test_year)).withColumn("is_test", y == test_year)


def split_summary(df: DataFrame, day: str = "day") -> DataFrame:
    """Rows and distinct days per side of a split."""
    return df.groupBy(F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")).alias("side")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(day).alias("n_days"))


# --------------------------------------------------------------------------
# Baseline and metrics
# --------------------------------------------------------------------------
def baseline(df: DataFrame, label: str = "is_late", delay: str = "delay_min") -> DataFrame:
    """M5: train late share, test late share, Brier of the constant train share,
    MAE of the train median — on a table with ``is_test``."""
    train = df.filter(~F.col("is_test"))
    share = train.select(F.avg(_y(label))).scalar()
    med = median_scalar(train, delay)
    test = df.filter(F.col("is_test"))
    return test.agg(
        share.alias("train_late_share"),
        F.avg(_y(label)).alias("test_late_share"),
        F.avg(F.pow(_y(label) - share, 2)).alias("brier_const"),
        F.avg(F.abs(F.col(delay) - med)).alias("mae_const"),
    )


def score_metrics(test: DataFrame, score: str = "p_late", label: str = "is_late", delay: str = "delay_min",
                  pred: str = "pred_min") -> DataFrame:
    """Brier, MAE, R² in one aggregation (R² via the population variance)."""
    err = F.col(delay) - F.col(pred)
    return test.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow(F.col(score) - _y(label), 2)).alias("brier"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.sum(F.pow(err, 2)) / (F.var_pop(delay) * F.count(delay))).alias("r2"),
    )


def overall(test: DataFrame, score: str = "p_late", label: str = "is_late") -> DataFrame:
    """Mean predicted chance vs actual late share (%)."""
    return test.agg((F.avg(score) * 100).alias("pred_pct"), (F.avg(_y(label)) * 100).alias("actual_pct"))


def skill(df: DataFrame, score: str = "p_late", label: str = "is_late", delay: str = "delay_min",
          pred: str = "pred_min") -> DataFrame:
    """Model vs constant: MAE gain, chance − train share, 'never warn' accuracy."""
    train = df.filter(~F.col("is_test"))
    share = train.select(F.avg(_y(label))).scalar()
    med = median_scalar(train, delay)
    test = df.filter(F.col("is_test"))
    return test.agg(
        (F.avg(F.abs(F.col(delay) - med)) - F.avg(F.abs(F.col(delay) - F.col(pred)))).alias("mae_gain"),
        (F.avg(score) - share).alias("chance_minus_train_share"),
        (F.lit(1.0) - F.avg(_y(label))).alias("never_warn_accuracy"),
    )


# --------------------------------------------------------------------------
# AUC (exact, distributed)
# --------------------------------------------------------------------------
#: Most ranges that the distinct scores are cut into, and the scores a range should hold.
MAX_RANGES, PER_RANGE = 1024, 1 << 16


def score_ranges(d: DataFrame, score: str, per_range: int = PER_RANGE) -> Column:
    """Edges that cut the distinct scores of ``d`` into ranges of about ``per_range``.

    One quantile sketch, merged over the tasks, gives all ``MAX_RANGES`` - 1 edges and
    the number of scores; of the edges as many are used as the number asks for."""
    n, edges = d.agg(F.count(score), F.percentile_approx(score, [i / MAX_RANGES for i in range(1, MAX_RANGES)], 10 * MAX_RANGES)).first()
    ranges = min(MAX_RANGES, max(1, -(-n // per_range)))
    used = sorted({float(edges[i * MAX_RANGES // ranges - 1]) for i in range(1, ranges)})
    return F.array(*[F.lit(e) for e in used]).cast("array<double>")


def auc(df: DataFrame, score: str = "p_late", label: str = "is_late", per_range: int = PER_RANGE) -> DataFrame:
    """M10 AUC = P(score_pos > score_neg) + ½ P(tie), exact.

    1. positives/negatives per distinct score (partial aggregation);
    2. a quantile sketch of the distinct scores cuts them into ranges of similar
       size, as many as the scores need (``score_ranges``), however near to each
       other they lie;
    3. negatives below a score = negatives of lower ranges (at most ``MAX_RANGES``
       rows) + running sum inside the range (window partitioned by range).
    """
    y = F.col(label)
    d = df.filter(F.col(score).isNotNull() & y.isNotNull()).groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    edges = score_ranges(d, "_s", per_range)
    s = F.col("_s")
    d = d.withColumn("_b", F.size(F.filter(edges, lambda e: e < s)))
    per_b = d.groupBy("_b").agg(F.sum("neg").alias("_bneg"))
    per_b = per_b.withColumn("_neg_before", F.coalesce(
        F.sum("_bneg").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_neg_in", F.coalesce(F.sum("neg").over(inner), F.lit(0)))
    j = d.join(F.broadcast(per_b.select("_b", "_neg_before")), "_b")
    wins = F.col("pos").cast("double") * (F.col("_neg_before") + F.col("_neg_in") + F.col("neg") * 0.5)
    return j.agg((F.sum(wins) / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("auc"))


def auc_by_group(df: DataFrame, groups: Sequence[str], score: str = "p_late", label: str = "is_late") -> DataFrame:
    """Exact AUC per group for BOUNDED groups (e.g. the ≤ 8000-row importance
    sample per permuted feature): running sums inside each group."""
    y = F.col(label)
    d = df.groupBy(*groups, score).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    w = Window.partitionBy(*groups).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_below", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    wins = F.col("pos").cast("double") * (F.col("_below") + F.col("neg") * 0.5)
    return d.groupBy(*groups).agg((F.sum(wins) / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("auc"))


# --------------------------------------------------------------------------
# M8: permutation importance over all rows
# --------------------------------------------------------------------------
def _seeded(key: str, *parts) -> Column:
    """A hash order that SQL can repeat: md5 of the key and the parts, joined by bars."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), *[F.lit(str(p)) for p in parts]))


def row_numbers(df: DataFrame, order: Column, tie: str, name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the order of an md5 (ties by ``tie``), without bringing all rows to one task.

    The hash is cut into 1,024 ranges; a table of their sizes (as many rows) gives each
    range's offset, and rows are numbered inside ranges."""
    marked = df.withColumn("_h", order)
    marked = marked.withColumn("_b", F.expr("cast(conv(substring(_h, 1, 3), 16, 10) as int) div 4"))
    sizes = marked.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).agg(F.collect_list(F.struct("_b", "n")).alias("s"))
    before = F.transform("s", lambda x: F.struct(x["_b"].alias("_b"), F.aggregate(
        F.filter("s", lambda y: y["_b"] < x["_b"]), F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("_before")))
    offsets = sizes.select(F.inline(before))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", tie))
    return marked.withColumn("_i", inside).join(F.broadcast(offsets), "_b").select(*df.columns, (F.col("_before") + F.col("_i")).alias(name))


def permuted_auc_drop(test: DataFrame, cols: Sequence[str], scored: Callable[[DataFrame], DataFrame], key: str, repeats: int = C.IMPORTANCE_REPEATS,
                      seed: int = C.SEED, score: str = "p_late", label: str = "is_late") -> DataFrame:
    """M8: how much the AUC over ALL rows of ``test`` falls when one column's values change places at random.

    ``scored`` adds ``score`` to rows. Rows are numbered in one hash order, a column's
    values in another one per column and repeat, and the two are joined by number: one
    column at a time, so the work is that of a join and a scoring per column and repeat.
    Only the numbers of the result come to the driver."""
    base = checkpoint_table(row_numbers(test, _seeded(key, seed), key, "_n"))

    def auc_of(rows: DataFrame) -> float | None:
        return auc(checkpoint_table(scored(rows).select(score, label)), score, label).first()["auc"]

    whole, out = auc_of(base.drop("_n")), []
    for c in cols:
        parts = []
        for r in range(repeats):
            donor = row_numbers(base.select(F.col(key).alias("_key"), F.col(c).alias("_value")), _seeded("_key", c, r, seed), "_key", "_n").select("_n", "_value")
            rows = base.join(donor, "_n").withColumn(c, F.col("_value")).drop("_n", "_value")
            parts.append(auc_of(rows))
        out.append((c, None if whole is None or None in parts else whole - sum(parts) / len(parts)))
    df = test.sparkSession.createDataFrame(out, "feature string, auc_drop double")
    return df.orderBy(F.desc("auc_drop"), "feature")


# --------------------------------------------------------------------------
# Calibration, confusion, error views
# --------------------------------------------------------------------------
def calibration(test: DataFrame, groups: int = 10, score: str = "p_late", label: str = "is_late") -> DataFrame:
    """M11 + C24: equal-frequency groups of the score (exact quantile edges,
    duplicates dropped, right-closed, lowest included); mean score, late rate, n.

    The edges (``groups + 1`` numbers) come from ``exact_quantiles``, which
    selects them by value ranges and never gathers all distinct scores in one task."""
    probs = [i / groups for i in range(groups + 1)]
    edges = _bounded_array(exact_quantiles(test, score, probs).select(F.array_distinct("q")))
    binned = test.withColumn("bin", X.quantile_bin(score, edges)).filter(F.col("bin").isNotNull())
    return binned.groupBy("bin").agg(F.avg(score).alias("p_mean"), F.avg(_y(label)).alias("late_rate"),
                                     F.count(F.lit(1)).alias("n"))


def thresholds(start: float = C.THRESHOLD_FROM, stop: float = C.THRESHOLD_TO, step: float = C.THRESHOLD_STEP) -> list[float]:
    n = int(round((stop - start) / step)) + 1
    return [round(start + step * i, 2) for i in range(n)]


def confusion_sweep(test: DataFrame, ts: Sequence[float] | None = None, score: str = "p_late",
                    label: str = "is_late") -> DataFrame:
    """Confusion cells, precision, recall, accuracy per threshold.

    One pass: each row falls into one bin, the number of thresholds at or below its
    score; the bins (one more than thresholds) are summed up from the top. Rows
    without a score or label are in no cell; zero denominators give 0."""
    ts = sorted(thresholds() if ts is None else map(float, ts))
    y = F.col(label)
    below = F.filter(F.array(*[F.lit(t) for t in ts]), lambda t: t <= F.col(score))
    h = test.groupBy(F.when(F.col(score).isNotNull(), F.size(below)).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg"))
    s = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")
    k = F.col("_k")
    cells = [F.struct(F.lit(t).alias("threshold"), s(k > i, "_pos").alias("tp"), s(k > i, "_neg").alias("fp"), s(k <= i, "_pos").alias("fn"), s(k <= i, "_neg").alias("tn"))
             for i, t in enumerate(ts)]
    agg = h.agg(F.array(*cells).alias("_cells"), F.sum("_n").alias("_n")).filter("_n > 0").select(F.inline("_cells"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select("threshold", "tp", "fp", "fn", "tn",
                      (tp / F.greatest(tp + fp, F.lit(1))).alias("precision"),
                      (tp / F.greatest(tp + fn, F.lit(1))).alias("recall"),
                      ((tp + tn) / F.when(tp + fp + fn + tn > 0, tp + fp + fn + tn)).alias("accuracy"))


def by_day(test: DataFrame, min_n: int, score: str = "p_late", label: str = "is_late", day: str = "day",
           extra: str | None = "wpgt") -> DataFrame:
    """Per day actual vs predicted (%), n ≥ min_n, error = actual − predicted."""
    aggs = [(F.avg(_y(label)) * 100).alias("actual_pct"), (F.avg(score) * 100).alias("pred_pct"),
            F.count(F.lit(1)).alias("n")]
    if extra and extra in test.columns:
        aggs.append(F.first(extra, ignorenulls=True).alias(extra))
    out = test.groupBy(day).agg(*aggs).filter(F.col("n") >= min_n)
    return out.withColumn("error", F.col("actual_pct") - F.col("pred_pct"))


def by_hour(test: DataFrame, min_n: int, score: str = "p_late", label: str = "is_late") -> DataFrame:
    """Per hour actual vs predicted (%), n ≥ min_n, absolute gap."""
    out = test.groupBy("hour").agg((F.avg(_y(label)) * 100).alias("actual_pct"), (F.avg(score) * 100).alias("pred_pct"),
                                   F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_n)
    return out.withColumn("abs_gap", F.abs(F.col("actual_pct") - F.col("pred_pct")))


def by_delay_class(test: DataFrame, edges=C.DELAY_CLASS_EDGES, labels=C.DELAY_CLASS_LABELS, score: str = "p_late",
                   delay: str = "delay_min") -> DataFrame:
    """Mean predicted chance (%) per actual-delay class (left-closed)."""
    b = X.bin_number(delay, edges, closed="left")
    return (test.select(b.alias("class_no"), score).filter(F.col("class_no").isNotNull())
                .groupBy("class_no").agg((F.avg(score) * 100).alias("pred_pct"), F.count(F.lit(1)).alias("n"))
                .withColumn("delay_class", X.ordinal_name("class_no", labels, base=1)))
