"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and ratios of the characters, words and lines of a whole
text. Each is cut into quantile bins. Training goes round the features in
cycles; a step fits a shallow tree to the logistic gradient of one feature's
bins (best cuts on the bin histogram, Newton leaf values) and adds it, shrunk,
to that feature's lookup table. Then the pairs that still explain most are
picked and their tables of coarser bins are boosted in the same way. Scoring adds one
table entry per feature and pair: vectorised bin lookups.

Only the fit sees a sample: at most ``max_fit`` labelled rows, those with the
smallest hash of the id. Features and scores cover every row and whole texts.

Defined results: null and empty texts have all features 0 and get the score of
that point; repeated rows are scored alike; ids may be null; unlabelled rows
are scored, not learnt; other columns are ignored. Without labelled rows of
both classes the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.operators.evaluate import hash_sample

FEATURES = ("log_bytes", "words", "word_length", "distinct", "top_word", "same_next", "upper", "upper_words", "digits", "marks",
            "symbols", "pipes", "line_words", "distinct_lines", "stops", "long_words", "marked_words", "non_ascii", "distinct_pairs",
            "ends")
_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 prose mark, 5 symbol, 6 pipe, 7 space, 8 beyond ASCII
for _c in range(256):
    _KIND[_c] = (8 if _c > 127 else 1 if 97 <= _c <= 122 else 2 if 65 <= _c <= 90 else 3 if 48 <= _c <= 57 else 4 if chr(_c) in ".,;:!?'\"-()"
                 else 7 if chr(_c).isspace() else 6 if _c == 124 else 5 if 33 <= _c <= 126 else 0)


def features(text: bytes) -> tuple[float, ...]:
    """The features of one whole text."""
    n = len(text)
    words = text.split()
    m = len(words)
    if not m:
        return (float(np.log1p(n)),) + (0.0,) * (len(FEATURES) - 1)
    kind = np.bincount(_KIND[np.frombuffer(text, dtype=np.uint8)], minlength=9)
    letters = max(1, kind[1] + kind[2] + kind[8])
    count = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    ends = sum(map(count.get, [w for w in count if w[-1] in b".!?"]))
    short = sum(c for w, c in count.items() if len(w) <= 3)
    long = sum(c for w, c in count.items() if len(w) >= 16)
    marked = sum(c for w, c in count.items() if _KIND[w[-1]] in (5, 6))
    upper = sum(c for w, c in count.items() if len(w) > 1 and w.isupper())
    return (float(np.log1p(n)), float(np.log1p(m)), (n - kind[7]) / m, len(count) / m ** 0.75, max(count.values()) / m, same / m,
            kind[2] / letters, upper / m, kind[3] / n, kind[4] / n, kind[5] / n, kind[6] / n, float(np.log1p(m / max(1, len(lines)))),
            len(set(lines)) / max(1, len(lines)), short / m, long / m, marked / m, kind[8] / n,
            len(set(zip(words, words[1:]))) / m, ends / m)


@dataclass
class Gam:
    """Lookup tables: ``edges`` and ``tables`` by feature, ``pairs`` of (feature, feature, table over coarse bins)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, j], side="right")]
        for a, b, t in self.pairs:
            out += t[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, least: float, ridge: float) -> np.ndarray:
    """A tree over ordered bins with gradient sums ``g`` and curvature sums ``h``: the value of each bin."""
    gs, hs = g.sum(), h.sum()
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
        gain[(hl < least) | (hs - hl < least)] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] > 1e-9:
            return np.concatenate([_tree(g[:k + 1], h[:k + 1], depth - 1, least, ridge), _tree(g[k + 1:], h[k + 1:], depth - 1, least, ridge)])
    return np.full(len(g), gs / (hs + ridge))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse_bins: int = 8, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 8,
        depth: int = 2, rate: float = 0.15, least: float = 3.0, ridge: float = 1.0) -> Gam:
    """Cyclic boosting of one table per feature, then of the best pairs."""
    n_features = x.shape[1]
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Gam(float(np.log(p / (1 - p))), [np.empty(0)] * n_features, [np.zeros(1)] * n_features)
    p = y.mean()
    m = Gam(float(np.log(p / (1 - p))), [_cuts(x[:, j], bins) for j in range(n_features)], [])
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    m.coarse = [_cuts(x[:, j], coarse_bins) for j in range(n_features)]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(m.edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(m.coarse)]
    f = np.full(len(y), m.base)

    def sums(b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-f))
        return np.bincount(b, y - q, size), np.bincount(b, np.maximum(q * (1 - q), 1e-6), size)

    for _ in range(rounds):
        for j, b in enumerate(at):
            step = rate * _tree(*sums(b, len(m.tables[j])), depth, least, ridge)
            m.tables[j] += step
            f += step[b]
    found = []
    for a in range(n_features):
        for b in range(a + 1, n_features):
            wide = len(m.coarse[b]) + 1
            g, h = sums(rough[a] * wide + rough[b], (len(m.coarse[a]) + 1) * wide)
            found.append((float((g**2 / (h + ridge)).sum()), a, b))
    best = [(a, b, np.zeros((len(m.coarse[a]) + 1, len(m.coarse[b]) + 1))) for _, a, b in sorted(found, reverse=True)[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, t in best:
            cell = rough[a] * t.shape[1] + rough[b]
            g, h = (v.reshape(t.shape) for v in sums(cell, t.size))
            # one cut of the first feature, then a shallow tree over the second on either side
            gl, hl = np.cumsum(g.sum(1))[:-1], np.cumsum(h.sum(1))[:-1]
            k = int(np.argmax(gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge))) + 1 if len(gl) else len(g)
            step = np.empty_like(t)
            for part in (slice(0, k), slice(k, None)):
                if len(g[part]):
                    step[part] = rate * _tree(g[part].sum(0), h[part].sum(0), depth, least, ridge)
            t += step
            f += step.ravel()[cell]
    m.pairs = best
    return m


def feature_frame(docs: DataFrame, id_col: str, text_col: str, *keep: str) -> DataFrame:
    """``keep`` columns and one array column of features for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", *keep)], pa.array(x, type=pa.list_(pa.float64()))],
                                             names=["doc_id", *keep, "features"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)) + ", features array<double>")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_fit: int = 20_000,
          **options) -> Gam:
    """Fits on at most ``max_fit`` labelled rows: those with the smallest hash of the id.

    ``labels`` are small keys; the rows are picked before any text is joined."""
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).filter("doc_id is not null and y is not null")
    y = hash_sample(y.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id", max_fit)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = d.join(F.broadcast(y), "doc_id")  # at most max_fit rows of two numbers
    rows = feature_frame(rows, "doc_id", "text", "y").orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(max_fit).toPandas()
    x = np.stack(rows["features"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows["y"].to_numpy(dtype=float), **options)


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with one more column: the chance of label 1. All columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            x = np.array([features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))
            yield pd.Series(m.score(x))

    return docs.withColumn(out, run(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
