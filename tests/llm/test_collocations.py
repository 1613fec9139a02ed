"""Collocations against a plain count, and the parts of the sort."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SCHEMA, docs, empty, texts  # noqa: F401

from punctuo.llm import collocations as C
from punctuo.llm.workers import importable


@pytest.fixture(autouse=True)
def path(spark):
    importable(spark)


def test_quicksort_groups_equal_suffixes():
    rng = np.random.default_rng(4)
    for n, kinds in ((1, 1), (50, 2), (2000, 3), (5000, 400), (5000, 100_000)):
        seq = np.concatenate([rng.integers(2, 2 + kinds, n), np.zeros(4, dtype=np.int64)]).astype(np.int32)
        order, starts = C.leading(seq, np.arange(n))
        for deep in range(2, 5):
            order, starts = C.split_equal(order, starts, seq[deep - 1:])
            assert sorted(order.tolist()) == [*range(n)]
            sizes = np.diff(np.append(starts, n))
            want = Counter(tuple(seq[i:i + deep].tolist()) for i in range(n))
            assert {tuple(seq[order[s]:order[s] + deep].tolist()): int(z) for s, z in zip(starts, sizes, strict=True)} == want and len(starts) == len(want)
    order, starts = C.leading(seq, np.empty(0, dtype=np.int64))
    assert len(C.split_equal(order, starts, seq[1:])[0]) == 0


def by_hand(rows, max_words, least, inside, scale, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, p), a in cand.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                longer[lang, p[i:i + size]] = max(longer[lang, p[i:i + size]], a)
    out = []
    for (lang, p), a in cand.items():
        if (lang, p) in longer and 100 * longer[lang, p] >= inside * a:
            continue
        score, k = min((scale * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    seen, rows = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            rows.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


MORE = [("en", "New York. new york, NEW YORK! new\tyork new york times"), (None, "one two three " * 20), ("und", "one two  three; one two\rthree"), ("de", "Ärger ÄRGER ärger " * 9),
        ("de", "a\x0bb\x0cc\x1cd a\x1cb a+b a+b"), ("fr", "...,,, \t \n"), ("", "x y x y x y x y"), ("en", None), ("hot", "of the " * 700)]


@pytest.mark.parametrize(("max_words", "least", "top", "words"), [(3, 10, 2000, 1 << 20), (3, 2, 40, 600), (4, 3, 2000, 2500), (2, 1, 2000, 300)])
def test_collocations_equal_plain_counts(spark, docs, empty, monkeypatch, max_words, least, top, words):  # noqa: F811
    monkeypatch.setattr(C, "WORDS", words)
    rng = random.Random(8)
    more = [*MORE, *((rng.choice(["en", "xx"]), " ".join(rng.choices("abcdefg", k=60)) + ".") for _ in range(40))]
    df = docs.unionByName(spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(more)], "doc_id long, text string, lang string"), allowMissingColumns=True).repartition(5)
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    got = [tuple(r) for r in C.collocations(df, max_words=max_words, least=least, top=top).orderBy("lang", "rank").collect()]
    assert got == by_hand(rows, max_words, least, 50, 1_000_000, top)
    assert C.collocations(empty, max_words=max_words).collect() == []


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(C, "STRIP", 16)
    text = b"short words and averyveryverylongwordwithoutblank. end\nof " + b"y" * 50
    held = C.Words()
    held.add("en", text)
    whole = C.Words()
    monkeypatch.setattr(C, "STRIP", 1 << 20)
    whole.add("en", text)
    assert np.concatenate(held.parts).tolist() == np.concatenate(whole.parts).tolist()


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    a, left, right = 3_000_000_000_017, 4_000_000_000_003, 5_000_000_000_009
    known = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, words int, f long")
    total = spark.createDataFrame([("en", 1 << 50)], "lang string, n long")
    monkeypatch.setattr(C, "frequent_phrases", lambda *_: (known, total))
    row = C.collocations(None).first()
    assert (row.l, row.r, row.score) == (left, right, 1_000_000 * a * a // (left * right))
