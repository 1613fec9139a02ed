"""Tokenizer operators against the libraries and brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import docs, empty, texts  # noqa: F401
from pyspark.sql import functions as F

from punctuo.llm import bpe_codec, token_alignment
from punctuo.llm import queries as Q
from punctuo.llm.workers import importable

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def odd_texts():
    rng = random.Random(1)
    out = ["Hello World<|endoftext|> it's ΣΑΣ 12 é\x1c x y", "a" * 5000, "ababab" * 300 + " x", "日本語テキスト" * 50, "İstanbul ŉ ǅ ́e é \x85a\xa0b c ​d",
           "<|startoftext|><|endoftext|>x<|EndOfText|>", "!!!...???" * 20, "\x00\x01 a\x00b", "H̱ É İ x", " lead", "  two  three   ", "x ", " ", "\n\n a \n b\t c",
           "under▁line a▁ b", "<s> </s> <unk> <0x0A>", "don't we'll I'M 'S", "😀😀 zwj 👩‍👩‍👧"]
    for _ in range(300):
        ranges = [(32, 33), (33, 127), (97, 123), (97, 123), (9, 14), (0x80, 0x250), (0x300, 0x370), (0x370, 0x3000), (0x10000, 0x1FFFF)]
        out.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.choice([3, 30, 200]))))
    return out


@pytest.fixture(autouse=True)
def path(spark):
    importable(spark)


@pytest.fixture(scope="module")
def odd(spark, docs):  # noqa: F811
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd_texts())], "doc_id long, text string")
    return docs.unionByName(more, allowMissingColumns=True).withColumn("ids", F.lit(1)).withColumn("links", F.lit("x")).withColumn("n_a", F.lit(2))


def test_bpe_equals_the_library(odd, empty):  # noqa: F811
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD)
    rows = odd.select("doc_id", "text").collect()
    want = Counter()
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, np.asarray(ids, dtype="<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)] += 1
    ids = bpe_codec.encode(odd, WORD)
    assert "text" not in ids.columns and dict(ids.dtypes)["ids"] == "binary" and ids.filter("key = 'k' and n_a = 2").count() == len(rows) - len(odd_texts())
    back = bpe_codec.decode(ids.withColumn("raw", F.col("ids")), WORD)
    assert Counter((r.doc_id, bytes(r.raw), r.text) for r in back.collect()) == want
    assert bpe_codec.encode(empty, WORD).collect() == []


def test_scans_and_heap_merge_alike():
    c = bpe_codec.codec(WORD)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeinorst", k=rng.randint(1, bpe_codec.SHORT))).encode() for _ in range(500)]
    assert c.merge(words) == [c._heap(w) for w in words]


def test_bpe_generations(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe_codec, "CHUNKS", 3)
    monkeypatch.setattr(bpe_codec, "WORDS", 3)
    c, tok = bpe_codec.BytePairs(WORD), Tokenizer.from_file(WORD)
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abc", k=3)) + rng.choice([",", "", "x"]) for _ in range(5)) for _ in range(4)]  # noqa: F811
        assert c.encode([t.encode() for t in texts]) == [np.asarray(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


# ---------------------------------------------------------------- alignment
def aligned_by_hand(text):
    """(ids of A, ids of B, their ends, common ends) of the whole text, None without tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    global _TOOLS
    if "_TOOLS" not in globals():
        a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
        a.encode_special_tokens = True
        _TOOLS = a, b, {c: i for i, c in enumerate(bpe_codec.byte_alphabet())}
    a, b, own = _TOOLS
    if not text:
        return None
    raw = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(own[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    return ids_a, ids_b, ends_a, ends_b, sorted({*ends_a} & {*ends_b})


def groups_by_hand(ids_a, ids_b, ends_a, ends_b, common):
    low, out = 0, []
    for c in common:
        out.append(([i for i, e in zip(ids_a, ends_a, strict=True) if low < e <= c], [i for i, e in zip(ids_b, ends_b, strict=True) if low < e <= c]))
        low = c
    return out


def test_alignment_equals_brute_force(odd, empty):  # noqa: F811
    rows = odd.select("doc_id", "text").filter("length(coalesce(text, '')) < 2500").collect()
    al = token_alignment.align(odd.filter("length(coalesce(text, '')) < 2500"), BYTE, PIECE)
    counts = token_alignment.best_counts(token_alignment.link_counts(al, BYTE, PIECE))
    got = token_alignment.scored(al, counts, BYTE, PIECE)
    assert "text" not in got.columns and got.filter("key = 'k'").count() > 50
    made = [(r.doc_id, aligned_by_hand(r.text)) for r in rows]
    pairs, links = Counter(), []
    for _, x in made:
        here = [] if x is None else [(i, j) for i, e in zip(x[0], x[2], strict=True) for j, f in zip(x[1], x[3], strict=True) if e == f]
        links.append(here)
        pairs.update(here)
    most = defaultdict(int)
    for (_, j), n in pairs.items():
        most[j] = max(most[j], n)
    want = Counter()
    for (doc, x), here in zip(made, links, strict=True):
        if x is None:
            want[doc, 0, 0, 0, "", 0, 0, 0] += 1
            continue
        groups = groups_by_hand(*x)
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want[doc, len(x[0]), len(x[1]), len(groups), text, len(here), sum(pairs[p] == most[p[1]] for p in here), sum(pairs[p] for p in here)] += 1
    assert sum(x is None for _, x in made) >= 4
    assert Counter(tuple(r) for r in got.select("doc_id", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum").collect()) == want
    al = token_alignment.align(empty, BYTE, PIECE)
    assert token_alignment.scored(al, token_alignment.best_counts(token_alignment.link_counts(al, BYTE, PIECE)), BYTE, PIECE).collect() == []


@pytest.mark.parametrize("kind", ["overlap", "group"])
def test_other_links(spark, kind):
    some = [t for t in odd_texts() if len(t) < 300]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    for r in token_alignment.align(df, BYTE, PIECE, links=kind).collect():
        x = aligned_by_hand(some[r.doc_id])
        got = sorted(map(tuple, np.frombuffer(bytes(r.links), dtype="<u2").reshape(-1, 2).tolist()))
        if x is None:
            assert got == []
        elif kind == "group":
            assert got == sorted((i, j) for a, b in groups_by_hand(*x) for i in a for j in b)
        else:
            starts_a, starts_b = [0, *x[2]], [0, *x[3]]
            assert got == sorted((i, j) for i, s, e in zip(x[0], starts_a, x[2], strict=False) for j, t, f in zip(x[1], starts_b, x[3], strict=False) if s < f and t < e)


def test_queries_of_tokens(spark):
    from conftest import SF001

    d = {r.doc_id: r.text or "" for r in Q.table(spark, SF001, "documents").select("doc_id", "text").collect()}
    rows = Q.REGISTRY["op11_rank_array_bpe"](spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD)
    for r in rows[::7]:
        ids = tok.encode(d[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    rows = Q.REGISTRY["op12_token_alignment"](spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d)
    for r in rows[::7]:
        x = aligned_by_hand(d[r.doc_id])
        text = "" if x is None else ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups_by_hand(*x))
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")
