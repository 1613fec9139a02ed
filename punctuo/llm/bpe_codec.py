"""Byte-pair encoding and decoding with a contiguous rank array per word.

A text is cut into words by the vocabulary file's own normaliser and pattern;
words do not depend on each other. A word starts as one part per byte. Beside the
parts lie, in one contiguous array, the ranks of the merges of neighbouring parts.
The smallest rank (the first of equal ones) is found by a scan, its boundary is
deleted, the ranks to both sides are looked up anew, and so on until no rank is
left. Words of up to ``SHORT`` bytes are merged many at a time, one row of a matrix
each; in a longer word, where scans would take time with the square of its length,
the same merges come off a heap.

Words and white-space chunks already encoded are remembered in two generations of
bounded size. There is no shuffle: every row is encoded where it is read.

The file must hold a BPE model over the byte-level alphabet, with or without a word
end mark. Decoding joins tokens as the file's decoder says: none (a space between
any two tokens) or byte-level. Special tokens in a text become their ids.

Defined results: null and empty texts have no ids, no ids decode to an empty text;
repeated rows are encoded alike; an empty table stays empty; other columns pass
through unchanged, one that has the new column's name gives way to it.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from punctuo.llm.slices import slices

#: Longest word, in bytes, that is merged by scans.
SHORT = 64
#: Chunks and words that one generation remembers.
CHUNKS, WORDS = 120_000, 120_000
#: Only chunks of at most so many bytes are remembered.
LONGEST = 64
#: Rows and bytes of text or ids of one output batch.
ROWS, BYTES = 2048, 1 << 20
#: Characters that Python and the file's normaliser lower-case and split alike.
PLAIN = re.compile(r"[\x21-\x7eÀ-įı-ž]*")
#: Letters and marks behind them: two words in every pattern this module takes, the commonest kind of chunk.
WORD_AND_MARKS = re.compile(rb"([a-z]+)([!-&(-/:-@\[-`{-~]*)")
#: First bytes of the combining marks that make one character with an ASCII letter.
MARKS = re.compile(rb"[\xcc\xcd]")
NONE = np.iinfo(np.int32).max


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class BytePairs:
    """Encodes and decodes by one vocabulary file."""

    def __init__(self, path: str):
        import regex
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a plain BPE model is needed")
        vocab, suffix, alphabet = model["vocab"], model.get("end_of_word_suffix") or "", byte_alphabet()
        self.of_byte = np.asarray([vocab[c] for c in alphabet], dtype=np.int32)
        self.of_last = np.asarray([vocab[c + suffix] for c in alphabet], dtype=np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.asarray([vocab[m[i]] for m in merges], dtype=np.int64) for i in (0, 1))
        self.size = max(vocab.values()) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.asarray([vocab["".join(m)] for m in merges], dtype=np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.any_special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.special_bytes = [n.encode() for n in names]
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
            raise ValueError("a pattern of words followed by the byte-level alphabet is needed")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        #: The file's own rules: Unicode NFC, lower case, and words of letters, single digits and runs of marks, but for apostrophes.
        self.lowers = '"Lowercase"' in json.dumps(spec["normalizer"]) and [self.pattern.findall(x) for x in ("ab,.", "a1-")] == [["ab", ",."], ["a", "1", "-"]]
        whole = tokenizers.Tokenizer.from_file(path)
        self.normalizer = whole.normalizer
        self.splitter = tokenizers.pre_tokenizers.Split(tokenizers.Regex(steps[0]["pattern"]["Regex"]), "removed", invert=True)

        decoder = (spec["decoder"] or {"type": None})["type"]
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder} is not supported")
        own = {c: bytes([b]) for b, c in enumerate(alphabet)}
        spell = (lambda t: t.encode()) if decoder is None else (lambda t: b"".join(own[c] for c in t) if all(c in own for c in t) else t.encode())
        self.glue = b" " if decoder is None else b""
        self.token = [b""] * (max([self.size - 1, *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = spell(t)

        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}

    # ------------------------------------------------------------ merges
    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges of neighbours; ``NONE``: no such merge, or a part is -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def _scan(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes, all merged at the same time."""
        count = np.asarray([len(w) for w in words])
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(-1, width)
        column = np.arange(width + 1)
        part = np.full((len(words), width + 1), -1, dtype=np.int32)
        part[:, :width] = np.where(column[:width] < count[:, None], self.of_byte[raw], -1)
        every = np.arange(len(words))
        part[every, count - 1] = self.of_last[raw[every, count - 1]]
        rank = np.full((len(words), width + 1), NONE, dtype=np.int32)
        rank[:, :width] = self._rank(part[:, :-1], part[:, 1:])
        done, who = np.empty((len(words), width), dtype="<u4"), every
        while len(who):
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(who)), at]
            live = low != NONE
            if not live.all():
                done[who[~live]] = part[~live, :width]
                who, part, rank, at, low = who[live], part[live], rank[live], at[live], low[live]
            row = np.arange(len(who))
            shift = np.minimum(column + (column > at[:, None]), width)  # the boundary behind ``at`` goes
            part, rank = np.take_along_axis(part, shift, 1), np.take_along_axis(rank, shift, 1)
            part[row, at] = self.merged[low]
            rank[row, at] = self._rank(part[row, at], part[row, at + 1])
            inner = np.flatnonzero(at)
            rank[inner, at[inner] - 1] = self._rank(part[inner, at[inner] - 1], part[inner, at[inner]])
            count[who] -= 1
        return [d[:n].tobytes() for d, n in zip(done, count, strict=True)]

    def _heap(self, word: bytes) -> bytes:
        """Ids of one long word: the same merges, the next one from a heap of (rank, place)."""
        part = [*self.of_byte[np.frombuffer(word, dtype=np.uint8)].tolist()]
        part[-1] = int(self.of_last[word[-1]])
        n = len(part)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank_of = lambda i: self.rank_of.get(part[i] * self.size + part[after[i]], NONE) if after[i] >= 0 else NONE
        rank = [rank_of(i) for i in range(n)]
        heap = [(r, i) for i, r in enumerate(rank) if r != NONE]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if rank[i] != r:
                continue
            j = after[i]
            part[i], after[i], rank[j] = int(self.merged[r]), after[j], -1
            if after[j] >= 0:
                before[after[j]] = i
            for k in (i, before[i]):
                if k >= 0:
                    rank[k] = rank_of(k)
                    if rank[k] != NONE:
                        heappush(heap, (rank[k], k))
        out, i = [], 0
        while i >= 0:
            out.append(part[i])
            i = after[i]
        return np.asarray(out, dtype="<u4").tobytes()

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each word of at least one byte."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.asarray([len(w) for w in words], dtype=np.int64)
        low, width = 0, 4
        while low < SHORT:
            some = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            for at in range(0, len(some), 1 << 15):
                part = some[at:at + (1 << 15)]
                for i, ids in zip(part, self._scan([words[i] for i in part], width), strict=True):
                    out[i] = ids
            low, width = width, 2 * width
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = self._heap(words[i])
        return out

    # ------------------------------------------------------------ texts
    def _split(self, chunk: bytes) -> list[bytes]:
        if self.lowers and (m := WORD_AND_MARKS.fullmatch(chunk)):
            return [w for w in m.groups() if w]
        s = chunk.decode("utf-8", "replace")
        if PLAIN.fullmatch(s) and (s.isascii() or unicodedata.is_normalized("NFC", s)):
            return [w.encode() for w in self.pattern.findall(s.lower())]
        s = self.normalizer.normalize_str(s) if self.normalizer else s
        return [w.encode() for w, _ in self.splitter.pre_tokenize_str(s)]

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new chunks."""
        if len(self.words) > WORDS:
            self.words, self.old_words = {}, self.words
        known, before = self.words, self.old_words
        split = [(c, self._split(c)) for c in chunks]
        new = dict.fromkeys(w for _, words in split for w in words if w not in known and w not in before)
        found = dict(zip(new, self.merge([*new]), strict=True))
        known.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST)
        for _, words in split:
            for w in words:
                if w not in found:
                    found[w] = known[w] if w in known else known.setdefault(w, before[w])
        return {c: b"".join([found[w] for w in words]) for c, words in split}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        lists: list[list[bytes]] = []
        for t in texts:
            parts = self.any_special.split(t.decode("utf-8", "replace")) if any(s in t for s in self.special_bytes) else None
            if parts is None and self.lowers and not MARKS.search(t):
                t = t.lower()  # before NFC only where no mark could join a letter
            lists.append(t.split() if parts is None else [c for p in parts for c in ([p] if p in self.special else p.encode().split())])  # special tokens stay str
        if len(self.chunks) > CHUNKS:
            self.chunks, self.old_chunks = {}, self.chunks
        known, before = self.chunks, self.old_chunks
        here: dict = {n: np.asarray([i], dtype="<u4").tobytes() for n, i in self.special.items()}  # str keys
        new = set()
        for c in set().union(*lists):
            if c in known:
                here[c] = known[c]
            elif c in before:
                here[c] = known[c] = before[c]
            elif c not in here:
                new.add(c)
        found = self._learn(new)
        known.update((c, ids) for c, ids in found.items() if len(c) <= LONGEST)
        here.update(found)
        return [b"".join(map(here.__getitem__, x)) for x in lists]

    def decode(self, ids: bytes) -> bytes:
        raw = self.glue.join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return raw if self.glue else raw.decode("utf-8", "replace").encode()


_CODECS: dict[str, BytePairs] = {}


def codec(path: str) -> BytePairs:
    """One per Python worker; Spark already runs a worker per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _CODECS:
        _CODECS[path] = BytePairs(path)
    return _CODECS[path]


def _replaced(df: DataFrame, old: str, new: str, kind: T.DataType, value: Callable[[list], list]) -> DataFrame:
    """``df`` with the column ``new`` of ``value`` (a list for a list) in place of ``old``."""
    rest = [c for c in df.columns if c not in (old, new)]
    source = df.select(*[f"`{c}`" for c in rest], df[f"`{old}`"].cast("binary").alias(new))
    schema = T.StructType([*[f for f in source.schema.fields if f.name != new], T.StructField(new, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, len(rest), ROWS, BYTES):
                got = value([x or b"" for x in b.column(len(rest)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], pa.array(got, pa.binary()).cast(arrow)], names=[*rest, new])

    return source.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the texts replaced by their ids: ``out``, little-endian unsigned 32-bit numbers."""
    return _replaced(docs, text_col, out, T.BinaryType(), lambda texts: codec(path).encode(texts))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``tokens`` with the ids replaced by the text they decode to, special tokens included."""
    return _replaced(tokens, ids_col, out, T.StringType(), lambda ids: [*map(codec(path).decode, ids)])
