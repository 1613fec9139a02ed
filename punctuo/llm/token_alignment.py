"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenisations of a text cover the same bytes, so each is a sparse matrix of
tokens by bytes, held in hand-built CSR arrays. The product A·Bᵀ, made row by row
(Gustavson: a row of A gathers the rows of Bᵀ of its bytes and adds up equal
columns), links every token of A with every token of B that it overlaps, with the
number of common bytes. Offsets where tokens of both end cut the text into groups;
two matrices of groups by tokens give the links inside shared groups as G_Aᵀ·G_B.

A text is cut before every space between two other characters, where neither
tokenizer has a token across (checked on the two vocabularies; else a text is one
chunk). The matrices are block-diagonal by chunks, so each distinct chunk is
multiplied once, many chunks in one product, and remembered in two generations of
bounded size.

``A`` is a byte-level BPE file of the tokenizers library without prefix space, which
reads a space and the text; ``B`` a sentencepiece model that adds the space itself.
Strings of special tokens inside texts are plain text.

Defined results: a text that is null or empty, or whose tokens' bytes are not a
space and the text, has no tokens: zeros, an empty text of groups, no links;
repeated rows are aligned alike; an empty table stays empty; other columns pass
through, those with the names of new columns give way to them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuo.llm.bpe_codec import byte_alphabet
from punctuo.llm.slices import slices
from punctuo.operators.util import checkpoint_table

#: A space between two characters that are none.
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"
#: Chunks that one generation remembers, and the longest remembered, in characters.
CHUNKS, LONGEST = 80_000, 64
#: Rows and bytes of one output batch.
ROWS, BYTES = 2048, 1 << 20
#: Chunks, and characters beyond a first one, encoded and multiplied at once.
BLOCK, PRODUCT = 8192, 1 << 18
KINDS = ("end", "overlap", "group")
COLUMNS = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "groups": T.StringType(), "links": T.BinaryType()}


# ---------------------------------------------------------------- sparse rows
def rows_of(lengths: np.ndarray) -> np.ndarray:
    """Row pointers of consecutive rows of these lengths."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def transposed(pointers: np.ndarray, columns: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """CSR of the transposed matrix of ones: ``width`` rows."""
    row = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))
    order = np.argsort(columns, kind="stable")
    return rows_of(np.bincount(columns, minlength=width)), row[order]


def product(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson's row products of two CSR matrices of ones (``b`` has ``width`` columns): row, column and value of each non-zero."""
    row = np.repeat(np.arange(len(a[0]) - 1), np.diff(a[0]))
    taken = b[0][a[1] + 1] - b[0][a[1]]  # length of the row of b that each entry of a gathers
    out = np.repeat(row, taken)
    place = np.arange(len(out)) - np.repeat(np.cumsum(taken) - taken, taken) + np.repeat(b[0][a[1]], taken)
    key = out * width + b[1][place]
    key, value = np.unique(key, return_counts=True)
    return key // width, key % width, value


# ---------------------------------------------------------------- one pair of vocabularies
def id_type(a_size: int, b_size: int) -> str:
    """Links hold ids of two bytes where both vocabularies allow it, else of four."""
    return "<u2" if max(a_size, b_size) <= 1 << 16 else "<u4"


class Aligner:
    def __init__(self, a_path: str, b_path: str, kind: str = "end"):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        own = {c: b for b, c in enumerate(byte_alphabet())}
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for t, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(own[c] for c in t) if all(c in own for c in t) else t.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.asarray([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        across = re.compile(f"[^{SPACE}]{SPACE}")
        self.cut = None if any(across.search(p) for p in pieces) or any(re.search(r"\S ", t.decode("utf-8", "replace")) for t in self.a_bytes) else CUT
        self.kind, self.number = kind, id_type(len(self.a_bytes), len(self.b_bytes))
        #: What stands for a token in the text of groups: of A inside a group and at its end, then of B.
        self.shown = [f"{i}{mark}" for size, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for mark in marks for i in range(size)]
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def possible_links(self) -> int:
        """How many id pairs can end together: the shorter one's bytes are a suffix of the longer one's."""
        count = 0
        for one, other, least in ((self.a_bytes, self.b_bytes, 0), (self.b_bytes, self.a_bytes, 1)):
            have: dict[bytes, int] = {}
            for t in other:
                have[t] = have.get(t, 0) + 1
            count += sum(have.get(t[k:], 0) for t in one for k in range(least, len(t)))
        return count

    def _links(self, ends_a: np.ndarray, ends_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked occurrences: numbers of the tokens of A and of B, rising."""
        if self.kind == "group":
            both = int(group_a[-1]) + 1
            a_of = rows_of(np.bincount(group_a, minlength=both)), np.arange(len(group_a))  # groups by tokens of A
            b_of = rows_of(np.bincount(group_b, minlength=both)), np.arange(len(group_b))
            a, b, _ = product(transposed(*a_of, len(group_a)), b_of, len(group_b))
            return a, b
        n = int(ends_a[-1])
        a_of = np.concatenate([[0], ends_a]), np.arange(n)  # tokens of A by bytes
        b_of = np.concatenate([[0], ends_b]), np.arange(n)
        a, b, _ = product(a_of, transposed(*b_of, n), len(ends_b))
        if self.kind == "end":
            together = ends_a[a] == ends_b[b]
            a, b = a[together], b[together]
        return a, b

    def _shown(self, flat_a: np.ndarray, flat_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Places in ``shown`` of all tokens, A's before B's in each group, and how many tokens stand before each group."""
        n = int(group_a[-1]) + 1
        in_a, in_b = (rows_of(np.bincount(g, minlength=n)) for g in (group_a, group_b))
        out = np.empty(len(flat_a) + len(flat_b), dtype=np.int64)
        last_a, last_b = (np.isin(np.arange(len(f)), i[1:] - 1) for f, i in ((flat_a, in_a), (flat_b, in_b)))
        out[np.arange(len(flat_a)) + in_b[group_a]] = flat_a + last_a * len(self.a_bytes)
        out[np.arange(len(flat_b)) + in_a[group_b + 1]] = flat_b + 2 * len(self.a_bytes) + last_b * len(self.b_bytes)
        return out.tolist(), in_a + in_b

    def _multiply(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> list[tuple]:
        """(groups, each with its end mark, links, n_a, n_b, n_groups) of chunks whose tokens cover the same bytes."""
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        a, b = self._links(ends_a, ends_b, group_a, group_b)
        pairs = np.stack([flat_a[a], flat_b[b]], axis=1).astype(self.number).tobytes()
        first_a = rows_of(np.fromiter(map(len, ids_a), dtype=np.int64))
        link_cut = (2 * int(self.number[-1]) * np.searchsorted(a, first_a)).tolist()
        group_cut = np.append(group_a[first_a[:-1]], len(common))
        shown, before = self._shown(flat_a, flat_b, group_a, group_b)
        token_cut, groups, shows = before[group_cut].tolist(), np.diff(group_cut).tolist(), self.shown.__getitem__
        return [("".join(map(shows, shown[token_cut[i]:token_cut[i + 1]])), pairs[link_cut[i]:link_cut[i + 1]], len(ids_a[i]), len(ids_b[i]), groups[i])
                for i in range(len(ids_a))]

    def _same(self, raw: list[bytes], ids: list[list[int]], spell: list[bytes]) -> list[bool]:
        """Whether each chunk's tokens are its bytes."""
        return [b"".join(map(spell.__getitem__, i)) == r for r, i in zip(raw, ids, strict=True)]

    def learn(self, chunks: list[str]) -> dict[str, tuple | None]:
        """The alignment of each chunk behind a space; None: the bytes differ."""
        spaced = [" " + c for c in chunks]
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(chunks, num_threads=1)
        raw = [s.encode() for s in spaced]
        good = [x and y for x, y in zip(self._same(raw, ids_a, self.a_bytes), self._same(raw, ids_b, self.b_bytes), strict=True)]
        if all(good):
            return dict(zip(chunks, self._multiply(ids_a, ids_b), strict=True))
        out: dict[str, tuple | None] = dict.fromkeys(chunks)
        some = [i for i, g in enumerate(good) if g]
        if some:
            out.update(zip([chunks[i] for i in some], self._multiply([ids_a[i] for i in some], [ids_b[i] for i in some]), strict=True))
        return out

    def learn_all(self, chunks: list[str]) -> dict[str, tuple | None]:
        """``learn`` in blocks; a very long chunk is a block of its own."""
        out: dict[str, tuple | None] = {}
        at = 0
        while at < len(chunks):
            to, size = at + 1, len(chunks[at])
            while to < min(len(chunks), at + BLOCK) and size + len(chunks[to]) <= PRODUCT:
                size += len(chunks[to])
                to += 1
            out.update(self.learn(chunks[at:to]))
            at = to
        return out

    def align(self, texts: list[str]) -> list[list]:
        """Columns n_a, n_b, n_groups, groups, links."""
        lists = [[] if not t or SPACE in t else self.cut.split(t) if self.cut else [t] for t in texts]
        if len(self.known) > CHUNKS:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        here, new = {}, []
        for c in set().union(*lists):
            if c in known:
                here[c] = known[c]
            elif c in old:
                here[c] = known[c] = old[c]
            else:
                new.append(c)
        found = self.learn_all(new)
        known.update((c, x) for c, x in found.items() if len(c) <= LONGEST)
        here.update(found)
        cols: list[list] = [[], [], [], [], []]
        for chunks in lists:
            got = [here[c] for c in chunks]
            if not got or None in got:
                row = (0, 0, 0, "", b"")
            else:
                groups, links, n_a, n_b, n_groups = zip(*got, strict=True)
                row = (sum(n_a), sum(n_b), sum(n_groups), "".join(groups)[:-1], b"".join(links))
            for col, v in zip(cols, row, strict=True):
                col.append(v)
        return cols


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(a_path: str, b_path: str, kind: str) -> Aligner:
    """One per Python worker; Spark already runs a worker per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    name = (a_path, b_path, kind)
    if name not in _ALIGNERS:
        _ALIGNERS[name] = Aligner(*name)
    return _ALIGNERS[name]


# ---------------------------------------------------------------- tables
def _filled(df: DataFrame, old: str, new: dict[str, T.DataType], value, rows: int, size: int) -> DataFrame:
    """``df`` with the columns ``new`` in place of the binary column ``old``; ``value`` makes them from a list."""
    rest = [c for c in df.columns if c != old and c not in new]
    name = next(n for n in (f"value{i}" for i in range(len(rest) + 1)) if n not in rest)
    source = df.select(*[f"`{c}`" for c in rest], df[f"`{old}`"].cast("binary").alias(name))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(n, t) for n, t in new.items()]])
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, len(rest), rows, size):
                got = value(b.column(len(rest)).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(rest)], *[pa.array(v, kinds[t]) for v, t in zip(got, new.values(), strict=True)]], names=[*rest, *new])

    return source.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", links: str = "end") -> DataFrame:
    """``docs`` with the texts replaced by their alignment.

    n_a, n_b, n_groups: tokens and groups; groups: ids of both in order, `a1,a2|b1;a3|b2`;
    links: pairs of ids (A first, little-endian unsigned, see ``id_type``) of the linked
    occurrences. ``links``: "end": byte ranges that end together, "overlap": that have a
    common byte, "group": of the same group (as many as the product of a group's sizes)."""
    if links not in KINDS:
        raise ValueError(f"links must be one of {KINDS}")
    return _filled(docs, text_col, COLUMNS, lambda raw: aligner(a_path, b_path, links).align([(x or b"").decode("utf-8", "replace") for x in raw]), ROWS, BYTES)


def pair_type(a_path: str, b_path: str) -> tuple[str, int]:
    """The ids' type in links, and how many id pairs can end together."""
    a = Aligner(a_path, b_path)
    return a.number, a.possible_links()


def _codes(links: list[bytes | None], number: str) -> np.ndarray:
    pairs = np.frombuffer(b"".join([x or b"" for x in links]), dtype=number).reshape(-1, 2).astype(np.uint64)
    return (pairs[:, 0] << np.uint64(32)) | pairs[:, 1]


def link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, n): how many links of all rows hold the id pair; equal pairs are added up in the tasks first."""
    number, _ = pair_type(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ALIGNERS.clear()  # a worker that aligned texts before need not keep them
        codes, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c) for c in ((codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64), counts)],
                                              names=["a", "b", "n"])

        for whole in batches:
            for batch in slices(whole, 0, 1 << 20, BYTES):
                new, n = np.unique(_codes(batch.column(0).to_pylist(), number), return_counts=True)
                codes, back = np.unique(np.concatenate([codes, new]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, n]).astype(np.float64), minlength=len(codes)).astype(np.int64)  # of one task: exact in a double
                if len(codes) > 1 << 20:
                    yield out()
                    codes, counts = codes[:0], counts[:0]
        yield out()

    return aligned.select("links").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def best_counts(counts: DataFrame) -> DataFrame:
    """``counts`` with ``best``: no other pair of the same B id has more links."""
    counts = checkpoint_table(counts)
    return counts.join(counts.groupBy("b").agg(F.max("n").alias("most")), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum in place of its "end" links.

    The pairs of ``counts`` (a, b, n, best) go to every task: of pairs that end together
    there are no more than the two vocabularies allow (``possible_links``, some 10^5),
    whatever the number of texts; more are an error."""
    number, most = pair_type(a_path, b_path)
    table = counts.select("a", "b", "n", "best").limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ValueError("counts hold pairs that cannot end together")
    codes = (table.column("a").to_numpy().astype(np.uint64) << np.uint64(32)) | table.column("b").to_numpy().astype(np.uint64)
    order = np.argsort(codes)
    sent = aligned.sparkSession.sparkContext.broadcast((codes[order], table.column("n").to_numpy()[order], table.column("best").to_numpy(zero_copy_only=False)[order]))

    def score(links: list[bytes | None]) -> list:
        _ALIGNERS.clear()
        codes, n, best = sent.value
        sizes = np.asarray([len(x or b"") // (2 * int(number[-1])) for x in links], dtype=np.int64)
        at = np.searchsorted(codes, _codes(links, number))
        ends = rows_of(sizes)
        sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)]) for x in (best, n)]
        return [sizes, *[s[ends[1:]] - s[ends[:-1]] for s in sums]]

    return _filled(aligned, "links", {c: T.LongType() for c in ("n_links", "n_best", "count_sum")}, score, 1 << 20, BYTES)
