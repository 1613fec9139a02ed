"""Order-preserving packing of tokenised documents into fixed windows.

Documents keep the order in which a partition reads them and form one token
stream per partition. A dynamic program chooses the window cuts: a window of
``window`` tokens pays one unit per token of padding, a cut inside a sentence
pays ``mid_penalty``, a cut at a sentence end ``sentence_penalty`` and a cut at
a document end nothing. With ``g(j) = f(j) + p_j`` the transition

    f(i) = penalty(i) + window - p_i + min{ g(j) : p_i - p_j <= window }

is a sliding-window minimum, kept in a monotone queue. The stream is handled
in blocks of ``block_tokens``; what follows a block's last cut is carried into
the next block, so memory is bounded by a block plus one document. What is left
at the end of a partition is cut at powers of two, which need no padding.

There is no shuffle: every partition is packed where it is read, and a lost
task is packed again from its input.

Defined results: null text is an empty text (one end id); empty and repeated
rows are documents of their own; a null id stays null; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.llm.bpe_codec import byte_alphabet

PIECES = ("doc_id {id}, start long, ids binary, doc_tokens long, sequence_id long, offset long")
#: Texts of these characters are lower-cased and split alike by Python and by the tokenizer's normaliser.
PLAIN = re.compile(r"[\x00-\x7fÀ-įı-ž]*")
#: Lower-case letters, in UTF-8, and marks: a word, or one with marks behind it, are the commonest chunks, split without the tokenizer's own pattern.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Chunks that one generation remembers, chunks looked up at once, and bytes of text that are tokenised at once.
CHUNKS, PART, GROUP = 600_000, 1 << 17, 1 << 18


class WordTokenizer:
    """Ids of texts by a tokenizer whose words do not depend on each other.

    White space always ends a word, so the ids of a text are those of its
    white-space chunks in a row; a chunk's ids are those of its words (letters,
    digits, others), and a word alone is a chunk. Chunks are remembered in two
    generations of bounded size: a full one becomes the old one, and what is used
    again moves back. Chunks outside the plain Latin repertoire go through the whole
    tokenizer."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        #: Tokens of one word, given as one character a byte.
        self.word = self.full.model.tokenize
        self.spell = dict(enumerate(byte_alphabet())) | {32: " "}
        vocab = self.full.get_vocab()
        #: By id: a token of closing marks only ends a sentence.
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocab.items() if re.fullmatch(r"[.!?]+(</w>)?", t)]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}

    @staticmethod
    def _pack(ids) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, dtype="<u4").tobytes()

    def _words(self, chunk: bytes) -> list[bytes] | None:
        """The words of a chunk, None if only the whole tokenizer can tell."""
        letters = chunk.rstrip(MARKS)
        if LETTERS.fullmatch(letters):
            return [letters, chunk[len(letters):]] if len(letters) < len(chunk) else [chunk]
        s = chunk.decode("utf-8", "replace")
        if PLAIN.fullmatch(s) and "<|" not in s and (s.isascii() or unicodedata.is_normalized("NFC", s)):
            return [w.encode() for w in self.split.findall(s.lower())]
        return None

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; none holds white space."""
        ids: list[int] = []
        ends = []
        for w in b" ".join(words).decode("latin-1").translate(self.spell).split(" ") if words else ():
            ids += [t.id for t in self.word(w)]
            ends.append(4 * len(ids))
        raw = self._pack(ids)
        return [raw[i:k] for i, k in zip([0, *ends], ends)]

    def learn(self, chunks: set[bytes]) -> None:
        """Remembers the ids of chunks that this generation does not know."""
        if len(self.chunks) + len(chunks) > CHUNKS:
            self.chunks, self.old_chunks = {}, self.chunks
        known, old = self.chunks, self.old_chunks
        new: dict[bytes, None] = {}
        parts: list[tuple[bytes, list[bytes]]] = []
        for c in chunks:
            if (ids := old.get(c)) is not None:
                known[c] = ids
            elif c.isalpha() and c.islower():
                new[c] = None
            elif (words := self._words(c)) is None:
                known[c] = self._pack(self.full.encode(c.decode("utf-8", "replace"), add_special_tokens=False).ids)
            else:
                if words != [c]:
                    parts.append((c, words))
                for w in words:
                    if w not in known:
                        if (ids := old.get(w)) is not None:
                            known[w] = ids
                        else:
                            new[w] = None
        known.update(zip(new, self._encode(list(new)), strict=True))
        for c, words in parts:
            known[c] = b"".join([known[w] for w in words])

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        chunks: list[bytes] = []
        ends = []
        for text in texts:
            chunks += (text if b"<|" in text else text.lower()).split()  # the tokenizer lowers all but its special tokens
            ends.append(len(chunks))
        ids: list[bytes] = []
        for at in range(0, len(chunks), PART):
            part = chunks[at:at + PART]
            found = list(map(self.chunks.get, part))
            if holes := [i for i, x in enumerate(found) if x is None]:
                self.learn({part[i] for i in holes})
                for i in holes:
                    found[i] = self.chunks[part[i]]
            ids += found
        for i, k in zip([0, *ends], ends):
            yield b"".join(ids[i:k])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker; Spark already runs a worker per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def choose_cuts(total: int, ends: np.ndarray, sentences: np.ndarray, window: int, sentence_penalty: float,
                mid_penalty: float, step: int, last: bool) -> list[int]:
    """Cut positions in a stream of ``total`` tokens, ascending, without 0.

    Candidates are document ends, sentence ends and, in longer sentences, every
    ``step``-th position. With ``last`` the stream ends here and the cuts reach
    ``total``; otherwise they stop at the best candidate of the last window."""
    if not total:
        return []
    pos = np.unique(np.concatenate([[0], sentences, ends, [total]]).astype(np.int64))
    more = (np.diff(pos) - 1) // step
    inner = np.repeat(pos[:-1], more) + step * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    pos = np.sort(np.concatenate([pos, inner]))
    pen = np.full(len(pos), mid_penalty)
    pen[np.searchsorted(pos, sentences)] = sentence_penalty
    pen[np.searchsorted(pos, ends)] = 0.0
    p, cost = pos.tolist(), (pen + window).tolist()
    n = len(p)
    g, came = [0.0] * n, [0] * n  # g(i) = f(i) + p_i, so the transition is g(i) = penalty + window + min g(j)
    queue, head = [0], 0  # positions rising, g rising
    for i in range(1, n):
        low = p[i] - window
        while p[queue[head]] < low:
            head += 1
        came[i] = j = queue[head]
        g[i] = v = cost[i] + g[j]
        while len(queue) > head and g[queue[-1]] >= v:
            queue.pop()
        queue.append(i)
    near = range(int(np.searchsorted(pos, total - window)), n)
    if last:  # the rest is cut at powers of two, without padding
        i = min(near[:-1] or near, key=lambda i: (g[i] - p[i], -p[i]))
    else:
        i = min(near, key=lambda i: (g[i] - 2 * p[i], -p[i]))
    end, cuts = p[i], []
    while i:
        cuts.append(p[i])
        i = came[i]
    cuts.reverse()
    if last:
        rest = total - end
        while rest:
            take = 1 << (min(rest, window).bit_length() - 1)
            end, rest = end + take, rest - take
            cuts.append(end)
    return cuts


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         end_id: int = 1, sentence_penalty: float = 12.0, mid_penalty: float = 48.0, step: int = 64,
         block_tokens: int = 1 << 18) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), ids
    (little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id,
    offset (the piece's first place in its sequence)."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, stop = tokenizer(tokenizer_path), np.asarray([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        buf, ends = bytearray(), []
        held: list[list] = []  # [id, first position (negative: partly emitted), ids]
        id_arrow = None

        def documents():
            nonlocal id_arrow
            for b in batches:
                id_arrow = b.schema.field("doc_id").type
                docs, texts, size = [], [], 0
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    docs.append(doc)
                    texts.append(text.as_py())
                    size += len(texts[-1])
                    if size >= GROUP:
                        yield from zip(docs, tok.encode(texts), strict=True)
                        docs, texts, size = [], [], 0
                yield from zip(docs, tok.encode(texts), strict=True)

        def flush(last: bool):
            nonlocal buf, ends, held, sequence
            raw = bytes(buf)
            total, sentences = len(raw) >> 2, np.flatnonzero(tok.closes[np.frombuffer(raw, dtype="<u4")]) + 1
            cuts = choose_cuts(total, np.asarray(ends, dtype=np.int64), sentences, window, sentence_penalty,
                               mid_penalty, step, last)
            cols: list[list] = [[], [], [], [], [], []]
            begin, k = 0, 0
            for cut in cuts:
                at = begin
                while at < cut:
                    doc, first, n = held[k]
                    to = min(cut, first + n)
                    for col, v in zip(cols, (doc, at - first, raw[4 * at:4 * to], n, sequence, at - begin), strict=True):
                        col.append(v)
                    if to == first + n:
                        k += 1
                    at = to
                begin, sequence = cut, sequence + 1
            held = [[d, s - begin, n] for d, s, n in held[k:]]
            ends = [e - begin for e in ends if e > begin]
            buf = bytearray(raw[4 * begin:])
            kinds = (id_arrow, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)],
                                              names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

        for doc, ids in documents():
            first = len(buf) >> 2
            buf += ids
            buf += stop
            here = len(buf) >> 2
            held.append([doc, first, here - first])
            ends.append(here)
            if here >= block_tokens:
                yield flush(False)
        if buf:
            yield flush(True)

    return docs.mapInArrow(run, PIECES.format(id=id_type))
