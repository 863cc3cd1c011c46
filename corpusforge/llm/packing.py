"""Packing by concatenate and cut (operator 2).

Pass 1 tokenises every document once where it is read and writes its ids, its partition and
its token offset inside the partition.  Prefix sums over the partition totals (one row a
partition) give every document its global offset.  Pass 2 cuts the ids at the fixed window
boundaries and emits one record a piece; a document that crosses a boundary gives boundary
records (``piece > 0`` or ``last = false``).  Tokens are never shuffled.

Only the last sequence can be short; its padding is what is missing to the window, or none
when its length is a power of two.

Defined cases: null or empty text is a document of the end id alone; repeated rows are
documents of their own; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import materialise

WINDOW, END_ID = 4096, 2
_MEMORY = 200_000            # word stems a Python worker learns before it forgets those not met since the last time
_LONGEST = 64                # characters of the longest stem it remembers beyond the texts at hand
_AT_ONCE = 1024              # documents a worker holds as ids at a time
_CHARS = 4_000_000           # characters of texts, beyond the last one, that it holds as words at a time
# a word of plain Latin letters with ASCII marks behind it falls apart between the two
_LETTERS = "".join(chr(c) for c in [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
_STEM = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_MARKS = "".join(chr(c) for c in [*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts from a memory of ids by word stem.

    Valid for tokenizers that split at white space and between letters and marks before the
    model runs and that ignore case, as the vocabulary used here does: the ids of a text are
    those of its space-separated words in turn.  Words that are no plain letters and marks are
    encoded whole.  The memory has two halves: a stem met again moves from the older to the newer one, and
    the older one is dropped when the newer is full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.wide = self.tok.get_vocab_size() > 65536
        self.kind, self.code = ("<u4", "I") if self.wide else ("<u2", "H")
        self.model = self.tok.model
        self.added = [t.content.lower() for t in self.tok.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}                 # of the texts at hand
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

        # letters as the model sees them, where it can be asked directly (checked on all of them)
        self.letters = str.maketrans({c: self._shown(c) for c in _LETTERS})
        self.direct = all(self._ask(w) == self._whole([w])[0] for w in [*_LETTERS, _LETTERS, "there", "été", "über"])

    def _shown(self, letter: str) -> str:
        pre = self.tok.pre_tokenizer
        out = pre.pre_tokenize_str(letter) if pre is not None else []
        return out[0][0] if len(out) == 1 else letter

    def _ask(self, stem: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(stem.translate(self.letters))]).tobytes()

    def _whole(self, new: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(new, add_special_tokens=False)]

    def learn(self, words: set[str]) -> None:
        """Puts the ids of all of ``words`` into ``self.words``."""
        parts, older, ids = self.parts, self.older, {}
        marked, ask, whole = [], set(), {""}
        for w in words:
            v = parts.get(w)                              # most words are a stem
            if v is None and w in older:
                v = parts[w] = older[w]
            if v is not None:
                ids[w] = v
                continue
            stem = w.rstrip(_MARKS)
            plain = stem.isalpha() if stem.isascii() else _STEM.fullmatch(stem)
            stem, marks = (stem.lower(), w[len(stem):]) if plain else (w, "")
            marked.append(w)
            marked.append(stem)
            marked.append(marks)
            for x in (stem, marks) if marks else (stem,):
                if x not in parts:
                    if x in older:
                        parts[x] = older[x]
                    else:
                        (ask if self.direct and plain and x is stem else whole).add(x)
        for stem in ask:
            parts[stem] = self._ask(stem)
        rest = sorted(whole)
        parts.update(zip(rest, self._whole(rest)))
        turn = iter(marked)
        for w, stem, marks in zip(turn, turn, turn):
            ids[w] = parts[stem] + parts[marks] if marks else parts[stem]
        for x in [*ask, *rest]:
            if len(x) > _LONGEST:
                del parts[x]
        if len(parts) > _MEMORY:
            self.older, self.parts = parts, {}
        self.words = ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of every text; learns the unknown words of many of them at once."""
        out, held, size = [], [], 0
        for i, t in enumerate(texts, 1):
            low = t.lower() if t.isascii() else t
            if low is not t and not any(a in low for a in self.added):      # whose capitals matter
                t = low
            held.append(t.replace("\n", " ").split(" "))
            size += len(t)
            if size >= _CHARS or i == len(texts):
                self.learn(set().union(*held))
                ids = self.words.__getitem__
                out += [b"".join(map(ids, words)) for words in held]
                self.words, held, size = {}, [], 0
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary; it outlives the task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_TOKENS = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def tokenise(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, part, local, doc_tokens, ids)``: ids as little-endian unsigned 16-bit numbers
    where the vocabulary allows, else 32-bit; ``local`` counts inside partition ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from corpusforge.llm import packing              # the worker's own module keeps the memory
        encode = packing.encoder(path)
        end = np.array([end_id], encode.kind).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for b in (x.slice(s, _AT_ONCE) for x in batches for s in range(0, x.num_rows, _AT_ONCE)):
            ids = [x + end for x in encode([t or "" for t in b.column(1).to_pylist()])]
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // len(end)
            local = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(local), pa.array(n),
                 pa.array(ids, pa.binary())], schema=_TOKENS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, part int, local long, doc_tokens long, ids binary")


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, piece long, last boolean")


def cut(tokens: DataFrame, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Pieces of the concatenation of ``tokens`` (a written table of :func:`tokenise`)."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))     # one row a partition
    base = totals.select("part", F.expr(
        "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)").alias("base"))
    schema = _PIECES + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(s, _AT_ONCE) for x in batches for s in range(0, x.num_rows, _AT_ONCE)):
            doc, n = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            begin = b.column(2).to_numpy(zero_copy_only=False)
            cols: list[list] = [[] for _ in range(10)]
            for i, raw in enumerate(b.column(3)):
                raw = raw.as_py()
                size = int(n[i])
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4").astype("<u4").tobytes()
                start, g, piece = 0, int(begin[i]), 0
                while start < size:
                    length = min(size - start, window - g % window)
                    part = ids[4 * start:4 * (start + length)]
                    for c, v in zip(cols, (doc[i], start, length, zlib.crc32(part), size, g // window,
                                           g % window, piece, start + length == size, part if keep_ids else None)):
                        c.append(v)
                    start, g, piece = start + length, g + length, piece + 1
            kinds = [pa.int64()] * 8 + [pa.bool_(), pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                     "piece", "last", "ids"]
            k = 10 if keep_ids else 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:k], kinds[:k])], names=names[:k])

    return (tokens.join(F.broadcast(base), "part")
            .select("doc_id", "doc_tokens", (F.col("base") + F.col("local")).alias("g"), "ids")
            .mapInArrow(run, schema))


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """All of ``docs(doc_id, text)`` as pieces of gapless sequences of ``window`` ids."""
    return cut(materialise(tokenise(docs, tokenizer or tokenizer_path(), end_id)), window, keep_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, n_ids, ids)`` from pieces with ``keep_ids``: at most ``window`` ids a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("p")).select(
        "sequence_id", "n_ids",
        F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
