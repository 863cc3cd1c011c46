"""Substring dedup by sliding sentence spans (operator 3).

A text is cut into sentences (at line ends, behind ``. ! ?`` before white space, and behind
ideographic full stops with their closing marks).  Words are white-space runs; in the scripts that
write no spaces (Thai, Lao, Myanmar, Khmer, Chinese, Japanese) every character is a word.  A
sentence of more than ``MAX_WORDS`` words is cut behind the word of least hash of every
``MAX_WORDS / 2`` words in a row (the hash of a word and the one before it): equal passages are
cut alike but for their first and last few words, whatever stands around them, and a piece has
half of ``MAX_WORDS`` words at most.  From every sentence on and up to every sentence the shortest run of at
least ``SPAN`` sentences and ``MIN_WORDS`` words is hashed (128 bits over the lower-cased
words).  The runs are joined globally by hash: the first occurrence is the one with the least
(doc_id, text hash, position), and every sentence that lies in a run which is not its hash's
first occurrence is removed.  A repeated passage thus stays in one place only.

Shuffled are only the run hashes with their places.  The halves of the hashes are counted first;
only runs whose half comes more than once go on, with their whole hash.  A hash that a third of
all documents share is pre-aggregated to its first place, and the places are joined back by a
join whose large side adaptive execution can split.

Defined cases: null text stays null; texts without a run (too short) stay as they are; rows
equal in doc_id and text are one document that occurs once; null ids come first; an empty
table gives an empty result; extra columns are kept, clashing ones give way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from corpusforge.llm.common import discard, materialise

SPAN, MIN_WORDS, MAX_WORDS = 3, 12, 16
_BREAK = re.compile(r"\n\s*|(?<=[.!?…])\s+|(?<=[。！？｡])(?![。！？｡」』）”’])\s*|(?<=[。！？｡][」』）”’])(?![」』）”’])\s*")
# the same breaks where no ideographic full stop is: a set of first characters is searched faster
_PLAIN_BREAK = re.compile(r"[.!?…\n](?:(?<=\n)|\s)\s*")
_FULL_STOP = re.compile("[。！？｡]")
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\ua000-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_SPACELESS = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(rf"(?:(?!\s)[{_UNSPACED}]|[^\s{_UNSPACED}]+)\s*")
_PLAIN_WORD = re.compile(r"\S+\s*")


def _cuts(words: list[bytes]) -> list[int]:
    """Numbers of words before every cut of a long sentence: behind the least word (the last of equal
    ones) of each ``MAX_WORDS // 2`` words in a row."""
    h = list(map(crc32, words, [0, *map(crc32, words)]))         # of a word, begun with the one before it
    width, least, out = MAX_WORDS // 2, -1, []
    for end in range(width, len(words) + 1):
        if least < end - width:
            last = h[end - width:end][::-1]
            least = end - 1 - last.index(min(last))
        elif h[end - 1] <= h[least]:
            least = end - 1
        if least + 1 < len(words) and (not out or out[-1] <= least):
            out.append(least + 1)
    return out


def sentences(text: str) -> tuple[list[int], list[bytes], list[int]]:
    """End offset, matching key (lower-cased words) and word count of every sentence."""
    ends, keys, counts, begin = [], [], [], 0
    ascii_ = text.isascii()
    word = _PLAIN_WORD if ascii_ or not _SPACELESS.search(text) else _WORD
    breaks = _PLAIN_BREAK if ascii_ or not _FULL_STOP.search(text) else _BREAK
    for stop in [*[m.end() for m in breaks.finditer(text)], len(text)]:
        part = text[begin:stop]
        words = part.split() if word is _PLAIN_WORD else [w.rstrip() for w in _WORD.findall(part)]
        if not words:
            continue
        line = " ".join(words)
        low = line.lower().encode()
        if len(words) <= MAX_WORDS:
            keys.append(low)
            counts.append(len(words))
        else:
            own = part.lstrip()
            shift = begin + len(part) - len(own)
            # ends of the words with the white space behind them; single spaces need no search
            if word is _PLAIN_WORD and len(own.rstrip()) == len(line):
                at = [n + i for i, n in enumerate(accumulate(map(len, words)), shift + 1)]
            else:
                at = [shift + m.end() for m in word.finditer(own)]
            words = low.split(b" ")
            cuts = _cuts(words)
            ends += [at[c - 1] for c in cuts]
            for i, j in zip([0, *cuts], [*cuts, len(words)]):
                keys.append(b" ".join(words[i:j]))
                counts.append(j - i)
        ends.append(stop)
        begin = stop
    return ends, keys, counts


def spans(counts: list[int]) -> list[tuple[int, int]]:
    """Runs ``(first, last)``: the shortest sufficient one from each sentence on and up to each."""
    n, out = len(counts), set()
    if n < SPAN:
        return []
    total = [0, *accumulate(counts)]
    last = SPAN - 1
    for first in range(n - SPAN + 1):
        last = max(last, first + SPAN - 1)
        while last < n and total[last + 1] - total[first] < MIN_WORDS:
            last += 1
        if last == n:
            break
        out.add((first, last))
    first = 0
    for last in range(SPAN - 1, n):
        if total[last + 1] >= MIN_WORDS:
            while first < last - SPAN + 1 and total[last + 1] - total[first + 1] >= MIN_WORDS:
                first += 1
            out.add((first, last))
    return sorted(out)


def span_table(docs: DataFrame) -> DataFrame:
    """``(h, g, doc_id, th, a, b)``: halves of the hash and place of every run; ``th`` tells texts of
    one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes, firsts, lasts = [], [], [], []
            for text in batch.column(2):
                _, keys, counts = sentences(text.as_py() or "")
                runs = spans(counts)
                hashes += [xxhash.xxh3_128_digest(b"\n".join(keys[a:b + 1])) for a, b in runs]
                sizes.append(len(runs))
                firsts += [a for a, _ in runs]
                lasts += [b for _, b in runs]
            half = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(half[:, 0]), pa.array(half[:, 1]), batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=["h", "g", "doc_id", "th", "a", "b"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
            .where("text is not null").mapInArrow(run, "h long, g long, doc_id long, th long, a int, b int"))


def repeated_places(places: DataFrame) -> DataFrame:
    """``(doc_id, th, runs)``: the runs of every document that are not their hash's first place."""
    # half a hash is counted in a narrow shuffle; the few runs it leaves are compared by the whole hash
    multi = materialise(places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    some = materialise(places.join(multi.hint("shuffle_hash"), "h"))
    discard(multi)
    place = F.struct("doc_id", "th", "a")
    # pre-aggregated, unique per hash, and a written table: a hot hash's places can then be split
    firsts = materialise(some.groupBy("h", "g").agg(F.min(place).alias("first"), F.max(place).alias("other"))
                         .where("first < other").select("h", "g", "first"))
    later = some.join(firsts, ["h", "g"]).where(place > F.col("first")).select("doc_id", "th", "a", "b")
    # one document's own runs: bounded by its text
    out = materialise(later.groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "b")).alias("runs")))
    discard(some), discard(firsts)
    return out


def remove(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with the covered sentences cut out, plus ``n_sentences`` and ``n_removed``."""
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "_runs")]
    r = repeated.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"),
                        F.transform("runs", lambda x: x["a"]).alias("_a"),
                        F.transform("runs", lambda x: x["b"]).alias("_b"))
    both = (docs.select(*[F.col(f"`{c}`") for c in names], F.xxhash64("text").alias("_th"))
            .join(r, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left")
            .select(*[F.col(f"`{c}`") for c in names], "_a", "_b"))
    at = names.index("text")
    out = StructType(both.drop("_a", "_b").schema.fields[:]).add("n_sentences", IntegerType()).add(
        "n_removed", IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone = [], [], []
            for text, a, b in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(),
                                  batch.column(len(names) + 1).to_pylist()):
                ends, _, _ = sentences(text or "")
                cut = np.zeros(len(ends), bool)
                for i, j in zip(a or (), b or ()):
                    cut[i:j + 1] = True
                if cut.any():
                    begin = [0, *ends[:-1]]
                    text = "".join(text[s:e] for s, e, c in zip(begin, ends, cut) if not c).strip()
                texts.append(text), total.append(len(ends)), gone.append(int(cut.sum()))
            cols = list(batch.columns[:len(names)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols + [pa.array(total, pa.int32()), pa.array(gone, pa.int32())],
                                             names=names + ["n_sentences", "n_removed"])

    return both.mapInArrow(run, out)


def dedup_spans(docs: DataFrame) -> DataFrame:
    """Remove from ``docs(doc_id, text, ...)`` every sentence of a repeated run but its first place."""
    places = materialise(span_table(docs))
    repeated = repeated_places(places)
    discard(places)
    return remove(docs, repeated)
