"""Quality classifier from weak labels (operator 10).

1. Heuristic labellers vote good (1), bad (0) or abstain (-1) on every document.
2. The votes of all documents are counted by vote pattern (at most 3^labellers rows).
   Expectation-maximisation over the patterns estimates each labeller's accuracy and each
   pattern's posterior, assuming labellers err independently given the class.
3. The posteriors label a bounded training sample (``train_rows`` documents by seeded hash,
   half of them from either side where there are enough) on which a linear scorer over hashed
   features (byte pairs and repetition events) is fitted.  Every document is then scored.

Defined cases: null and empty texts have no feature and are judged bad; ties in the hash go
together; an empty table gives an empty result; where all documents get one vote pattern the
posterior is that of the prior; extra columns are kept, clashing ones give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.hashing import hash48
from corpusforge.llm.common import materialise

LABELLERS = ("symbols", "capitals", "separators", "repeats", "variety", "shouting", "plain", "flow", "letters", "again")
FEATURE_BITS = 12
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER, _UPPER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_LOWER[97:123], _UPPER[65:91], _DIGIT[48:58] = True, True, True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "#$%&*<>=@\\^_{}|~+"]] = True


def block_variety(items: list, size: int) -> float:
    """Share of distinct items within consecutive blocks of ``size``, over all blocks."""
    return sum(len(set(items[i:i + size])) for i in range(0, len(items), size)) / max(1, len(items))


def seen_before(words: list[str], run: int = 5) -> float:
    """Share of the runs of five words that occurred before in the text."""
    if len(words) <= run:
        return 0.0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    n = len(words) - run + 1
    key = np.zeros(n, np.uint64)
    for i in range(run):
        key = (key ^ (ids[i:i + n] + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return 1 - len(np.unique(key)) / n


def votes(text: str) -> list[int]:
    """One vote a labeller, in the order of :data:`LABELLERS`.

    The first six and the last know one kind of junk each and otherwise abstain; the others judge
    the text as a whole and may vote either way.  Variety and flow are means over all blocks of a
    text and ``again`` looks at the whole of it, so no measure depends on the length as such.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    n = len(raw)
    words = text.split()
    if not words:
        return [-1, -1, -1, -1, -1, -1, 0, -1, 0, -1]
    count = np.bincount(raw, minlength=256)
    lower, upper, odd = int(count[_LOWER].sum()), int(count[_UPPER].sum()), int(count[_ODD].sum())
    letters, m = lower + upper + int(count[128:].sum()), len(words)
    pairs = list(zip(words, words[1:]))
    same = sum(a == b for a, b in pairs)
    lone = sum(1 for w in words if not w[-1].isalnum() and not w[0].isalnum())
    plain = sum(1 for w in words if w.rstrip(".,;:?!\"')").isalpha() and (w.islower() or w[1:].islower() or len(w) == 1)
                and not w.endswith("!!"))
    flow = block_variety(pairs, 400)

    def bad(x: bool) -> int:
        return 0 if x else -1

    def either(no: bool, yes: bool) -> int:
        return 0 if no else 1 if yes else -1
    return [
        bad(odd > 0.04 * n),
        bad(m >= 3 and upper > 0.5 * (lower + upper)),
        bad(lone > 0.15 * m),
        bad(m >= 8 and same > 0.3 * m),
        bad(m >= 30 and block_variety(words, 200) < 0.25),
        bad(int(count[33]) > 0.3 * m),
        either(plain < 0.6 * m, plain > 0.85 * m),
        either(m >= 12 and flow < 0.4, m >= 12 and flow > 0.6),
        either(letters < 0.55 * n, letters > 0.7 * n),
        bad(m >= 30 and seen_before(words) > 0.5),
    ]


def features(text: str, bits: int = FEATURE_BITS) -> np.ndarray:
    """Hashed feature vector: square roots of the shares of byte pairs and repetition events, of the
    whole text at any length."""
    size = 1 << bits
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    if len(raw) < 2:
        return np.zeros(size, np.float32)
    pair = ((raw[:-1] * np.uint32(256) + raw[1:]) * np.uint32(2654435761)) >> np.uint32(32 - bits)
    x = np.bincount(pair, minlength=size).astype(np.float32) / (len(raw) - 1)
    words = text.split()
    if len(words) > 1:
        same = sum(map(str.__eq__, words[1:], words[:-1])) / (len(words) - 1)
        x[size - 1 - int(round(15 * same))] += same
        x[0] += same
        x[1] += block_variety(words, 200)
        x[2] += seen_before(words)
    return np.sqrt(x)


def fit_label_model(patterns: dict[tuple[int, ...], int], rounds: int = 200, prior: float = 0.8):
    """EM for ``P(good)`` and every labeller's chance to vote right when it votes.

    Returns ``(prior, accuracy, {pattern: posterior})``; the M step has one pseudo-count a cell
    and accuracies start at 0.8, which also fixes which class is called good.
    """
    if not patterns:
        return prior, np.empty(0), {}
    votes_ = np.array(list(patterns))
    n = np.array([float(c) for c in patterns.values()])
    k = votes_.shape[1]
    right_good, right_bad = np.full(k, 0.8), np.full(k, 0.8)
    # abstaining says something too: its rate differs by class
    speak_good, speak_bad = np.full(k, 0.7), np.full(k, 0.7)
    good = votes_ == 1
    bad = votes_ == 0
    spoken = good | bad
    post = np.full(len(n), prior)
    for _ in range(rounds):
        lg = (np.where(good, np.log(right_good), 0) + np.where(bad, np.log1p(-right_good), 0)
              + np.where(spoken, np.log(speak_good), np.log1p(-speak_good))).sum(1) + np.log(prior)
        lb = (np.where(bad, np.log(right_bad), 0) + np.where(good, np.log1p(-right_bad), 0)
              + np.where(spoken, np.log(speak_bad), np.log1p(-speak_bad))).sum(1) + np.log1p(-prior)
        new = 1.0 / (1.0 + np.exp(np.clip(lb - lg, -700, 700)))
        g, b = (n * new)[:, None], (n * (1 - new))[:, None]
        right_good = ((g * good).sum(0) + 1) / ((g * spoken).sum(0) + 2)
        right_bad = ((b * bad).sum(0) + 1) / ((b * spoken).sum(0) + 2)
        speak_good = ((g * spoken).sum(0) + 1) / (g.sum() + 2)
        speak_bad = ((b * spoken).sum(0) + 1) / (b.sum() + 2)
        prior = float((n * new).sum() + 1) / (n.sum() + 2)
        if np.abs(new - post).max() < 1e-9:
            post = new
            break
        post = new
    return prior, (right_good + right_bad) / 2, {tuple(int(x) for x in v): float(p) for v, p in zip(votes_, post)}


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels ``y`` by accelerated full-batch gradient descent."""
    if not len(y):
        return np.zeros(x.shape[1] if x.ndim == 2 else 1 << FEATURE_BITS), 0.0
    w, b = np.zeros(x.shape[1], x.dtype), 0.0
    vw, vb = w.copy(), b
    pos = max(y.sum(), 1e-9)
    weight = y * (0.5 / pos) + (1 - y) * (0.5 / max((1 - y).sum(), 1e-9))
    weight /= weight.sum()
    step = 4.0 / (float((x * x).sum(1).max()) + 1)
    for i in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -50, 50)))
        r = weight * (p - y)
        nw, nb = vw - (step * (r.astype(x.dtype) @ x + l2 * vw)).astype(x.dtype), vb - step * r.sum()
        m = i / (i + 3)
        vw, vb = (nw + m * (nw - w)).astype(x.dtype), nb + m * (nb - b)
        w, b = nw, nb
    return w, float(b)


def _vote_patterns(docs: DataFrame, order) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [bytes(v + 1 for v in votes(t.as_py() or "")).translate(_AS_TEXT).decode()
                   for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["h", "pattern"])
    return docs.select(order.alias("h"), "text").mapInArrow(run, "h long, pattern string")


_AS_TEXT = bytes.maketrans(b"\x00\x01\x02", b"abc")      # abstain, bad, good


def _read(pattern: str) -> tuple[int, ...]:
    return tuple("abc".index(c) - 1 for c in pattern)


def train(docs: DataFrame, train_rows: int = 4000, seed: int = 11):
    """``(weights, bias, label model)`` fitted on ``docs(doc_id, text)``.

    ``train_rows`` is the documented bound of the training sample: about that many documents,
    chosen by hash, whatever the size of the table.
    """
    order = hash48(F.lit(seed), F.col("doc_id"), F.xxhash64("text"))
    voted = materialise(_vote_patterns(docs, order))
    counts = {_read(r.pattern): r["count"] for r in voted.groupBy("pattern").count().collect()}  # <= 3^labellers
    model = fit_label_model(counts)
    posterior = model[2]
    sides = {True: 0, False: 0}
    for p, c in counts.items():
        sides[posterior[p] >= 0.5] += c
    share = {s: min(1.0, 0.5 * train_rows / c) if c else 0.0 for s, c in sides.items()}
    limit = {s: int(f * 2 ** 48) for s, f in share.items()}
    table = docs.sparkSession.createDataFrame(
        [("".join("abc"[v + 1] for v in p), q, limit[q >= 0.5]) for p, q in posterior.items()] or [("", 0.5, 0)],
        "pattern string, y double, upto long")
    # two rows a hash value only where documents are equal: the sample stays about train_rows
    picked = (voted.join(F.broadcast(table), "pattern").where("h < upto").groupBy("h").agg(F.first("y").alias("y")))
    texts = docs.select(order.alias("h"), "text").where(F.col("h") < F.lit(max(limit.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py() or "").astype(np.float16).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], names=["y", "x"])

    rows = (texts.join(F.broadcast(picked), "h").dropDuplicates(["h"]).select("y", "text")
            .mapInArrow(run, "y double, x binary").collect())
    rows.sort(key=lambda r: (r.x, r.y))
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows], np.float32).reshape(len(rows), 1 << FEATURE_BITS)
    w, b = fit_scorer(x, np.array([r.y for r in rows]))
    return w, b, model


def classify(docs: DataFrame, train_rows: int = 4000, seed: int = 11, threshold: float = 0.5) -> DataFrame:
    """``docs`` plus ``quality`` (the scorer's probability of good, 6 decimals) and ``kept``."""
    w, b, _ = train(docs, train_rows, seed)
    w = w.astype(np.float32)
    names = [c for c in docs.columns if c not in ("quality", "kept")]
    fields = docs.select(*[F.col(f"`{c}`") for c in names]).schema
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = np.zeros(batch.num_rows)
            for i, t in enumerate(batch.column(at)):
                text = t.as_py() or ""
                if text.strip():
                    q[i] = 1 / (1 + np.exp(-np.clip(float(features(text) @ w) + b, -50, 50)))
            q = np.round(q, 6)
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(q), pa.array(q >= threshold)],
                                             names=list(batch.schema.names) + ["quality", "kept"])

    from pyspark.sql.types import BooleanType, DoubleType, StructType
    out = StructType(list(fields.fields)).add("quality", DoubleType()).add("kept", BooleanType())
    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, out)
