"""Exact top-k search by MaxScore over sharded, quantised vectors (operator 6).

Every dimension is a query term.  Inside a shard the contribution of term d to candidate v is
``q[d] * v[d]``; shifted by its least value in the shard it lies between 0 and the bound
``|q[d]| * (max[d] - min[d])``.  With the terms in order of their bounds, those whose bounds
together cannot lift a candidate into the top k are non-essential: the essential terms'
postings are traversed for all candidates of the shard, and the non-essential ones are probed,
largest bound first, only for the candidates that can still reach the k-th score.  Scores are
exact integers.  The queries of a block share one order of the terms, so the essential terms of
all of them are one matrix product.

Shards hold at most ``shard_rows`` candidates (fewer of long vectors) and query blocks at most
``block_rows`` queries; every block of the stated query set meets every shard.  Shards and queries
are dealt to a few parts, each packed and shuffled once; a task is one part of either.  It reads its
shards one after another, and the k-th score that a query has reached in them is its threshold in
the next.  So what is shuffled follows the vectors and not their pairs, a task's memory is bounded,
and nothing but counts reaches the driver: the parts meet in a Cartesian product that is asked for
by a hint, for the planner takes packed vectors for small rows and would broadcast them.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part;
vectors of different lengths never meet; rows that repeat a vec_id are candidates of their own
but never of a query with that vec_id, which is asked once (its least vector); ties go to the
smaller id; components beyond 2^62 count as 2^62 and scores beyond the range of a long as its ends (in
the order too); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.llm.common import discard, materialise

SCALE = 64
_FAR = 2.0 ** 62                    # components beyond count as this
_MOST = 2 ** 63 - 1                 # scores beyond the range of a long count as its ends
_NONE = -2 ** 63                    # threshold of a query that has not met k candidates
SHARD_PARTS, TASKS = 8, 4096        # at most; every part of the shards returns k rows a query
TASK_PAIRS = 2 ** 29                # scores that make a task of its own worth while
CELLS = 2 ** 22                     # components of a shard, or of a part of the queries


def quantise(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)`` with ``floor(scale * x)`` per component as long; unusable vectors are left out."""
    x = F.col("embedding")
    ok = x.isNotNull() & (F.size(x) > 0) & F.col("vec_id").isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return embeddings.where(F.coalesce(ok, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.greatest(F.lit(-_FAR), F.least(F.lit(_FAR), F.lit(float(scale)) * e.cast("double"))))
                    .cast("long")).alias("v"))


def _pack(df: DataFrame, key: str) -> DataFrame:
    """One row a block: ids in their order and the vectors as one matrix of the narrowest type that holds them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        m = np.stack(pdf["v"].to_numpy()).astype(np.int64)
        lo, hi = int(m.min()), int(m.max())
        m = m.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "dim": [m.shape[1]],
                             "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()]})
    return df.groupBy(key, "dim").applyInPandas(
        lambda pdf: run(pdf.drop(columns="dim")), f"{key} int, dim int, ids binary, m binary")


def _matrix(ids: bytes | pa.Buffer, m: bytes | pa.Buffer, dim: int) -> np.ndarray:
    """The matrix that :func:`_pack` packed for ``ids``."""
    ids, m = np.frombuffer(ids, np.int64), np.frombuffer(m, np.int8)
    return m.view(f"i{len(m) // (len(ids) * dim)}").reshape(-1, dim)


class Shard:
    """Candidates in the order of their ids, and the least and largest value of every term."""

    def __init__(self, cid: np.ndarray, c: np.ndarray):
        if np.any(cid[1:] < cid[:-1]):
            order = np.argsort(cid, kind="stable")
            cid, c = cid[order], c[order]
        self.ids, self.c, self.lo, self.hi = cid, c, c.min(0), c.max(0)
        self.largest = max(-float(self.lo.min()), float(self.hi.max()), 0.0)
        self._postings: dict[type, np.ndarray] = {}

    def postings(self, kind: type) -> np.ndarray:
        """A row a term, a column a candidate."""
        if kind not in self._postings:
            self._postings = {kind: np.ascontiguousarray(self.c.T.astype(kind))}
        return self._postings[kind]


def search_shard(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, probe: int = 8):
    """Top ``k`` of one shard for every query: arrays ``(query_id, vec_id, score)``."""
    at, found, score = _search(qid, q, Shard(cid, c), np.full(len(qid), _NONE), k, probe)
    return qid[at], found, score


def _search(qid: np.ndarray, q: np.ndarray, shard: Shard, floor: np.ndarray, k: int, probe: int = 8):
    """Top ``k`` of a shard for every query: arrays ``(number of the query, vec_id, score)``.  Candidates
    below the query's ``floor``, a score that k candidates met before have reached, may be left out."""
    if not len(qid):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    largest = float(np.abs(q.astype(float)).max(initial=0)) * shard.largest * q.shape[1]
    # sums of integer products are exact in a float type up to its mantissa, else use integers, and
    # Python's beyond 64 bits
    kind = np.float32 if largest < 2 ** 24 else np.float64 if largest < 2 ** 53 else np.int64 if largest < 2 ** 61 else object
    return (_search_block if kind in (np.float32, np.float64) else _search_each)(qid, q, shard, floor, k, probe, kind)


def best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int):
    """The ``k`` largest scores of every ``q`` in their order, ties by ``v``, and their ranks from 0."""
    o = np.lexsort((v, -s, q))
    q, v, s = q[o], v[o], s[o]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][:len(q)])
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    keep = rank < k
    return q[keep], v[keep], s[keep], rank[keep]


def _below(x: np.ndarray, kind: type) -> np.ndarray:
    """Floats that are not above the integers ``x`` and not below the least float."""
    return np.nextafter(x.astype(kind), kind(-np.inf)).clip(np.finfo(kind).min)[:, None]


def _kth(s: np.ndarray, k: int) -> np.ndarray:
    """A score that ``k`` columns reach, for every row; the largest of groups of columns stand for
    them where there are many.  ``_NONE`` where fewer count (-inf does not)."""
    groups = max(256, 4 * k)
    if s.shape[1] >= 2 * groups:
        wide = s.shape[1] // groups
        s = s[:, :wide * groups].reshape(len(s), wide, groups).max(1)
    if s.shape[1] < k:
        return np.full(len(s), _NONE)
    x = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    none = np.isneginf(x)
    return np.where(none, _NONE, np.where(none, 0, x).astype(np.int64))


def _search_block(qid: np.ndarray, q: np.ndarray, shard: Shard, floor: np.ndarray, k: int, probe: int, kind: type):
    """The search by products of whole blocks, where all sums are exact as floats of ``kind``."""
    ids, postings = shard.ids, shard.postings(kind)
    w = q.astype(np.int64)
    ends = w * shard.lo.astype(np.int64), w * shard.hi.astype(np.int64)
    low, high = np.minimum(*ends), np.maximum(*ends)
    theta = floor
    if np.any(theta == _NONE):                        # a score that k candidates reach
        first = np.linspace(0, len(ids) - 1, num=min(len(ids), 16 * (k + 1))).astype(int)
        some = w.astype(kind) @ postings[:, first]
        some[qid[:, None] == ids[first]] = -np.inf
        theta = np.maximum(theta, _kth(some, k))
    able = np.flatnonzero(high.sum(1) >= theta)       # who can find anything here
    if not len(able):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    w, low, high, theta, new = w[able], low[able], high[able], theta[able], floor[able] == _NONE
    own, upto = np.searchsorted(ids, qid[able], "left"), np.searchsorted(ids, qid[able], "right")
    wk, bound = w.astype(kind), high - low
    order = np.argsort(bound.sum(0), kind="stable")   # least bound first, for the whole block
    need = np.where(theta == _NONE, 0, np.maximum(theta, low.sum(1) - 1) - low.sum(1))
    cut = int((np.cumsum(bound[:, order], axis=1) < need[:, None]).sum(1).min())
    essential, rest = order[cut:], order[:cut][::-1]

    def itself(s: np.ndarray) -> np.ndarray:
        for i in np.flatnonzero(upto > own):
            s[i, own[i]:upto[i]] = -np.inf
        return s

    def reach(s: np.ndarray, todo: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        return s >= _below(np.where(theta == _NONE, -2 ** 62, np.maximum(theta, -2 ** 62) - high[:, todo].sum(1)), kind)[of]

    score = itself(wk[:, essential] @ postings[essential] if cut else wk @ postings)
    whole = not cut
    if cut:
        # to probe is worth while where few can still reach the k-th score; a part of them tells
        whole = np.count_nonzero(reach(score[:, ::16], rest)) * 8 > score[:, ::16].size
        if not whole:
            alive = reach(score, rest)
            whole = np.count_nonzero(alive) * 8 > alive.size
        if whole:
            score += wk[:, rest] @ postings[rest]
    if not whole:
        at, col = np.divmod(np.flatnonzero(alive), len(ids))
        score = score[at, col]
        for step in range(0, len(rest), probe):
            d, todo = rest[step:step + probe], rest[step + probe:]
            score = score + np.einsum("ij,ji->i", wk[:, d][at], postings[d][:, col])
            keep = reach(score[:, None], todo, at)[:, 0]
            at, col, score = at[keep], col[keep], score[keep]
    else:
        if np.any(new):
            theta = np.maximum(theta, _kth(score, k))
        hit = score >= _below(theta, kind)
        if np.count_nonzero(hit) > 8 * k * len(able):  # ties: the first by id are enough
            for i in np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * k):
                col = np.flatnonzero(hit[i])
                hit[i, np.delete(col, np.argsort(-score[i, col], kind="stable")[:k])] = False
        at, col = np.divmod(np.flatnonzero(hit), len(ids))
        score = score[at, col]
    return best(able[at], ids[col], score.astype(np.int64), k)[:3]


def _search_each(qid: np.ndarray, q: np.ndarray, shard: Shard, floor: np.ndarray, k: int, probe: int, kind: type):
    """The search for one query after another, by integers of any size."""
    whole = object if kind is object else np.int64
    cid, postings, lo, hi = shard.ids, shard.postings(kind), shard.lo.astype(whole), shard.hi.astype(whole)
    first = np.linspace(0, len(cid) - 1, num=min(len(cid), 16 * (k + 1))).astype(int)
    out: list[tuple] = []
    for i in range(len(qid)):
        w = q[i].astype(whole)
        low, high = np.minimum(w * lo, w * hi), np.maximum(w * lo, w * hi)
        alive = np.flatnonzero(cid != qid[i])
        some = first[cid[first] != qid[i]]
        theta = int(floor[i])                         # a score that k candidates reach
        if theta == _NONE and len(some) >= k:
            s = w.astype(kind) @ postings[:, some]
            theta = min(_MOST, int(np.partition(s, -k)[-k]))
        order = np.argsort(high - low, kind="stable")  # least bound first
        lift = np.cumsum((high - low)[order])
        cut = int(np.searchsorted(lift, max(0, min(_MOST, theta - int(low.sum()))), side="left")) if theta > -_MOST else 0
        essential, rest = order[cut:], order[:cut][::-1]
        score = (w[essential].astype(kind) @ postings[essential])[alive]
        for step in range(0, len(rest) + 1, probe):
            todo = rest[step:]
            if len(score) > k:                        # k candidates are sure of their lower bound
                theta = min(_MOST, max(theta, int(np.partition(score, -k)[-k]) + int(low[todo].sum())))
            if theta > -_MOST:                        # who can still reach the k-th score
                keep = np.asarray(score + int(high[todo].sum()) >= theta, bool)
                alive, score = alive[keep], score[keep]
            d = todo[:probe]
            if len(d):
                score = score + w[d].astype(kind) @ postings[d][:, alive]
        s = (np.array([max(-_MOST, min(_MOST, int(x))) for x in score], np.int64) if kind is object else score.astype(np.int64))
        top = np.lexsort((cid[alive], -s))[:k]
        out.append((np.full(len(top), i, np.int64), cid[alive[top]], s[top]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _parts(shards: int, blocks: int, pairs: int, cells: int) -> tuple[int, int]:
    """Numbers of parts that the shards and the queries are dealt to, for so many pairs and queries' components."""
    left = min(shards, SHARD_PARTS)
    return left, min(blocks, max(-(-min(TASKS, max(32, pairs // TASK_PAIRS)) // left), -(-cells // CELLS)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = 16_384,
          block_rows: int = 512) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for integer vectors ``(vec_id, v)``."""
    vec = materialise(vectors.withColumn("dim", F.size("v")))
    qry = materialise(queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    (n, n_cells), (m, m_cells) = (x.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).head() for x in (vec, qry))
    shards, blocks = max(1, -(-n // shard_rows), -(-n_cells // CELLS)), max(1, -(-m // block_rows))
    left, right = _parts(shards, blocks, n * m, m_cells)

    def place(df: DataFrame, name: str, parts: int) -> DataFrame:
        # by position in the written table: even whatever the ids are; the result does not depend on it
        return df.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int"))

    c = materialise(_pack(place(vec, "shard", shards), "shard"))
    q = materialise(_pack(place(qry, "part", right), "part"))
    discard(vec), discard(qry)
    # every part of the stated query set against every part of the shards
    c = c.repartitionById(left, F.pmod("shard", F.lit(left)))
    q = q.repartitionById(right, F.col("part")).withColumnsRenamed({"dim": "qdim", "ids": "qids", "m": "qm"})
    met = c.join(q.hint("shuffle_replicate_nl"), F.col("dim") == F.col("qdim")).select(
        "part", "dim", "ids", "m", "qids", "qm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}                                     # best of the task's queries, by the vectors' length
        for batch in batches:
            for i, key in enumerate(zip(*(batch.column(j).to_pylist() for j in range(2)))):
                ids, m, qids, qm = (batch.column(j)[i].as_buffer() for j in range(2, 6))
                qid, q = np.frombuffer(qids, np.int64), _matrix(qids, qm, key[1])
                shard = Shard(np.frombuffer(ids, np.int64), _matrix(ids, m, key[1]))
                own, floor, *top = held.get(key) or (qid.copy(), np.full(len(qid), _NONE), *[np.empty(0, np.int64)] * 3)
                for at in range(0, len(qid), block_rows):
                    to = slice(at, at + block_rows)
                    new = _search(qid[to], q[to], shard, floor[to], k)
                    top = [np.concatenate(x) for x in zip(top, (new[0] + at, *new[1:]))]
                *top, rank = best(*top, k)
                floor[top[0][rank == k - 1]] = top[2][rank == k - 1]
                held[key] = own, floor, *top
        for own, _, at, vec_id, score in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(vec_id), pa.array(score)],
                                             names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
