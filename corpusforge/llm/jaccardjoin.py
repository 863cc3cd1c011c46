"""N-gram Jaccard join with adaptive multi-match prefixes (operator 4).

Documents are sets of distinct word shingles; two documents link when
``100 * |intersection| >= threshold * |union|`` (threshold in per cent).

1. Equal sets form a class (128-bit set hash).  A bounded count sketch over the shingles of all
   documents gives a common global order, rare buckets first.
2. A set of size n has the prefixes of ``n - ceil(t n) + l`` shingles in that order; two linked
   sets share at least l shingles of their l-prefixes.  Every set picks the l (1 to 8) whose
   estimated cost - postings to scan, plus candidates to verify, which must share l of them -
   is least; a longer prefix contains the shorter ones.  Against sets that are no smaller a
   set of size n needs only the first ``n - ceil(2t/(1+t) n) + l`` of them.
3. Pivot rounds (``common.pivot_rounds``) check every class against one pivot only: its postings
   lists are parted by a MinHash, another one each round, and the class with the most common
   prefix (every other round: any class) is a part's pivot.  That puts large groups of near copies
   into one component in linear work.  The pair round takes the pairs that share
   prefix shingles across different components, counts their matches, filters and verifies
   them.  Pairs inside a component need no check: the result is the components.
4. Verification is exact, on the whole sets of the candidates.  The components are found by
   star contraction (``common.connected_components``).

The parity filter is exact: a 512-bit parity sketch differs in at most as many bits as two sets
differ in elements, so a pair whose sketches differ in more bits than a link allows is none.

Defined cases: null and empty texts are empty sets that link with nothing; texts of fewer words
than a shingle are one shingle; repeated rows and ids keep a row each; a component without any
non-null id has a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import PIVOT_ROUNDS, discard, materialise, merge_components, pivot_rounds
from corpusforge.llm.shingles import word_shingles

SKETCH_BITS, SLICE = 21, 4096
PARITY_BITS = 512
MOST_MATCHES = 8
VERIFY_COST = 8.0           # work of verifying a candidate, in postings scanned
LEAST_ROUNDS = 2            # pivot rounds made however few the pairs
BLOOM_BITS = 1 << 25        # of the filter that fetches the candidates' texts


_PARITY = [f"p{i}" for i in range(PARITY_BITS // 64)]
_MINS = [f"m{i}" for i in range(PIVOT_ROUNDS)]
# a round's MinHash: the set's first shingle from this hash on, around the ring of hashes
_FROM = np.random.Generator(np.random.PCG64(4)).integers(0, 2 ** 64, PIVOT_ROUNDS, dtype=np.uint64)


def _parity(u: np.ndarray) -> bytes:
    """Per bit whether an odd number of elements falls on it."""
    slots = np.bincount((u >> np.uint64(20)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS)
    return np.packbits(slots & 1).tobytes()


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Rows ``kind 0``: a document's set figures; ``kind 1``: a slice of the partition's sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["kind", "doc_id", "th", "n", "sid", "data", *_PARITY, *_MINS]
        for b in batches:
            n, sid, par, least = [], [], [], np.zeros((b.num_rows, PIVOT_ROUNDS), np.uint64)
            for t in b.column(2):
                u = word_shingles(t.as_py(), k)
                if len(u):
                    least[len(n)] = u[np.searchsorted(u, _FROM) % len(u)]
                n.append(len(u))
                sid.append(xxhash.xxh3_128_digest(u.tobytes()))
                par.append(_parity(u))
                np.add.at(sketch, (u & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
            words = np.frombuffer(b"".join(par), "<i8").reshape(len(n), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(n), pa.int32()), b.column(0), b.column(1), pa.array(n, pa.int32()),
                 pa.array(sid, pa.binary()), pa.nulls(len(n), pa.binary()), *map(pa.array, words.T),
                 *map(pa.array, least.view(np.int64).T)], names=names)
        rows = [(i, sketch[i * SLICE:(i + 1) * SLICE]) for i in range(len(sketch) // SLICE)]
        rows = [(i, _small(x)) for i, x in rows if x.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * len(rows), pa.int32()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
             pa.array([i for i, _ in rows], pa.int32()), pa.nulls(len(rows), pa.binary()),
             pa.array([x for _, x in rows], pa.binary()), *[pa.nulls(len(rows), pa.int64()) for _ in (*_PARITY, *_MINS)]], names=names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
            .mapInArrow(run, "kind int, doc_id long, th long, n int, sid binary, data binary, "
                        + ", ".join(f"{c} long" for c in (*_PARITY, *_MINS))))


def _small(x: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type that holds them."""
    return x.astype(f"<u{next(w for w in (1, 2, 4, 8) if int(x.max()) < 1 << (8 * w))}").tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // SLICE}").astype(np.uint64)


def _sketch(table: DataFrame) -> np.ndarray:
    """The partitions' sketches added up, in two steps; 16 MB whatever the data."""
    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.uint64)
        for x in pdf["data"]:
            total += _counts(x)
        return pd.DataFrame({"n": [int(pdf["n"].iloc[0])], "data": [_small(total)]})
    part = (table.where("kind = 1").withColumn("g", F.spark_partition_id())
            .groupBy("n", "g").applyInPandas(add, "n int, data binary"))
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in part.groupBy("n").applyInPandas(add, "n int, data binary").collect():
        out[r.n * SLICE:(r.n + 1) * SLICE] = _counts(r.data)
    return out


def choose_prefix(u: np.ndarray, sketch: np.ndarray, mean: float, percent: int) -> tuple[np.ndarray, int]:
    """The set's prefix in the global order and its number of matches l."""
    n = len(u)
    count = sketch[(u & np.uint64(len(sketch) - 1)).astype(np.int64)]
    least = -(-percent * n // 100)                               # ceil(t n)
    most = max(1, min(MOST_MATCHES, least))
    size = n - least + most
    order = np.lexsort((u, count)) if size >= n else None
    if order is None:
        near = np.argpartition(count, size - 1)
        bound = count[near[size - 1]]
        pool = np.flatnonzero(count <= bound)
        order = pool[np.lexsort((u[pool], count[pool]))]
    prefix = u[order[:size]]
    scan = np.cumsum(np.maximum(count[order[:size]] - mean, 0.0) + 1.0)
    ells = np.arange(1, most + 1)
    work = scan[n - least + ells - 1]
    ell = int(ells[np.argmin(work + VERIFY_COST * work / ells)])
    return prefix[:n - least + ell], ell


def _postings(docs: DataFrame, k: int, percent: int, sketch: np.ndarray) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(sketch.astype(np.uint32) if sketch.max() < 1 << 32 else sketch)   # bounded: 8 or 16 MB
    mean = float(sketch.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            toks, sids, ells, shorts, longs, known = [], [], [], [], [], set()
            for t in b.column(0):
                u = word_shingles(t.as_py(), k)
                sid = xxhash.xxh3_128_digest(u.tobytes())
                if not len(u) or sid in known:                    # copies have the same postings
                    continue
                known.add(sid)
                prefix, ell = choose_prefix(u, table, mean, percent)
                toks.append(prefix), sids.append(sid), ells.append(ell), longs.append(len(prefix))
                shorts.append(len(u) - least_overlap(len(u), len(u), percent) + ell)
            at = np.repeat(np.arange(len(longs)), longs)
            tok = np.concatenate(toks).view(np.int64) if toks else np.empty(0, np.int64)
            pos = np.arange(len(at)) - np.repeat(np.cumsum([0, *longs[:-1]]), longs) if longs else at
            early = pos < np.array(shorts, np.int64)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tok), pa.array(sids, pa.binary()).take(pa.array(at)), pa.array(np.array(ells, np.int32)[at]), pa.array(early)],
                names=["tok", "sid", "ell", "early"])

    return docs.select("text").mapInArrow(run, "tok long, sid binary, ell int, early boolean")


def least_overlap(a: int, b: int, percent: int) -> int:
    """Least intersection of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _size_filter(a: str, b: str, percent: int) -> Column:
    return ((F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent))


def _parity_filter(percent: int) -> Column:
    """Whether the parity sketches of ``a`` and ``b`` differ in no more bits than a link allows."""
    total = F.col("na") + F.col("nb")
    differ = sum((F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in _PARITY), F.lit(0))
    return differ <= total - 2 * _least_overlap(percent)


def _least_overlap(percent: int) -> Column:
    """:func:`least_overlap` of the sizes ``na`` and ``nb`` (whole numbers throughout)."""
    return F.expr(f"({percent} * (cast(na as bigint) + nb) + {99 + percent}) div {100 + percent}")


def _texts_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``(doc_id, th, text)`` of the rows that ``reps(_d, _t)`` may name: those whose hash is in a bounded
    bitmap (4 MB whatever the data), so that the other texts are not shuffled to meet them."""
    def place(d: str, t: str) -> Column:
        return F.xxhash64(F.col(d), F.col(t)).bitwiseAND(F.lit(BLOOM_BITS - 1))
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    named = reps.select((place("_d", "_t") + 1).alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    for r in named.collect():                                    # buckets of 4 kB, from 1
        bits[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            at = b.column(3).to_numpy()
            yield b.select([0, 1, 2]).filter(pa.array((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return texts.withColumn("at", place("doc_id", "th")).mapInArrow(run, "doc_id long, th long, text string")


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of class hashes that link; exact, on the candidates' whole sets."""
    wanted = pairs.select(F.col("a").alias("sid"), F.lit(True).alias("left")).unionByName(
        pairs.select(F.col("b").alias("sid"), F.lit(False).alias("left"))).groupBy("sid").agg(
        F.max("left").alias("is_a"), F.min("left").alias("only_a"))
    reps = materialise(wanted.join(classes, "sid").select("sid", F.col("rep.doc_id").alias("_d"),
                                                         F.col("rep.th").alias("_t"), "is_a", "only_a"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, keep = [], []
            for sid, text in zip(b.column(0).to_pylist(), b.column(3)):
                u = word_shingles(text.as_py(), k).tobytes()
                keep.append(xxhash.xxh3_128_digest(u) == sid)
                out.append(u)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())],
                                             names=["sid", "is_a", "only_a", "u"]).filter(pa.array(keep, pa.bool_()))

    texts = materialise(_texts_of(docs, reps))      # written, so that a task has one Python worker at a time
    found = materialise(texts.join(reps, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
                        .select("sid", "is_a", "only_a", "text").mapInArrow(sets, "sid binary, is_a boolean, only_a boolean, u binary")
                        .dropDuplicates(["sid"]))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("ua").to_pylist(), b.column("ub").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                inter = int((y[at] == x).sum())
                keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = materialise(pairs.select("a", "b")
                        .join(found.where("is_a").select(F.col("sid").alias("a"), F.col("u").alias("ua")), "a")
                        .join(found.where("not only_a").select(F.col("sid").alias("b"), F.col("u").alias("ub")), "b")
                        .mapInArrow(check, "a binary, b binary"))
    discard(found), discard(reps), discard(texts)
    return links


def _members(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, th, n, sid)`` of every row of ``docs(doc_id, text)``; ``(sid, component)`` of every
    class of equal sets, the empty set left out."""
    table = materialise(_sets(docs, k))
    sketch = _sketch(table)
    rows = table.where("kind = 0").drop("kind")
    classes = materialise(rows.where("n > 0").groupBy("sid").agg(
        F.min("n").alias("n"), *[F.min(c).alias(c) for c in (*_PARITY, *_MINS)], F.min(F.struct("doc_id", "th")).alias("rep")))
    post = materialise(_postings(docs, k, percent, sketch))
    # the classes are told apart by a short hash: numbers, unlike bytes, are aggregated in place
    short = F.xxhash64("sid")
    multi = materialise(post.groupBy("tok").agg(F.min(short).alias("lo"), F.max(short).alias("hi"), F.count("*").alias("df"),
                                                F.max("early").alias("any"))
                        .where("lo < hi and any").select("tok", "df"))
    shared = materialise(post.join(multi, "tok").dropDuplicates(["tok", "sid"]))
    discard(post), discard(multi)
    # pivot rounds
    fame = shared.groupBy("sid").agg(F.sum("df").alias("df"))
    figures = materialise(classes.drop("rep").join(fame, "sid").withColumn("fame", F.col("df") / F.col("n")).drop("df"))

    def side(x: str) -> DataFrame:
        return figures.select(F.col("sid").alias(x), F.col("n").alias(f"n{x}"), *[F.col(c).alias(c + x) for c in _PARITY])

    def refine(r: int, nodes: DataFrame) -> DataFrame:
        rank = F.lit(0.0) if r % 2 else -F.col("fame")
        return figures.select(F.col("sid").alias("node"), F.col(_MINS[r]).alias("sub"), rank.alias("rank"))

    def choose(met: DataFrame) -> DataFrame:
        near = met.join(side("a"), "a").join(side("b"), "b").where(_size_filter("na", "nb", percent) & _parity_filter(percent))
        return near.groupBy("b").agg(F.max(F.struct("w", "a")).alias("p")).select(F.col("p.a").alias("a"), "b")

    apart = docs.sparkSession.createDataFrame([], "node binary, component binary")
    open_, comp, tested = pivot_rounds(
        shared.select(F.col("tok").alias("key"), F.col("sid").alias("node"), "ell", "early"), apart, refine, choose,
        lambda pairs: _verify(pairs, classes, docs, k, percent), least=LEAST_ROUNDS, keep=("ell", "early"))
    discard(shared)
    # pair round: pairs of different components, the smaller set by its early shingles
    mixed = open_.groupBy("key").agg(F.max("early").alias("any")).where("any").select("key")
    cur = materialise(open_.join(mixed, "key").withColumnRenamed("node", "sid").join(figures.select("sid", "n", *_PARITY), "sid"))
    discard(open_)
    size = F.col("n").cast("long")
    short = size - F.expr(f"({percent} * 2 * cast(n as bigint) + {99 + percent}) div {100 + percent}") + F.col("ell")
    long = size - F.expr(f"({percent} * cast(n as bigint) + 99) div 100") + F.col("ell")
    small = cur.where("early").select(F.col("key").alias("tok"), F.col("sid").alias("a"), F.col("n").alias("na"), short.alias("sa"),
                                      F.col("c").alias("ca"), *[F.col(c).alias(c + "a") for c in _PARITY])
    large = cur.select(F.col("key").alias("tok"), F.col("sid").alias("b"), F.col("n").alias("nb"), long.alias("lb"),
                       F.col("c").alias("cb"), *[F.col(c).alias(c + "b") for c in _PARITY])
    need = F.greatest(F.lit(1), _least_overlap(percent) - F.greatest(F.col("na") - F.col("sa"), F.col("nb") - F.col("lb")))
    pair = ((F.col("ca") != F.col("cb")) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
            & _size_filter("na", "nb", percent) & _parity_filter(percent))
    met = (small.join(large, (small["tok"] == large["tok"]) & pair).groupBy("a", "b", need.alias("need"))
           .agg(F.count("*").alias("w")).where("w >= need").select("a", "b"))
    if tested is not None:
        done = tested.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        met = met.join(done, (F.least("a", "b") == F.col("x")) & (F.greatest("a", "b") == F.col("y")), "left_anti").select("a", "b")
    second = materialise(met)
    discard(cur), discard(figures)
    comp = materialise(merge_components(comp, _verify(second, classes, docs, k, percent)))
    return rows, classes.select("sid").join(comp.select(F.col("node").alias("sid"), "component"), "sid", "left").select(
        "sid", F.coalesce("component", "sid").alias("component"))


def link_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row a row of ``docs(doc_id, text)``."""
    rows, member = _members(docs, k, percent)
    least = (rows.groupBy("sid").agg(F.min("doc_id").alias("d")).join(member, "sid")
             .groupBy("component").agg(F.min("d").alias("component_id")))
    named = materialise(member.join(least, "component").select("sid", "component_id"))
    return rows.join(named, "sid", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def first_rows(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, th)`` of the first document of every component: the least id, null ids last, then
    the least text hash.  Documents with an empty set link with nothing and are all named."""
    rows, member = _members(docs, k, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = (rows.groupBy("sid").agg(F.min(order).alias("p")).join(member, "sid")
             .groupBy("component").agg(F.min("p").alias("p")).select("p.doc_id", "p.th"))
    return first.unionByName(rows.where("n = 0").select("doc_id", "th").distinct())
