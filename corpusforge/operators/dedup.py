"""Near-duplicate removal with keep-first semantics.

Plan at scale
-------------
1. Word tokens are a JVM regex projection on each row (narrow).
2. Signatures are computed by ``mapInArrow`` on Arrow batches: token hashes, rolling
   shingle hashes and 128 multiply-shift hashes, all vectorised NumPy (narrow, no shuffle).
3. LSH: every row emits ``b`` band keys; a single aggregation on ``(band, key)`` finds the
   buckets with two or more members (partial aggregation makes hot buckets cheap).
   A bucket is a clique of the duplicate graph, so the graph is kept as a *membership*
   table ``(band, bucket_first, node)`` whose size is linear in the input - no pairs are
   ever emitted.
4. Keep-first is the lexicographically first maximal independent set of that graph.  It
   is resolved in rounds: a node whose every bucket has it as the first still-alive member
   is kept; every other alive member of such a bucket is dropped.  Each round is a few
   aggregations/joins on the shrinking membership table and is checkpointed into the
   shared checkpoint folder.  What a few rounds leave (chains of near-duplicates) is split
   into connected components, and those of a bounded size are walked through in one task each.
   In verified mode (D10) the members of a bucket are compared with its kept lead alone, by
   exact Jaccard; where that fails, with the next lead.  No bucket emits pairs.
5. The input is filtered with one left-anti join against the dropped nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions.text import blank_runs, word_tokens
from corpusforge.session import cut_lineage, written

MERSENNE31 = (1 << 31) - 1


# D1 -------------------------------------------------------------------------------------
def dedup_text(df: DataFrame) -> Column:
    """``text`` if the rows have it, else ``generated.text``, else the row as JSON."""
    if "text" in df.columns:
        return F.col("text")
    gen = df.schema["generated"].dataType if "generated" in df.columns else None
    if isinstance(gen, T.StructType) and "text" in gen.fieldNames():
        return F.col("generated.text")
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))


# D2 / D3 --------------------------------------------------------------------------------
# The shingle builders take an *already projected* token array / normalised text column.
# Both are referenced more than once below, so Catalyst keeps the (expensive) regex in
# its own projection instead of inlining it.
def word_shingles_from_tokens(w: Column, n: int = 5) -> Column:
    """Distinct word n-grams of a token array (one shingle of all tokens if shorter)."""
    n = max(1, int(n))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - n + 1))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " ")))


def char_shingles(norm: Column, n: int = 5) -> Column:
    """Distinct character n-grams of a normalised text (the whole text if it has fewer code points).

    One regex pass: a look-ahead takes n code points at every place, the match goes on by one."""
    n = max(1, int(n))
    return F.when(norm.isNull() | (F.length(norm) < n), F.array(norm)).otherwise(
        F.array_distinct(F.regexp_extract_all(norm, F.lit(f"(?s)(?=(.{{{n}}}))."), 1)))


def char_normalize(text) -> Column:
    """Lower-case and collapse whitespace runs to one blank (no strip)."""
    return blank_runs(F.lower(text if isinstance(text, Column) else F.col(text)))


def with_shingles(df: DataFrame, text: Column, out: str = "shingles", n: int = 5,
                  level: str = "word") -> DataFrame:
    """``df`` plus a column of distinct shingles (D2 word n-grams or D3 char n-grams).

    Never non-empty-filter or ``explode`` the result directly: Catalyst would infer a
    ``size(...) > 0`` filter and push it, with the tokeniser inlined per element, to the scan
    (shingle sets are never empty, so ``explode_outer`` gives the same rows).
    """
    if level == "char":
        staged = df.withColumn("_norm", char_normalize(text))
        return staged.withColumn(out, char_shingles(F.col("_norm"), n)).drop("_norm")
    staged = df.withColumn("_tok", word_tokens(text))
    return staged.withColumn(out, word_shingles_from_tokens(F.col("_tok"), n)).drop("_tok")


# D4 -------------------------------------------------------------------------------------
# A shingle is identified by the rolling (Horner) hash of its token hashes,
#   x = (((t1 * R + t2) * R + t3) ...) mod (2^31 - 1),  t = md5-derived 31-bit token hash,
# i.e. a hash of the n-gram as a token sequence (tokens never contain blanks, so these are
# the same sets as the joined n-gram strings).  A text shorter than n tokens is one shingle
# of all its tokens; no tokens gives the empty shingle, hash 0.  Each of the ``num_perm``
# hash functions is multiply-shift: ``h(x) = ((a x + b) mod 2^64) >> 32``.
ROLL_BASE = 1_000_003


def char_tokens(text) -> Column:
    """The code points of the lower-cased, whitespace-collapsed text, one string each."""
    return F.regexp_extract_all(char_normalize(text), F.lit("(?s)."), 0)


def hash_tokens(tokens: pa.Array, level: str = "word") -> np.ndarray:
    """Token hash of an Arrow array of strings: md5-derived 31 bits (word) or the code
    point + 1 (char).  Each distinct token is hashed once; only those become Python strings."""
    if len(tokens) == 0:
        return np.empty(0, dtype=np.int64)
    named = tokens.dictionary_encode()
    uniq = named.dictionary.to_pylist()
    if level == "char":
        vals = np.fromiter((ord(c) + 1 for c in uniq), dtype=np.int64, count=len(uniq))
    else:
        vals = np.fromiter((int.from_bytes(hashlib.md5(t.encode("utf-8")).digest()[:4], "big") % MERSENNE31
                            for t in uniq), dtype=np.int64, count=len(uniq))
    return vals[named.indices.to_numpy(zero_copy_only=False)]


@lru_cache(maxsize=None)
def minhash_params(num_perm: int = 128, seed: int = 1) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Multiply-shift coefficients: odd 64-bit ``a_i`` and 64-bit ``b_i`` from md5 of a tag."""
    def h64(tag: str, i: int) -> int:
        return int(hashlib.md5(f"{tag}:{seed}:{i}".encode()).hexdigest()[:16], 16)
    return (tuple(h64("minhash-a", i) | 1 for i in range(num_perm)),
            tuple(h64("minhash-b", i) for i in range(num_perm)))


def _rolling(flat: np.ndarray, n: int) -> np.ndarray:
    """Horner hash of every length-n window of ``flat`` (vectorised over all windows)."""
    m = flat.shape[0] - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.int64)
    s = flat[:m].copy()
    for j in range(1, n):
        s *= ROLL_BASE
        s += flat[j:j + m]
        np.remainder(s, MERSENNE31, out=s)
    return s


def shingle_ids(tok: np.ndarray, lens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of many texts from their concatenated token hashes:
    ``(x, starts)`` = all shingle hashes and the offset of each text's first one."""
    offs = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    win = _rolling(tok, n)
    counts = np.where(lens >= n, lens - n + 1, 1)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    x = np.empty(int(counts.sum()), dtype=np.int64)
    for i in range(lens.shape[0]):     # one slice copy per text; the windows are vectorised
        L = int(lens[i])
        if L >= n:
            x[starts[i]:starts[i] + L - n + 1] = win[offs[i]:offs[i] + L - n + 1]
        else:                          # short text: one shingle of all its tokens
            v = 0
            for t in tok[offs[i]:offs[i] + L].tolist():
                v = (v * ROLL_BASE + t) % MERSENNE31
            x[starts[i]] = v
    return x, starts


def _minhash_block(x: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray,
                   budget: int = 1 << 21) -> np.ndarray:
    """Per text, the min over its shingles of ``((a x + b) mod 2^64) >> 32`` for every (a, b)."""
    k = a.shape[0]
    xu = x.astype(np.uint64)
    out = np.empty((starts.shape[0], k), dtype=np.uint64)
    step = max(1, min(k, budget // max(1, xu.shape[0])))
    buf = np.empty((step, xu.shape[0]), dtype=np.uint64)
    shift = np.uint64(32)
    for lo in range(0, k, step):
        hi = min(k, lo + step)
        h = buf[:hi - lo]
        np.multiply(a[lo:hi, None], xu[None, :], out=h)
        h += b[lo:hi, None]
        h >>= shift
        out[:, lo:hi] = np.minimum.reduceat(h, starts, axis=1).T
    return out.astype(np.int64)


def _signature_batches(batch: pa.RecordBatch, a: np.ndarray, b: np.ndarray, n: int, level: str,
                       token_budget: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Signatures of a batch ``(id, token list)``, in pieces of at most ``token_budget`` tokens (or one text);
    rows with a NULL list are left out.  The tokens stay in their Arrow buffers."""
    lens = np.asarray(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(lens)
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + token_budget, side="right")))
        part = batch.slice(lo, hi - lo)
        part = part.filter(part.column(1).is_valid())
        if part.num_rows:
            own = part.column(1)
            sizes = np.asarray(pc.list_value_length(own).to_numpy(zero_copy_only=False), dtype=np.int64)
            x, starts = shingle_ids(hash_tokens(own.flatten(), level), sizes, n)
            sig = _minhash_block(x, starts, a, b)
            rows = np.arange(sig.shape[0] + 1, dtype=np.int32) * a.shape[0]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(rows, sig.reshape(-1))],
                                             names=[batch.schema.names[0], "sig"])
        lo = hi


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a freshly read table of fewer files than the cluster has cores (a few large row
    groups) before CPU-heavy per-row work.  For readers only: it looks at the table's file
    names and runs no job; a table of many files stays as it is."""
    par = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    return df.repartition(par, key) if 0 < len(files) < par else df


# D6 -------------------------------------------------------------------------------------
def _integrate(f, lo: float, hi: float, n: int = 2000) -> float:
    if hi <= lo:
        return 0.0
    xs = np.linspace(lo, hi, n + 1)
    ys = f(xs)
    h = (hi - lo) / n
    return float(h / 3 * (ys[0] + ys[-1] + 4 * ys[1:-1:2].sum() + 2 * ys[2:-1:2].sum()))


@lru_cache(maxsize=None)
def lsh_params(threshold: float = 0.9, num_perm: int = 128,
               fp_weight: float = 0.5, fn_weight: float = 0.5) -> tuple[int, int]:
    """(bands, rows) minimising the weighted false-positive + false-negative area of the
    S-curve ``1-(1-s^r)^b`` around ``threshold`` (the standard MinHash-LSH choice)."""
    best, best_err = (1, 1), float("inf")
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = _integrate(lambda s: 1 - (1 - s ** r) ** b, 0.0, threshold)
            fn = _integrate(lambda s: (1 - s ** r) ** b, threshold, 1.0)
            err = fp_weight * fp + fn_weight * fn
            if err < best_err:
                best, best_err = (b, r), err
    return best


# D5 -------------------------------------------------------------------------------------
def band_keys(sig: Column, bands: int, rows: int) -> Column:
    """``array<struct<band, k1, k2>>``: a 128-bit digest of each band of the signature."""
    return F.array(*[
        F.struct(F.lit(j).alias("band"),
                 F.xxhash64(F.slice(sig, j * rows + 1, rows)).alias("k1"),
                 F.xxhash64(F.lit("band-salt"), F.slice(sig, j * rows + 1, rows)).alias("k2"))
        for j in range(bands)])


def signatures(df: DataFrame, order_col: str, text: Column, *, num_perm: int = 128,
                n_gram: int = 5, level: str = "word", seed: int = 1) -> DataFrame:
    """``(order_col, sig)`` for rows with non-empty text (empty text is never indexed).

    Tokens are a codegen'd JVM projection; ``mapInArrow`` consumes that projection's rows
    as they are (a pandas UDF would pull the whole text expression into its own, slower
    input evaluation), and it drops the rows without text, so no filter on the text
    expression is pushed down and evaluated twice.
    """
    a_t, b_t = minhash_params(num_perm, seed)
    a = np.asarray(a_t, dtype=np.uint64)
    b = np.asarray(b_t, dtype=np.uint64)
    n = max(1, int(n_gram))
    idx = df.select(F.col(order_col), text.alias("_t"))
    kind = df.schema[order_col].dataType.simpleString()
    toks = char_tokens(F.col("_t")) if level == "char" else word_tokens(F.col("_t"))
    staged = idx.select(order_col, F.when(F.length("_t") > 0, toks).alias("_tok"))

    def run(batches):
        for batch in batches:
            yield from _signature_batches(batch, a, b, n, level)

    return staged.mapInArrow(run, f"`{order_col}` {kind}, sig array<bigint>")


def lsh_membership(sigs: DataFrame, order_col: str, bands: int, rows: int) -> DataFrame:
    """Members of every LSH bucket with >= 2 rows: ``(band, first, node)``.

    ``first`` (the smallest order value in the bucket) names the bucket; within one band
    every row is in exactly one bucket, so ``(band, first)`` is a unique bucket id.
    """
    # used twice below (bucket sizes, members): materialise the small band-key table once
    # instead of recomputing the signatures
    keyed = cut_lineage(sigs.select(F.col(order_col).alias("node"),
                                    F.explode_outer(band_keys(F.col("sig"), bands, rows)).alias("bk")
                                    ).select("node", "bk.band", "bk.k1", "bk.k2"))
    return _members(keyed)


def _members(keyed: DataFrame) -> DataFrame:
    # the bucket table is materialised so that the join's other side is no aggregate over the
    # same exchange: adaptive execution can then split a hot bucket
    buckets = cut_lineage(keyed.groupBy("band", "k1", "k2")
                          .agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
                          .filter(F.col("n") >= 2))
    return keyed.join(buckets, ["band", "k1", "k2"]).select("band", "first", "node")


def collapse_equal(sigs: DataFrame, order_col: str) -> tuple[DataFrame, DataFrame]:
    """``(sigs of the first row of every signature, nodes of the others)``.  Rows of one signature
    share every bucket, so all but the first are dropped whatever becomes of the first."""
    named = cut_lineage(sigs.withColumn("_h1", F.xxhash64("sig")).withColumn("_h2", F.xxhash64(F.lit("sig"), "sig")))
    first = cut_lineage(named.groupBy("_h1", "_h2").agg(F.min(order_col).alias("_lead")))
    tagged = named.join(first, ["_h1", "_h2"])
    return (tagged.filter(F.col(order_col) == F.col("_lead")).select(order_col, "sig"),
            tagged.filter(F.col(order_col) != F.col("_lead")).select(F.col(order_col).alias("node")))


# D7 -------------------------------------------------------------------------------------
# Rounds before the components are looked at, and the largest component (membership rows, or shingles
# where pairs are verified) that one task walks through.
SHALLOW_ROUNDS = 3
WHOLE_ROWS = 1_000_000
WHOLE_SHINGLES = 10_000_000
_BUCKET = ["band", "first"]


def _walk_components(rows: DataFrame, kind: str, threshold: float | None = None) -> DataFrame:
    """Dropped nodes of whole components: ``rows(component, node, buckets[, s])``, one row a node.

    A task reads its components one after the other in the order of their nodes and keeps, of the
    component it is in, the buckets that hold a kept node (and those nodes' shingle sets).
    """
    def run(batches):
        component, closed, sets = None, {}, {}
        for pdf in batches:
            dropped = []
            for row in pdf.itertuples(index=False):
                if row.component != component:
                    component, closed, sets = row.component, {}, {}
                buckets = [(b["band"], b["first"]) for b in row.buckets]
                leads = {lead for b in buckets for lead in closed.get(b, ())}
                if threshold is None:
                    hit = bool(leads)
                else:
                    own = np.asarray(row.s)
                    hit = any(_similar(own, sets[lead], threshold) for lead in leads)
                if hit:
                    dropped.append(row.node)
                    continue
                for b in buckets:
                    closed.setdefault(b, []).append(row.node)
                if threshold is not None:
                    sets[row.node] = own
            yield pd.DataFrame({"node": dropped})

    dealt = rows.repartition("component").sortWithinPartitions("component", "node")
    return dealt.mapInPandas(run, f"node {kind}")


def _similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Jaccard of two arrays of distinct values."""
    shared = np.intersect1d(a, b, assume_unique=True).shape[0]
    return shared / (a.shape[0] + b.shape[0] - shared) >= threshold


def keep_first_dropped(members: DataFrame, max_rounds: int = 10_000, *, sets: DataFrame | None = None,
                       threshold: float = 0.9, trace: list | None = None) -> DataFrame:
    """Nodes dropped by keep-first over a clique-membership table ``(band, first, node)``.

    A node is kept iff it has no earlier kept neighbour.  Without ``sets`` all members of a bucket
    are neighbours; with ``sets(node, s, n)`` (distinct shingle hashes and their number) they also
    need a Jaccard similarity of at least ``threshold``.

    A round decides the nodes that come first in all their buckets and compares the other members of
    those buckets with them alone.  What :data:`SHALLOW_ROUNDS` leave undecided is split into
    connected components: those of a bounded size are walked through whole, one task each; the
    rest has further rounds.  ``trace`` receives one entry a step.
    """
    kind = members.schema["node"].dataType.simpleString()
    alive = written(members.select(*_BUCKET, "node"))
    sets = None if sets is None else written(sets)
    dropped_parts: list[DataFrame] = []
    rounds, trace = 0, [] if trace is None else trace
    while not alive.isEmpty():
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"keep-first did not converge in {max_rounds} rounds")
        if rounds % (SHALLOW_ROUNDS + 1) == 0:
            trace.append("components")
            dropped_now, alive = _decide_components(alive, kind, sets, threshold)
            dropped_parts.append(dropped_now)
            continue
        trace.append("round")
        # a bucket with one member left decides nothing: its node is done where it has no other
        leads = written(alive.groupBy(*_BUCKET).agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n"))
                            .filter("n > 1").drop("n"))
        tagged = alive.join(leads, _BUCKET)
        kept_now = written(tagged.groupBy("node").agg(F.bool_and(F.col("node") == F.col("lead")).alias("ok"))
                               .filter("ok").select("node"))
        follow = tagged.join(kept_now.withColumnRenamed("node", "lead"), "lead", "left_semi").filter("node <> lead")
        if sets is None:
            dropped_now = written(follow.select("node").distinct())
        else:
            dropped_now = written(_verified(follow.select("node", "lead").distinct(), sets, threshold)
                                      .select("node").distinct())
        dropped_parts.append(dropped_now)
        alive = written(tagged.select(*_BUCKET, "node").join(kept_now, "node", "left_anti")
                            .join(dropped_now, "node", "left_anti"))
    if not dropped_parts:
        return members.select("node").limit(0)
    out = dropped_parts[0]
    for part in dropped_parts[1:]:
        out = out.unionByName(part)
    return out


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(node, lead)`` whose shingle sets are similar: sizes first, then the sets."""
    small = sets.select("node", "n")
    sized = (pairs.join(small, "node").join(small.select(F.col("node").alias("lead"), F.col("n").alias("m")), "lead")
             .where(F.least("n", "m") >= F.lit(threshold) * F.greatest("n", "m") - F.lit(1e-9)))
    both = (sized.join(sets.select("node", "s"), "node")
            .join(sets.select(F.col("node").alias("lead"), F.col("s").alias("t")), "lead")
            .select("node", "lead", "n", "m", F.size(F.array_intersect("s", "t")).alias("i")))
    return both.where(F.col("i") / (F.col("n") + F.col("m") - F.col("i")) >= F.lit(threshold)).select("node", "lead")


def _decide_components(alive: DataFrame, kind: str, sets: DataFrame | None, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(dropped nodes, memberships still undecided)`` after walking through the bounded components."""
    from corpusforge.operators.components import group_components
    labelled = written(alive.join(group_components(alive, _BUCKET, "node"), "node"))
    nodes = labelled.groupBy("component", "node").agg(F.collect_list(F.struct(*_BUCKET)).alias("buckets"))   # one node's
    size, most = F.size("buckets"), WHOLE_ROWS
    if sets is not None:
        nodes = nodes.join(sets, "node")
        size, most = F.col("n"), WHOLE_SHINGLES
    nodes = written(nodes)
    small = written(nodes.groupBy("component").agg(F.sum(size).alias("_rows")).where(F.col("_rows") <= most).select("component"))
    dropped = written(_walk_components(nodes.join(small, "component"), kind, None if sets is None else threshold))
    return dropped, written(labelled.join(small, "component", "left_anti").select(*_BUCKET, "node"))


# D10 ------------------------------------------------------------------------------------
def shingle_sets(df: DataFrame, order_col: str, text: Column, *, n_gram: int = 5, level: str = "word") -> DataFrame:
    """``(node, s, n)``: 64-bit hashes of the whole text's distinct shingles (D2, D3), and how many."""
    named = df.select(F.col(order_col).alias("node"), text.alias("_t"))
    hashed = with_shingles(named, F.col("_t"), "_s", n_gram, level).select(
        "node", F.sort_array(F.transform("_s", lambda x: F.xxhash64(x))).alias("s"))
    return hashed.select("node", "s", F.size("s").alias("n"))


def collapse_equal_sets(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(members that are first of their shingle set, nodes of the others)``.  Rows of one set share
    every bucket and neighbour, so all but the first go whatever becomes of it."""
    named = written(sets.select("node", F.xxhash64("s").alias("_h1"), F.xxhash64(F.lit("set"), "s").alias("_h2")))
    lead = written(named.groupBy("_h1", "_h2").agg(F.min("node").alias("_lead"), F.max("node").alias("_last")).where("_lead < _last"))
    equal = written(named.join(lead, ["_h1", "_h2"]).where("node <> _lead").select("node"))
    return members.join(equal, "node", "left_anti"), equal


def deduplicate(df: DataFrame, order_col: str, *, text: Column | None = None,
                threshold: float = 0.9, num_perm: int = 128, n_gram: int = 5,
                shingle_level: str = "word", seed: int = 1, verify: bool = False,
                return_dropped: bool = False):
    """Keep-first MinHash-LSH near-duplicate removal.

    ``order_col`` stands for the position of the row in the input; it may be of any orderable
    type and must be non-null and unique (else this raises).  Rows with null or empty text are
    kept and never indexed.  With ``verify`` (D10) a row is dropped only for an earlier kept row
    with a common bucket *and* a Jaccard similarity of at least ``threshold`` over the whole
    shingle sets; only rows in buckets have their sets built.
    """
    ids = df.groupBy(order_col).agg(F.count(F.lit(1)).alias("n"))
    if not ids.filter((F.col("n") > 1) | F.col(order_col).isNull()).isEmpty():
        raise ValueError(f"{order_col} must be unique and not null")
    text = dedup_text(df) if text is None else text
    bands, rows = lsh_params(threshold, num_perm)
    sigs = signatures(df, order_col, text, num_perm=num_perm, n_gram=n_gram,
                      level=shingle_level, seed=seed)
    if verify:
        members = written(lsh_membership(sigs, order_col, bands, rows))
        inside = members.select(F.col("node").alias(order_col)).distinct()
        sets = written(shingle_sets(df.select(order_col, text.alias("_dt")).join(inside, order_col, "left_semi"), order_col,
                                        F.col("_dt"), n_gram=n_gram, level=shingle_level))
        members, equal = collapse_equal_sets(members, sets)
        dropped = keep_first_dropped(members, sets=sets, threshold=threshold).unionByName(equal)
    else:
        sigs, equal = collapse_equal(sigs, order_col)
        dropped = keep_first_dropped(lsh_membership(sigs, order_col, bands, rows)).unionByName(equal)
    kept = df.join(dropped.withColumnRenamed("node", order_col), order_col, "left_anti")
    return (kept, dropped) if return_dropped else kept


# D9 -------------------------------------------------------------------------------------
def dedup_stats(df: DataFrame, order_col: str, dropped: DataFrame) -> DataFrame:
    """``total, unique, duplicates`` as one row."""
    flag = dropped.select(F.col("node").alias(order_col), F.lit(1).alias("_dup"))
    return (df.select(order_col).join(flag, order_col, "left")
            .agg(F.count(F.lit(1)).alias("total"), F.count("_dup").alias("duplicates"))
            .select("total", (F.col("total") - F.col("duplicates")).alias("unique"), "duplicates"))
