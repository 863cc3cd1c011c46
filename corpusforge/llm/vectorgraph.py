"""Embedding near-dedup on a robust-pruned flat graph (operator 8).

1. Equal vectors of one label form a class.  Centroids per label are fitted on a bounded
   sample (``sample_rows`` classes by hash); every class is indexed.
2. A class belongs to its nearest cluster (its primary one) and to every cluster whose bisector
   is within the link radius, so all partners of a class lie in its primary cluster's shard.
   Shards are cut into units of at most about ``unit_rows`` classes.
3. In every unit a flat graph is built: nearest neighbours, robust-pruned, plus some random
   long arcs.  A class's adjacency lists from all its units are united.
4. Every class is searched in all units of its primary shard: greedy beam search from the
   unit's medoid, then the range is expanded over the graph from every hit as long as new hits
   within the radius appear.  Hits are verified in double precision.
5. ``n_links`` adds up the sizes of the classes found; components come from star contraction
   over a spanning forest of every unit's links (pairs are never written out).
6. The recall of the links is audited against brute force on ``audit_rows`` classes; below
   ``target_recall`` the search is repeated with a doubled beam, and below ``least_recall`` it
   raises at last.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows without a label or id, link with nothing; the latter two have a null component where the id
is null; equal vectors of one label link; rows that repeat an id count each; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.hashing import hash48
from corpusforge.llm.common import connected_components, discard, materialise

MIN_COSINE = 0.98
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 48, 1.2, 24


def vector_classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, classes)``: every row with its class key (null where it takes no part), and
    ``classes(k1, k2, label, dim, cls, cnt, x)`` with ``cls`` the least vec_id."""
    x = F.col("embedding")
    fine = (x.isNotNull() & (F.size(x) > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
            & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
            & F.exists(x, lambda e: e != 0))
    base = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding",
                             F.coalesce(fine, F.lit(False)).alias("ok"))
    keyed = base.select("vec_id", "label", "embedding", *[
        F.when(F.col("ok"), F.xxhash64(F.lit(i), "label", "embedding")).alias(f"k{i}") for i in (1, 2)])
    classes = keyed.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("label").alias("label"), F.min("vec_id").alias("cls"), F.count("*").alias("cnt"),
        F.min("embedding").alias("embedding"))
    return keyed.select("vec_id", "k1", "k2"), classes.select(
        "label", F.size("embedding").alias("dim"), "cls", "cnt", "k1", "k2",
        F.transform("embedding", lambda e: e.cast("double")).alias("x"))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of unit vectors by Lloyd's rounds from evenly spaced seeds."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        for j in range(k):
            own = x[near == j]
            if len(own):
                c[j] = own.mean(0)
    return c


def clusters_of(x: np.ndarray, c: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest cluster per row, and the membership matrix: clusters in which a vector within
    ``radius`` of the row may have its nearest centroid."""
    d = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
    near = d.argmin(1)
    apart = np.sqrt(np.maximum(((c[near][:, None, :] - c[None]) ** 2).sum(2), 1e-18))
    beyond = (d - d[np.arange(len(x)), near][:, None]) / (2 * apart)      # distance to the bisector
    return near, beyond <= radius + 1e-9


def robust_prune(x: np.ndarray, rows: np.ndarray, cand: np.ndarray, degree: int, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours kept per row of ``cand`` (nearest first, -1 empty): a candidate goes when a kept
    one is ``alpha`` times nearer to it than the row itself."""
    v = x[np.maximum(cand, 0)]
    to_row = np.where(cand >= 0, 2 - 2 * np.einsum("nd,nmd->nm", x[rows], v), np.inf)
    alive = cand >= 0
    out, filled = np.full((len(rows), degree), -1, np.int64), np.zeros(len(rows), np.int64)
    for j in range(cand.shape[1]):
        at = np.flatnonzero(alive[:, j] & (filled < degree))
        if not len(at):
            continue
        out[at, filled[at]] = cand[at, j]
        filled[at] += 1
        between = 2 - 2 * np.einsum("nd,nmd->nm", v[at, j], v[at, j + 1:])
        alive[at, j + 1:] &= alpha * between > to_row[at, j + 1:]
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES) -> np.ndarray:
    """Adjacency matrix (-1 empty) of a flat graph over unit vectors."""
    n = len(x)
    m = min(candidates, n - 1)
    near = np.full((n, max(m, 1)), -1, np.int64)
    for s in range(0, n, 512):
        sim = x[s:s + 512] @ x.T
        sim[np.arange(len(sim)), np.arange(s, s + len(sim))] = -np.inf
        if m:
            top = np.argpartition(-sim, m - 1, axis=1)[:, :m]
            near[s:s + 512, :m] = np.take_along_axis(top, np.argsort(-np.take_along_axis(sim, top, 1), axis=1), 1)
    kept = np.empty((n, degree), np.int64)
    for s in range(0, n, 512):
        kept[s:s + 512] = robust_prune(x, np.arange(s, min(s + 512, n)), near[s:s + 512], degree)
    # long arcs in both directions along a seeded cycle keep the graph connected
    order = np.random.Generator(np.random.PCG64(5)).permutation(n)
    nxt = np.empty(n, np.int64)
    nxt[order] = np.roll(order, -1)
    prv = np.empty(n, np.int64)
    prv[order] = np.roll(order, 1)
    return np.concatenate([kept, nxt[:, None], prv[:, None]], axis=1)


def range_search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, reach: float, beam: int):
    """Pairs ``(query row, unit row)`` with a similarity of at least ``reach`` that the search meets."""
    n, nq = len(x), len(q)
    medoid = int((x @ x.mean(0)).argmax())
    beam = min(beam, n)
    seen = np.zeros((nq, n), bool)
    ids = np.full((nq, beam), -1, np.int64)
    sims = np.full((nq, beam), -np.inf, x.dtype)
    done = np.ones((nq, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = medoid, q @ x[medoid], False
    seen[:, medoid] = True
    hits_q, hits_v = [], []
    hit = np.flatnonzero(sims[:, 0] >= reach)
    hits_q.append(hit), hits_v.append(np.full(len(hit), medoid))
    active = np.arange(nq)
    while len(active):
        score = np.where(done[active], -np.inf, sims[active])
        best = score.argmax(1)
        going = score[np.arange(len(active)), best] > -np.inf
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        nb = graph[ids[active, best]]
        fresh = (nb >= 0) & ~seen[active[:, None], np.maximum(nb, 0)]
        r, c = np.nonzero(fresh)
        rows, cols = active[r], nb[r, c]
        seen[rows, cols] = True                                  # a list holds no node twice but by long arcs
        s = np.full(nb.shape, -np.inf, x.dtype)
        s[r, c] = np.einsum("md,md->m", q[rows], x[cols])
        found = np.nonzero(s >= reach)
        hits_q.append(active[found[0]]), hits_v.append(nb[found])
        all_s = np.concatenate([sims[active], s], axis=1)
        all_i = np.concatenate([ids[active], nb], axis=1)
        all_d = np.concatenate([done[active], ~fresh], axis=1)
        top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam] if all_s.shape[1] > beam else np.argsort(-all_s, 1)
        sims[active] = np.take_along_axis(all_s, top, 1)
        ids[active] = np.take_along_axis(all_i, top, 1)
        done[active] = np.take_along_axis(all_d, top, 1)
    # range expansion: from every hit over the arcs, either way, as long as new hits appear
    tail, slot = np.nonzero(graph >= 0)
    head = graph[tail, slot]
    arcs = np.unique(np.concatenate([tail * n + head, head * n + tail]))
    tail, head = np.divmod(arcs, n)
    begin = np.searchsorted(tail, np.arange(n + 1))
    pairs = np.unique(np.concatenate(hits_q) * n + np.concatenate(hits_v))
    out, front = [pairs], pairs
    while len(front):
        grown = []
        for s in range(0, len(front), 20_000):
            a, b = np.divmod(front[s:s + 20_000], n)
            many = begin[b + 1] - begin[b]
            first = np.repeat(begin[b] - (np.cumsum(many) - many), many)
            rows, cols = np.repeat(a, many), head[first + np.arange(many.sum())]
            new = ~seen[rows, cols]
            code = np.unique(rows[new] * n + cols[new])
            rows, cols = np.divmod(code, n)
            seen[rows, cols] = True
            for t in range(0, len(code), 100_000):
                sim = np.einsum("md,md->m", q[rows[t:t + 100_000]], x[cols[t:t + 100_000]])
                grown.append(code[t:t + 100_000][sim >= reach])
        front = np.concatenate(grown) if grown else np.empty(0, np.int64)
        out.append(front)
    return np.divmod(np.unique(np.concatenate(out)), n)


def _roots(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reachable over the arcs ``a - b`` (positions into the sorted ``nodes``)."""
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def _matrix(col) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in col])


def near_duplicates(embeddings: DataFrame, min_cosine: float = MIN_COSINE, unit_rows: int = 4096,
                    cluster_rows: int = 2048, sample_rows: int = 20_000, audit_rows: int = 200,
                    target_recall: float = 0.99,
                    least_recall: float = 0.9, beam: int = BEAM) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``embeddings(vec_id, embedding, label)``."""
    spark = embeddings.sparkSession
    rows, classes = vector_classes(embeddings)
    rows, classes = materialise(rows), materialise(classes)
    radius = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    order = hash48(F.lit("sample"), "k1", "k2")
    total = classes.count()
    share = min(1.0, sample_rows / max(1, total))
    big = classes.groupBy("label", "dim").count().where(F.col("count") > cluster_rows)   # <= total / cluster_rows
    sample = (classes.where(order < F.lit(int(share * 2 ** 48))).join(big, ["label", "dim"])
              .select("label", "dim", "count", "x", order.alias("o")).orderBy("o").collect())   # bounded sample
    centres: dict = {}
    groups: dict = {}
    for r in sample:
        groups.setdefault((r.label, r.dim), (r["count"], []))[1].append(r.x)
    for key, (count, xs) in groups.items():
        centres[key] = k_means(_unit(np.array(xs)), max(1, min(-(-count // cluster_rows), len(xs) // 8)))
    shared = spark.sparkContext.broadcast(centres)               # bounded by the sample

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (label, dim), part in b.groupby(["label", "dim"], sort=False):
                c = shared.value.get((label, dim))
                if c is None:
                    yield part[["label", "dim", "cls", "cnt", "x"]].assign(cluster=0, primary=True)
                    continue
                near, member = clusters_of(_unit(_matrix(part["x"])), c, radius)
                r, cl = np.nonzero(member)
                yield part.iloc[r][["label", "dim", "cls", "cnt", "x"]].assign(cluster=cl, primary=near[r] == cl)

    placed = materialise(classes.select("label", "dim", "cls", "cnt", "x").mapInPandas(
        assign, "label int, dim int, cls long, cnt long, x array<double>, cluster long, primary boolean"))
    shard = ["label", "dim", "cluster"]
    units = placed.groupBy(*shard).agg(F.ceil(F.count("*") / F.lit(unit_rows)).cast("int").alias("units"),
                                       F.ceil(F.count("*") / F.lit(4 * unit_rows)).cast("int").alias("blocks"))
    member = materialise(placed.join(units, shard).withColumn(
        "unit", F.pmod(hash48(F.lit("unit"), "cls"), F.col("units")).cast("int")))
    unit = [*shard, "unit"]

    def graph_of(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls", kind="stable")
        ids, x = pdf["cls"].to_numpy(np.int64), _unit(_matrix(pdf["x"])).astype(np.float32)
        g = build_graph(x)
        return pd.DataFrame({"label": key[0], "dim": key[1], "cls": ids,
                             "near": [ids[r[r >= 0]].tolist() for r in g]})

    lists = member.groupBy(*unit).applyInPandas(graph_of, "label int, dim int, cls long, near array<long>")
    united = lists.groupBy("label", "dim", "cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    indexed = materialise(member.join(united, ["label", "dim", "cls"]))
    discard(placed)
    # a class searches all units of its primary shard; where there are many askers they come in blocks
    asking = indexed.where("primary").select(
        *shard, "cls", "x", F.pmod(hash48(F.lit("block"), "cls"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("unit"))
    holding = indexed.select(*unit, "cls", "cnt", "x", "near",
                             F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def search(width: int):
        def run(key, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            empty = pd.DataFrame({"cls": [], "n_links": [], "root": []}).astype("int64")
            if not len(held) or not len(asked):
                return empty
            held = held.sort_values("cls", kind="stable")
            ids, cnt = held["cls"].to_numpy(np.int64), held["cnt"].to_numpy(np.int64)
            exact = _unit(_matrix(held["x"]))
            at = [np.searchsorted(ids, np.asarray(v, np.int64)) for v in held["near"]]
            inside = [a[(a < len(ids)) & (ids[np.minimum(a, len(ids) - 1)] == np.asarray(v, np.int64))]
                      for a, v in zip(at, held["near"])]
            graph = np.full((len(ids), max(1, max(map(len, inside)))), -1, np.int64)
            for i, v in enumerate(inside):
                graph[i, :len(v)] = v
            out = []
            asked = asked.sort_values("cls", kind="stable")
            for s in range(0, len(asked), 4096):                 # bounds the visited matrix
                part = asked.iloc[s:s + 4096]
                own, q = part["cls"].to_numpy(np.int64), _unit(_matrix(part["x"]))
                a, b = range_search(exact.astype(np.float32), graph, q.astype(np.float32), min_cosine - 1e-4, width)
                sure = np.zeros(len(a), bool)
                for t in range(0, len(a), 200_000):
                    sure[t:t + 200_000] = np.einsum("md,md->m", q[a[t:t + 200_000]], exact[b[t:t + 200_000]]) >= min_cosine
                other = sure & (own[a] != ids[b])
                a, b = a[other], b[other]
                links = np.bincount(a, weights=cnt[b], minlength=len(own)).astype(np.int64)
                nodes = np.unique(np.concatenate([own, ids[b]]))
                root = _roots(nodes, np.searchsorted(nodes, own[a]), np.searchsorted(nodes, ids[b]))
                n = np.zeros(len(nodes), np.int64)
                n[np.searchsorted(nodes, own)] = links
                out.append(pd.DataFrame({"cls": nodes, "n_links": n, "root": nodes[root]}))
            return pd.concat(out) if out else empty
        return (holding.groupBy(*unit, "block").cogroup(asking.groupBy(*unit, "block"))
                .applyInPandas(run, "cls long, n_links long, root long"))

    for attempt in range(4):
        found = materialise(search(beam << attempt))
        counted = found.groupBy("cls").agg(F.sum("n_links").alias("n"))
        recall = _recall(classes, counted, min_cosine, audit_rows)
        if recall >= target_recall or attempt == 3:
            break
        discard(found)
    if recall < least_recall:
        raise RuntimeError(f"the graph search finds {recall:.3f} of the links")
    comp = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = (classes.select("k1", "k2", "cls", "cnt").join(counted, "cls", "left")
             .join(comp.withColumnRenamed("node", "cls"), "cls", "left")
             .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("cnt") - 1).alias("n_links"),
                     F.coalesce("component", "cls").alias("component_id")))
    out = rows.join(named, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _recall(classes: DataFrame, counted: DataFrame, min_cosine: float, audit_rows: int) -> float:
    """Share of the true links of ``audit_rows`` classes (by hash) that the search has found."""
    total = max(1, classes.count())
    order = hash48(F.lit("audit"), "k1", "k2")
    picked = classes.where(order < F.lit(int(min(1.0, audit_rows / total) * 2 ** 48)))
    probes = [(r.label, r.dim, r.cls, np.array(r.x)) for r in picked.select("label", "dim", "cls", "x").collect()]
    if not probes:
        return 1.0
    by: dict = {}
    for label, dim, cls, x in probes:
        by.setdefault((label, dim), []).append((cls, x / np.linalg.norm(x)))
    shared = classes.sparkSession.sparkContext.broadcast(by)     # at most about audit_rows vectors

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, part in b.groupby(["label", "dim"], sort=False):
                own = shared.value.get(key)
                if own:
                    ids = np.array([c for c, _ in own])
                    sim = np.stack([x for _, x in own]) @ _unit(_matrix(part["x"])).T >= min_cosine
                    sim &= ids[:, None] != part["cls"].to_numpy()[None]
                    yield pd.DataFrame({"cls": ids, "true": (sim * part["cnt"].to_numpy()).sum(1)})

    true = (classes.select("label", "dim", "cls", "cnt", "x").mapInPandas(brute, "cls long, true long")
            .groupBy("cls").agg(F.sum("true").alias("true")))
    r = true.join(counted, "cls", "left").agg(
        F.sum("true").alias("t"), F.sum(F.least("true", F.coalesce("n", F.lit(0)))).alias("f")).first()
    return 1.0 if not r.t else float(r.f) / float(r.t)
