"""Mixing sources to target weights: min-cost flow over membership patterns (operator 7).

1. Documents are aggregated by membership pattern (the set of sources a document belongs
   to); only one row per pattern reaches the driver, and their number is bounded by
   ``max_patterns`` (more raise an error, nothing is dropped).
2. A small flow network routes word capacity to source quotas: pattern -> its sources ->
   sink, where the r-th repetition of a pattern's words costs r-1 more than the first (a
   convex cost), so the flow repeats nothing while unused words are left.
3. Per pattern the flow is ``full`` whole copies of every document plus a remainder, which
   is filled with whole documents in seeded order.  The cut of that order is found by exact
   radix selection over the 48-bit key (at most 4096 sums a pattern and digit), so a source
   holding a third of all rows is never sorted in one task.

Defined cases: null text has size 0; a null source is a source of its own (last in order);
rows that agree in id and text share one key and are taken together; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.hashing import hash48
from corpusforge.llm.common import WORD_PATTERN, materialise

DIGIT_BITS, KEY_BITS = 12, 48
_BASE = 1 << DIGIT_BITS


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: dict, weights=(3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> dict:
    """Quota per source: ``share`` of all words dealt by the repeating ``weights`` (sources by
    code point, null last); a quota stops at ``cap`` times its source's size and the excess is
    dealt again by weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > cap * sizes[s]]
        if not over:
            out.update({s: rest * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = cap * sizes[s]
        rest -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(n_nodes: int, arcs: list[tuple[int, int, int, int]], s: int, t: int) -> list[int]:
    """Flow per arc ``(from, to, capacity, cost)`` of a maximum flow of least cost (successive
    shortest paths with potentials; integer capacities, costs >= 0)."""
    graph: list[list[int]] = [[] for _ in range(n_nodes)]
    to, cap, cost = [], [], []
    for a, b, c, w in arcs:
        graph[a].append(len(to)), to.append(b), cap.append(c), cost.append(w)
        graph[b].append(len(to)), to.append(a), cap.append(0), cost.append(-w)
    potential = [0] * n_nodes
    while True:
        dist, via, queue = {s: 0}, {}, [(0, s)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > dist[x]:
                continue
            for e in graph[x]:
                nd = d + cost[e] + potential[x] - potential[to[e]]
                if cap[e] > 0 and nd < dist.get(to[e], nd + 1):
                    dist[to[e]], via[to[e]] = nd, e
                    heapq.heappush(queue, (nd, to[e]))
        if t not in dist:
            break
        far = max(dist.values())
        potential = [p + dist.get(i, far) for i, p in enumerate(potential)]
        path, x = [], t
        while x != s:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push
    return [cap[2 * i + 1] for i in range(len(arcs))]


def route(patterns: dict[tuple, int], targets: dict, max_copies: int = 2) -> dict[tuple, dict]:
    """Words each pattern gives to each of its sources: ``{pattern: {source: words}}``."""
    pats, srcs = list(patterns), list(targets)
    p_at = {p: 1 + i for i, p in enumerate(pats)}
    s_at = {s: 1 + len(pats) + i for i, s in enumerate(srcs)}
    sink = 1 + len(pats) + len(srcs)
    arcs, member = [], []
    for p, words in patterns.items():
        arcs += [(0, p_at[p], words, r) for r in range(max_copies)]
    for p in pats:
        for src in p:
            member.append((len(arcs), p, src))
            arcs.append((p_at[p], s_at[src], max_copies * patterns[p], 0))
    arcs += [(s_at[s], sink, int(round(t)), 0) for s, t in targets.items()]
    flow = min_cost_flow(sink + 1, arcs, 0, sink)
    out: dict[tuple, dict] = {p: {} for p in pats}
    for i, p, src in member:
        out[p][src] = flow[i]
    return out


def _prefix_cut(items: DataFrame, budget: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """For every pattern the largest key bound such that the words of items with ``key`` below it
    sum to at most the budget, and the words left over.  ``items(pid, key, size)``."""
    spark = items.sparkSession
    left = dict(budget)
    prefix = {p: 0 for p in budget}
    done: dict[int, int] = {}
    for level in range(KEY_BITS // DIGIT_BITS):
        live = [(p, prefix[p], left[p]) for p in budget if p not in done]
        if not live:
            break
        below = KEY_BITS - DIGIT_BITS * (level + 1)
        state = spark.createDataFrame(live, "pid int, prefix long, room long")
        digit = F.shiftright("key", below).bitwiseAND(F.lit(_BASE - 1))
        hist = (items.join(F.broadcast(state), "pid")           # one row a pattern: bounded
                .where(F.shiftright("key", below + DIGIT_BITS) == F.col("prefix"))
                .groupBy("pid", "room", digit.alias("digit")).agg(F.sum("size").alias("w"), F.min("key").alias("a"),
                                                                  F.max("key").alias("b")))
        # at most 4096 digits a pattern: their running sum is bounded whatever the data
        cum = hist.withColumn("cum", F.expr("sum(w) over (partition by pid order by digit)"))
        rows = {r.pid: r for r in cum.groupBy("pid").agg(
            F.min(F.when(F.col("cum") > F.col("room"), F.struct("digit", "cum", "w", "a", "b"))).alias("at"),
            F.max("cum").alias("w")).collect()}
        for p, _, room in live:
            at = rows[p]["at"] if p in rows else None
            if at is not None:
                left[p] = room - (at.cum - at.w)
                prefix[p] = prefix[p] * _BASE + at.digit
                if at.a == at.b:                               # one key: the cut lies before it
                    done[p] = at.a
            else:                                              # everything below fits
                left[p] = room - (rows[p].w if p in rows else 0)
                done[p] = (prefix[p] + 1) << (below + DIGIT_BITS)
    return {p: done.get(p, prefix[p]) for p in budget}, left


def mix(docs: DataFrame, key: Column, size: Column, sources: Column, targets=source_targets,
        seed: int = 7, max_copies: int = 2, refills: int = 4, max_patterns: int = 100_000) -> DataFrame:
    """``docs`` plus ``size, sources, source_size, target, copies, taken``.

    ``sources`` is an array column (the membership pattern); ``targets(sizes)`` maps
    ``{source: words}`` to quotas.  ``key`` identifies a document for the seeded order.
    ``refills`` further passes fill what the first document beyond the cut leaves open: the first
    half of them with documents of at most a quarter of the gap, the rest with any that fit.  ``source_size`` and ``target`` are those of the
    pattern's first source.
    """
    spark = docs.sparkSession
    own = ("size", "source_size", "target", "copies", "taken")
    names = [c for c in docs.columns if c not in own]           # a clashing input column gives way
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), size.alias("size"),
                       F.to_json(F.array_sort(F.array_distinct(sources))).alias("pattern"),
                       hash48(F.lit(seed), key).alias("key"))
    narrow = materialise(work.groupBy("pattern", "key", "size")
                         .agg((F.col("size") * F.count("*")).alias("words")))   # equal rows go together
    rows = narrow.groupBy("pattern").agg(F.sum("words").alias("words")).limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    rows = sorted(rows, key=lambda r: r.pattern)
    members = [tuple(json.loads(r.pattern)) for r in rows]
    words = [int(r.words) for r in rows]
    sizes: dict = {}
    for m, w in zip(members, words):
        for s in m:
            sizes[s] = sizes.get(s, 0) + w
    quota = targets(sizes)
    flow = route(dict(zip(members, words)), quota, max_copies)
    taken = [sum(flow[m].values()) for m in members]
    full = [t // w if w else 0 for t, w in zip(taken, words)]
    gap = {i: taken[i] - full[i] * words[i] for i in range(len(rows))}

    def plan(cuts: list[dict]) -> DataFrame:
        """One row a pattern: its number, copies, source figures and the cuts found so far."""
        out = [(r.pattern, i, full[i], sizes[members[i][0]] if members[i] else 0,
                float(quota[members[i][0]]) if members[i] else 0.0, *[x for c in cuts for x in c[i]])
               for i, r in enumerate(rows)]
        return F.broadcast(spark.createDataFrame(
            out, "pattern string, pid int, full long, source_size long, target double"
            + "".join(f", m{k} long, k{k} long" for k in range(len(cuts)))))

    def chosen(n: int) -> Column:
        out = F.lit(False)
        for k in range(n):
            out = out | ((F.col("size") <= F.col(f"m{k}")) & (F.col("key") < F.col(f"k{k}")))
        return out

    cuts: list[dict] = []
    limit = {i: 1 << 62 for i in gap}
    for step in range(refills + 1):
        bound = F.broadcast(spark.createDataFrame(list(limit.items()), "pid int, limit long"))
        pool = (narrow.join(plan(cuts), "pattern").join(bound, "pid")
                .where((F.col("size") <= F.col("limit")) & ~chosen(len(cuts))))
        if not any(gap.values()):
            break
        cut, gap = _prefix_cut(pool.select("pid", "key", F.col("words").alias("size")), gap)
        cuts.append({i: (limit[i], cut[i]) for i in gap})
        limit = {i: gap[i] // 4 if step < refills // 2 else gap[i] for i in gap}
    copies = F.col("full") + chosen(len(cuts)).cast("long")
    return (work.join(plan(cuts), "pattern")
            .select("doc.*", "size", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("size") * F.col("copies")))
