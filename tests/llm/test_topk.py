import math
import random

import numpy as np
import pytest

from corpusforge.llm import topk as tk


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("shard_rows,block_rows", [(1000, 100), (37, 5)])
def test_against_brute_force(spark, shard_rows, block_rows):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], 0) for i in range(300)]
    rows += [(300 + i, list(rows[i][1]), 1) for i in range(40)]                   # ties
    rows += [(900, None, 0), (901, [], 0), (902, [math.nan] * 16, 0), (903, [None] + [0.0] * 15, 0), (904, [math.inf] * 16, 0),
             (None, [0.1] * 16, 0), (920, [0.5, 0.5], 0), (940, [0.5, -0.5], 0)]
    vectors = tk.quantise(_table(spark, rows))
    got = sorted(tuple(r) for r in tk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 7, shard_rows, block_rows).collect())
    usable = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v, _ in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in usable:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), c) for c, v in usable.items() if c != q and len(v) == len(usable[q]))
            want += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:7], 1)]
    assert got == sorted(want)


def test_few_candidates_repeated_ids_and_empty(spark):
    v = tk.quantise(_table(spark, [(0, [1.0, 0.0], 1), (0, [0.5, 0.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1)]))
    got = [tuple(r) for r in tk.top_k(v, v.where("vec_id = 0"), 5).collect()]
    assert sorted(got) == [(0, 1, 1, 32 * 64), (0, 2, 1, 32 * 64)]                # never itself; asked with its least vector
    assert tk.top_k(v.limit(0), v.limit(0), 5).count() == 0
    assert tk.top_k(v, v.limit(0), 5).count() == 0


def test_large_values_stay_exact():
    rng = np.random.default_rng(2)
    c = rng.integers(-2 ** 28, 2 ** 28, (200, 8)).astype(np.int32)
    q, cand, s = tk.search_shard(np.array([3]), c[3:4], np.arange(200), c, 5)
    exact = sorted((-int((c[3].astype(object) * c[j].astype(object)).sum()), j) for j in range(200) if j != 3)[:5]
    assert [(-int(a), int(b)) for a, b in zip(s, cand)] == exact


@pytest.mark.parametrize("large", [1e9, 3e17, 3.4028234663852886e38])
def test_finite_components_of_any_size(spark, large):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.choice([large, -large, 1.5, -0.25, 0.0, large / 3]))) for _ in range(4)], 0) for i in range(60)]
    vectors = tk.quantise(_table(spark, rows))
    got = sorted(tuple(r) for r in tk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 7, 16, 2).collect())
    far = 2 ** 62
    usable = {i: [max(-far, min(far, math.floor(64 * x))) for x in v] for i, v, _ in rows}
    want = []
    for q in (0, 20, 40):
        score = {c: max(-tk._MOST, min(tk._MOST, sum(a * b for a, b in zip(usable[q], v)))) for c, v in usable.items() if c != q}
        want += [(q, rank, c, score[c]) for rank, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:7], 1)]
    assert got == sorted(want)


@pytest.mark.parametrize("shape", ["even", "skewed", "ties"])
def test_blocks_of_queries_against_brute_force(shape):
    # skewed: most terms cannot lift a candidate, so they are probed; ties: more than k candidates reach the k-th score
    rng = np.random.default_rng(5)
    scale = 100 * 0.5 ** np.arange(24) + 1 if shape == "skewed" else 30
    c = np.rint(rng.normal(0, 1, (2400, 24)) * scale).astype(np.int64)
    if shape == "ties":
        c = c[rng.integers(0, 3, len(c))]
    ids, qid = rng.permutation(len(c)), rng.permutation(len(c))[:40]
    q = c[np.argsort(ids)[qid]]                                                  # the queries are candidates
    want = [(i, int(ids[j]), int(s[j])) for i, s in zip(qid, q @ c.T)
            for j in [x for x in np.lexsort((ids, -s)) if ids[x] != i][:7]]
    assert [tuple(map(int, x)) for x in zip(*tk.search_shard(qid, q, ids, c, 7))] == want
    held, floor = [np.empty(0, np.int64)] * 3, np.full(len(qid), tk._NONE)
    for at in range(0, len(c), 600):                                             # thresholds go from shard to shard
        new = tk._search(qid, q, tk.Shard(ids[at:at + 600], c[at:at + 600]), floor, 7)
        *held, rank = tk.best(*(np.concatenate(x) for x in zip(held, new)), 7)
        floor[held[0][rank == 6]] = held[2][rank == 6]
    assert [(int(qid[i]), int(v), int(s)) for i, v, s in zip(*held)] == want


def test_scores_below_the_range_of_a_long_tie():
    far = np.array([[-2 ** 62, -2 ** 62], [-2 ** 61, 0], [-2 ** 62, 0]])       # the first has the least product
    _, found, score = tk.search_shard(np.array([9]), np.array([[2 ** 62, 2 ** 62]]), np.arange(3), far, 2)
    assert found.tolist() == [0, 1] and score.tolist() == [-tk._MOST] * 2


def test_blocks_are_neither_broadcast_nor_multiplied(spark):
    # the planner takes a packed block for a row of some bytes: it sent all blocks times all shards through the driver
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)], 0) for i in range(2000)]
    vectors = tk.quantise(_table(spark, rows))
    out = tk.top_k(vectors, vectors.where("vec_id % 4 = 0"), 3, 50, 10)           # 40 shards, 50 blocks
    assert out.count() == 500 * 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan


@pytest.mark.parametrize("n,m", [(51_282, 2_564), (615_384, 30_770), (15_000_000, 750_000), (10 ** 9, 5 * 10 ** 7)])
def test_tasks_are_few_and_rows_of_a_query_bounded(n, m):
    shards, blocks = -(-n // 16_384), -(-m // 512)
    left, right = tk._parts(shards, blocks, n * m, 64 * m)
    assert left <= min(shards, tk.SHARD_PARTS) and right <= blocks and 24 <= left * right <= tk.TASKS + 64 * m * left / tk.CELLS
    assert 64 * m / right <= tk.CELLS
