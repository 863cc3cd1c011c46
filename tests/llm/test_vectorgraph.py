import math

import numpy as np
import pytest

from corpusforge.llm import vectorgraph as vg
from tests.llm.helpers import components


def _table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def _check(rows, got, min_cosine=0.98):
    ids = [r[0] for r in rows]
    fine = [r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x) for x in r[1])
            and any(x != 0 for x in r[1]) for r in rows]
    x = [np.array([np.float32(v) for v in r[1]], float) if ok else None for r, ok in zip(rows, fine)]
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if fine[i] and fine[j] and rows[i][2] == rows[j][2]
             and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= min_cosine]
    comp = components(ids, [(ids[i], ids[j]) for i, j in links])
    n = {i: 0 for i in ids}
    for i, j in links:
        n[ids[i]] += 1
        n[ids[j]] += 1
    assert {r["vec_id"]: r["n_links"] for r in got} == n
    assert {r["vec_id"]: r["component_id"] for r in got} == comp
    assert {r["vec_id"]: r["kept"] for r in got} == {i: i == comp[i] for i in ids}


@pytest.mark.parametrize("unit_rows,cluster_rows", [(4096, 2048), (60, 40)])
def test_against_brute_force(spark, unit_rows, cluster_rows):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(260):
        rows.append((i, rng.normal(size=24).tolist(), int(rng.integers(0, 2))))
    for i in range(260, 420):                                # near copies of few, exact copies, other label
        src = rows[int(rng.integers(0, 6))]
        v = np.array(src[1]) + rng.normal(size=24) * rng.choice([0, 0.05, 0.12])
        rows.append((i, v.tolist(), src[2] if i % 5 else 1 - src[2]))
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 24, 0), (903, [math.nan] * 24, 0), (904, [None] * 24, 1),
             (905, rows[0][1], None), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0)]
    got = vg.near_duplicates(_table(spark, rows), unit_rows=unit_rows, cluster_rows=cluster_rows, least_recall=0.99).collect()
    _check(rows, got)


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=32)
    rows = [(i, (base + rng.normal(size=32) * 0.02).tolist(), 1) for i in range(500)]
    rows += [(500 + i, rng.normal(size=32).tolist(), 1) for i in range(100)]
    _check(rows, vg.near_duplicates(_table(spark, rows), unit_rows=150, cluster_rows=200).collect())


def test_null_ids_repeats_and_empty(spark):
    got = vg.near_duplicates(_table(spark, [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (5, [0.0, 1.0], 1)])).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == [
        ("3", 1, "3", True), ("3", 1, "3", True), ("5", 0, "5", True), ("None", 0, "None", False)]
    assert vg.near_duplicates(_table(spark, [])).count() == 0


def test_robust_prune_drops_what_a_kept_neighbour_covers():
    x = np.array([[1.0, 0.0], [0.9, 0.43], [0.88, 0.47], [0.0, 1.0]])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    kept = vg.robust_prune(x, np.array([0]), np.array([[1, 2, 3]]), 3)
    assert 1 in kept[0] and 2 not in kept[0]
