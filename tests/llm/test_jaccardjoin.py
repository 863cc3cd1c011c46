import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import jaccardjoin as jj
from corpusforge.llm.shingles import word_hashes, word_shingles
from tests.llm.helpers import components, docs_of


def _set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 40, 200])))) for i in range(n)]
    for i in range(n, 3 * n):                             # chains of edits: near, and near of near
        words = rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            at = rng.randrange(len(words))
            words[at] = word()
        rows.append((i, "\t".join(words).upper() if rng.random() < 0.2 else " ".join(words)))
    return rows + [(-5, None), (-4, ""), (-3, " \n"), (-2, None)]


@pytest.mark.parametrize("k,percent,seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_against_brute_force(spark, k, percent, seed):
    rows = _corpus(seed)
    sets = {i: _set(t, k) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components(list(sets), links)
    got = {r["doc_id"]: r for r in jj.link_components(docs_of(spark, rows), k, percent).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(want) - 20


def test_repeated_and_null_ids(spark):
    t = "one two three four five six"
    got = jj.link_components(docs_of(spark, [(7, t), (7, t), (7, "else where no one"), (None, t), (None, "alone here now")]), 3, 90).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == [
        ("7", 2, "7"), ("7", 4, "7"), ("7", 4, "7"), ("None", 1, "None"), ("None", 4, "7")]
    assert jj.link_components(docs_of(spark, []), 3, 90).count() == 0


def test_prefixes_are_long_enough():
    """Linked sets share min(l) shingles of their chosen prefixes, whatever the sketch says."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        sketch = rng.integers(0, 500, 1 << 10)
        base = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 120), dtype=np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.integers(0, 2 ** 63, rng.integers(0, 6), dtype=np.uint64)]))
        inter = len(np.intersect1d(base, other))
        if not len(other) or 100 * inter < 90 * (len(base) + len(other) - inter):
            continue
        (p, l1), (q, l2) = (jj.choose_prefix(s, sketch, float(sketch.mean()), 90) for s in (base, other))
        assert len(np.intersect1d(p, q)) >= min(l1, l2)


def test_word_hashes():
    assert len(word_hashes(None)) == len(word_hashes(" \n\t")) == 0
    a, b = word_hashes("Ab\x0bÄ ab\x1cx ab"), word_hashes("aB ä")
    assert len(a) == 4 and a[0] == b[0] != a[1] and a[1] != b[1]      # only ASCII space and case count
    assert (word_hashes("x y " * 50_000)[:2] == word_hashes("x y")).all()
    assert len(word_shingles("a b a b a b", 3)) == 2 and len(word_shingles("a b", 3)) == 1


def test_pivot_rounds_leave_few_pairs_of_near_copies(spark, monkeypatch):
    """Groups of near copies whose prefixes a famous text shares: most copies meet a pivot of their own
    group, so the pair round tests fewer pairs than there are copies, not the square of a group."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 7)))
    rows, fame = [], []
    for _ in range(4):
        base = [word() for _ in range(260)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = word()
            rows.append((len(rows), " ".join(words)))
        fame += base
    rows += [(1000 + i, " ".join([*fame, word(), word()])) for i in range(3)]
    seen, verify = [], jj._verify
    monkeypatch.setattr(jj, "_verify", lambda pairs, *a: seen.append(pairs.count()) or verify(pairs, *a))
    got = {r["doc_id"]: r["component_id"] for r in jj.link_components(docs_of(spark, rows), 3, 90).collect()}
    sets = {i: _set(t, 3) for i, t in rows}
    want = components(list(sets), [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])])
    assert got == want and seen[-1] < len(rows), seen


def test_only_named_texts_are_fetched(spark):
    docs = docs_of(spark, [(i, f"text number {i}") for i in range(2000)] + [(None, "of no id"), (5, None)])
    base = docs.select(F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"))
    named = base.where("_d % 100 = 5 or _d is null")
    got = jj._texts_of(docs, named).collect()
    assert {(r["doc_id"], r["text"]) for r in got} >= {(i, f"text number {i}") for i in range(5, 2000, 100)} | {(None, "of no id"), (5, None)}
    assert len(got) < 40
    assert jj._texts_of(docs, named.limit(0)).count() == 0
