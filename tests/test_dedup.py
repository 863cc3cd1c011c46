"""Shingles, MinHash, LSH, keep-first against a sequential statement of the rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import dedup as dd


def test_band_parameters():
    assert dd.lsh_params(0.9, 128) == (5, 25)
    assert dd.lsh_params(0.89, 128) == (6, 21)


def test_word_shingles_short_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "!!!"), (3, "one two three four five six")], "id int, t string")
    got = {r["id"]: sorted(r["s"]) for r in dd.with_shingles(df, F.col("t"), "s", 5).collect()}
    assert got[1] == ["a b c"]
    assert got[2] == [""]
    assert got[3] == ["one two three four five", "two three four five six"]


def _py_shingle_hash(tokens_h, n):
    if len(tokens_h) < n:
        windows = [tokens_h]
    else:
        windows = [tokens_h[i:i + n] for i in range(len(tokens_h) - n + 1)]
    out = []
    for w in windows:
        v = 0
        for t in w:
            v = (v * dd.ROLL_BASE + t) % dd.MERSENNE31
        out.append(v)
    return out


def test_numpy_signature_matches_scalar_definition():
    rng = random.Random(3)
    docs = [[rng.randrange(dd.MERSENNE31) for _ in range(rng.choice([0, 1, 3, 5, 6, 40]))] for _ in range(30)]
    lens = np.array([len(d) for d in docs], dtype=np.int64)
    flat = np.array([t for d in docs for t in d], dtype=np.int64)
    x, starts = dd.shingle_ids(flat, lens, 5)
    a, b = dd.minhash_params(16, 1)
    sig = dd._minhash_block(x, starts, np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    for i, d in enumerate(docs):
        xs = _py_shingle_hash(d, 5)
        want = [min((((ai * v + bi) & ((1 << 64) - 1)) >> 32) for v in xs) for ai, bi in zip(a, b)]
        assert sig[i].tolist() == want


def test_keep_first_chain_is_not_connected_components(spark):
    # A~B (bucket 1), B~C (bucket 2), A and C not similar: keeps A and C
    mem = spark.createDataFrame([(0, 1, 1), (0, 1, 2), (1, 2, 2), (1, 2, 3)], "band int, first bigint, node bigint")
    dropped = sorted(r[0] for r in dd.keep_first_dropped(mem).collect())
    assert dropped == [2]


def _sequential(n, edges):
    adj = {i: set() for i in range(n)}
    for u, v in edges:
        adj[u].add(v)
        adj[v].add(u)
    kept = []
    for i in range(n):
        if not any(j in adj[i] for j in kept):
            kept.append(i)
    return set(range(n)) - set(kept)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keep_first_matches_sequential_rule(spark, seed):
    rng = random.Random(seed)
    n = 40
    # random buckets (cliques) over n nodes
    rows, edges = [], []
    for band in range(4):
        nodes = list(range(n))
        rng.shuffle(nodes)
        i = 0
        while i < n:
            size = rng.choice([1, 1, 2, 3])
            grp = sorted(nodes[i:i + size])
            i += size
            if len(grp) >= 2:
                rows += [(band, grp[0], g) for g in grp]
                edges += [(u, v) for u in grp for v in grp if u < v]
    mem = spark.createDataFrame(rows, "band int, first bigint, node bigint")
    got = {r[0] for r in dd.keep_first_dropped(mem).collect()}
    assert got == _sequential(n, edges)


def test_dedup_keeps_empty_text_and_first_copy(spark):
    base = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(0, base), (1, ""), (2, None), (3, base), (4, "!!!"), (5, "!!!"), (6, "something else entirely different here")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    kept = sorted(r[0] for r in dd.deduplicate(df, "id").collect())
    assert kept == [0, 1, 2, 4, 6]


def test_dedup_partition_invariant(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r[0] for r in dd.deduplicate(docs, "doc_id").select("doc_id").collect()}
    b = {r[0] for r in dd.deduplicate(docs.repartition(7).sortWithinPartitions(F.rand(5)), "doc_id")
         .select("doc_id").collect()}
    assert a == b


def test_hot_copy_group_and_token_free_texts(spark):
    """A third of all rows are copies of one text and several texts have no tokens: every
    copy after the first and every token-free text after the first is dropped."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    first = docs.orderBy("doc_id").first()
    n = docs.count()
    copies = spark.range(n // 2).select((F.col("id") + 10_000).alias("doc_id"), F.lit(first["text"]).alias("text"))
    junk = spark.range(5).select((F.col("id") + 20_000).alias("doc_id"), F.lit("!!! ???").alias("text"))
    allrows = docs.unionByName(copies).unionByName(junk)
    kept = {r[0] for r in dd.deduplicate(allrows, "doc_id").select("doc_id").collect()}
    base = {r[0] for r in dd.deduplicate(docs, "doc_id").select("doc_id").collect()}
    assert kept == base | {20_000}


def test_ids_must_be_unique_and_may_be_text(spark):
    rows = [("x1", "one two three four five six"), ("x2", "one two three four five six"), ("x3", "entirely other words are in here now")]
    df = spark.createDataFrame(rows, "id string, text string")
    assert sorted(r["id"] for r in dd.deduplicate(df, "id").collect()) == ["x1", "x3"]
    for wrong in (rows + [("x1", "another text")], rows + [(None, "z")]):
        with pytest.raises(ValueError):
            dd.deduplicate(spark.createDataFrame(wrong, "id string, text string"), "id")


def _chain(n):
    return [(i % 2, i, j) for i in range(n) for j in (i, i + 1)]


def test_long_chain_needs_few_rounds(spark):
    """A chain of 5,000 near-copies: every second one stays."""
    mem = spark.createDataFrame(_chain(5000), "band int, first bigint, node bigint")
    steps = []
    got = {r[0] for r in dd.keep_first_dropped(mem, trace=steps).collect()}
    assert got == set(range(1, 5001, 2))
    assert len(steps) < 20 and steps.count("components") == 1


def test_components_above_the_size_are_decided_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(dd, "WHOLE_ROWS", 10)
    rows = _chain(12) + [(b, f + 100, n + 100) for b, f, n in _chain(3)]
    steps = []
    got = {r[0] for r in dd.keep_first_dropped(spark.createDataFrame(rows, "band int, first bigint, node bigint"), trace=steps).collect()}
    assert got == {1, 3, 5, 7, 9, 11, 101, 103} and steps.count("round") > 3


def test_group_components(spark):
    from corpusforge.operators.components import group_components
    rng = random.Random(8)
    rows = [(g, n) for g in range(60) for n in rng.sample(range(120), rng.choice([1, 2, 3]))]
    rows += [(1000 + i, 500 + x) for i, x in enumerate(rng.sample(range(200), 200))] + [(1001 + i, 500 + x) for i, x in enumerate(range(200))]
    parent = {n: n for _, n in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    by = {}
    for g, n in rows:
        a, b = find(by.setdefault(g, n)), find(n)
        parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, group_components(spark.createDataFrame(rows, "g int, n int"), ["g"], "n").collect()))
    assert got == {n: find(n) for n in parent}


def _words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def _sets(texts, n=5):
    out = {}
    for i, t in texts:
        w = t.split()
        out[i] = {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))}
    return out


def _verified_brute(spark, df, texts, threshold):
    b, r = dd.lsh_params(threshold, 128)
    mem = dd.lsh_membership(dd.signatures(df, "id", F.col("text")), "id", b, r).collect()
    buckets = {}
    for m in mem:
        buckets.setdefault((m["band"], m["first"]), set()).add(m["node"])
    near = {}
    for group in buckets.values():
        for x in group:
            near.setdefault(x, set()).update(group - {x})
    sets, kept = _sets(texts), []
    for i, _ in sorted(texts):
        similar = [j for j in kept if j in near.get(i, ()) and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold]
        if not similar:
            kept.append(i)
    return kept, sum(len(g) * (len(g) - 1) // 2 for g in buckets.values())


@pytest.mark.parametrize("walk", [True, False])
def test_verified_mode_matches_the_rule(spark, monkeypatch, walk):
    """Groups of versions of one text, edited more and more: buckets hold pairs below the threshold."""
    monkeypatch.setattr(dd, "SHALLOW_ROUNDS", 1 if walk else 100)
    rng = random.Random(11)
    texts, i = [], 0
    for _ in range(12):
        base = _words(rng, 90)
        for v in range(9):
            w = list(base)
            for _ in range(v):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            texts.append((i, " ".join(w)))
            i += 1
    texts += [(i, texts[3][1]), (i + 1, texts[40][1]), (i + 2, "!!!"), (i + 3, "??"), (i + 4, "a b"), (i + 5, "a b")]
    rng.shuffle(texts)
    df = spark.createDataFrame(texts + [(900, None), (901, "")], "id bigint, text string")
    as_words = [(k, t if t[0] not in "!?" else "") for k, t in texts]
    want, pairs = _verified_brute(spark, df, as_words, 0.6)
    got = sorted(r[0] for r in dd.deduplicate(df, "id", threshold=0.6, verify=True).select("id").collect())
    assert got == want + [900, 901]
    loose = {r[0] for r in dd.deduplicate(df, "id", threshold=0.6).select("id").collect()}
    assert loose < set(got), "some bucket members are not similar enough"


def test_verified_hot_bucket_stays_linear(spark, monkeypatch):
    """A third of the rows are near-copies of one text: one comparison a row, none between the copies."""
    rng = random.Random(12)
    base = _words(rng, 200)
    rows = []
    for i in range(150):
        rows.append((i, " ".join(base[:-1] + [f"y{i}"])))
    rows += [(1000 + i, " ".join(_words(rng, 60, 10 ** 6))) for i in range(300)]
    compared = []
    whole = dd._verified

    def counting(pairs, sets, threshold):
        compared.append(pairs.count())
        return whole(pairs, sets, threshold)
    monkeypatch.setattr(dd, "_verified", counting)
    df = spark.createDataFrame(rows, "id bigint, text string")
    kept = {r[0] for r in dd.deduplicate(df, "id", verify=True).select("id").collect()}
    want, pairs = _verified_brute(spark, df, rows, 0.9)
    assert sorted(kept) == want and len(want) < 310
    assert sum(compared) <= 5 * 150 < pairs / 10


def test_char_shingles_are_taken_without_a_lambda_an_element(spark):
    rows = [(0, "ab\U0001F680cdab\U0001F680cd"), (1, "abc"), (2, ""), (3, None), (4, "A \t B　c")]
    df = spark.createDataFrame(rows, "id bigint, t string")
    made = dd.with_shingles(df, F.col("t"), "s", 5, "char")
    got = {r["id"]: r["s"] for r in made.collect()}
    assert got == {0: ["ab\U0001F680cd", "b\U0001F680cda", "\U0001F680cdab", "cdab\U0001F680", "dab\U0001F680c"], 1: ["abc"], 2: [""],
                   3: [None], 4: ["a b c"]}
    from corpusforge.plans.catalog import QUERIES
    for out in (made, QUERIES["shingles_char"](spark, "/root/testdata/sf0.001")):
        assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_signature_batches_stay_in_arrow_and_within_the_budget(spark):
    import pyarrow as pa
    texts = [["a", "b", "c", "d", "e", "f"], None, ["x"], [], ["b"] * 9, ["a", "b", "c", "d", "e", "f"]]
    batch = pa.record_batch([pa.array(range(6), pa.int64()), pa.array(texts, pa.list_(pa.string()))], names=["id", "_tok"])
    a, b = (np.array(p, dtype=np.uint64) for p in dd.minhash_params(4, 1))
    pieces = list(dd._signature_batches(batch, a, b, 5, "word", token_budget=7))
    assert [p.column(0).to_pylist() for p in pieces] == [[0, 2, 3], [4], [5]]     # the text of nine tokens is a piece of its own
    whole = [r for p in dd._signature_batches(batch, a, b, 5, "word") for r in p.to_pylist()]
    assert [r for p in pieces for r in p.to_pylist()] == whole
    for r in whole:
        hashes = dd.hash_tokens(pa.array(texts[r["id"]], pa.string())).tolist()
        want = [min((((int(ai) * v + int(bi)) & ((1 << 64) - 1)) >> 32) for v in _py_shingle_hash(hashes, 5)) for ai, bi in zip(a, b)]
        assert r["sig"] == want
    df = spark.createDataFrame([(1, "a text")], "id bigint, t string")
    assert "MapInArrow" in dd.signatures(df, "id", F.col("t"))._jdf.queryExecution().optimizedPlan().toString()
