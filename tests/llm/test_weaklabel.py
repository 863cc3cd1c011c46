import random

import numpy as np
from pyspark.sql import functions as F

from corpusforge.llm import weaklabel as wl
from tests.llm.helpers import docs_of


def test_em_recovers_accuracies():
    rng = random.Random(3)
    right, speak, n = [0.95, 0.9, 0.8, 0.85, 0.7], [0.9, 0.6, 0.8, 0.5, 0.9], 20_000
    counts, truth = {}, {}
    for _ in range(n):
        good = rng.random() < 0.7
        v = tuple((int(good) if rng.random() < a else int(not good)) if rng.random() < s else -1 for a, s in zip(right, speak))
        counts[v] = counts.get(v, 0) + 1
        truth.setdefault(v, []).append(good)
    prior, acc, post = wl.fit_label_model(counts)
    assert abs(prior - 0.7) < 0.03 and np.abs(acc - right).max() < 0.04
    hits = sum(g == (post[v] >= 0.5) for v, gs in truth.items() for g in gs)
    assert hits / n > 0.93
    assert wl.fit_label_model({})[2] == {} and wl.fit_label_model({(-1,) * 5: 9})[2].keys() == {(-1,) * 5}


def test_held_out_accuracy_on_labels(spark):
    """The gold labels are used here only."""
    sf = "/root/testdata/sf0.01"
    out = wl.classify(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).select("doc_id", "kept")
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    r = {(x["quality"], x["kept"]): x["n"] for x in out.join(lab, "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    good, bad = r.get((1, True), 0) + r.get((1, False), 0), r.get((0, True), 0) + r.get((0, False), 0)
    assert r[1, True] / good > 0.99 and r[0, False] / bad > 0.95


def test_nulls_clashes_repeats_and_empty(spark):
    rows = [(1, "A perfectly plain sentence, followed by another one. " * 4, "x"), (1, "A perfectly plain sentence, followed by another one. " * 4, "x"),
            (2, None, "x"), (3, "", "x"), (None, "THE!! BAD!! TEXT!! OF!! SHOUTS!! " * 20, "x"), (5, "w*** x$$$ y%%% " * 30, "x")]
    out = wl.classify(docs_of(spark, rows, ", kept string"))
    assert out.columns == ["doc_id", "text", "quality", "kept"]
    got = [(str(r["doc_id"]), r["kept"]) for r in out.collect()]
    assert len(got) == 6 and ("2", False) in got and ("3", False) in got and got.count(("1", True)) == 2
    assert wl.classify(docs_of(spark, [])).count() == 0


def test_votes_and_features_of_odd_texts():
    for t in ("", " ", "!", "\x00", "é" * 10, "word " * 50_000, "日本語のテキスト"):
        assert len(wl.votes(t)) == len(wl.LABELLERS) and set(wl.votes(t)) <= {-1, 0, 1}
        x = wl.features(t)
        assert x.shape == (1 << wl.FEATURE_BITS,) and np.isfinite(x).all()


def test_long_repetition_differs_from_its_passage():
    """A passage repeated 50 times gets other votes and features; a text of 50 passages doesn't."""
    rng = random.Random(8)
    passage = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)) + ". "
    one = passage()
    again, many = one * 50, "".join(passage() for _ in range(50))
    at = wl.LABELLERS.index("again")
    assert wl.votes(one)[at] == wl.votes(many)[at] == -1 and wl.votes(again)[at] == 0
    assert abs(wl.features(again) - wl.features(one)).max() > 0.5 > 0.1 > abs(wl.features(many) - wl.features(one)).max()
    assert wl.seen_before(one.split()) == 0 and abs(wl.seen_before(again.split()) - 0.98) < 0.005
    few = ("one two three four " * 500).split()
    assert abs(wl.block_variety(few, 200) - 0.02) < 1e-9 and wl.block_variety([], 200) == 0
