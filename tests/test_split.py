"""What the stratified split must and must not move; radix selection."""

import random

import pytest
from pyspark.sql import functions as F

from corpusforge.functions.hashing import hash48_py
from corpusforge.operators import split as sp


def _check_split(got, rows, labels, ratio=0.15, seed=42):
    """Which rows may and must be in test and val, stated per row over the rows before it."""
    order = sorted(rows, key=lambda r: (hash48_py(r["id"], "split", seed), r["id"]))
    positive = {r["id"]: {k for k, v in (r["labels"] or {}).items() if v >= 0.5} for r in rows}
    target = {k: max(1, int(sum(k in p for p in positive.values()) * ratio)) for k in labels}
    cap = int(len(rows) * ratio)
    pool = [r["id"] for r in order]
    for part in ("test", "val"):
        chosen = [i for i in pool if got[i] == part]
        assert len(chosen) <= cap
        for at, i in enumerate(pool):
            before = [j for j in pool[:at] if got[j] == part]
            wanted = any(sum(k in positive[j] for j in before) < target[k] for k in positive[i])
            assert (got[i] == part) == (wanted and len(before) < cap), (part, i)
        pool = [i for i in pool if got[i] != part]
    assert {got[i] for i in pool} <= {"train"}
    assert all(got[r["id"]] == "train" for r in rows if r["labels"] is None)


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_stratified_split_moves_what_is_wanted_and_nothing_else(spark, seed):
    rng = random.Random(seed)
    labels = ["a", "b", "c"]
    rows = []
    for i in range(rng.choice([7, 40, 120])):
        if rng.random() < 0.1:
            rows.append({"id": i, "labels": None})
        else:
            rows.append({"id": i, "labels": {k: rng.choice([0.1, 0.7, 0.9, 0.2]) for k in labels
                                             if rng.random() < 0.8}})
    df = spark.createDataFrame([(r["id"], r["labels"] is not None) for r in rows], "row_id bigint, has boolean")
    probs = spark.createDataFrame([(r["id"], k, float(v)) for r in rows if r["labels"] for k, v in r["labels"].items()],
                                  "row_id bigint, label string, p double")
    got = {r["row_id"]: r["split"] for r in sp.stratified_split(df, probs, labels, has_labels="has").collect()}
    _check_split(got, rows, labels)


def test_random_split_counts_and_order(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "row_id")
    got = {r["row_id"]: r["split"] for r in sp.random_split(df, "row_id").collect()}
    order = sorted(range(101), key=lambda i: (hash48_py(i, "split", 42), i))
    assert [got[i] for i in order] == ["test"] * 15 + ["val"] * 15 + ["train"] * 71


def test_radix_selection_finds_the_kth_key_of_a_large_group(spark):
    df = spark.range(0, 130_000).select(F.col("id").alias("row_id"), F.when(F.col("id") < 120_000, "big").otherwise("small").alias("g"))
    df = df.withColumn("key", sp.shuffle_key(F.col("row_id"), 7))
    k = spark.createDataFrame([("big", 77_777), ("small", 20_000), ("none", 0)], "g string, k bigint")
    got = {r["g"]: (r["key"], r["row_id"]) for r in sp.kth_keys(df, ["g"], k).collect()}
    order = sorted((hash48_py(i, "split", 7), i) for i in range(120_000))
    assert got == {"big": order[77_776], "small": (None, None)}      # 10,000 rows: every row qualifies


def test_wide_keys_and_keys_out_of_range(spark):
    df = spark.range(2 ** 61, 2 ** 61 + 50).select(F.col("id").alias("row_id"), F.col("id").alias("key"))
    assert sorted(r["row_id"] - 2 ** 61 for r in sp.within_first_k(df, [], 3, key_bits=63).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        sp.within_first_k(df, [], 3).collect()
    with pytest.raises(ValueError):
        sp.within_first_k(df.withColumn("key", F.lit(None).cast("bigint")), [], 3).collect()


def test_split_of_text_ids(spark):
    df = spark.createDataFrame([(f"r{i}",) for i in range(4)], "row_id string")
    probs = spark.createDataFrame([(f"r{i}", "a", 0.9) for i in range(4)], "row_id string, label string, p double")
    assert {r["split"] for r in sp.stratified_split(df, probs, ["a"]).collect()} == {"train"}


def test_rates_by_grouping_sets(spark):
    rows = spark.createDataFrame([(i, "train" if i % 4 else "test") for i in range(40)], "id bigint, split string")
    probs = spark.createDataFrame([(i, k, ((i * 7) % 10) / 10) for i in range(40) for k in ("a", "b") if k == "a" or i % 2],
                                  "row_id bigint, label string, p double")
    got = {(r["split"], r["label"]): (r["n_judged"], r["n_positive"]) for r in sp.split_rates(rows, probs, row_id="id").collect()}
    want = {}
    for i in range(40):
        for k in ("a", "b"):
            if k == "a" or i % 2:
                for key in (("train" if i % 4 else "test", k), (None, k), ("train" if i % 4 else "test", None)):
                    n, p = want.get(key, (0, 0))
                    want[key] = (n + 1, p + (((i * 7) % 10) / 10 >= 0.5))
    assert got == want
