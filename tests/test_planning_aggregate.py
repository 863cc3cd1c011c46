"""G1-G13 on a configuration of our own; A1-A9 aggregation rules."""

import json

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import aggregate as ag
from corpusforge.operators import planning as pl
from corpusforge.operators import prompts as pr

# a newsletter planner of our own making
NEWSLETTER = {
    "roles": ["Editor"],
    "industries": {"values": ["Gardening", "Sailing", "Chess"]},
    "styles": {"digest": {"weight": 3, "length_bucket": "page", "emoji_count": 1},
               "interview": {"style_id": "q-and-a", "cta_present": True}},
    "length_buckets": {"page": {"min_chars": 40, "max_chars": 900}, "note": {"min_chars": 5}},
    "hashtags": {"default": {"values": ["#Boats", ["##Winter", " ", "tea\n\u00e9"]]}},
    "response_schema_version": "news-3",
}


def test_plan_draws_only_from_the_configuration(spark):
    rows = pl.plan(spark.range(60), pl.read_config(NEWSLETTER)).collect()
    assert {r["style_id"] for r in rows} == {"digest", "q-and-a"}
    assert {r["length_bucket"] for r in rows if r["style_id"] == "digest"} == {"page"}
    assert {r["industry"] for r in rows} == {"Gardening", "Sailing", "Chess"} and {r["role"] for r in rows} == {"Editor"}
    assert {tuple(r["hashtags"]) for r in rows} == {("boats",), ("winter", "tea\n\u00e9")}
    assert {r["response_schema_version"] for r in rows} == {"news-3"}
    assert rows[7]["prompt_id"] == f"prompt-{rows[7]['style_id']}-000007"
    assert all(1 <= r["seed"] <= 2 ** 31 - 1 for r in rows)


def test_plan_can_be_held_to_one_style(spark):
    assert {r["style_id"] for r in pl.plan(spark.range(9), pl.read_config(NEWSLETTER, style_id="q-and-a")).collect()} == {"q-and-a"}
    with pytest.raises(ValueError):
        pl.read_config(NEWSLETTER, style_id="sonnet")


@pytest.mark.parametrize("wrong", [{"styles": {"a": 3}}, {"length_buckets": {"a": "x"}}, {"hashtags": {"default": [7]}}])
def test_malformed_configuration_raises_at_plan_time(wrong):
    with pytest.raises(ValueError):
        pl.read_config(wrong)


def test_prompt_values_are_prompt_ready(spark):
    rows = pr.prompt_values(pl.plan(spark.range(40), pl.read_config(NEWSLETTER))).collect()
    assert {r["cta_present"] for r in rows} == {"true", "false"}
    assert all(isinstance(r["emoji_count"], int) for r in rows)
    assert {r["hashtags"] for r in rows} == {json.dumps(["boats"]), json.dumps(["winter", "tea\n\u00e9"])}


def test_length_ok(spark):
    cfg = pl.read_config(NEWSLETTER)
    df = spark.createDataFrame([("page", "x" * 40), ("page", "x" * 39), ("note", "x" * 5), ("else", "x")], "b string, t string")
    assert [r[0] for r in df.select(pl.length_ok(cfg, F.col("b"), F.col("t"))).collect()] == [True, False, True, None]


def test_mix_real_returns_exactly_n(spark):
    planned = spark.range(2 ** 50, 2 ** 50 + 1000)
    real = spark.range(2 ** 52, 2 ** 52 + 30)
    got = pl.mix_real(planned, real, 1000, 0.1).collect()             # a share of 100, but 30 real rows
    assert len(got) == 1000 and sum(r["source"] == "real" for r in got) == 30
    assert sorted(r["id"] - 2 ** 50 for r in got if r["source"] == "synthetic") == list(range(970))
    with pytest.raises(ValueError):
        pl.mix_real(planned, real, 1031, 0.1)


def test_render_literal_braces_and_unknown_placeholder(spark):
    df = spark.createDataFrame([("x",)], "role string")
    assert df.select(pr.render('As {role}: {"k": 1}', df.columns)).first()[0] == 'As x: {"k": 1}'
    try:
        pr.render("{nope}", df.columns)
    except KeyError:
        pass
    else:
        raise AssertionError("unknown placeholder must fail at plan time")


def test_coverage_uses_every_style_per_epoch(spark):
    cfg = dict(NEWSLETTER, styles={f"s{i}": {"weight": 0.001 if i else 100.0} for i in range(4)},
               sampling={"ensure_label_coverage": True})
    rows = pl.plan(spark.range(12), pl.read_config(cfg)).orderBy("id").collect()
    for e in range(3):
        assert sorted(r["style_id"] for r in rows[4 * e:4 * e + 4]) == ["s0", "s1", "s2", "s3"]


def test_aggregation_rules(spark):
    s = spark.createDataFrame([
        (1, 0, 0.2, True, "a", ["x", "y"]), (1, 1, 0.4, False, "", ["y", "z"]), (1, 2, None, True, "", ["w", "x"]),
        (2, 0, 0.5, True, "", ["p"]), (2, 1, 1.5, False, "", []),
    ], "r int, s int, v double, b boolean, t string, arr array<string>")
    mean = {r[0]: r[1] for r in ag.aggregate_numeric(s, ["r"], "v", minimum=0, maximum=1).collect()}
    assert mean == {1: 0.30000000000000004, 2: 1.0}
    med = {r[0]: r[1] for r in ag.aggregate_numeric(s, ["r"], "v", how="median").collect()}
    assert med == {1: 0.30000000000000004, 2: 1.0}
    integer = {r[0]: r[1] for r in ag.aggregate_numeric(s, ["r"], "v", integer=True).collect()}
    assert integer == {1: 0, 2: 1}                                 # 1.0 -> 1, 0.3 -> 0
    maj = {r[0]: r[1] for r in ag.aggregate_bool_majority(s, ["r"], "b").collect()}
    assert maj == {1: True, 2: True}                               # 1 of 2 -> tie -> true
    last = {r[0]: r[1] for r in ag.aggregate_last_nonempty(s, ["r"], "t", "s").collect()}
    assert last == {1: "a", 2: ""}
    union = {r[0]: r[1] for r in ag.aggregate_array_union(s, ["r"], "arr", "s", max_items=3).collect()}
    assert union == {1: ["x", "y", "z"], 2: ["p"]}
    empty = spark.createDataFrame([(1, 0, []), (1, 1, []), (2, 0, None)], "r int, s int, arr array<string>")
    assert [tuple(r) for r in ag.aggregate_array_union(empty, ["r"], "arr", "s").collect()] == [(1, [])]


def test_ensemble_rules(spark):
    v = spark.createDataFrame([(1, 0, "k", 0.6), (1, 1, "k", 0.4), (1, 2, "k", 0.7), (2, 0, "k", 0.5), (2, 1, "k", 0.4)],
                              "r int, j int, key string, v double")
    vote = {r[0]: r[2] for r in ag.ensemble_vote(v, ["r"], "key", "j", "v").collect()}
    assert vote == {1: 1.0, 2: 0.0}                                # 1 of 2 is not a strict majority
    late = v.union(spark.createDataFrame([(1, 1, "other", 0.9)], v.schema))   # a key the first judge lacks
    assert {r["key"] for r in ag.ensemble_vote(late, ["r"], "key", "j", "v").collect()} == {"k"}
    pick = {r[0]: r[2] for r in ag.ensemble_median(v, ["r"], "key", "j", "v", nested="pick").collect()}
    assert pick == {1: 0.4, 2: 0.4}                                # judge at index n // 2
    modes = spark.createDataFrame([(1, 0, "k", "b"), (1, 1, "k", "a"), (1, 2, "k", "a"), (2, 0, "k", "x"), (2, 1, "k", "y"),
                                   (2, 1, "z", "y")], "r int, j int, key string, v string")
    assert {(r[0], r[1]): r[2] for r in ag.ensemble_mode(modes, ["r"], "key", "j", "v").collect()} == {(1, "k"): "a", (2, "k"): "x"}
    assert {r[0]: r[1] for r in ag.ensemble_first(modes.filter("key = 'k'"), ["r"], "j", "v").collect()} == {1: "b", 2: "x"}
