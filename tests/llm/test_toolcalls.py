import json

from corpusforge.llm import toolcalls as tc

SCHEMAS = {"add": {"type": "object", "required": ["x"], "additionalProperties": False,
                   "properties": {"x": {"type": "integer"}, "y": {"type": "integer"}}}}
CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"


def _run(spark, calls, results):
    out = tc.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    return {(r["kind"], r["conv_id"], r["call_id"]): r for r in out}, out


def test_links_levels_and_json(spark):
    calls = [(1, "a", 0, "add", '{"y": 2, "x": 1}', []), (1, "b", 2, "add", '{"x": 1.5}', ["a", "unknown"]),
             (1, "c", 4, "add", '{"x": 1, "z": 0}', ["a", "b"]), (1, "d", 6, "other", "{}", ["c", "a"]),
             (2, "a", 0, "add", "not json", None)]
    results = [(1, "a", 1, "3"), (1, "a", 3, "later"), (1, "zz", 5, "orphan"), (2, "a", 1, "é\n\"q\"")]
    got, rows = _run(spark, calls, results)
    assert len(rows) == 6
    assert [got["call", 1, c]["seq"] for c in "abcd"] == [0, 1, 2, 3]
    assert [got["call", 1, c]["valid"] for c in "abcd"] == [True, False, False, False]
    assert got["call", 1, "a"]["n_results"] == 2
    assert got["call", 1, "a"]["json"] == ('{"arguments":{"x":1,"y":2},"call_id":"a","name":"add",'
                                           '"result":{"content":"3","turn":1},"seq":0,"turn":0,"valid":true}')
    assert "result" not in json.loads(got["call", 1, "b"]["json"])
    assert json.loads(got["call", 2, "a"]["json"])["result"]["content"] == "é\n\"q\""
    assert "arguments" not in json.loads(got["call", 2, "a"]["json"]) and not got["call", 2, "a"]["valid"]
    assert json.loads(got["orphan_result", 1, "zz"]["json"]) == {"call_id": "zz", "content": "orphan", "turn": 5}


def test_cycles_duplicates_and_nulls(spark):
    calls = [(1, "a", 0, "add", '{"x":1}', ["b"]), (1, "b", 1, "add", '{"x":1}', ["a"]), (1, "c", 2, "add", '{"x":1}', ["a"]),
             (1, "self", 3, "add", '{"x":1}', ["self"]), (1, "free", 4, "add", '{"x":1}', []),
             (1, "free", 9, "add", '{"x":2}', []), (1, "free", 9, "add", '{"x":2}', []),
             (None, "a", 0, "add", '{"x":1}', []), (1, None, 0, None, None, None)]
    got, rows = _run(spark, calls, [(None, "a", 1, "x"), (1, None, 1, None)])
    # the free call comes first, those on and behind cycles follow by turn
    assert [got["call", 1, c]["seq"] for c in ("free", "a", "b", "c", "self")] == [0, 1, 2, 3, 4]
    assert got["call", 1, "free"]["turn"] == 4 and got["duplicate_call", 1, "free"]["n_results"] == 2
    assert sum(r["kind"] == "orphan_result" for r in rows) == 2
    assert got["call", None, "a"]["n_results"] == 0 and got["call", 1, None]["valid"] is False


def test_order_against_the_turns_and_long_chains(spark):
    chain = [(1, f"c{i:03}", 200 - i, "add", '{"x":1}', [f"c{i - 1:03}"] if i else []) for i in range(12)]
    straight = [(2, f"s{i:05}", i, "add", '{"x":1}', [f"s{i - 1:05}", "s00000"] if i else []) for i in range(3000)]
    got, _ = _run(spark, chain + straight, [])
    assert [got["call", 1, f"c{i:03}"]["seq"] for i in range(12)] == list(range(12))
    assert [got["call", 2, f"s{i:05}"]["seq"] for i in range(3000)] == list(range(3000))


def test_empty_tables(spark):
    assert _run(spark, [], [])[1] == []
    assert [r["kind"] for r in _run(spark, [], [(1, "a", 0, "x")])[1]] == ["orphan_result"]


def test_chat_calls(spark):
    chat = spark.createDataFrame([(1, 0, "user", "hi there"), (1, 1, "assistant", "hello"), (1, 2, "user", None),
                                  (1, 3, "system", "s"), (2, 0, "assistant", "lost"), (None, 0, "user", "x")],
                                 "conv_id bigint, turn bigint, role string, text string")
    calls, results = tc.chat_calls(chat)
    got = {(r["conv_id"], r["call_id"]): r for r in calls.collect()}
    assert got[1, "1-0"]["name"] == "lookup" and json.loads(got[1, "1-0"]["arguments"]) == {"words": 2, "turn": 0, "text": "hi there"}
    assert got[1, "1-2"]["depends_on"] == ["1-0", "1-0"] and got[None, None]["turn"] == 0
    assert {(r["conv_id"], r["call_id"]) for r in results.collect()} == {(1, "1-0"), (2, "2--1")}
