"""V1-V4 keyword semantics; R1 extraction; R2/R3 choices."""

import pytest
from pyspark.sql import functions as F

from corpusforge.functions.schema import check_schema, compile_schema
from corpusforge.operators import responses as rs

SCHEMA = {"type": "object", "additionalProperties": False, "required": ["text", "n"],
          "properties": {"text": {"type": "string", "minLength": 2, "maxLength": 4},
                         "n": {"type": "integer", "minimum": 0, "maximum": 5},
                         "opt": {"type": "string"}, "tags": {"type": "array", "maxItems": 2, "items": {"type": "string"}}}}


@pytest.mark.parametrize("raw,ok", [
    ('{"text": "ab", "n": 1}', True),
    ('{"text": "abcd", "n": 5.0}', True),            # 5.0 is an integer
    ('{"text": "abcd", "n": true}', False),          # true is not
    ('{"text": "a", "n": 1}', False),                # minLength
    ('{"text": "abcde", "n": 1}', False),            # maxLength
    ('{"text": "ab"}', False),                       # missing required
    ('{"text": "ab", "n": 1, "x": 0}', False),       # extra key
    ('{"text": "ab", "n": 1, "opt": null}', False),  # JSON null is not a string
    ('{"text": "ab", "n": 6}', False),               # maximum
    ('{"text": "ab", "n": 1, "tags": ["a", "b", "c"]}', False),
    ('{"text": "ab", "n": 1, "tags": ["a", 3]}', False),
    ('not json', False),
])
def test_schema_keywords(spark, raw, ok):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(compile_schema(SCHEMA, F.col("raw"))).first()[0] is ok


def test_check_schema_needs_properties():
    with pytest.raises(ValueError):
        check_schema({"type": "object"})


def test_enum_const_pattern_and_unknown_keywords(spark):
    rules = {"type": "object", "properties": {"n": {"enum": [1, 2.5, "x", None, True]}, "c": {"const": 3},
                                              "p": {"type": "string", "pattern": "^a.c$"}, "e": {"exclusiveMinimum": 0}}}
    rows = [('{"n": 1}', True), ('{"n": 1.0}', True), ('{"n": 2.5}', True), ('{"n": "x"}', True), ('{"n": null}', True),
            ('{"n": true}', True), ('{"n": false}', False), ('{"n": "1"}', False), ('{"n": 3}', False), ('{"c": 3.0}', True),
            ('{"c": true}', False), ('{"p": "abc"}', True), ('{"p": "abcd"}', False), ('{"e": 0}', False), ('{"e": 0.1}', True)]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(rows)], "i int, raw string")
    got = [r[1] for r in df.select("i", compile_schema(rules, F.col("raw"))).orderBy("i").collect()]
    assert got == [ok for _, ok in rows]
    with pytest.raises(ValueError):
        compile_schema({"type": "object", "properties": {"a": {"anyOf": []}}}, F.col("raw"))


def test_extract_json(spark):
    df = spark.createDataFrame([("  {\"a\": 1} ",), ("Sure: {\"a\": {\"b\": 2}} ok",), ("{broken",), ("x {1} y",)], "raw string")
    got = [r[0] for r in df.select(rs.extract_json(F.col("raw"))).collect()]
    assert got == ['{"a": 1}', '{"a": {"b": 2}}', None, None]


def test_k_valid_and_backup(spark):
    resp = spark.createDataFrame([(1, 0, 1, "x"), (1, 0, 2, "ok"), (1, 0, 3, "ok2"), (1, 0, 4, "ok3"),
                                  (2, 0, 1, "x"), (2, 0, 2, "x"), (2, 1, 1, "bk")],
                                 "request_id bigint, variant_priority int, attempt_no int, raw string")
    valid = F.col("raw") != "x"
    ks = sorted((r["request_id"], r["sample_no"], r["raw"]) for r in
                rs.k_valid_samples(resp.filter("variant_priority = 0"), valid, k=2, max_retries=1).collect())
    assert ks == [(1, 0, "ok"), (1, 1, "ok2")]
    chosen = {r["request_id"]: r["raw"] for r in rs.first_valid_with_backup(resp, valid, retry_limit=1).collect()}
    assert chosen == {1: "ok", 2: "bk"}


def test_failure_policies(spark):
    req = spark.createDataFrame([(1,), (2,)], "request_id bigint")
    chosen = spark.createDataFrame([(1, "ok")], "request_id bigint, raw string")
    assert rs.apply_failure_policy(req, chosen, "request_id", "drop").count() == 1
    assert rs.apply_failure_policy(req, chosen, "request_id", "null").count() == 2
    with pytest.raises(RuntimeError):
        rs.apply_failure_policy(req, chosen, "request_id", "fail")


def test_all_judges_failed_raises(spark):
    from corpusforge.operators import aggregate as ag
    j = spark.createDataFrame([(1, 0, True), (1, 1, False), (2, 0, False)], "row_id bigint, judge_no int, ok boolean")
    assert ag.successful_judges(j, "row_id", "judge_no", ok_col="ok", on_all_failed="drop").count() == 1
    with pytest.raises(ValueError):
        ag.successful_judges(j, "row_id", "judge_no", ok_col="ok")


def test_violations_agree_with_validity_and_name_the_place(spark):
    from pyspark.sql import functions as F
    from corpusforge.functions.schema import compile_schema, compile_violations
    from corpusforge.operators import responses as rs
    schema = {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {
        "a": {"type": "integer", "minimum": 1, "maximum": 5}, "b": {"type": "string", "minLength": 2, "pattern": "^x"},
        "c": {"type": "array", "maxItems": 2, "items": {"type": "object", "required": ["k"], "properties": {"k": {"enum": [1, "two"]}}}}}}
    cases = {
        '{"a": 2, "b": "xy"}': [],
        '{"a": 2, "b": "xy", "c": []}': [],
        '{"b": "y"}': [("$.a", "required"), ("$.b", "minLength"), ("$.b", "pattern")],
        '{"a": 9, "b": "xyz", "d": 1, "e": null}': [("$.a", "maximum"), ("$.d", "additionalProperties"), ("$.e", "additionalProperties")],
        '{"a": true, "b": null}': [("$.a", "type"), ("$.b", "type")],
        '{"a": 1, "b": "xx", "c": [{"k": 1}, {"k": 3}, {}]}': [("$.c", "maxItems"), ("$.c[1].k", "enum"), ("$.c[2].k", "required")],
        '{"a": 1, "b": "xx", "c": [1, {"k": "two"}]}': [("$.c[0]", "type")],
        '[1]': [("$", "type")],
        'nonsense': [("$", "json")],
    }
    df = spark.createDataFrame([(r,) for r in cases], "raw string")
    got = df.select("raw", compile_violations(schema, F.col("raw")).alias("v"), compile_schema(schema, F.col("raw")).alias("ok")).collect()
    for r in got:
        assert sorted((x["path"], x["rule"]) for x in r["v"]) == sorted(cases[r["raw"]]), r["raw"]
        assert r["ok"] == (not cases[r["raw"]])
    rows, seen = rs.with_violations(df.withColumn("j", F.lit(None).cast("string")), F.col("raw"), F.col("j"), schema, schema)
    counts = {(r["path"], r["rule"]): (r["n_rows"], r["n"]) for r in rs.rule_counts(rows).collect()}
    assert counts[("$.c[*].k", "enum")] == (1, 1) and counts[("$.a", "type")] == (1, 1)
    rows.collect()
    assert seen.get == {"total": len(cases), "valid": 2, "invalid": len(cases) - 2}


def test_failure_raised_by_the_plan(spark):
    from corpusforge.operators import responses as rs
    req = spark.createDataFrame([(1,), (2,)], "request_id bigint")
    chosen = spark.createDataFrame([(1, "a"), (2, None)], "request_id bigint, raw string")
    got = rs.apply_failure_policy(req, chosen, "request_id", "fail_in_plan").collect()
    assert sorted((r["request_id"], r["raw"]) for r in got) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="generation failed"):
        rs.apply_failure_policy(req, chosen.where("request_id = 1"), "request_id", "fail_in_plan").select("raw").collect()
