"""Z1/Z2/Z3/Z5 composition with stand-in model hooks (the model call is the user's code)."""

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import planning as pl
from corpusforge.plans import jobs

CFG = {"styles": {"a": {"length_bucket": "short"}, "b": {}}, "industries": ["X"], "roles": ["Y"],
       "length_buckets": {"short": {"min_chars": 10, "max_chars": 90}}}


def test_run_end_to_end(spark, tmp_path):
    # hooks defined here are pickled by value, so workers need not import this module
    def gen_fn(pdf):
        import json
        import pandas as pd
        rows = []
        for rid, user in zip(pdf["request_id"], pdf["user"]):
            text = f"post {rid} about {user} " * (1 + rid % 3)
            rows.append((rid, "primary", 0, 1, "oops"))
            rows.append((rid, "primary", 0, 2, "Here: " + json.dumps({"text": text})))
        return pd.DataFrame(rows, columns=["request_id", "variant", "variant_priority", "attempt_no", "raw"])

    def judge_fn(pdf):
        import hashlib
        import pandas as pd
        rows = []
        for rid, prompt in zip(pdf["request_id"], pdf["prompt"]):
            for attempt in (1, 2, 3):
                for label in ("quality", "toxic"):
                    h = int(hashlib.md5(f"{prompt}:{attempt}:{label}".encode()).hexdigest()[:6], 16) / 16 ** 6
                    rows.append((rid, attempt, label, h))
        return pd.DataFrame(rows, columns=["request_id", "attempt_no", "label", "prob"])

    ids = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"))
    plan = pl.plan(ids, pl.read_config(CFG))
    out = jobs.run(plan, "Write for {role} in {industry}", gen_fn, judge_fn,
                   generator_schema="request_id bigint, variant string, variant_priority int, attempt_no int, raw string",
                   judge_schema="request_id bigint, attempt_no int, label string, prob double",
                   labels=["quality", "toxic"], stage_dir=str(tmp_path / "stages"), num_samples=2,
                   valid_generated=F.col("raw").contains("{"))
    assert {"generated_raw", "metadata", "judgment"} <= set(out.columns)
    whole = out.first()
    assert set(whole["judgment"]) == {"quality", "toxic"} and whole["metadata"]["prompt"]["prompt_id"].startswith("prompt-")
    rows = out.select("row_id", "split").collect()
    assert 0 < len(rows) <= ids.count()
    assert {r["split"] for r in rows} <= {"train", "val", "test"}
    assert len({r["row_id"] for r in rows}) == len(rows)


def test_calibrate_files(spark, tmp_path):
    import json
    preds, truth = [], []
    for i in range(40):
        p = (i % 10) / 10 + 0.05
        preds.append({"id": i, "judgment": {"overall": p, "labels": {"a": 1 - p}}})
        truth.append({"id": i, "label": bool(i % 10 >= 5), "labels": {"a": 1.0 if i % 10 < 5 else 0.0}})
    (tmp_path / "p.jsonl").write_text("\n".join(json.dumps(r) for r in preds))
    (tmp_path / "t.jsonl").write_text("\n".join(json.dumps(r) for r in truth))
    cal, params = jobs.calibrate_files(spark, str(tmp_path / "p.jsonl"), str(tmp_path / "t.jsonl"), ["a"],
                                       params_path=str(tmp_path / "params"))
    got = {(r["row_id"], r["label"]): r["p"] for r in cal.collect()}
    assert got[(0, "overall")] == 0.0 and got[(9, "overall")] == 1.0     # perfectly separable
    assert got[(0, "a")] == 1.0 and got[(9, "a")] == 0.0
    assert {r["key"]: r["method"] for r in params.collect()} == {"overall": "isotonic", "a": "isotonic"}


@pytest.mark.parametrize("staged", [True, False])
def test_every_hook_sees_every_request_once(spark, tmp_path, staged):
    seen = {k: spark.sparkContext.accumulator(0) for k in ("generate", "judge", "compare")}
    gen_calls, judge_calls, pair_calls = seen["generate"], seen["judge"], seen["compare"]

    def gen_fn(pdf):
        import pandas as pd
        gen_calls.add(len(pdf))
        return pd.DataFrame([(r, 0, 1, '{"text": "words number %d and some more words"}' % r) for r in pdf["request_id"]],
                            columns=["request_id", "variant_priority", "attempt_no", "raw"])

    def judge_fn(pdf):
        import pandas as pd
        judge_calls.add(len(pdf))
        return pd.DataFrame([(r, 1, k, 0.5) for r in pdf["request_id"] for k in ("quality", "toxic")],
                            columns=["request_id", "attempt_no", "label", "prob"])

    out = jobs.run(pl.plan(spark.range(20), pl.read_config(CFG)), "For {role}", gen_fn, judge_fn, num_samples=1,
                   generator_schema="request_id bigint, variant_priority int, attempt_no int, raw string",
                   judge_schema="request_id bigint, attempt_no int, label string, prob double", labels=["quality", "toxic"],
                   stage_dir=str(tmp_path / "s") if staged else None, process_opts={"dedup": {"threshold": 0.99}})
    out.collect()
    assert (gen_calls.value, judge_calls.value) == (20, 20)

    def compare(pairs):
        def ask(batches):
            for pdf in batches:
                pair_calls.add(len(pdf))
                yield pdf.assign(preferred="A", confidence_raw="0.5", reason="r")
        return pairs.mapInPandas(ask, "label string, id_a bigint, id_b bigint, preferred string, confidence_raw string, reason string")

    samples = spark.createDataFrame([(i, 0, "overall", 0.5) for i in range(40)], "row_id bigint, sample_no int, label string, prob double")
    shifted, audit = jobs.judge(samples, trigger_labels=["overall"], pairwise=dict(window=0.05, margin=0.2), answers_fn=compare,
                                with_audit=True)
    assert shifted.count() == 40 and audit.count() == 40
    assert pair_calls.value == 20


def test_process_options(spark):
    rows = spark.createDataFrame([(i, f"text number {i} has its own words {i * 7}", 5 if i == 3 else None) for i in range(30)],
                                 "id bigint, text string, emoji_count int")
    probs = spark.createDataFrame([(i, "a", i / 30) for i in range(30)], "row_id bigint, label string, p double")
    out = {r["id"]: r for r in jobs.process(rows, order_col="id", probs=probs, labels=["a"], validate=F.length("text") > 10, emoji={},
                                            dedup={"threshold": 0.99}, triage={}, attach="judgment").collect()}
    assert len(out) == 30 and out[3]["emoji_count"] == 5 and out[4]["emoji_count"] == 0
    assert out[29]["judgment"] == {"a": 29 / 30}


def test_calibrate_files_rejects_unpaired_ids(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id": 1, "overall": 0.2}\n{"id": 2, "overall": 0.4}')
    (tmp_path / "t.jsonl").write_text('{"id": 1, "label": true}')
    with pytest.raises(ValueError):
        jobs.calibrate_files(spark, str(tmp_path / "p.jsonl"), str(tmp_path / "t.jsonl"), ["a"])


def _counting_hooks(spark):
    seen = {k: spark.sparkContext.accumulator(0) for k in ("generate", "judge")}
    gen_calls, judge_calls = seen["generate"], seen["judge"]

    def gen_fn(pdf):
        import pandas as pd
        gen_calls.add(len(pdf))
        return pd.DataFrame([(r, 0, 1, '{"text": "words number %d and some more words"}' % r) for r in pdf["request_id"]],
                            columns=["request_id", "variant_priority", "attempt_no", "raw"])

    def judge_fn(pdf):
        import pandas as pd
        judge_calls.add(len(pdf))
        return pd.DataFrame([(r, a, k, (r % 10) / 10 if r != 7 else None) for r in pdf["request_id"] for a in (1, 2) for k in ("quality", "toxic")],
                            columns=["request_id", "attempt_no", "label", "prob"])
    return seen, gen_fn, judge_fn


def _run(spark, hooks, stage_dir, n=20, template="For {role}", **more):
    _, gen_fn, judge_fn = hooks
    return jobs.run(pl.plan(spark.range(n), pl.read_config(CFG)), template, gen_fn, judge_fn, num_samples=2, stage_dir=stage_dir,
                    generator_schema="request_id bigint, variant_priority int, attempt_no int, raw string",
                    judge_schema="request_id bigint, attempt_no int, label string, prob double", labels=["quality", "toxic"],
                    judge_info={"model": "m1", "temperature": 0.3, "seed": 9, "provider": "p"},
                    **{"process_opts": {"dedup": {"threshold": 0.99}}, **more})


def test_run_resumes_behind_the_last_complete_stage(spark, tmp_path, monkeypatch):
    hooks = _counting_hooks(spark)
    calls = lambda: (hooks[0]["generate"].value, hooks[0]["judge"].value)
    stage = str(tmp_path / "s")
    with monkeypatch.context() as m:                      # the job dies after judging
        m.setattr(jobs, "process", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _run(spark, hooks, stage)
    assert calls() == (20, 20)
    rows = _run(spark, hooks, stage).collect()
    assert calls() == (20, 20) and len(rows) == 20
    with monkeypatch.context() as m:                      # the judged table was not committed
        from corpusforge.plans import stages
        whole = stages.write_jsonl
        m.setattr(stages, "write_jsonl", lambda df, path, **k: 1 / 0 if path.endswith("judged") else whole(df, path, **k))
        with pytest.raises(ZeroDivisionError):
            _run(spark, hooks, stage, valid_judgment=F.col("prob") >= 0)
    assert calls() == (20, 40)
    assert len(_run(spark, hooks, stage, valid_judgment=F.col("prob") >= 0).collect()) == 20
    assert calls() == (20, 60)
    _run(spark, hooks, stage, template="Other for {role}").collect()
    assert calls() == (40, 80)                            # another template: nothing fits
    _run(spark, hooks, stage, n=21, template="Other for {role}").collect()
    assert calls() == (61, 101)


def test_run_records_provenance_and_marks(spark):
    hooks = _counting_hooks(spark)
    opts = {"dedup": {"threshold": 0.99}, "mark": {"enabled": True, "method": "isotonic"}}
    rows = {r["row_id"]: r for r in _run(spark, hooks, None, process_opts=opts).collect()}
    assert rows[7]["judgment_meta"] is None and rows[7]["judgment"] is None
    meta = rows[3]["judgment_meta"]
    assert meta["judge_meta"].asDict() == {"model": "m1", "temperature": 0.3, "num_samples": 2, "seed": 9, "aggregation": "mean", "provider": "p"}
    assert meta["prompt_id"] == rows[3]["metadata"]["prompt"]["prompt_id"] and meta["style_id"] == rows[3]["metadata"]["prompt"]["style_id"]
    assert meta["calibration_applied"] is False and meta["calibration_version"] == "isotonic"
    from corpusforge.operators import calibrate as cb
    params = spark.createDataFrame([("quality", "platt", 1.0, 0.0)], "key string, method string, coef double, intercept double") \
        .selectExpr("key", "method", "cast(null as double) x", "cast(null as double) y", "cast(null as double) x1", "cast(null as double) y1",
                    "coef", "intercept")
    assert params.columns == cb.SEGMENTS
    opts["calibrate"], opts["mark"] = params, {"enabled": True, "params_path": "params/v7.json"}
    meta = {r["row_id"]: r for r in _run(spark, hooks, None, process_opts=opts).collect()}[3]["judgment_meta"]
    assert meta["calibration_applied"] is True and meta["calibration_version"] == "v7"
    rows = spark.createDataFrame([(i, f"text number {i} of its own") for i in range(5)], "id bigint, text string")
    out = jobs.process(rows, order_col="id", mark={"enabled": False}).collect()
    assert all(r["calibration_applied"] is False for r in out)


def test_quarantine_parts_good_rows_from_bad_lines(spark, tmp_path):
    from corpusforge.sources.jsonl import read_quarantined
    (tmp_path / "a.jsonl").write_text('{"id": 1, "name": "x"}\n\n{"id": 2\n  \n[1]\n"text"\n{"id": "seven"}\n{"name": "no id"}\n')
    (tmp_path / "b.jsonl").write_text('{"id": 5, "more": true}\n{}\nnull\n')
    good, bad = read_quarantined(spark, str(tmp_path), "id bigint, name string")
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, "x"), (None, "no id"), (5, None), (None, None)], key=str)
    got = sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"]) for r in bad.collect())
    assert got == sorted([("a.jsonl", '{"id": 2', "not JSON"), ("a.jsonl", "[1]", "not an object"), ("a.jsonl", '"text"', "not an object"),
                          ("a.jsonl", '{"id": "seven"}', "wrong type"), ("b.jsonl", "null", "not an object")])
    with pytest.raises(ValueError, match="5 of 9 lines"):
        read_quarantined(spark, str(tmp_path), "id bigint, name string", max_bad_share=0.5)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "c.jsonl").write_text("")
    good, bad = read_quarantined(spark, str(tmp_path / "empty"), "id bigint")
    assert good.count() == bad.count() == 0


def test_stream_equals_batch_and_rejects_apart(spark, tmp_path):
    from corpusforge.operators import calibrate as cb
    from corpusforge.streaming import rowwise as st
    rows = [(i, f"  text   {i} " + "long " * (i % 5), {"a": i / 40, "b": 1 - i / 40}) for i in range(40)]
    schema = "row_id bigint, text string, probs map<string,double>"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    fitted = cb.fit_segments(spark.createDataFrame([("a", i / 40, int(i > 20)) for i in range(40)], "label string, p double, y int"), ["a"])
    reads = []
    done, rejected = st.process_stream(spark, stream, params=lambda: (reads.append(1), fitted)[1], name="t", valid=F.length("text") > 12)
    got = {r["row_id"]: r for r in done.collect()}
    assert len(reads) == 5 and set(got) | {r["row_id"] for r in rejected.collect()} == set(range(40))
    assert got[9]["text"] == "text 9 long long long long" and got[9]["probs"] == {"a": 0.0, "b": 1 - 9 / 40}
    assert all(r["text"].startswith("  text") for r in rejected.collect()) and rejected.count() == 40 - len(got)


def test_process_works_out_the_cleaned_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return text
    counted = F.udf(count, "string").asNondeterministic()
    rows = [(i, f"row {i} of a text with words of its own number {i * i}") for i in range(20)] + [(20, "short")]
    df = spark.createDataFrame(rows, "id bigint, text string").withColumn("text", counted("text"))
    out = jobs.process(df, order_col="id", validate=F.length("text") > 10, emoji={})
    assert sorted(r[0] for r in out.select("id").collect()) == list(range(20))
    assert seen.value == len(rows)


def test_stream_checks_every_row_once(spark, tmp_path):
    from corpusforge.streaming import rowwise as st
    seen = spark.sparkContext.accumulator(0)

    def long_enough(text):
        seen.add(1)
        return len(text) > 4
    rows = [(i, "some words" if i % 3 else "no", {"a": 0.25}) for i in range(12)]
    ddl = "id bigint, text string, probs map<string,double>"
    spark.createDataFrame(rows, ddl).repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    params = spark.createDataFrame([("a", "platt", 2.0, -1.0)], "key string, method string, coef double, intercept double")
    params = params.selectExpr("key", "method", "null :: double x", "null :: double y", "null :: double x1", "null :: double y1", "coef", "intercept")
    valid = F.udf(long_enough, "boolean").asNondeterministic()("text")
    done, rejected = st.process_stream(spark, stream, params=lambda: params, name="once", row_id="id", emoji={}, valid=valid)
    assert sorted(r[0] for r in done.select("id").collect()) == [i for i in range(12) if i % 3]
    assert sorted(r[0] for r in rejected.select("id").collect()) == [0, 3, 6, 9]
    assert seen.value == len(rows)
