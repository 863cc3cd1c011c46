"""Composite jobs (Z1-Z5): the public entry points, each a composition of operators.

A model hook is called exactly once per request: its answers are written to the shared
checkpoint folder before anything is derived from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import clean_text, emoji_count, emoji_density
from corpusforge.operators import calibrate as cb
from corpusforge.operators import triage as tr
from corpusforge.operators.dedup import deduplicate
from corpusforge.operators.split import random_split, stratified_split
from corpusforge.session import cut_lineage, written


def process(df: DataFrame, *, order_col: str, text_col: str = "text", probs: DataFrame | None = None,
            labels: list[str] | None = None, clean: dict | None = None, emoji: dict | None = None,
            validate: Column | None = None, dedup: dict | None = None, triage: dict | None = None,
            calibrate: DataFrame | None = None, split: dict | None = None, attach: str | None = None,
            mark: dict | None = None) -> DataFrame:
    """Z3 ``process``: clean -> emoji features -> validate -> dedup -> triage -> calibrate -> split.

    ``df`` has one row per example with unique ``order_col``; ``probs`` is the long-form
    ``(row_id, label, p)`` table of label probabilities (rows absent from it have no
    judgment and go to train).  ``validate`` is a boolean column of the cleaned rows;
    ``triage`` holds ``given`` (``(row_id, label, y)``; the thresholded probabilities where
    absent) and ``engine``; ``calibrate`` is a table of fitted parameters; ``split`` may name a
    ``holdout_source``: rows of any other ``source`` go to train.  Output: the
    surviving rows plus ``emoji_count`` (set where missing), ``emoji_density``, ``split`` and,
    under the name ``attach``, the map of their calibrated probabilities.

    ``mark`` (``enabled, params_path, version, method``) records on every judgment whether it was
    calibrated (K8): in the struct ``judgment_meta`` where the rows have one, else as columns of
    their own.  It counts as applied only where ``calibrate`` was given.

    The cleaned rows are written once and read for the signatures and for the output; everything
    between runs on narrow id tables.
    """
    clean = {} if clean is None else clean
    out = df
    if clean.get("enabled", True):
        out = out.withColumn(text_col, clean_text(F.col(text_col),
                                                  unicode_normalize=clean.get("unicode_normalize", False),
                                                  repair_first=clean.get("repair_first", False),
                                                  boilerplate=clean.get("boilerplate", False)))
    if emoji is not None and emoji.get("compute", True):
        n = emoji_count(F.col(text_col)).cast("int")
        out = out.withColumn("emoji_count", F.coalesce(F.col("emoji_count").cast("int"), n) if "emoji_count" in df.columns else n)
        out = out.withColumn("emoji_density", emoji_density(F.col(text_col), emoji.get("normalization", "per_word")))
    if validate is not None:
        out = out.withColumn("_valid", validate)
    if out is not df:                             # worked out once, behind any spread of the rows: a filter would go before it
        out = cut_lineage(out) if "void" in out.schema.simpleString() else written(out)
    if validate is not None:
        out = out.where("_valid").drop("_valid")
    dd = {} if dedup is None else dedup
    _, dropped = deduplicate(out, order_col, text=F.col(text_col), threshold=dd.get("threshold", 0.9),
                             num_perm=dd.get("num_perm", 128), n_gram=dd.get("n_gram", 5),
                             shingle_level=dd.get("shingle_level", "word"), verify=dd.get("verify", False), return_dropped=True)
    ids = out.select(order_col).join(
        dropped.withColumnRenamed("node", order_col), order_col, "left_anti")
    if probs is not None:
        ids = cut_lineage(ids)
        probs = cut_lineage(probs.join(ids.withColumnRenamed(order_col, "row_id"), "row_id", "left_semi"))
        if triage is not None:
            given = triage.get("given")
            given = tr.hard_labels(probs, labels) if given is None else given.join(
                ids.withColumnRenamed(order_col, "row_id"), "row_id", "left_semi")
            issues = cut_lineage(tr.find_label_issues(given.select("row_id", "label", "y"), probs,
                                                      engine=triage.get("engine", "confident_learning")))
            ids = tr.filter_issues(ids.withColumnRenamed(order_col, "row_id"), issues).withColumnRenamed("row_id", order_col)
            probs = tr.filter_issues(probs, issues)
        if calibrate is not None:
            probs = cb.apply(probs, calibrate)
    ids = cut_lineage(ids)
    sp = {} if split is None else split
    ratios = dict(val_ratio=sp.get("val_ratio", 0.15), test_ratio=sp.get("test_ratio", 0.15), seed=sp.get("seed", 42))
    held = sp.get("holdout_source")
    if held is not None:
        mine = cut_lineage(df.where(F.col("source") == held).select(order_col).join(ids, order_col, "left_semi"))
    if probs is not None and labels and sp.get("stratify", True):
        probs = cut_lineage(probs)
        has = probs.select(F.col("row_id").alias(order_col)).distinct().withColumn("_has_labels", F.lit(True))
        has = has if held is None else has.join(mine, order_col, "left_semi")
        tagged = stratified_split(ids.join(has, order_col, "left").fillna(False, ["_has_labels"]), probs, labels,
                                  row_id=order_col, has_labels="_has_labels", **ratios).drop("_has_labels")
    else:
        tagged = random_split(ids if held is None else mine, order_col, **ratios)
        if held is not None:
            tagged = ids.join(tagged, order_col, "left").fillna("train", ["split"])
    out = out.join(tagged, order_col)
    if attach and probs is not None:              # the labels of one row: a bounded list
        own = probs.groupBy(F.col("row_id").alias(order_col)).agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "p")))).alias(attach))
        out = out.drop(attach).join(own, order_col, "left")
    if mark is not None:
        applied, version = cb.calibration_mark(mark.get("enabled", False), mark.get("params_path"), calibrate is not None,
                                               mark.get("version"), mark.get("method"))
        out = cb.mark(out, applied, version, "judgment_meta" if "judgment_meta" in out.columns else None)
    return out


def generate(plan_df: DataFrame, template: str, model_fn, *, response_schema: str,
             valid: Column | None = None, retry_limit: int = 3, failure_policy: str = "drop",
             system: str = "", extra: DataFrame | None = None, models: Column | None = None) -> DataFrame:
    """Z1 ``generate``: plan rows -> prompts -> user model hook -> first valid answer (with
    backup) -> failure policy -> lineage metadata.

    ``model_fn`` maps a pandas batch of ``(request_id, system, user)`` to rows of
    ``response_schema`` (which must contain ``request_id, variant_priority, attempt_no, raw``);
    the columns of ``extra(id, ...)`` travel along with the prompts.  ``models`` is recorded in the
    metadata.
    """
    from corpusforge.operators.planning import lineage_metadata
    from corpusforge.operators.prompts import prompt_values, render
    from corpusforge.operators.responses import apply_failure_policy, call_model, first_valid_with_backup

    values = prompt_values(plan_df)
    prompts = values.select(F.col("id").alias("request_id"), F.lit(system).alias("system"),
                            render(template, values.columns).alias("user"))
    if extra is not None:
        prompts = prompts.join(extra.withColumnRenamed("id", "request_id"), "request_id")
    responses = cut_lineage(call_model(prompts, model_fn, response_schema))       # the one call
    chosen = first_valid_with_backup(responses, F.lit(True) if valid is None else valid, retry_limit=retry_limit)
    rows = apply_failure_policy(plan_df.withColumnRenamed("id", "request_id"), chosen, "request_id", failure_policy)
    controls = [c for c in plan_df.columns if c != "id"]
    whole = rows.withColumn("_plan", F.struct(*controls))
    return whole.withColumn("metadata", lineage_metadata(whole, generated=None, controls="_plan", models=models)).drop("_plan")


def judge(samples: DataFrame, *, scores_key: str = "label", aggregation: str = "mean", judge_col: str | None = None,
          trigger_labels: list[str] | None = None, pairwise: dict | None = None, answers_fn=None,
          with_audit: bool = False):
    """Z2 ``judge``: long judge samples ``(row_id, [judge,] sample_no, label, prob)`` -> per-row
    scores (A1, clamped to [0, 1]; the mean over judges where ``judge_col`` is given) -> optional
    pairwise resolution of borderline rows (P1-P5).

    ``answers_fn(pairs) -> (label, id_a, id_b, preferred, confidence_raw, reason)`` stands for
    the comparison model; it sees every pair once.  ``with_audit`` also returns the audit lists
    ``(row_id, pairwise)`` (P6).
    """
    from corpusforge.operators.aggregate import aggregate_numeric, ensemble_mean
    from corpusforge.operators.pairwise import audit_lists, pair_rows, shift_probabilities, verdicts

    keys = ["row_id", *([judge_col] if judge_col else []), scores_key]
    scores = aggregate_numeric(samples, keys, "prob", how=aggregation, minimum=0, maximum=1, out="p")
    if judge_col:
        scores = ensemble_mean(scores, ["row_id", scores_key], judge_col, "p", out="p")
    if not pairwise or answers_fn is None:
        return (scores, None) if with_audit else scores
    labels = trigger_labels or ["overall"]
    scores = cut_lineage(scores)
    pairs = cut_lineage(pair_rows(scores, labels, **pairwise))
    v = verdicts(pairs, cut_lineage(answers_fn(pairs.select("label", "id_a", "id_b"))))
    shifted = shift_probabilities(scores, v, labels)
    return (shifted, audit_lists(v)) if with_audit else shifted


def judgment_provenance(samples: DataFrame, gen: DataFrame, info: dict, aggregation: str, version: str | None = None) -> DataFrame:
    """``(row_id, judgment_meta)`` per judged row.

    ``judge_meta`` names the judge (``info``: model, temperature, seed, provider) and the samples that
    were really used; prompt keys come from the row's metadata; nothing is marked as calibrated.
    """
    from corpusforge.operators.aggregate import enrich_judgment, judge_meta

    meta = judge_meta(samples.where("prob is not null"), ["row_id"], "sample_no", model=info.get("model"),
                      temperature=info.get("temperature", 0.0), seed=info.get("seed"), aggregation=aggregation)
    prompt = gen.schema["metadata"].dataType["prompt"].dataType.fieldNames()
    rows = meta.withColumn("judge_meta", F.col("judge_meta").withField("provider", F.lit(info.get("provider")).cast("string"))).join(
        gen.select("row_id", F.col("metadata.prompt").alias("_prompt")), "row_id")
    own = F.struct("judge_meta", F.lit(version).cast("string").alias("calibration_version"))
    return rows.select("row_id", enrich_judgment(own, ["judge_meta", "calibration_version"], F.col("_prompt"), prompt).alias("judgment_meta"))


def run(plan_df: DataFrame, template: str, generator_fn, judge_fn, *, generator_schema: str,
        judge_schema: str, labels: list[str], stage_dir: str | None = None, num_samples: int = 3,
        max_retries: int = 2, valid_generated: Column | None = None, valid_judgment: Column | None = None,
        aggregation: str = "mean", process_opts: dict | None = None, models: Column | None = None,
        backup_judge_fn=None, extra: DataFrame | None = None, retry_limit: int = 3,
        judge_info: dict | None = None, judge_extra: DataFrame | None = None) -> DataFrame:
    """Z5 ``run``: generate -> judge -> process, with the stage tables persisted.

    ``generator_fn``: pandas batch ``(request_id, system, user)`` -> rows of
    ``generator_schema`` (``request_id, variant_priority, attempt_no, raw`` at least).
    ``judge_fn``: pandas batch ``(request_id, prompt)`` -> rows of ``judge_schema``
    (``request_id, attempt_no, label, prob`` - one row per attempt and key, NULL prob =
    key absent); the columns of ``judge_extra(id, ...)`` travel along with the prompts;
    ``backup_judge_fn`` judges the rows that got no valid sample.  The output keeps
    the generated JSON, the judgment (calibrated probabilities by label), its provenance
    ``judgment_meta`` (``judge_info`` names the judge) and the metadata.

    With ``stage_dir`` the generated and judged tables are written as JSON lines and read back, each
    with a manifest (:mod:`corpusforge.plans.stages`).  A later call with the same plan, template,
    schemas, hooks and settings reads the stages that are complete: their hooks are not called again.
    """
    from corpusforge.operators.prompts import judge_prompt
    from corpusforge.operators.responses import call_model, extract_json, k_valid_samples
    from corpusforge.plans.stages import fingerprint, read_stage, table_digest, write_stage

    spark = plan_df.sparkSession
    info, opts = judge_info or {}, process_opts or {}
    marks = {"generated": "", "judged": ""}
    if stage_dir:
        marks["generated"] = fingerprint(plan=table_digest(plan_df), extra=table_digest(extra), template=template, hook=generator_fn,
                                         schema=generator_schema, valid=valid_generated, models=models, retry_limit=retry_limit)
        marks["judged"] = fingerprint(generated=marks["generated"], extra=table_digest(judge_extra), hook=judge_fn, backup=backup_judge_fn,
                                      schema=judge_schema, num_samples=num_samples, max_retries=max_retries,
                                      valid=valid_judgment, aggregation=aggregation, info=info, method=(opts.get("mark") or {}).get("method"))

    def stage(name: str, make):
        if not stage_dir:
            return cut_lineage(make())
        done = read_stage(spark, stage_dir, name, marks[name])
        return write_stage(make(), stage_dir, name, marks[name]) if done is None else done

    def generated() -> DataFrame:
        gen = generate(plan_df, template, generator_fn, response_schema=generator_schema, valid=valid_generated, models=models,
                       extra=extra, retry_limit=retry_limit)
        return gen.select(F.col("request_id").alias("row_id"), extract_json(F.col("raw")).alias("generated_raw"),
                          F.get_json_object(extract_json(F.col("raw")), "$.text").alias("text"), "metadata")

    gen = stage("generated", generated)

    def sampled(prompts: DataFrame, fn) -> DataFrame:
        answers = cut_lineage(call_model(prompts, fn, judge_schema))              # the one call
        ok = answers if valid_judgment is None else answers.filter(valid_judgment)
        kept = k_valid_samples(ok.select("request_id", "attempt_no").distinct(), F.lit(True), k=num_samples,
                               max_retries=max_retries)
        return answers.join(kept, ["request_id", "attempt_no"]).select(
            F.col("request_id").alias("row_id"), "sample_no", "label", "prob")

    def judged() -> DataFrame:
        prompts = gen.select(F.col("row_id").alias("request_id"), judge_prompt(gen.select("text"), None).alias("prompt"))
        if judge_extra is not None:
            prompts = prompts.join(judge_extra.withColumnRenamed("id", "request_id"), "request_id")
        samples = cut_lineage(sampled(prompts, judge_fn))
        if backup_judge_fn is not None:
            failed = prompts.join(samples.select(F.col("row_id").alias("request_id")).distinct(), "request_id", "left_anti")
            samples = cut_lineage(samples.unionByName(sampled(cut_lineage(failed), backup_judge_fn)))
        scores = judge(samples, aggregation=aggregation)
        meta = judgment_provenance(samples, gen, info, aggregation, (opts.get("mark") or {}).get("method"))
        return scores.join(meta, "row_id", "left")

    whole = stage("judged", judged)
    scores = whole.drop("judgment_meta")
    meta = whole.groupBy("row_id").agg(F.first("judgment_meta").alias("judgment_meta"))        # one row's labels
    return process(gen.join(meta, "row_id", "left"), order_col="row_id", probs=scores, labels=labels, attach="judgment", **opts)


def calibrate_files(spark, predictions_path: str, truth_path: str, labels: list[str], *,
                    id_field: str = "id", overall_key: str = "overall", method: str = "isotonic",
                    truth_keys: list[str] = ("label", "overall"), output_path: str | None = None,
                    params_path: str | None = None):
    """Z4 ``calibrate`` over JSON-lines files (S2 -> K1-K7 -> S3/S5).

    Each line is parsed once into a VARIANT, so booleans, numbers and nested maps keep
    their JSON types.  Predictions: ``{id, judgment?: {<overall_key>, labels: {...}}}``
    (a flat object works too); truths: ``{id, <one of truth_keys>, labels | truth: {...}}``.
    Texts are neither probabilities nor truths.  Rows are paired by ``id_field`` (DataFrames have
    no line order); both files must hold the same ids once.  Returns
    ``(calibrated long table, parameters)`` and writes them when paths are given.
    """
    from corpusforge.sources.jsonl import write_jsonl

    def number(v: Column) -> Column:
        return cb.variant_number(v)
    path = lambda k: "$['" + k + "']"
    pv = spark.read.text(predictions_path).select(F.parse_json("value").alias("v"))
    j = F.coalesce(F.try_variant_get("v", "$.judgment", "variant"), F.col("v"))
    preds = pv.select(F.try_variant_get("v", path(id_field), "bigint").alias("row_id"), j.alias("j"))
    p_over = preds.select("row_id", F.lit(overall_key).alias("label"),
                          number(F.try_variant_get("j", path(overall_key), "variant")).alias("p"))
    p_lab = preds.select("row_id", F.explode_outer(F.try_variant_get("j", "$.labels", "map<string,variant>"))
                         .alias("label", "_v")).select("row_id", "label", number(F.col("_v")).alias("p"))
    p_long = p_over.unionByName(p_lab).filter(F.col("p").isNotNull() & F.col("label").isNotNull())

    tv = spark.read.text(truth_path).select(F.parse_json("value").alias("v"))
    t_over = tv.select(F.try_variant_get("v", path(id_field), "bigint").alias("row_id"), F.lit(overall_key).alias("label"),
                       F.coalesce(*[cb.truth_value(number(F.try_variant_get("v", path(k), "variant"))) for k in truth_keys]).alias("y"))
    lab = F.try_variant_get("v", "$.labels", "map<string,variant>")
    alt = F.try_variant_get("v", "$.truth", "map<string,variant>")
    t_map = F.when(lab.isNull() | (F.size(lab) == 0), alt).otherwise(lab)
    t_lab = tv.select(F.try_variant_get("v", path(id_field), "bigint").alias("row_id"),
                      F.explode_outer(t_map).alias("label", "_v")).select("row_id", "label", cb.truth_value(number(F.col("_v"))).alias("y"))
    t_long = t_over.unionByName(t_lab).filter(F.col("y").isNotNull() & F.col("label").isNotNull())

    truth_ids = tv.select(F.try_variant_get("v", path(id_field), "bigint").alias("row_id"))
    cb.pair_with_truth(preds.select("row_id"), truth_ids, ["row_id"])           # K1: the same ids, once each
    pairs = p_long.join(t_long, ["row_id", "label"])
    params = cb.fit(pairs, [overall_key] + list(labels), method=method)
    calibrated = cb.apply(p_long, params)
    if output_path:
        write_jsonl(calibrated, output_path)
    if params_path:
        cb.save_params(params, params_path)
    return calibrated, params
