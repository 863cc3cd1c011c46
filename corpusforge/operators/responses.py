"""Model responses as tables.

The model call is the one thing outside a Catalyst plan: a ``prompts`` table goes out, a
``responses`` table ``(request_id, variant, variant_priority, attempt_no, raw)`` comes back.
Choosing among attempts, retries and backups is then ordinary windowing over each
request's few attempts (a bounded group), and validation is a compiled column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpusforge.functions.schema import VIOLATIONS, compile_schema, compile_violations
from corpusforge.functions.text import strip_ws


# R1 -------------------------------------------------------------------------------------
def extract_json(raw: Column) -> Column:
    """The JSON text in a free-text answer: the whole (stripped) text if it parses, else the
    span from the first '{' to the last '}' if that parses, else NULL."""
    t = strip_ws(raw)
    span = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return (F.when(F.try_parse_json(t).isNotNull(), t)
            .when((span != "") & F.try_parse_json(span).isNotNull(), span))


# V1 / V3 --------------------------------------------------------------------------------
def row_valid(generated_raw: Column | None, judgment_raw: Column | None,
              generation_schema: dict | None, judgment_schema: dict | None) -> Column:
    """A row is valid if each part that is present satisfies its schema (none present: valid)."""
    cond = F.lit(True)
    if generated_raw is not None and generation_schema is not None:
        cond = cond & (generated_raw.isNull() | compile_schema(generation_schema, generated_raw))
    if judgment_raw is not None and judgment_schema is not None:
        cond = cond & (judgment_raw.isNull() | compile_schema(judgment_schema, judgment_raw))
    return cond


def validation_report(df: DataFrame, valid: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"),
                  F.count_if(~valid).alias("invalid"))


def with_violations(df: DataFrame, generated_raw: Column | None, judgment_raw: Column | None,
                    generation_schema: dict | None, judgment_schema: dict | None,
                    out: str = "violations") -> tuple[DataFrame, Observation]:
    """V3 row by row: ``df`` with the broken rules of both parts, ``array<struct<part, path, rule>>``
    (none: valid), and an observation of ``total``, ``valid`` and ``invalid`` that the first action
    on the result fills; no pass of its own is needed for the report."""
    def of_part(part: str, raw: Column, schema: dict) -> Column:
        own = F.when(raw.isNull(), F.array().cast(VIOLATIONS)).otherwise(compile_violations(schema, raw))
        return F.transform(own, lambda x: F.struct(F.lit(part).alias("part"), x["path"].alias("path"), x["rule"].alias("rule")))
    parts = [("generated", generated_raw, generation_schema), ("judgment", judgment_raw, judgment_schema)]
    lists = [of_part(part, raw, schema) for part, raw, schema in parts if raw is not None and schema is not None]
    found = F.concat(*lists) if lists else F.array().cast("array<struct<part:string,path:string,rule:string>>")
    seen = Observation()
    valid = F.size(out) == 0
    return df.withColumn(out, found).observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"),
                                             F.count_if(~valid).alias("invalid")), seen


def rule_counts(df: DataFrame, violations: str = "violations") -> DataFrame:
    """``(part, path, rule, n_rows, n)``: rows that break a rule and how often; positions in arrays are ``[*]``."""
    broken = df.select(F.monotonically_increasing_id().alias("_row"), F.explode(violations).alias("v"))
    path = F.regexp_replace("v.path", r"\[\d+\]", "[*]")
    per_row = broken.groupBy("_row", "v.part", path.alias("path"), "v.rule").agg(F.count(F.lit(1)).alias("n"))
    return per_row.groupBy("part", "path", "rule").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n"))


# R2 -------------------------------------------------------------------------------------
def k_valid_samples(responses: DataFrame, valid: Column, *, k: int, max_retries: int = 2,
                    request_col: str = "request_id", attempt_col: str = "attempt_no") -> DataFrame:
    """The first ``k`` valid answers per request among its first ``k + max_retries`` attempts.

    Requests with no valid answer are absent (they failed).  ``sample_no`` numbers the kept
    answers from 0.  The window partition is one request's attempts (bounded by the retry
    budget), and Spark turns ``rn <= k`` into a group limit.
    """
    k = max(1, int(k))
    cand = responses.filter((F.col(attempt_col) <= k + max_retries) & valid)
    w = Window.partitionBy(request_col).orderBy(attempt_col)
    return cand.withColumn("sample_no", F.row_number().over(w) - 1).filter(F.col("sample_no") < k)


# R3 -------------------------------------------------------------------------------------
def first_valid_with_backup(responses: DataFrame, valid: Column, *, retry_limit: int = 3,
                            request_col: str = "request_id", priority_col: str = "variant_priority",
                            attempt_col: str = "attempt_no") -> DataFrame:
    """Primary gets ``retry_limit + 1`` attempts, then the backup the same: the first valid
    answer in (variant priority, attempt) order, one row per request."""
    cand = responses.filter((F.col(attempt_col) <= retry_limit + 1) & valid)
    w = Window.partitionBy(request_col).orderBy(priority_col, attempt_col)
    return cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# R4 -------------------------------------------------------------------------------------
def apply_failure_policy(requests: DataFrame, chosen: DataFrame, on: str, policy: str = "drop") -> DataFrame:
    """``drop``: failed requests vanish; ``null``: kept with NULL answer; ``fail``: look first and raise;
    ``fail_in_plan``: no look first, the join itself raises when it meets a failed request."""
    if policy == "drop":
        return requests.join(chosen, on)
    if policy == "null":
        return requests.join(chosen, on, "left")
    if policy == "fail":
        if not requests.join(chosen, on, "left_anti").isEmpty():
            raise RuntimeError("generation failed for at least one request")
        return requests.join(chosen, on)
    if policy == "fail_in_plan":
        answers = [c for c in chosen.columns if c != on]
        both = requests.join(chosen.select(on, F.struct(F.lit(0).alias("_"), *answers).alias("_answer")), on, "left")
        lost = F.when(F.col("_answer").isNull(), F.raise_error(F.lit("generation failed for at least one request")).cast("int")).otherwise(0)
        # the answers depend on the check, so no plan can leave it out
        return both.select(*requests.columns, *[F.when(lost == 0, F.col(f"_answer.`{c}`")).alias(c) for c in answers])
    raise ValueError(f"unknown failure policy {policy!r}")


# R5 -------------------------------------------------------------------------------------
def call_model(prompts: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The user hook: ``fn`` maps a pandas batch of prompts to a batch of responses.

    It runs inside the executors on Arrow batches (``mapInPandas``), so client batching,
    rate limits and retries are the user's code; the result is an ordinary table.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return prompts.mapInPandas(run, schema)
