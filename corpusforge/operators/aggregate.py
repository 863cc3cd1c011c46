"""Aggregation of repeated judge samples and of several judges.

Everything works on *long* tables: one row per (row, [judge,] sample, key).  A key that a
sample lacks is simply an absent row or a NULL value, which is exactly the "aggregate over
the samples that have it" rule (A6).  All aggregations are plain ``groupBy().agg()`` with
map-side partial aggregation; the per-group work is bounded by samples x items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _clamp(x: Column, minimum=None, maximum=None) -> Column:
    if minimum is not None:
        x = F.greatest(x, F.lit(float(minimum)))
    if maximum is not None:
        x = F.least(x, F.lit(float(maximum)))
    return x


# A1 / A2 --------------------------------------------------------------------------------
def aggregate_numeric(samples: DataFrame, keys: list[str], value: str, *, how: str = "mean",
                      minimum=None, maximum=None, integer: bool = False, out: str = "value") -> DataFrame:
    """``median`` if asked, any other name = mean; clamp to [minimum, maximum]; integers are
    rounded half-to-even.  NULL values (absent keys) are ignored."""
    v = F.col(value).cast("double")
    agg = F.median(v) if how.lower() == "median" else F.avg(v)
    raw = samples.groupBy(*keys).agg(agg.alias("_raw")).filter(F.col("_raw").isNotNull())
    # clamp after the NULL filter: greatest/least skip NULLs and would invent a value
    res = _clamp(F.col("_raw"), minimum, maximum)
    res = F.bround(res, 0).cast("bigint") if integer else res
    return raw.select(*keys, res.alias(out))


# A3 -------------------------------------------------------------------------------------
def aggregate_array_union(samples: DataFrame, keys: list[str], array_col: str, order_col: str,
                          max_items: int | None = None, out: str = "items") -> DataFrame:
    """Union of the sample arrays in first-seen order (sample order, then position); samples
    whose arrays are all empty give an empty list, a key without any array gives no row."""
    groups = samples.filter(F.col(array_col).isNotNull()).select(*keys).distinct()
    items = samples.select(*keys, order_col, F.posexplode_outer(array_col).alias("_pos", "_item")) \
        .filter(F.col("_item").isNotNull())
    first = items.groupBy(*keys, "_item").agg(F.min(F.struct(order_col, "_pos")).alias("_first"))
    merged = first.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_first"), F.col("_item")))).alias("_l"))
    res = F.transform("_l", lambda s: s["_item"])
    if max_items is not None:
        res = F.slice(res, 1, int(max_items))
    same = [groups[k].eqNullSafe(merged[k]) for k in keys]
    none = F.array().cast(samples.schema[array_col].dataType)
    return groups.join(merged, same, "left").select(*[groups[k] for k in keys], F.coalesce(res, none).alias(out))


# A4 -------------------------------------------------------------------------------------
def aggregate_bool_majority(samples: DataFrame, keys: list[str], value: str, out: str = "value") -> DataFrame:
    """True iff at least half of the samples are true (ties -> true)."""
    v = F.col(value)
    return samples.filter(v.isNotNull()).groupBy(*keys).agg(
        (F.sum(v.cast("int")) >= F.count(v) / F.lit(2.0)).alias(out))


# A5 -------------------------------------------------------------------------------------
def aggregate_last_nonempty(samples: DataFrame, keys: list[str], value: str, order_col: str,
                            out: str = "value") -> DataFrame:
    """Value of the last sample that is neither NULL nor empty; all empty -> the last value."""
    v = F.col(value)
    last_nonempty = F.max_by(F.when((v.isNotNull()) & (v != ""), v), F.when((v.isNotNull()) & (v != ""),
                                                                              F.col(order_col)))
    last_any = F.max_by(v, F.col(order_col))
    return samples.groupBy(*keys).agg(F.coalesce(last_nonempty, last_any).alias(out))


# A7-A10 ---------------------------------------------------------------------------------
def successful_judges(judgments: DataFrame, row_col: str, judge_no: str, ok_col: str | None = None,
                      on_all_failed: str = "raise") -> DataFrame:
    """A10: drop failed judges; a row whose every judge failed raises (or is dropped)."""
    ok = judgments if ok_col is None else judgments.filter(F.col(ok_col))
    if on_all_failed == "raise":
        lost = judgments.select(row_col).distinct().join(ok.select(row_col).distinct(), row_col, "left_anti")
        if not lost.isEmpty():
            raise ValueError("All judges failed for at least one row")
    return ok


def ensemble_mean(values: DataFrame, keys: list[str], judge_no: str, value: str,
                  out: str = "value") -> DataFrame:
    """Numeric keys -> mean over the judges that have the key."""
    return values.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias(out))


def ensemble_first(values: DataFrame, keys: list[str], judge_no: str, value: str,
                   out: str = "value") -> DataFrame:
    """A7/A8 for non-numeric keys: the value of the first judge (in judge order) having it."""
    return values.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min_by(value, judge_no).alias(out))


def first_judge_keys(values: DataFrame, row_keys: list[str], key_col: str, judge_no: str) -> DataFrame:
    """The values of the keys that a row's first judge has."""
    first = values.groupBy(*row_keys).agg(F.min(judge_no).alias("_fj"))
    keys = values.join(first, row_keys).filter(F.col(judge_no) == F.col("_fj")).select(*row_keys, key_col).distinct()
    return values.join(keys, row_keys + [key_col], "left_semi")


def ensemble_median(values: DataFrame, row_keys: list[str], key_col: str, judge_no: str, value: str,
                    nested: str = "median", out: str = "value", first_keys: bool = True) -> DataFrame:
    """Keys of the first judge only; numeric -> median over judges.

    ``nested="pick"`` reproduces the original treatment of the ``labels`` dict: it is not
    medianed but taken whole from the judge at index ``n // 2`` of the judges having it.
    ``first_keys=False`` takes ``values`` as restricted to the first judge's keys already.
    """
    v = values.filter(F.col(value).isNotNull())
    if first_keys:
        v = first_judge_keys(v, row_keys, key_col, judge_no)
    if nested == "pick":
        # index n//2 (0-based) among judges having the key, in judge order
        ranked = v.groupBy(*row_keys, key_col).agg(
            F.sort_array(F.collect_list(F.struct(judge_no, value))).alias("_l"))
        pick = F.element_at("_l", (F.floor(F.size("_l") / 2) + 1).cast("int"))[value]
        return ranked.select(*row_keys, key_col, pick.alias(out))
    return v.groupBy(*row_keys, key_col).agg(F.median(value).alias(out))


def ensemble_vote(values: DataFrame, row_keys: list[str], key_col: str, judge_no: str, value: str,
                  out: str = "value") -> DataFrame:
    """A9 numeric, for the first judge's keys: 1.0 iff strictly more than half of the judges that
    have the key say >= 0.5, else 0.0."""
    v = first_judge_keys(values.filter(F.col(value).isNotNull()), row_keys, key_col, judge_no)
    yes = F.count_if(F.col(value) >= 0.5) > F.count(value) / F.lit(2.0)
    return v.groupBy(*row_keys, key_col).agg(F.when(yes, F.lit(1.0)).otherwise(F.lit(0.0)).alias(out))


def ensemble_mode(values: DataFrame, row_keys: list[str], key_col: str, judge_no: str, value: str,
                  out: str = "value") -> DataFrame:
    """A9 non-numeric, for the first judge's keys: most common value; ties go to the value seen
    first (judge order)."""
    keys = [*row_keys, key_col]
    counts = first_judge_keys(values.filter(F.col(value).isNotNull()), row_keys, key_col, judge_no) \
        .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(judge_no).alias("_first"))
    best = counts.groupBy(*keys).agg(
        F.max(F.struct(F.col("_n"), (-F.col("_first")).alias("_neg"), F.col(value).alias("_v"))).alias("_b"))
    return best.select(*keys, F.col("_b._v").alias(out))


# A11 ------------------------------------------------------------------------------------
def judge_meta(samples: DataFrame, row_keys: list[str], sample_no: str, *, model: str,
               temperature: float, seed, aggregation: str) -> DataFrame:
    """Provenance per judged row; ``num_samples`` is the number of samples actually used."""
    return samples.groupBy(*row_keys).agg(F.countDistinct(sample_no).alias("num_samples")).select(
        *row_keys, F.struct(F.lit(model).alias("model"), F.lit(float(temperature)).alias("temperature"),
                            F.col("num_samples").cast("bigint").alias("num_samples"),
                            F.lit(seed).cast("bigint").alias("seed"),
                            F.lit(aggregation).alias("aggregation")).alias("judge_meta"))


# Keys copied from the generated part onto a judgment that lacks them.
_COPIED = ("prompt_id", "style_id", "seed", "response_schema_version")


def enrich_judgment(judgment: Column, fields: list[str], generated: Column, generated_fields: list[str]) -> Column:
    """The judgment struct with the prompt keys it lacks taken from the generated part and the
    calibration marks set to "not applied" where absent."""
    for name in _COPIED:
        given = generated.getField(name) if name in generated_fields else F.lit(None)
        own = judgment.getField(name) if name in fields else F.lit(None)
        if name in fields or name in generated_fields:
            judgment = judgment.withField(name, F.coalesce(own, given))
    applied = judgment.getField("calibration_applied") if "calibration_applied" in fields else F.lit(None).cast("boolean")
    return judgment.withField("calibration_applied", F.coalesce(applied, F.lit(False)))
