"""Probability calibration against human truth (K1-K9).

Training pairs are first pooled by equal probability.  Platt parameters of all labels are
found together, one aggregation per Newton step.  Isotonic levels are pooled (pool adjacent
violators) in ranges of probability in parallel; the ranges are moved and pooled again until no two
neighbours violate the order (pooling in pieces gives the same levels), so neither the pairs nor the
levels of a label meet in one task.

Fitted parameters are a long table of segments, one row a knot: ``(key, method, x, y, x1, y1, coef,
intercept)`` with the next knot beside each.  :func:`as_arrays` gathers it to one row a key for files.
Applied with column expressions: Platt is a sigmoid, isotonic a linear interpolation between knots,
constant outside them.  Few knots are broadcast and found by bisection; beyond
:data:`BROADCAST_KNOTS` probabilities and knots are merged by range (:mod:`corpusforge.operators.asof`).
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import pandas as pd
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators.asof import asof_backward
from corpusforge.session import cut_lineage, written

# Knots of all keys together up to which they are broadcast (16 bytes each and once a key).
BROADCAST_KNOTS = 100_000

PARAMS_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("x", T.ArrayType(T.DoubleType())),
    T.StructField("y", T.ArrayType(T.DoubleType())),
    T.StructField("coef", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
])

SEGMENTS = ["key", "method", "x", "y", "x1", "y1", "coef", "intercept"]
_SEGMENTS_DDL = "key string, method string, x double, y double, x1 double, y1 double, coef double, intercept double"


# K1 -------------------------------------------------------------------------------------
_UNPAIRED = "a prediction or a truth has no partner of the same key"


def pair_with_truth(preds: DataFrame, truth: DataFrame, on: list[str], check: bool | str = True) -> DataFrame:
    """Inner join predictions and truths on their key; both sides must have the same keys once.

    ``check=True`` looks first and raises ``ValueError``.  ``check="plan"`` costs no job: the join
    groups both sides by the key it joins on anyway and raises when it meets a wrong one (see
    :func:`pairing_errors`).
    """
    if check == "plan":
        return _checked_join(preds, truth, on)
    if check:
        for name, df in (("predictions", preds), ("truths", truth)):
            dup = df.groupBy(*on).count().filter("count > 1")
            if not dup.isEmpty():
                raise ValueError(f"{name} have duplicate keys")
        if preds.join(truth, on, "left_anti").limit(1).count() or truth.join(preds, on, "left_anti").limit(1).count():
            raise ValueError(_UNPAIRED)
    return preds.join(truth, on)


def _checked_join(preds: DataFrame, truth: DataFrame, on: list[str]) -> DataFrame:
    sides = []
    for df, tag in ((preds, "p"), (truth, "t")):
        rest = [c for c in df.columns if c not in on]
        sides.append(df.groupBy(*on).agg(F.count(F.lit(1)).alias(f"_n{tag}"),
                                         F.first(F.struct(F.lit(0).alias("_"), *rest)).alias(f"_{tag}")))
    both = sides[0].join(sides[1], on, "full")
    right = (F.when(F.col("_np").isNull() | F.col("_nt").isNull(), F.raise_error(F.lit(_UNPAIRED)))
             .when(F.col("_np") > 1, F.raise_error(F.lit("predictions have duplicate keys")))
             .when(F.col("_nt") > 1, F.raise_error(F.lit("truths have duplicate keys"))).otherwise(F.lit(0)))
    # the values themselves depend on the check, so no plan can leave it out
    return both.select(*on, *[F.when(right.cast("int") == 0, F.col(f"_{tag}.`{c}`")).alias(c)
                              for df, tag in ((preds, "p"), (truth, "t")) for c in df.columns if c not in on])


@contextmanager
def pairing_errors():
    """Turn the errors of ``check="plan"`` into ``ValueError`` around the action that meets them."""
    try:
        yield
    except PySparkException as e:
        for text in (_UNPAIRED, "predictions have duplicate keys", "truths have duplicate keys"):
            if text in str(e):
                raise ValueError(text) from e
        raise


# K2 / K3 --------------------------------------------------------------------------------
def truth_value(c: Column) -> Column:
    """Number or boolean -> 0/1-like integer, rounded half-to-even."""
    return F.bround(c.cast("double"), 0).cast("int")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def overall_truth(truth: DataFrame, keys: list[str]) -> Column:
    """K2: the first of ``keys`` that is a number or boolean and not NULL; columns of any other
    type (texts above all) are no truths."""
    cols = [truth_value(F.col(k)) for k in keys if k in truth.columns and _is_number(truth.schema[k].dataType)]
    return F.coalesce(*cols) if cols else F.lit(None).cast("int")


def variant_number(v: Column) -> Column:
    """A JSON number or boolean of a variant as a double; texts and everything else are NULL."""
    kind = F.schema_of_variant(v)
    return F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).when(
        kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), F.try_variant_get(v, "$", "double"))


def label_truth_long(truth: DataFrame, id_col: str, labels_col: str = "labels",
                     fallback_col: str = "truth") -> DataFrame:
    """K3: ``labels`` map, or ``truth`` map when ``labels`` is empty/absent -> ``(id, label, y)``."""
    m = F.col(labels_col) if labels_col in truth.columns else F.lit(None)
    if fallback_col in truth.columns:
        m = F.when(m.isNull() | (F.size(m) == 0), F.col(fallback_col)).otherwise(m)
    long = truth.select(id_col, F.explode_outer(m).alias("label", "_v")).filter(F.col("label").isNotNull())
    kind = long.schema["_v"].dataType
    y = truth_value(variant_number(F.col("_v"))) if isinstance(kind, T.VariantType) else (
        truth_value(F.col("_v")) if _is_number(kind) else F.lit(None).cast("int"))
    return long.select(id_col, "label", y.alias("y")).filter(F.col("y").isNotNull())


# K4-K6 ----------------------------------------------------------------------------------
def fit_segments(pairs: DataFrame, keys: list[str], *, key_col: str = "label", p_col: str = "p", y_col: str = "y",
                 method: str = "isotonic") -> DataFrame:
    """Fit one calibrator per key of ``keys``; identity when a key has no pairs or a single class.

    ``y`` is 0 or 1.  The number of jobs does not depend on the number of keys.  The result is the
    long table of segments.
    """
    spark = pairs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(k,) for k in dict.fromkeys(keys)], "key string"))
    pooled = cut_lineage(pairs.select(F.col(key_col).alias("key"), F.col(p_col).cast("double").alias("x"),
                                      F.col(y_col).cast("double").alias("y")).dropna().join(wanted, "key")
                         .groupBy("key", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    usable = pooled.groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).filter("s > 0 and s < n")
    fitted = _fit_platt(pooled, usable) if method == "platt" else _fit_isotonic(pooled, usable)
    rest = wanted.join(fitted.select("key").distinct(), "key", "left_anti").select("key", F.lit("identity").alias("method"))
    shape = spark.createDataFrame([], _SEGMENTS_DDL)
    return cut_lineage(shape.unionByName(fitted, allowMissingColumns=True).unionByName(rest, allowMissingColumns=True))


def as_arrays(segments: DataFrame) -> DataFrame:
    """One row a key (:data:`PARAMS_SCHEMA`), its knots as arrays: the form of parameter files."""
    knots = F.array_sort(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("x", "y"))))
    one = segments.groupBy("key").agg(F.first("method").alias("method"), knots.alias("_k"), F.first("coef").alias("coef"),
                                      F.first("intercept").alias("intercept"))
    has = F.col("method") == "isotonic"
    return one.select("key", "method", F.when(has, F.col("_k.x")).alias("x"), F.when(has, F.col("_k.y")).alias("y"),
                      "coef", "intercept")


def as_segments(params: DataFrame) -> DataFrame:
    """The long table of parameters in either form."""
    if "x1" in params.columns:
        return params.select(*SEGMENTS)
    knot = F.posexplode_outer(F.arrays_zip(F.col("x").alias("x"), F.col("y").alias("y")))
    long = params.select("key", "method", "coef", "intercept", "x", "y", knot.alias("_i", "_k"))
    nxt = lambda c: F.get(F.col(c), F.col("_i") + 1)
    return long.select("key", "method", F.col("_k.x").alias("x"), F.col("_k.y").alias("y"), nxt("x").alias("x1"), nxt("y").alias("y1"),
                       "coef", "intercept")


def fit(pairs: DataFrame, keys: list[str], *, key_col: str = "label", p_col: str = "p", y_col: str = "y",
        method: str = "isotonic") -> DataFrame:
    """:func:`fit_segments`, gathered to one row a key."""
    return cut_lineage(as_arrays(fit_segments(pairs, keys, key_col=key_col, p_col=p_col, y_col=y_col, method=method)))


def _fit_platt(pooled: DataFrame, usable: DataFrame, rounds: int = 100, tol: float = 1e-11) -> DataFrame:
    """Logistic regression on the raw probability with an L2 penalty (C = 1) on the slope only:
    Newton steps for all keys at once, one aggregation a step."""
    spark = pooled.sparkSession
    at = {r["key"]: (0.0, 0.0) for r in usable.select("key").collect()}       # at most the asked keys
    for _ in range(rounds if at else 0):
        state = F.broadcast(spark.createDataFrame([(k, w, b) for k, (w, b) in at.items()], "key string, w double, b double"))
        q = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("w") * F.col("x") + F.col("b"))))
        d = pooled.join(state, "key").withColumn("q", q).withColumn("g", F.col("n") * F.col("q") - F.col("s")) \
            .withColumn("h", F.col("n") * F.col("q") * (1 - F.col("q")))
        moved = 0.0
        for r in d.groupBy("key").agg(F.sum(F.col("g") * F.col("x")).alias("gw"), F.sum("g").alias("gb"),
                                      F.sum(F.col("h") * F.col("x") * F.col("x")).alias("ww"),
                                      F.sum(F.col("h") * F.col("x")).alias("wb"), F.sum("h").alias("bb")).collect():
            w, b = at[r["key"]]
            gw, ww = r["gw"] + w, r["ww"] + 1.0
            det = ww * r["bb"] - r["wb"] ** 2
            dw, db = (r["bb"] * gw - r["wb"] * r["gb"]) / det, (ww * r["gb"] - r["wb"] * gw) / det
            at[r["key"]] = (w - dw, b - db)
            moved = max(moved, abs(dw), abs(db))
        if not moved > tol:
            break
    bad = [k for k, (w, b) in at.items() if not (math.isfinite(w) and math.isfinite(b))]
    if bad:
        raise ValueError(f"the Platt fit does not converge for {bad}")
    return spark.createDataFrame([(k, "platt", w, b) for k, (w, b) in at.items()],
                                 "key string, method string, coef double, intercept double")


def _pool(levels: list[list], level: list) -> None:
    """Add a level ``[lo, hi, n, s]`` to the right of ``levels`` and pool while the order is violated; equal
    means are pooled too.  Counts are whole numbers, so means are compared exactly."""
    while levels and levels[-1][3] * level[2] >= level[3] * levels[-1][2]:
        before = levels.pop()
        level = [before[0], level[1], before[2] + level[2], before[3] + level[3]]
    levels.append(level)


_LEVELS_DDL = "key string, lo double, hi double, n double, s double, next_lo double, next_y double, part int"


def _pool_ranges(batches):
    """Pooled levels of one range partition; a key may come in several batches, a batch hold several keys."""
    part, key, levels = TaskContext.get().partitionId(), None, []

    def done() -> pd.DataFrame:
        rows = [(key, lo, hi, float(n), float(s), *((levels[i + 1][0], levels[i + 1][3] / levels[i + 1][2])
                                                    if i + 1 < len(levels) else (None, None)), part)
                for i, (lo, hi, n, s) in enumerate(levels)]
        out = pd.DataFrame(rows, columns=["key", "lo", "hi", "n", "s", "next_lo", "next_y", "part"])
        return out.astype({"next_lo": "float64", "next_y": "float64"})
    for pdf in batches:
        for k, lo, hi, n, s in pdf[["key", "lo", "hi", "n", "s"]].itertuples(index=False):
            if k != key:
                if levels:
                    yield done()
                key, levels = k, []
            _pool(levels, [lo, hi, int(n), int(s)])
    if levels:
        yield done()


def _fit_isotonic(pooled: DataFrame, usable: DataFrame) -> DataFrame:
    """Segments of the least-squares non-decreasing step function of every key."""
    cur = pooled.join(F.broadcast(usable.select("key")), "key").select(     # at most the asked keys
        "key", F.col("x").alias("lo"), F.col("x").alias("hi"), F.col("n").cast("double"), "s")
    order, parts = ["key", "lo"], None
    while True:
        dealt = cur.repartitionByRange(*order) if parts is None else cur.repartitionByRange(parts, *order)
        levels = written(dealt.sortWithinPartitions(*order).mapInPandas(_pool_ranges, _LEVELS_DDL))
        level = F.struct("lo", "n", "s")
        ends = written(levels.groupBy("key", "part").agg(F.min_by(level, "lo").alias("first"), F.max_by(level, "lo").alias("last"))
                           .withColumn("next", F.lead("first").over(Window.partitionBy("key").orderBy("part"))))
        whole = lambda c: F.col(c).cast("decimal(19,0)")
        if ends.where(whole("last.s") * whole("next.n") >= whole("next.s") * whole("last.n")).isEmpty():
            break
        # fewer ranges: every old end but a few comes to lie inside a range
        parts = max(1, (ends.agg(F.max("part")).first()[0] + 1) * 2 // 3)
        cur = levels.select("key", "lo", "hi", "n", "s")
    # the last level of a range has its neighbour in the next one; at most one row a key and range
    after = F.broadcast(ends.where("next is not null").select("key", "part", F.col("next.lo").alias("_lo"),
                                                              (F.col("next.s") / F.col("next.n")).alias("_y")))
    y = (F.col("s") / F.col("n")).alias("y")
    full = levels.join(after, ["key", "part"], "left").select(
        "key", "lo", "hi", y, F.coalesce("next_lo", "_lo").alias("x1"), F.coalesce("next_y", "_y").alias("y1"))
    ends_at = F.struct(F.col("hi").alias("x"), "y", "x1", "y1")
    knots = F.when(F.col("lo") == F.col("hi"), F.array(ends_at)).otherwise(
        F.array(F.struct(F.col("lo").alias("x"), "y", F.col("hi").alias("x1"), F.col("y").alias("y1")), ends_at))
    return full.select("key", F.explode(knots).alias("k")).select("key", F.lit("isotonic").alias("method"), "k.*")


# K7 -------------------------------------------------------------------------------------
def _bisect(v: Column, xs: Column) -> Column:
    """Position (from 1) of the last of the ascending ``xs`` at or below ``v``; 1 where there is none."""
    size = F.size(xs)
    begin = F.struct(F.lit(1).alias("lo"), size.alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.ceil((acc["lo"] + acc["hi"]) / 2).cast("int")
        go = F.element_at(xs, mid) <= v
        return F.struct(F.when(go, mid).otherwise(acc["lo"]).alias("lo"),
                        F.when(go, acc["hi"]).otherwise(F.greatest(acc["lo"], mid - 1)).alias("hi"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size.cast("double") + 1)).cast("int"))
    return F.aggregate(steps, begin, halve)["lo"]


def _calibrated(v: Column, seg: str) -> Column:
    """The value of the segment struct ``seg`` at ``v``; NULL where it holds no model."""
    f = lambda c: F.col(f"{seg}.{c}")
    platt = F.lit(1.0) / (F.lit(1.0) + F.exp(-(f("coef") * v + f("intercept"))))
    flat = f("x1").isNull() | (v <= f("x"))
    iso = F.when(flat, f("y")).otherwise(f("y") + (v - f("x")) * (f("y1") - f("y")) / (f("x1") - f("x")))
    model = F.when(f("method") == "platt", platt).when(f("method") == "isotonic", iso)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), model))


def apply(probs: DataFrame, params: DataFrame, *, key_col: str = "label", p_col: str = "p",
          out: str | None = None, broadcast_knots: int | None = None) -> DataFrame:
    """Calibrate a long ``(…, key, p)`` table; keys without a model pass through unchanged.

    ``params`` has either form.  The knots are counted: up to ``broadcast_knots`` (default
    :data:`BROADCAST_KNOTS`) they are broadcast, one row a key, and every probability finds its
    segment by bisection, without any shuffle; more of them are merged with the probabilities by range.
    Both give the same values.
    """
    out = out or p_col
    limit = BROADCAST_KNOTS if broadcast_knots is None else broadcast_knots
    segments = written(as_segments(params).where("method in ('platt', 'isotonic')"))
    v = F.col(p_col).cast("double")
    keep = [F.col(f"`{c}`") for c in probs.columns if c != out]
    if segments.count() <= limit:
        table = segments.groupBy(F.col("key").alias("_key")).agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("x", F.lit(0.0)).alias("x"), "y", "x1", "y1", "method", "coef",
                                                 "intercept"))).alias("_segs"))
        table = table.withColumn("_xs", F.col("_segs.x"))             # at most `limit` knots in all
        j = probs.join(F.broadcast(table), F.col(key_col) == F.col("_key"), "left")
        # the place, then the segment, each in a projection of its own: computed once a row
        j = j.withColumn("_at", _bisect(v, F.col("_xs"))).withColumn("_seg", F.element_at("_segs", F.col("_at")))
    else:
        first = segments.groupBy("key", "method").agg(F.min_by("y", "x").alias("y"), F.first("coef").alias("coef"),
                                                      F.first("intercept").alias("intercept"))
        none = F.lit(None).cast("double")                 # constant below the first knot
        below = first.select("key", "method", F.lit(float("-inf")).alias("x"), "y", none.alias("x1"), none.alias("y1"), "coef", "intercept")
        knots = segments.where("method = 'isotonic'").unionByName(below).withColumnRenamed("key", "_key")
        named = probs.withColumns({"_key": F.col(key_col), "_v": v})
        j = asof_backward(named, knots, by="_key", on="_v", right_on="x").withColumnRenamed("asof", "_seg")
    value = _calibrated(v, "_seg")
    res = F.when(F.col("_seg").isNotNull() & v.isNotNull(), value).otherwise(F.col(p_col))
    return j.select(*keep, res.alias(out))


# K8 -------------------------------------------------------------------------------------
def calibration_mark(enabled: bool, params_path: str | None, path_exists: bool,
                     version: str | None = None, method: str | None = None) -> tuple[bool, str | None]:
    """(applied, version) recorded on every judgment."""
    hint = version or method or None
    if not enabled:
        return False, None
    if not params_path or not path_exists:
        return False, hint
    stem = params_path.rstrip("/").split("/")[-1].split(".")[0]
    return True, hint or stem


def mark(df: DataFrame, applied: bool, version: str | None, struct_col: str | None = None) -> DataFrame:
    """Set ``calibration_applied`` / ``calibration_version`` (inside ``struct_col`` if given)."""
    if struct_col:
        c = F.col(struct_col).withField("calibration_applied", F.lit(applied))
        if version:
            c = c.withField("calibration_version", F.lit(version))
        return df.withColumn(struct_col, c)
    df = df.withColumn("calibration_applied", F.lit(applied))
    return df.withColumn("calibration_version", F.lit(version)) if version else df


# S5 -------------------------------------------------------------------------------------
def save_params(params: DataFrame, path: str) -> None:
    params.coalesce(1).write.mode("overwrite").json(path)


def load_params(spark, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).json(path)


_OBJECT = "map<string,struct<method:string,x:array<double>,y:array<double>,coef:array<double>,intercept:array<double>>>"


def save_params_object(params: DataFrame, path: str) -> None:
    """One JSON object keyed by label: ``{label: {method, x, y}}`` or ``{method, coef: [..], intercept: [..]}``."""
    arrays = as_arrays(params) if "x1" in params.columns else params
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(F.col(c)))
    model = F.struct("method", "x", "y", one("coef").alias("coef"), one("intercept").alias("intercept"))
    whole = arrays.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", model.alias("model"))))).alias("m"))
    whole.select(F.to_json("m").alias("value")).coalesce(1).write.mode("overwrite").text(path)   # one row a key


def load_params_object(spark, path: str) -> DataFrame:
    """Parameters from such an object (also one written by hand, on several lines)."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", _OBJECT, {"mode": "FAILFAST"})).alias("key", "m"))
    return rows.select("key", F.coalesce("m.method", F.lit("identity")).alias("method"), "m.x", "m.y", F.get("m.coef", F.lit(0)).alias("coef"),
                       F.get("m.intercept", F.lit(0)).alias("intercept"))


# K9 -------------------------------------------------------------------------------------
def calibrate(preds: DataFrame, truth: DataFrame, keys: list[str], *, on: list[str], method: str = "isotonic",
              key_col: str = "label", p_col: str = "p", y_col: str = "y") -> tuple[DataFrame, DataFrame]:
    """Fit on (predictions x truth) and calibrate the predictions: ``(calibrated, segments)``."""
    with pairing_errors():
        pairs = pair_with_truth(preds, truth, on + [key_col], check="plan")
        params = fit_segments(pairs, keys, key_col=key_col, p_col=p_col, y_col=y_col, method=method)
    return apply(preds, params, key_col=key_col, p_col=p_col), params
