"""Reproducible train / val / test splits.

The original shuffles a list with a seeded RNG and then slices it.  Here the shuffle order
is the portable hash ``(h(row_id, seed), row_id)``.  "The first k rows of the shuffle" is
answered without a global sort or an unpartitioned window: :func:`kth_keys` finds the
k-th smallest key per group by radix selection (rounds over 12-bit digits of the key, four
for the 48-bit hash).  Each round is one aggregation whose per-group output is at most 4096
rows, so no task ever holds a whole group, whatever the skew; every size takes this path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions.hashing import hash48
from corpusforge.session import cut_lineage

_DIGIT_BITS = 12
_MASK = (1 << _DIGIT_BITS) - 1
_CONST = "_grp"


def shuffle_key(row_id, seed: int = 42) -> Column:
    """Position of a row in the seeded shuffle (ties broken by ``row_id``)."""
    return hash48(row_id, "split", seed)


_MAX_GROUPS = 100_000


def kth_keys(df: DataFrame, group_cols: list[str], k: DataFrame | int, key: str = "key",
             tie: str = "row_id", key_bits: int = 48) -> DataFrame:
    """Per group, the ``(key, tie)`` of the k-th smallest row (1-based).

    ``k`` is an int (same for all groups) or a DataFrame ``(group_cols..., k)``.  Groups with
    ``k <= 0`` are absent from the result; groups with fewer than ``k`` rows get
    ``key = NULL`` meaning "every row qualifies".  ``key`` must be a non-null, non-negative
    BIGINT below ``2**key_bits`` (anything else raises), ``tie`` unique within a group.
    Groups are few (labels): the per-group state lives on the driver (its size is checked)
    and is broadcast back.
    """
    spark = df.sparkSession
    groups = list(group_cols)
    if not groups:
        df = df.withColumn(_CONST, F.lit(0))
        groups = [_CONST]
    if isinstance(k, int):
        want = spark.range(1).select(F.lit(0).alias(_CONST), F.lit(k).cast("bigint").alias("k")) \
            if not group_cols else df.select(*groups).distinct().withColumn("k", F.lit(k).cast("bigint"))
    else:
        want = k.select(*groups, F.col("k").cast("bigint"))
    totals = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("keys"),
                                     F.min(key).alias("lo"), F.max(key).alias("hi"))
    state_rows = want.filter(F.col("k") > 0).join(totals, groups, "left").fillna(0, ["n", "keys"]) \
        .limit(_MAX_GROUPS + 1).collect()
    if len(state_rows) > _MAX_GROUPS:
        raise ValueError("kth_keys is meant for a small number of groups")
    for r in state_rows:
        if r["keys"] != r["n"] or (r["n"] and (r["lo"] < 0 or r["hi"] >= 1 << key_bits)):
            raise ValueError(f"keys must be non-null and lie in [0, 2**{key_bits})")
    gschema = want.select(*groups).schema
    out_schema = T.StructType(gschema.fields + [T.StructField(key, T.LongType()),
                                                T.StructField(tie, df.schema[tie].dataType)])
    short = [tuple(r[g] for g in groups) + (None, None) for r in state_rows if r["k"] > r["n"]]
    live = [r for r in state_rows if r["k"] <= r["n"]]
    found = spark.createDataFrame(short, out_schema)
    if live:
        found = found.unionByName(_radix_select(df, groups, live, gschema, key, tie, key_bits))
    if not group_cols:
        found = found.drop(_CONST)
    return found


def _radix_select(df, groups, live, gschema, key, tie, key_bits):
    spark = df.sparkSession
    st_schema = T.StructType(gschema.fields + [T.StructField("k", T.LongType()), T.StructField("prefix", T.LongType())])
    state = [tuple(r[g] for g in groups) + (r["k"], 0) for r in live]
    order = Window.partitionBy(*groups).orderBy("digit")
    digits = -(-key_bits // _DIGIT_BITS)
    for level in range(digits):
        shift = _DIGIT_BITS * (digits - 1 - level)
        cand = df.join(F.broadcast(spark.createDataFrame(state, st_schema)), groups)
        if level:            # the first digit has nothing above it
            cand = cand.filter(F.shiftright(F.col(key), shift + _DIGIT_BITS) == F.col("prefix"))
        hist = cand.groupBy(*groups, (F.shiftright(F.col(key), shift).bitwiseAND(_MASK)).alias("digit"),
                            "k", "prefix").agg(F.count(F.lit(1)).alias("c"))
        hist = hist.withColumn("cum", F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        picked = hist.filter((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("c") < F.col("k"))).select(
            *groups, (F.col("k") - (F.col("cum") - F.col("c"))).alias("k"),
            (F.shiftleft(F.col("prefix"), _DIGIT_BITS) + F.col("digit")).alias("prefix")).collect()
        if len(picked) != len(state):
            raise RuntimeError("the input changed between the rounds of a selection")
        state = [tuple(r[g] for g in groups) + (r["k"], r["prefix"]) for r in picked]
    st = F.broadcast(spark.createDataFrame(state, st_schema))
    # rows with exactly this key: tiny (hash collisions), ordered by the tie column
    exact = df.join(st, groups).filter(F.col(key) == F.col("prefix"))
    w = Window.partitionBy(*groups).orderBy(tie)
    return exact.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == F.col("k")) \
        .select(*groups, F.col(key), F.col(tie))


def _rank_le(key_c: Column, tie_c: Column, tk: Column, tt: Column) -> Column:
    return tk.isNull() | (key_c < tk) | ((key_c == tk) & (tie_c <= tt))


def first_k_threshold(df: DataFrame, k: int, key: str = "key", tie: str = "row_id", key_bits: int = 48):
    """Group-less :func:`kth_keys` fetched as one driver-side row: ``None`` if k <= 0,
    ``(None, None)`` if there are fewer than k rows, else the k-th ``(key, tie)``."""
    if k <= 0:
        return None
    row = kth_keys(df, [], k, key, tie, key_bits).first()
    if row is None:
        raise RuntimeError("the k-th row was not found")
    return row[key], row[tie]


def rank_within(thr, key_c: Column, tie_c: Column) -> Column:
    """Predicate "(key_c, tie_c) is among the first k" for a :func:`first_k_threshold` value."""
    if thr is None:
        return F.lit(False)
    if thr[0] is None:
        return F.lit(True)
    return _rank_le(key_c, tie_c, F.lit(thr[0]), F.lit(thr[1]))


def within_first_k(df: DataFrame, group_cols: list[str], k, key: str = "key",
                   tie: str = "row_id", key_bits: int = 48) -> DataFrame:
    """Rows of ``df`` whose rank in ``(key, tie)`` order within their group is <= k."""
    if not group_cols:
        return df.filter(rank_within(first_k_threshold(df, int(k), key, tie, key_bits), F.col(key), F.col(tie)))
    thr = kth_keys(df, group_cols, k, key, tie, key_bits).withColumnRenamed(key, "_tk").withColumnRenamed(tie, "_tt")
    j = df.join(F.broadcast(thr), group_cols)
    return j.filter(_rank_le(F.col(key), F.col(tie), F.col("_tk"), F.col("_tt"))).drop("_tk", "_tt")


def random_split(df: DataFrame, row_id: str = "row_id", *, val_ratio: float = 0.15,
                 test_ratio: float = 0.15, seed: int = 42, split_col: str = "split") -> DataFrame:
    """The first int(n*test) rows of the shuffle are test, the next int(n*val) val.

    Only two thresholds travel to the driver; the split itself is a narrow ``when``."""
    base = cut_lineage(df.select(F.col(row_id).alias("row_id"),
                                 shuffle_key(F.col(row_id), seed).alias("key")))
    n = base.count()
    n_test, n_val = int(n * test_ratio), int(n * val_ratio)
    thr_test = first_k_threshold(base, n_test)
    thr_head = first_k_threshold(base, n_test + n_val)
    key_c, tie_c = shuffle_key(F.col(row_id), seed), F.col(row_id)
    return df.withColumn(split_col, F.when(rank_within(thr_test, key_c, tie_c), "test")
                         .when(rank_within(thr_head, key_c, tie_c), "val").otherwise("train"))


def positives_long(probs: DataFrame, labels: list[str] | None, threshold: float = 0.5) -> DataFrame:
    """``(row_id, label)`` for every label with ``p >= threshold`` (long-form input)."""
    out = probs.filter(F.col("p") >= threshold)
    if labels is not None:
        out = out.filter(F.col("label").isin(list(labels)))
    return out.select("row_id", "label")


def targets_from_positives(pos: DataFrame, labels: list[str], *, val_ratio: float = 0.15,
                           test_ratio: float = 0.15) -> DataFrame:
    """X3 on positives ``(row_id, label)``: ``positives``, ``max(1, int(pos*ratio))`` targets."""
    spark = pos.sparkSession
    lab = spark.createDataFrame([(x,) for x in labels], "label string")
    cnt = pos.groupBy("label").agg(F.count(F.lit(1)).alias("positives"))
    cnt = F.broadcast(lab).join(cnt, "label", "left").fillna(0, ["positives"])
    return cnt.select(
        "label", "positives",
        F.greatest(F.lit(1), F.floor(F.col("positives") * F.lit(val_ratio))).cast("bigint").alias("target_val"),
        F.greatest(F.lit(1), F.floor(F.col("positives") * F.lit(test_ratio))).cast("bigint").alias("target_test"))


def label_targets(probs: DataFrame, labels: list[str], *, val_ratio: float = 0.15,
                  test_ratio: float = 0.15, threshold: float = 0.5) -> DataFrame:
    """Per label ``positives`` (p >= threshold) and the val / test targets."""
    return targets_from_positives(positives_long(probs, labels, threshold), labels,
                                  val_ratio=val_ratio, test_ratio=test_ratio)


def stratified_split(rows: DataFrame, probs: DataFrame, labels: list[str], *, row_id: str = "row_id",
                     has_labels: str | None = None, val_ratio: float = 0.15, test_ratio: float = 0.15,
                     seed: int = 42, threshold: float = 0.5, split_col: str = "split") -> DataFrame:
    """Exact closed form of the sequential multi-label assignment.

    A row needs test iff one of its positive labels has not reached its test target among
    earlier rows of the shuffle, i.e. its rank among that label's positives is <= target.
    Test takes the first int(n*test) such rows; val repeats the rule over the remaining
    rows.  Rows without label probabilities (``has_labels`` false) stay in train.
    """
    keyed = rows.select(F.col(row_id).alias("row_id"),
                        *([F.col(has_labels).alias("_has")] if has_labels else [F.lit(True).alias("_has")]))
    keyed = cut_lineage(keyed.withColumn("key", shuffle_key(F.col("row_id"), seed)))
    n = keyed.count()
    n_test, n_val = int(n * test_ratio), int(n * val_ratio)
    eligible = keyed.filter("_has").select("row_id", "key")
    pos = cut_lineage(positives_long(probs, labels, threshold).join(eligible, "row_id"))
    targets = F.broadcast(cut_lineage(
        targets_from_positives(pos, labels, val_ratio=val_ratio, test_ratio=test_ratio)))

    def assign(pos_df: DataFrame, target_col: str, cap: int) -> DataFrame:
        if cap <= 0:
            return pos_df.select("row_id").limit(0)
        k = targets.select("label", F.col(target_col).alias("k"))
        need = cut_lineage(within_first_k(pos_df, ["label"], k).select("row_id", "key").distinct())
        return within_first_k(need, [], cap).select("row_id")

    test = cut_lineage(assign(pos, "target_test", n_test))
    pos_rest = pos.join(test, "row_id", "left_anti")
    val = assign(pos_rest, "target_val", n_val)
    tagged = (rows.join(test.select(F.col("row_id").alias(row_id), F.lit("test").alias("_t")), row_id, "left")
              .join(val.select(F.col("row_id").alias(row_id), F.lit("val").alias("_v")), row_id, "left"))
    return tagged.withColumn(split_col, F.coalesce("_t", "_v", F.lit("train"))).drop("_t", "_v")


def split_report(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def split_rates(df: DataFrame, probs: DataFrame, *, row_id: str, split_col: str = "split", threshold: float = 0.5) -> DataFrame:
    """``(split, label, n_judged, n_positive, positive_rate)`` by split and label, by label (split NULL)
    and by split (label NULL), in one pass of grouping sets over the judgments ``probs(row_id, label, p)``."""
    y = F.when(F.col("p") >= threshold, 1).otherwise(0)
    rows = df.select(F.col(row_id).alias("row_id"), F.col(split_col).alias("split")).join(
        probs.select("row_id", "label", y.alias("y")), "row_id")
    by = [F.col("split"), F.col("label")]
    return rows.groupingSets([by, [F.col("label")], [F.col("split")]], *by).agg(
        F.count(F.lit(1)).alias("n_judged"), F.sum("y").cast("bigint").alias("n_positive"), F.avg("y").alias("positive_rate"))
