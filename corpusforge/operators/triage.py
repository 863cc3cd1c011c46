"""Label triage (T1-T5): confident learning per label, one-vs-rest.

Published method (Northcutt, Jiang, Chuang, JAIR 2021), per label task with classes {0, 1}:

* class threshold ``t_j`` = mean predicted probability of class j over rows *given* j;
* a row's confident class = the class with the largest ``p_j`` among those with ``p_j >= t_j``;
* confident joint ``C[i][j]`` counts rows given i, confidently j; it is calibrated so that
  every row sums to the number of rows given i;
* prune by noise rate: for i != j, flag the ``round(C_cal[i][j])`` rows given i with the
  largest margin ``p_j - p_i``.

A row is an issue if it is flagged for any label.  Everything is aggregation plus one
bounded top-k selection per (label, given class), so no task holds a whole class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.split import within_first_k
from corpusforge.session import cut_lineage

_SCALE = float(2 ** 46)


# T1 -------------------------------------------------------------------------------------
def hard_labels(probs: DataFrame, labels: list[str], *, id_col: str = "row_id", threshold: float = 0.5) -> DataFrame:
    """``(id, label, p, y)`` over every judged row x label; a missing label counts as p = 0."""
    rows = probs.select(id_col).distinct()
    grid = rows.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    p = grid.join(probs.select(id_col, "label", "p"), [id_col, "label"], "left") \
        .withColumn("p", F.coalesce(F.col("p").cast("double"), F.lit(0.0)))
    return p.withColumn("y", (F.col("p") >= threshold).cast("int"))


# T4 -------------------------------------------------------------------------------------
def detect_labels(probs: DataFrame, id_col: str = "row_id", every: bool = False) -> list[str]:
    """Label keys of the first row (smallest id) - the original auto-detection - or of all rows (``every``)."""
    if every:                                             # as many rows as labels
        return sorted(r[0] for r in probs.where("label is not null").select("label").distinct().collect())
    first = probs.agg(F.min(id_col)).first()[0]
    if first is None:
        return []
    return sorted(r[0] for r in probs.filter(F.col(id_col) == first).select("label").distinct().collect())


# T2 -------------------------------------------------------------------------------------
def find_label_issues(given: DataFrame, probs: DataFrame, *, id_col: str = "row_id",
                      engine: str = "confident_learning") -> DataFrame:
    """Rows whose given label looks wrong: ``(id, label)`` per flagged task.

    ``given``: ``(id, label, y)`` with y in {0, 1}; ``probs``: ``(id, label, p)`` = P(y = 1).
    Any other ``engine`` name skips triage (nothing flagged), as the original does.
    """
    if engine != "confident_learning":
        return given.sparkSession.createDataFrame([], f"{id_col} bigint, label string")
    d = given.select(id_col, "label", F.col("y").cast("int").alias("s")).join(
        probs.select(id_col, "label", F.col("p").cast("double").alias("p1")), [id_col, "label"])
    # used four times below (thresholds, joint, class sizes, candidates): materialise once
    d = cut_lineage(d.withColumn("p0", 1.0 - F.col("p1")))
    thr = d.groupBy("label").agg(
        F.avg(F.when(F.col("s") == 1, F.col("p1"))).alias("t1"),
        F.avg(F.when(F.col("s") == 0, F.col("p0"))).alias("t0"))
    d = d.join(F.broadcast(thr), "label")
    ok1 = F.col("t1").isNotNull() & (F.col("p1") >= F.col("t1"))
    ok0 = F.col("t0").isNotNull() & (F.col("p0") >= F.col("t0"))
    conf = (F.when(ok1 & ok0, F.when(F.col("p1") > F.col("p0"), 1).otherwise(0))
            .when(ok1, 1).when(ok0, 0))
    d = d.withColumn("c", conf)
    joint = d.filter(F.col("c").isNotNull()).groupBy("label", "s", "c").agg(F.count(F.lit(1)).alias("n"))
    given_n = d.groupBy("label", "s").agg(F.count(F.lit(1)).alias("n_given"))
    row_tot = joint.groupBy("label", "s").agg(F.sum("n").alias("n_row"))
    cal = (joint.join(row_tot, ["label", "s"]).join(given_n, ["label", "s"])
           .withColumn("k", F.bround(F.col("n") * F.col("n_given") / F.col("n_row"), 0).cast("bigint"))
           .filter((F.col("s") != F.col("c")) & (F.col("k") > 0)).select("label", "s", "k"))
    # candidates: rows given s, ranked by margin p_other - p_given (largest first)
    margin = F.when(F.col("s") == 1, F.col("p0") - F.col("p1")).otherwise(F.col("p1") - F.col("p0"))
    cand = d.select(id_col, "label", "s", F.floor((F.lit(1.0) - margin) * F.lit(_SCALE)).cast("bigint").alias("key"))
    flagged = within_first_k(cand.withColumnRenamed(id_col, "row_id"), ["label", "s"], cal, key="key", tie="row_id")
    return flagged.select(F.col("row_id").alias(id_col), "label")


# T3 / T5 --------------------------------------------------------------------------------
def filter_issues(df: DataFrame, issues: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Drop every row flagged for any label."""
    return df.join(issues.select(id_col).distinct(), id_col, "left_anti")


def triage_stats(df: DataFrame, issues: DataFrame, id_col: str = "row_id") -> DataFrame:
    flag = issues.select(id_col).distinct().withColumn("_f", F.lit(1))
    return df.select(id_col).join(flag, id_col, "left").agg(
        F.count(F.lit(1)).alias("total"), F.count("_f").alias("flagged"))
