"""Connected components of a graph given as groups (every group links all its members).

The table ``(group columns, label)`` is contracted in rounds: every label takes the smallest label
that it meets in any of its groups, chains of such steps are followed to their end by doubling, and
groups left with one label go.  The table shrinks with the number of labels; a round is a few shuffled aggregations and
joins on it, written to the shared checkpoint folder.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import written


def _roots(hook: DataFrame) -> DataFrame:
    """``hook(_c, _to)`` with every chain of steps followed to its end; a written table is four times as far."""
    while True:
        far = hook
        for _ in range(2):                        # every target is a label with a step of its own
            after = hook.select(F.col("_c").alias("_to"), F.col("_to").alias("_next"))
            far = far.join(after, "_to").select("_c", F.col("_next").alias("_to"))
        step = hook.select("_c", F.col("_to").alias("_before"))
        far = written(far.join(step, "_c"))
        hook = far.select("_c", "_to")
        if far.where("_to <> _before").isEmpty():
            return hook


def group_components(members: DataFrame, group: list[str], node: str, max_rounds: int = 100) -> DataFrame:
    """``(node, component)``: the smallest node that is reachable through common groups."""
    met = written(members.select(*group, F.col(node).alias("_c")).distinct())
    steps: list[DataFrame] = []
    while True:
        ends = met.groupBy(*group).agg(F.min("_c").alias("_low"), F.max("_c").alias("_high")).where("_low < _high")
        open_ = written(met.join(ends.drop("_high"), group))
        if open_.isEmpty():
            break
        if len(steps) == max_rounds:
            raise RuntimeError(f"components did not converge in {max_rounds} rounds")
        hook = _roots(written(open_.groupBy("_c").agg(F.min("_low").alias("_to"))))
        steps.append(hook)
        met = written(open_.join(hook, "_c").select(*group, F.col("_to").alias("_c")).distinct())
    out = members.select(F.col(node).alias("node")).distinct().withColumn("component", F.col("node"))
    for hook in steps:
        out = out.join(hook.select(F.col("_c").alias("component"), "_to"), "component", "left").select(
            "node", F.coalesce("_to", "component").alias("component"))
    return out
