"""As-of join: every left row with the last right row at or before it, within its key.

Both sides are merged and dealt by ranges of (key, position), so a key of any size is spread over
tasks and no task holds the rows of a key.  Sorted partitions are filled forward in one streaming pass;
what a partition needs from the ones before it is at most one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.session import written


def _run_starts(keys: pa.Array) -> np.ndarray:
    """Whether a row's key differs from that of the row before (the first row: yes)."""
    n = len(keys)
    after, before = keys.slice(1), keys.slice(0, n - 1)
    same = pc.or_(pc.fill_null(pc.equal(after, before), False), pc.and_(after.is_null(), before.is_null()))
    return np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)]) if n else np.empty(0, bool)


def asof_backward(left: DataFrame, right: DataFrame, *, by: str, on: str, right_on: str) -> DataFrame:
    """``left`` and ``asof``: the struct of the last row of ``right`` with the same ``by`` and ``right_on <= on``.

    ``right`` has each (by, right_on) once.  NULL positions of the left side find nothing; a NULL key is a
    key of its own.  Rows of one position may be cut between partitions anywhere.
    """
    payload, rows = F.struct(*[F.col(f"`{c}`") for c in right.columns]), F.struct(*[F.col(f"`{c}`") for c in left.columns])
    knots = right.where(F.col(right_on).isNotNull()).select(
        F.col(by).alias("_by"), F.col(right_on).alias("_on"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_salt"),
        payload.alias("_fill"))
    merged = knots.unionByName(left.select(
        F.col(by).alias("_by"), F.col(on).cast(right.schema[right_on].dataType).alias("_on"), F.lit(1).alias("_kind"),
        F.monotonically_increasing_id().alias("_salt"), rows.alias("_row")), allowMissingColumns=True)
    keys = ["_by", "_on", "_kind", "_salt"]
    dealt = merged.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_by", "_on", "_kind", "_fill", "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, held_by = TaskContext.get().partitionId(), None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            by_col, fill = batch.column(0), batch.column(3)
            begins, at = _run_starts(by_col), np.arange(n)
            knot = batch.column(2).to_numpy() == 0
            last = np.maximum.accumulate(np.where(knot, at, -1))
            start = np.maximum.accumulate(np.where(begins, at, 0))
            index = np.where(last >= start, last + 1, -1)            # 0 is the knot held from the batch before
            if held is not None and held_by == by_col[0].as_py():
                index = np.where((index < 0) & (start == 0), 0, index)
            pool = pa.concat_arrays([held if held is not None else fill.slice(0, 1), fill])
            filled = pool.take(pa.array(np.maximum(index, 0), mask=index < 0))
            if index[-1] >= 0:
                held, held_by = filled.slice(n - 1, 1), by_col[n - 1].as_py()
            else:
                held, held_by = None, None
            yield pa.RecordBatch.from_arrays([by_col, batch.column(1), batch.column(2), filled, batch.column(4),
                                              pa.array(np.full(n, part, np.int32))],
                                             names=["_by", "_on", "_kind", "_fill", "_row", "_part"])

    schema = T.StructType([*dealt.schema.fields, T.StructField("_part", T.IntegerType())])
    placed = written(dealt.mapInArrow(run, schema))
    # the last row of a key in a partition knows the key's last knot there, if any
    ends = placed.groupBy("_by", "_part").agg(F.max_by("_fill", F.struct("_on", "_kind")).alias("_last"))
    before = Window.partitionBy("_by").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = written(ends.select(F.col("_by").alias("_k"), F.col("_part").alias("_p"),
                                      F.last("_last", ignorenulls=True).over(before).alias("_carry"))
                          .where("_carry is not null"))                # keys that go on: at most two rows a partition
    out = placed.where("_kind = 1").join(
        F.broadcast(carried), (F.col("_part") == F.col("_p")) & F.col("_by").eqNullSafe(F.col("_k")), "left")
    found = F.when(F.col("_on").isNotNull(), F.coalesce("_fill", "_carry"))
    return out.select("_row.*", found.alias("asof"))
