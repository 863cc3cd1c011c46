"""Row-wise stages on Structured Streaming, and the ``process`` stages up to calibration as a stream.

The original has no streaming, but every per-row stage of ``process`` (cleaning, emoji
features, schema validation, applying a fitted calibration) is a stateless column
expression, so the same functions run unchanged on a streaming DataFrame.  The stateful
stages (near-dedup, splits, fits) need the whole table and stay batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions.text import clean_text, emoji_density
from corpusforge.operators.calibrate import apply
from corpusforge.sources.jsonl import scratch_path


def row_stages(df: DataFrame, *, text_col: str = "text", clean: dict | None = None,
               emoji: dict | None = None, valid: Column | None = None) -> DataFrame:
    """Clean -> emoji density -> validity filter; works on batch and streaming frames alike."""
    clean = {} if clean is None else clean
    out = df
    if clean.get("enabled", True):
        out = out.withColumn(text_col, clean_text(F.col(text_col), unicode_normalize=clean.get("unicode_normalize", False),
                                                  boilerplate=clean.get("boilerplate", False)))
    if emoji is not None:
        out = out.withColumn("emoji_density", emoji_density(F.col(text_col), emoji.get("normalization", "per_word")))
    if valid is not None:
        out = out.filter(valid)
    return out


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Drain an append-mode stream into a parquet folder and return it as a batch table.

    Uses a file sink with its checkpoint in the shared checkpoint folder, so a restarted
    query resumes exactly where it stopped.
    """
    out = scratch_path(spark, name)
    q = (stream.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def process_stream(spark: SparkSession, stream: DataFrame, *, params: Callable[[], DataFrame], name: str, row_id: str = "row_id",
                   text_col: str = "text", probs_col: str = "probs", clean: dict | None = None, emoji: dict | None = None,
                   valid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean, add features, validate and calibrate rows with a map column of probabilities by label.

    Every micro-batch reads the parameters anew (``params()``), so a new fit takes effect without a
    restart.  Rows that are not valid go to a second sink as they came.  Both sinks are folders by
    batch number, overwritten when a batch is repeated after a failure, so a row is in one of
    them, once.  Returns the two tables ``(processed, rejected)`` after draining the source.
    """
    out = scratch_path(spark, name)
    schemas = {}

    def sink(batch: DataFrame, kind: str, number: int) -> None:
        schemas[kind] = batch.schema
        batch.write.mode("overwrite").parquet(f"{out}/{kind}/batch={number}")

    def handle(batch: DataFrame, number: int) -> None:
        # a few files' rows over all cores, cleaned once: the sinks and the calibration read the kept rows
        dealt = batch.repartition(batch.sparkSession.sparkContext.defaultParallelism)
        staged = row_stages(dealt.withColumn("_raw", F.struct("*")), text_col=text_col, clean=clean, emoji=emoji)
        staged = staged.withColumn("_ok", F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))).persist()
        try:
            write(staged, number)
        finally:
            staged.unpersist()

    def write(staged: DataFrame, number: int) -> None:
        kept = staged.where("_ok").drop("_ok")
        if valid is not None:
            sink(staged.where("not _ok").select("_raw.*"), "rejected", number)
        long = kept.select(row_id, F.explode(probs_col).alias("label", "p"))
        calibrated = apply(long, params()).groupBy(row_id).agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "p")))).alias("_calibrated"))       # one row's labels
        rows = kept.drop("_raw").join(calibrated, row_id, "left")
        sink(rows.withColumn(probs_col, F.coalesce("_calibrated", F.col(probs_col))).drop("_calibrated"), "processed", number)

    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()

    def table(kind: str) -> DataFrame:
        if kind not in schemas:
            return spark.createDataFrame([], stream.schema)
        return spark.read.schema(schemas[kind]).parquet(*[f"{out}/{kind}"]).drop("batch")
    return table("processed"), table("rejected")
