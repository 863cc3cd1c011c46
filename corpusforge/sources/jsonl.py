"""JSON-lines sources and sinks.

Readers always take an explicit schema (no inference pass over the data).  ``FAILFAST``
reproduces "any bad line aborts"; ``PERMISSIVE`` keeps bad lines visible in
``_corrupt_record``, and :func:`read_quarantined` parts them from the good rows in one scan.  The three splits are written in one pass, partitioned by ``split``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.session import ensure_checkpoint_dir


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = True) -> DataFrame:
    """One JSON object per line."""
    reader = spark.read.schema(schema)
    if strict:
        return reader.option("mode", "FAILFAST").json(path)
    if isinstance(schema, T.StructType) and "_corrupt_record" not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        reader = spark.read.schema(schema)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType | str, *,
                     max_bad_share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """S1, permissive: ``(good rows, bad lines)`` of one scan.

    Bad lines are ``(file, line, reason)`` with the whole text of the line; the reason is ``not JSON``,
    ``not an object`` or ``wrong type`` (a value that the schema can't hold).  Blank lines are skipped.
    Good and bad are written side by side in the shared folder and counted on the way; a share of bad
    lines above ``max_bad_share`` raises ``ValueError``.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    held = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where("trim(line) <> ''")
    value = F.try_parse_json("line")
    parsed = lines.withColumns({"_kind": F.schema_of_variant(value), "_row": F.from_json(
        "line", held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})})
    reason = (F.when(F.col("_kind").isNull(), "not JSON").when(~F.col("_kind").startswith("OBJECT"), "not an object")
              .when(F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull(), "wrong type"))
    seen = Observation()
    out = parsed.withColumn("reason", reason).observe(seen, F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad"))
    folder = scratch_path(spark, "quarantine")
    out.select("file", "reason", F.when(F.col("reason").isNotNull(), F.col("line")).alias("line"),
               F.when(F.col("reason").isNull(), F.struct(*[F.col(f"_row.`{f.name}`") for f in schema.fields])).alias("row"),
               F.col("reason").isNotNull().alias("bad")).write.partitionBy("bad").parquet(folder)
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > max_bad_share * n:
        raise ValueError(f"{bad} of {n} lines of {path} are bad, more than a share of {max_bad_share}")
    kinds = T.StructType([T.StructField("file", T.StringType()), T.StructField("reason", T.StringType()),
                          T.StructField("line", T.StringType()), T.StructField("row", schema), T.StructField("bad", T.BooleanType())])
    table = spark.read.schema(kinds).parquet(folder)
    return table.where("not bad").select("row.*"), table.where("bad").select("file", "line", "reason")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: a stage table as JSON lines (NULL fields kept as JSON null)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """Train / val / test in one pass, one sub-directory per split."""
    df.write.mode(mode).partitionBy(split_col).option("ignoreNullFields", "false").json(path)


def read_splits(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read back the split directories; ``split`` comes from the partition directory."""
    return spark.read.schema(schema).json(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/corpusforge-out/{name}-{uuid.uuid4().hex}"
