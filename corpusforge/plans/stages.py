"""Stage manifests: which stage tables of a job are complete, and for which inputs.

Beside a stage's table lies a manifest with the fingerprint of everything the stage depends on and
the table's schema.  It is emptied before the stage is written and filled after the write has been
committed, so a stage found with the wanted fingerprint is whole and needs no second call of a
model hook.  All access goes through Spark, so any store it can write will do.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.sources.jsonl import read_jsonl, write_jsonl


def fingerprint(**parts) -> str:
    """SHA-256 of the named parts: texts and numbers as they are, functions by module and name, columns
    by their expression."""
    def plain(x):
        if callable(x) and hasattr(x, "__qualname__"):
            return f"{x.__module__}.{x.__qualname__}"
        return x if isinstance(x, (str, int, float, bool, type(None), list, tuple, dict)) else str(x)
    return hashlib.sha256(json.dumps({k: plain(v) for k, v in parts.items()}, sort_keys=True, default=str).encode()).hexdigest()


def table_digest(df: DataFrame | None) -> str:
    """Rows and a sum of row hashes, in any order of the rows (one pass)."""
    if df is None:
        return "-"
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(row).cast("decimal(20,0)")).alias("h")).first()
    return f"{df.schema.simpleString()}:{r['n']}:{r['h']}"


def _path(stage_dir: str, name: str) -> str:
    return f"{stage_dir.rstrip('/')}/_manifest/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _write_manifest(spark: SparkSession, stage_dir: str, name: str, content: dict) -> None:
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(
        _path(stage_dir, name))


def read_stage(spark: SparkSession, stage_dir: str, name: str, want: str) -> DataFrame | None:
    """The stage's table if its manifest has the fingerprint ``want``, else None."""
    path = _path(stage_dir, name)
    if not _exists(spark, f"{path}/_SUCCESS"):
        return None
    lines = [r["value"] for r in spark.read.text(path).collect()]          # one line
    held = json.loads(lines[0]) if lines else {}
    if held.get("fingerprint") != want:
        return None
    return read_jsonl(spark, f"{stage_dir}/{name}", T.StructType.fromJson(held["schema"]))


def write_stage(df: DataFrame, stage_dir: str, name: str, mark: str) -> DataFrame:
    """Write a stage's table as JSON lines, then its manifest; the table as read back."""
    spark = df.sparkSession
    _write_manifest(spark, stage_dir, name, {})
    write_jsonl(df, f"{stage_dir}/{name}")
    _write_manifest(spark, stage_dir, name, {"fingerprint": mark, "schema": df.schema.jsonValue()})
    return read_jsonl(spark, f"{stage_dir}/{name}", df.schema)
