"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime (it turns a side whose
# measured size is small into a broadcast, and splits skewed partitions), which is the
# size check we want for tables whose size depends on the data.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "corpusforge",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()                          # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusforge`` importable by the Python workers (Arrow UDFs, mapInPandas pickle
    module-level functions by reference): zip the package once and ``addPyFile`` it."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    os.environ["PYTHONPATH"] = os.pathsep.join(
        [root] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and p != root])
    out = tempfile.mkdtemp(prefix="corpusforge-pkg-")
    archive = shutil.make_archive(os.path.join(out, "corpusforge"), "zip", root, "corpusforge")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only local sessions get a scratch dir.

    Reliable checkpoints (never ``localCheckpoint``) are what the iterative operators use to
    cut lineage, so a lost executor does not force a replay of every previous round.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
        configured = tempfile.mkdtemp(prefix="corpusforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and return the re-read frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again.

    Like :func:`cut_lineage`, but the planner starts from the table's true size: a checkpoint keeps
    the estimates of the plan behind it, which grow with every round of a loop of joins.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
