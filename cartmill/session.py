"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Result semantics the operators rely on; everything else (memory, partitions, skew
# thresholds) belongs to whoever submits the job.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Scratch folders written by this process, for clear_scratch.
WRITTEN: list[str] = []


def build_session(app_name: str = "cartmill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with UTC, ANSI casts and adaptive execution."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **SEMANTIC_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return apply_semantics(spark)


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, on a session somebody else created."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it; a cluster may ship it with --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; where none is named, local mode has one of its own.

    The session's settings are left as they are.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{tempfile.gettempdir()}/cartmill-scratch"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where two passes must see exactly the same rows and partition ids: the files
    survive the loss of an executor, so nothing upstream is sampled or sorted again.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete what ``materialize`` wrote; call it once the results have been consumed."""
    removed = 0
    while WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        filesystem = path.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += int(filesystem.delete(path, True))
    return removed
