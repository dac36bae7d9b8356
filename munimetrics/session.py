"""Session settings and the shared folder used for checkpoints and written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "munimetrics", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the operators count on; anything can be overridden by ``settings``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without that setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    current = context.getCheckpointDir()
    if not configured and not current:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="munimetrics-")
    if not current:
        context.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a written intermediate."""
    return os.path.join(shared_dir(spark), "written", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows below the shared folder and read them back: they survive the loss of any executor.

    Unlike a checkpoint, the written table is computed once, brings its size to later join planning, and
    starts without the constraints of the old plan, which grow from round to round in iterative jobs.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_package(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where it lies, unless they have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, paths) if p)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
