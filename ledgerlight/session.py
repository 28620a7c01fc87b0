"""Session factory and the few session-wide helpers that operators share."""

from __future__ import annotations

import gc
import os

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "ledgerlight", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark can read."""
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: the cluster's spark.checkpoint.dir wins; a local folder only where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = os.path.join(os.environ.get("TMPDIR", "/tmp"), "checkpoints")
        sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and forget the lineage."""
    ready_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of steps that are over deleted now; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
