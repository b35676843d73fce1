"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

#: Runtime SQL settings every job relies on. All of them are size-neutral: broadcast joins stay behind Spark's own
#: statistics check, a hot join key is split by AQE even where that costs one more shuffle. Shuffles are dealt finely and AQE
#: puts neighbours together up to a fixed size: a stage's joins, sorts and aggregates hold up to a hundred times the
#: compressed bytes their task reads, so what a task reads must not grow with the tables.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
#: HotSpot never compiles a method of more than 8000 bytes; a wide stage can run faster as several smaller ones.
SMALL_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession, small_methods: bool = False) -> SparkSession:
    """Apply the runtime settings to an existing session; cluster sizing is left as the cluster set it."""
    for key, value in (RUNTIME | (SMALL_METHODS if small_methods else {})).items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "coverlake", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = tune(builder.getOrCreate(), small_methods=True)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="coverlake-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session may fall back to a temporary folder; on a cluster an unset folder is an error, because a
    machine-local path would not survive the loss of an executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()
