"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "promptmill", **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    ``spark.checkpoint.dir`` names it on a cluster, where every executor must reach it.
    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="promptmill-")


def materialise(df: DataFrame) -> DataFrame:
    """Run ``df`` once into the reliable checkpoint folder and cut its lineage."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffles and checkpoints that nothing refers to any more, as it does once the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more, in whatever store it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Session option: how many tasks share a scan. Unset, scans are left as Spark splits them.
SCAN_TASKS = "spark.promptmill.scanTasks"


def spread(scan: DataFrame, keep: bool = True) -> DataFrame:
    """The scan dealt out to ``SCAN_TASKS`` tasks, if the session sets that option.

    It is meant for files that cannot be split, such as a single row group, when their rows are costly.
    ``keep`` stores them, because the optimizer moves filters to the far side of a plain repartition.
    """
    tasks = scan.sparkSession.conf.get(SCAN_TASKS, None)
    if not tasks:
        return scan
    dealt = scan.repartition(int(tasks))
    return materialise(dealt) if keep else dealt
