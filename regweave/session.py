"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# The engine relies on these; a cluster's own memory and core settings stand.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Wide projections of rules outgrow what the JIT compiles as one method; past this
    # size Spark compiles each operator by itself, in methods the JIT accepts.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int = 8, *, app: str = "regweave", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting falls back to a scratch folder;
    on a cluster a machine-local folder would vanish with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="regweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
