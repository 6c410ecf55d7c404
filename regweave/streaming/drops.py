"""New archives in a folder are landed and built once each.

The file source remembers in its checkpoint which archives it has seen; only
paths travel through the stream, never contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from regweave.plans.build import Built, run_all
from regweave.sources.storage import Store

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_archives(spark: SparkSession, folder: str, at_once: int) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", at_once)
    return files.option("pathGlobFilter", "*.zip").load(folder).select("path", "modificationTime")


def drop_name(path: str, folder: str) -> str:
    """The archive's path below the watched folder, so that equal file names in subfolders differ."""
    below = local_uri(path).removeprefix(local_uri(folder).rstrip("/") + "/")
    return below.split("://", 1)[-1].strip("/").removesuffix(".zip")


def land_drops(
    spark: SparkSession,
    folder: str,
    target: str,
    *,
    checkpoint: str,
    at_once: int = 16,
    done: Callable[[str, Built], None] = lambda name, built: None,
    **landing,
) -> StreamingQuery:
    """Land every archive not yet seen into ``target/<archive name>``, then stop.

    ``checkpoint`` remembers what was seen and belongs to this folder alone. A batch
    takes ``at_once`` archives; repeated after a failure it finds the tables it
    already published and reuses them.
    """

    def land(batch: DataFrame, _: int) -> None:
        for row in batch.orderBy("modificationTime").collect():  # at most at_once short rows
            name = drop_name(row.path, folder)
            done(name, run_all(Store(spark, f"{target}/{name}"), local_uri(row.path), **landing))

    return (
        new_archives(spark, folder, at_once)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def local_uri(path: str) -> str:
    """Hadoop prints local files as ``file:/x``, which is no URI Arrow accepts."""
    return path.removeprefix("file:") if path.startswith("file:/") else path
