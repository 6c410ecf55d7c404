"""Links laid out for the lookup of one facility: files by ranges of its key, and what each holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.operators import links as lk
from regweave.registry import REGISTRY_KEY
from regweave.sources.storage import Store

LINKS, FILES = "crosswalk", "crosswalk_files"


def publish_links(store: Store, links: DataFrame, files: int | None = None) -> DataFrame:
    """Write the links sorted by facility, in `files` ranges of it (by default as many as a shuffle
    has partitions), and the table of the files' first and last facility.

    A range ends anywhere between two links, so a facility with very many lies in several
    files, next to each other, and none is larger for it.
    """
    number = files or int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    spread = links.repartitionByRange(number, REGISTRY_KEY, lk.ACRONYM, lk.PROGRAM_ID)
    path = store.write(LINKS, spread.sortWithinPartitions(REGISTRY_KEY, lk.ACRONYM, lk.PROGRAM_ID))
    written = store.spark.read.parquet(path)
    held = written.select(REGISTRY_KEY, F.col("_metadata.file_path").alias("file")).groupBy("file").agg(
        F.min(REGISTRY_KEY).alias("first"), F.max(REGISTRY_KEY).alias("last"), F.count("*").alias("links")
    )
    store.keep_only(FILES, store.write(FILES, held.coalesce(1)))
    store.keep_only(LINKS, path)
    return store.read(LINKS)


def files_of(store: Store, registry_id: str) -> list[str]:
    """The files that may hold a facility's links; all of them if the table of files is another
    version's."""
    current = store.current(LINKS)
    if current is None:
        raise FileNotFoundError(f"no published links under {store.root}")
    if store.has(FILES):
        held = store.read(FILES)
        # A short row for each file that holds the key.
        own = held.filter((F.col("first") <= registry_id) & (F.col("last") >= registry_id)).select("file").collect()
        stale = held.filter(~F.col("file").contains(f"/{LINKS}/{current.rsplit('/', 1)[-1]}/")).limit(1).count()
        if not stale:
            return sorted(r.file for r in own)
    return [current]


def lookup(store: Store, registry_id: str) -> DataFrame:
    """Everything a facility is known as, from the published links; opens only its files."""
    files = files_of(store, registry_id)
    links = store.read(LINKS)
    found = store.spark.read.schema(links.schema).parquet(*files) if files else links.limit(0)
    return lk.facility_lookup(found, registry_id)
