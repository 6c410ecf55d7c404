"""Published links by ranges of their facility."""

import pytest
from pyspark.sql import functions as F

from regweave.plans.layout import FILES, files_of, lookup, publish_links
from regweave.sources.storage import Store

HOT = "f00500"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("links")))
    facility = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.format_string("f%05d", F.col("id") % 1000))
    links = spark.range(0, 12_000, 1, 8).select(
        facility.alias("REGISTRY_ID"), F.lit("P").alias("PGM_SYS_ACRNM"), F.col("id").cast("string").alias("PGM_SYS_ID"),
        F.lit(1).cast("bigint").alias("source_table_count"), F.array(F.lit("sic")).alias("source_tables"))
    assert publish_links(store, links, 64).count() == 12_000
    return store


def test_a_lookup_opens_few_files(spark, store):
    assert store.read(FILES).count() == 64
    for key in ("f00001", "f00499", "f00999", "f00007"):
        files = files_of(store, key)
        assert 1 <= len(files) <= 2
        want = {str(i) for i in range(12_000) if i % 3 and f"f{i % 1000:05}" == key}
        assert {r.PGM_SYS_ID for r in lookup(store, key).collect()} == want and want
        assert {f.rsplit("/", 1)[-1] for f in lookup(store, key).inputFiles()} == {f.rsplit("/", 1)[-1] for f in files}
    assert files_of(store, "g") == [] and lookup(store, "g").count() == 0


def test_a_hot_facility_lies_in_several_files_of_like_size(store):
    files = files_of(store, HOT)
    assert 10 < len(files) < 40
    assert lookup(store, HOT).count() == 4_000 + sum(i % 3 > 0 for i in range(500, 12_000, 1000))
    sizes = [r.links for r in store.read(FILES).collect()]
    assert sum(sizes) == 12_000 and max(sizes) < 4 * 12_000 / 64


def test_a_table_of_files_of_another_version_is_not_used(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    links = spark.createDataFrame([("a", "P", "1", 1, ["sic"]), ("b", "P", "2", 1, ["sic"])], "REGISTRY_ID string, "
                                  "PGM_SYS_ACRNM string, PGM_SYS_ID string, source_table_count bigint, source_tables array<string>")
    publish_links(store, links, 2)
    path = store.write("crosswalk", links)  # a newer version without its table of files
    assert files_of(store, "a") == [path] and lookup(store, "a").count() == 1
    with pytest.raises(FileNotFoundError):
        lookup(Store(spark, str(tmp_path / "none")), "a")
