"""Crosswalk operators, and how their plans hold up under skew."""

import pytest
from pyspark.sql import functions as F

from regweave.operators import integrity, links as lk
from regweave.operators.compare import link_diff, report_diff
from regweave.operators.subset import water_system

TRIPLE = "REGISTRY_ID string, PGM_SYS_ACRNM string, PGM_SYS_ID string"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame)


def test_packed_items(spark):
    facility = spark.createDataFrame(
        [("1", "SFDW:A1, npdes :B:2, NOCOLON, :x, RCRA:, N:D,T,  Z : q "), ("2", None)], "REGISTRY_ID string, PGM_SYS_ACRNMS string")
    rows = [(r[1], r[2]) for r in lk.explode_packed(facility).collect()]
    assert rows == [("SFDW", "A1"), ("NPDES", "B:2"), ("", ":x"), ("RCRA", ""), ("N", "D,T"), ("Z", "q")]


def test_incomplete_links_are_left_out(spark):
    rows = [("1", "A", "x"), (None, "A", "x"), ("1", None, "x"), ("1", "A", None), ("1", "", "")]
    links = lk.crosswalk({"program": spark.createDataFrame(rows, TRIPLE)})
    assert {tuple(r)[:3] for r in links.collect()} == {("1", "A", "x"), ("1", "", "")}


def test_no_source_is_an_error(spark):
    with pytest.raises(ValueError):
        lk.crosswalk({})


def test_source_bits_round_trip(spark):
    masks = spark.range(1 << len(lk.LINK_SOURCES)).select(F.col("id").alias("m"), lk.source_list(F.col("id")).alias("s"))
    for row in masks.filter("m > 0").collect():
        assert row.s == sorted(s for s in lk.LINK_SOURCES if row.m & lk.source_bit(s))


def test_pivot_gives_one_whole_row_for_each_facility(spark):
    rows = [("hot", "A/B", f"id{i:04}") for i in range(1000)] + [("cold", "A/B", "x"), ("cold", "C-D E", "y"), ("none", "Q", "z")]
    links = spark.createDataFrame(rows, TRIPLE)
    whole = {r.REGISTRY_ID: r for r in lk.program_pivot(links, ["A/B", "C-D E"]).collect()}
    assert (whole["cold"].A_B, whole["cold"].C_D_E, whole["none"].A_B) == (["x"], ["y"], [])
    assert whole["hot"].A_B == [f"id{i:04}" for i in range(1000)] and whole["hot"].C_D_E == []
    assert lk.program_pivot(links, ["A/B"]).count() == 3
    with pytest.raises(ValueError):
        lk.program_pivot(links, ["A/B", "A B"])


def test_a_hot_link_folds_before_the_shuffle(spark):
    copies = spark.range(0, 200_000, 1, 4).select(
        F.lit("1").alias("REGISTRY_ID"), F.lit("A").alias("PGM_SYS_ACRNM"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("PGM_SYS_ID"))
    links = lk.crosswalk({"program": copies, "sic": copies})
    assert links.count() == copies.distinct().count()
    shown = plan(links)
    assert shown.count("Exchange") == 1 and "SortAggregate" not in shown and "ObjectHashAggregate" not in shown


def test_a_hot_facility_is_split_in_the_join(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    links = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), "id")).alias("REGISTRY_ID"),
        F.lit("SFDW").alias("PGM_SYS_ACRNM"), F.md5(F.col("id").cast("string")).alias("PGM_SYS_ID"))
    interests = spark.createDataFrame([], TRIPLE + ", INTEREST_TYPE string, ACTIVE_STATUS string, START_DATE date, END_DATE date")
    facility = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), "id")).alias("REGISTRY_ID"), *[F.lit("x").alias(c) for c in ("PRIMARY_NAME", "CITY_NAME", "COUNTY_NAME", "STATE_CODE", "FIPS_CODE_COUNTY5")],
        F.lit(1.0).alias("LATITUDE83"), F.lit(1.0).alias("LONGITUDE83"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        water = water_system(links, interests, facility)
        assert "skew=true" in final_plan(water)
        assert water.filter("PRIMARY_NAME = 'x'").count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_program_is_filtered_at_the_scan(spark, built):
    store, _ = built
    lookup = lk.facility_lookup(store.read("crosswalk"), "310000000011")
    assert "EqualTo(REGISTRY_ID,310000000011)" in plan(lookup)
    orphans = integrity.orphan_rows(store.read("raw/program").select("REGISTRY_ID"), store.read("raw/facility"))
    shown = plan(orphans)
    assert "LeftAnti" in shown and shown.count("ReadSchema: struct<REGISTRY_ID:string>") == 2


def test_key_profile_sends_keys_and_tags_to_the_fold(spark):
    frames = {t: spark.range(3).selectExpr("cast(id AS string) AS REGISTRY_ID") for t in ("facility", "sic", "naics")}
    below = plan(integrity.key_profile(frames)).split("Union")[1]
    assert "_common_expr" not in below and "AS t#" in below


def test_key_profile_agrees_with_joins(spark):
    facility = spark.createDataFrame([("1",), ("1",), ("2",), (None,), (None,)], "REGISTRY_ID string")
    child = spark.createDataFrame([("1",), ("3",), ("3",), (None,)], "REGISTRY_ID string")
    row = integrity.key_profile({"facility": facility, "sic": child}).first().asDict()
    assert row == {"rows.facility": 5, "rows.sic": 4, "duplicates.facility": 2, "orphans.sic": 3}
    assert row["orphans.sic"] == integrity.orphan_rows(child, facility).count()
    assert row["duplicates.facility"] == integrity.duplicate_keys(facility, "REGISTRY_ID").count()
    shown = plan(integrity.key_profile({"facility": facility, "sic": child}))
    assert "Join" not in shown


def test_link_and_report_differences(spark):
    schema = TRIPLE + ", source_tables array<string>"
    old = spark.createDataFrame([("1", "A", "x", ["p"]), ("1", "A", "y", ["p", "q"]), ("2", "A", "z", ["p"])], schema)
    new = spark.createDataFrame([("1", "A", "x", ["p"]), ("1", "A", "y", ["p"]), ("3", "A", "z", ["p"])], schema)
    assert {(r.REGISTRY_ID, r.change) for r in link_diff(old, new).collect()} == {("1", "changed"), ("2", "removed"), ("3", "added")}
    lines = "name string, status string, value string"
    before = spark.createDataFrame([("a", "ok", "0"), ("b", "ok", "1"), ("c", "ok", None)], lines)
    after = spark.createDataFrame([("a", "warn", "2"), ("b", "ok", "1"), ("d", "ok", None)], lines)
    assert {(r.name, r.change) for r in report_diff(before, after).collect()} == {("a", "changed"), ("c", "removed"), ("d", "added")}
