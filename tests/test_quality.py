"""The quality report keeps its shape whatever it is given."""

from regweave.layers import Layers
from regweave.operators import links, quality
from regweave.registry import spec_names


def names(report):
    return {r.name: r for r in report.collect()}


def test_no_tables_at_all(spark):
    lines = names(quality.run_checks(spark, Layers({})))
    assert {f"rows.{t}" for t in spec_names()} <= set(lines)
    assert {n for n in lines if n.startswith("skipped.")} == {
        "skipped.check_facility_key_unique", "skipped.check_orphans", "skipped.check_state_codes",
        "skipped.check_fips_shapes", "skipped.check_coordinates", "skipped.check_crosswalk_agreement",
        "skipped.check_single_source_links"}
    assert {r.status for r in lines.values()} == {"warn", "ok"}
    assert lines["text.replacement_characters"].value == "0"


def test_a_broken_check_costs_one_line(spark):
    def exploding(layers):
        raise ValueError("boom")

    lines = names(quality.run_checks(spark, Layers({}), (exploding, quality.RowCounts())))
    assert (lines["exploding"].status, lines["exploding"].detail) == ("fail", "boom")
    assert "rows.facility" in lines


def test_a_family_that_breaks_while_running_costs_one_line(spark):
    facility = spark.createDataFrame([("1", "OH")], "REGISTRY_ID string, STATE_CODE string")
    broken = facility.selectExpr("REGISTRY_ID", "raise_error('bad block') AS STATE_CODE")
    lines = names(quality.run_checks(spark, Layers({"facility": broken.selectExpr("REGISTRY_ID", "cast(STATE_CODE AS string) AS STATE_CODE")})))
    assert lines["check_state_codes"].status == "fail" and "bad block" in lines["check_state_codes"].detail
    assert lines["facility.registry_id_unique"].status == "ok" and lines["rows.facility"].value == "1"


def test_a_table_that_breaks_costs_only_its_own_lines(spark):
    broken = spark.range(1).selectExpr("raise_error('bad block') AS k").selectExpr(
        "cast(k AS string) AS REGISTRY_ID", "cast(k AS string) AS START_DATE")
    good = spark.createDataFrame([("1", "01-JAN-60", "bad")], "REGISTRY_ID string, CREATE_DATE string, UPDATE_DATE string")
    whole = names(quality.run_checks(spark, Layers({"facility": good, "program": good, "contact": good.selectExpr("REGISTRY_ID", "'' AS START_DATE")})))
    lines = names(quality.run_checks(spark, Layers({"facility": good, "program": good, "contact": broken})))
    assert set(whole) <= set(lines)
    failed = {n for n, r in lines.items() if r.status == "fail"} - {n for n, r in whole.items() if r.status == "fail"}
    assert {"check_dates", "check_orphans", "orphans.contact", "dates.contact.START_DATE.unparseable"} <= failed
    assert all("contact" in n or n in ("check_dates", "check_orphans") for n in failed), failed
    for n in whole:
        if "contact" not in n:
            assert lines[n] == whole[n]


def test_absent_columns_cost_one_line(spark):
    facility = spark.createDataFrame([("1",), ("1",)], "REGISTRY_ID string")
    lines = names(quality.run_checks(spark, Layers({"facility": facility})))
    assert lines["check_coordinates"].status == "fail"
    assert (lines["facility.registry_id_unique"].status, lines["facility.registry_id_unique"].value) == ("fail", "1")


def test_the_total_is_not_the_sample(spark):
    rows = [(str(i), f"Z{i:02}", "39155") for i in range(30)]
    layers = Layers({"facility": spark.createDataFrame(rows, "REGISTRY_ID string, STATE_CODE string, FIPS_CODE string")})
    line = quality.run_checks(spark, layers, (quality.StateCodes(),)).first()
    assert (line.value_num, len(line.sample), line.sample[0].key) == (30, 20, "Z00")


def test_a_latitude_without_longitude_is_unusable(spark):
    rows = [("1", "41.18", "-80.76"), ("2", "41.18", "0")]
    layers = Layers({"facility": spark.createDataFrame(rows, "REGISTRY_ID string, LATITUDE83 string, LONGITUDE83 string")})
    lines = names(quality.run_checks(spark, layers, (quality.Coordinates(),)))
    assert lines["facility.coordinates_unusable"].value == "1"
    assert lines["facility.coordinates_present"].status == "ok"


def test_no_coordinates_is_no_clean_bill(spark):
    layers = Layers({"facility": spark.createDataFrame([("1", "", None)], "REGISTRY_ID string, LATITUDE83 string, LONGITUDE83 string")})
    lines = names(quality.run_checks(spark, layers, (quality.Coordinates(),)))
    assert (lines["facility.coordinates_unusable"].status, lines["facility.coordinates_unusable"].value) == ("warn", "not applicable")


def test_an_empty_crosswalk(spark):
    schema = "REGISTRY_ID string, PGM_SYS_ACRNM string, PGM_SYS_ID string, source_table_count bigint, source_tables array<string>"
    layers = Layers({}, {"crosswalk": spark.createDataFrame([], schema)})
    lines = names(quality.run_checks(spark, layers, (quality.SingleSourceLinks(), quality.CrosswalkAgreement())))
    assert (lines["crosswalk.single_source_links"].value, lines["crosswalk.single_source_links"].status) == ("0 / 0", "ok")
    assert len(lines) == 3


def test_views_of_another_build_are_not_this_ones(spark):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("crosswalk")
    lines = names(quality.run_checks(spark, Layers({})))
    assert "skipped.check_crosswalk_agreement" in lines


def test_many_dates_share_one_scan(spark):
    schema = "REGISTRY_ID string, CREATE_DATE string, UPDATE_DATE string, REFRESH_DATE string"
    layers = Layers({"program": spark.createDataFrame([("1", "01-JAN-60", "bad", "")], schema)})
    frame = quality.Dates()(layers)
    assert frame._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    lines = names(frame)
    assert lines["dates.program.CREATE_DATE.century_adjusted"].value == "1"
    assert lines["dates.program.UPDATE_DATE.unparseable"].status == "warn"
    assert "dates.program.UPDATE_DATE.century_adjusted" not in lines


def test_dates_are_read_once_for_each_text(spark):
    rows = [("01-JAN-60", "x"), ("01-JAN-60", None), (" 01-JAN-60", ""), (None, "x"), ("29-feb-01", "01-JAN-60"), ("  ", "\t")] * 3
    frame = quality.Dates()(Layers({"program": spark.createDataFrame(rows, "CREATE_DATE string, UPDATE_DATE string")}))
    shown = frame._jdf.queryExecution().executedPlan().toString()
    above, below = shown.split("Expand")
    assert "RLIKE" in above and "RLIKE" not in below and "HashAggregate" in above
    lines = names(frame)
    assert {n: r.value for n, r in lines.items()} == {
        "dates.program.CREATE_DATE.unparseable": "3", "dates.program.CREATE_DATE.century_adjusted": "9",
        "dates.program.UPDATE_DATE.unparseable": "9", "dates.program.UPDATE_DATE.century_adjusted": "3"}
    assert lines["dates.program.CREATE_DATE.unparseable"].detail == "of 18 rows; read as NULL"


def test_dates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "START_DATE string")
    line, = quality.Dates()(Layers({"contact": empty})).collect()
    assert (line.value, line.status, line.detail) == ("0", "ok", "of 0 rows; read as NULL")


def test_states_are_told_inside_the_fold(spark):
    raw = spark.createDataFrame([(" zz",), ("ZZ",), ("OH",), ("q",), (" ",), (None,)], "s string")
    facility = raw.selectExpr("CASE s WHEN 'q' THEN 'Q  9' ELSE s END AS STATE_CODE")
    sample, = (frame() for frame in quality.StateCodes().frames(Layers({"facility": facility})))
    assert [tuple(x) for x in sample.first().sample] == [("ZZ", 2), ("Q 9", 1)]
    # A filter below the fold would hold the rules once for each use.
    below = sample._jdf.queryExecution().executedPlan().toString().split("HashAggregate")[-1]
    assert "Filter" not in below
    clean = Layers({"facility": facility}).clean("facility")
    bad = quality.out_of_domain(clean["STATE_CODE"], clean["STATE_CODE_RAW"])
    got = quality.top_values_of_all(clean, "STATE_CODE_RAW", bad).collect()
    assert [tuple(r) for r in got] == [(None, 3, True), ("ZZ", 2, False), ("Q 9", 1, False)]
    assert quality.top_values_of_all(clean.filter("STATE_CODE = 'OH'"), "STATE_CODE_RAW", bad).count() == 0


def test_two_reports_share_their_measures(spark):
    keys = "REGISTRY_ID string, PGM_SYS_ACRNM string, PGM_SYS_ID string"
    raw = {
        "facility": spark.createDataFrame(
            [("1", "A:x, B:y", "ZZ"), ("1", "A:x", "OH"), ("2", None, "OH")], "REGISTRY_ID string, PGM_SYS_ACRNMS string, STATE_CODE string"),
        "program": spark.createDataFrame([("1", "A", "x"), ("3", "C", "z"), (None, "C", "z")], keys),
        "contact": spark.createDataFrame([("1", "B", "y"), ("9", "D", "w"), ("9", "D", "w"), ("2", "C", None)], keys),
    }

    def masks(tables):
        return links.link_masks(links.tagged_union(Layers(tables).link_inputs()))

    checks = list(quality.ALL_CHECKS)
    both = quality.reports_without(Layers(raw, {"crosswalk": masks(raw)}), checks, ("contact",))
    rest = {t: f for t, f in raw.items() if t != "contact"}
    for tables, got in zip((raw, rest), both):
        listed = quality.fused_report(Layers(tables, {"crosswalk": links.crosswalk(Layers(tables).link_inputs())}), checks)
        assert names(got) == names(listed)
    whole, fewer = map(names, both)
    assert whole["crosswalk.single_source_links"].value == "2 / 4" and fewer["crosswalk.single_source_links"].value == "2 / 3"
    assert "orphans.contact" in whole and "orphans.contact" not in fewer
