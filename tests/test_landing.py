"""Archive to published tables, and everything built from them."""

import io
import random
import zipfile

import numpy as np
import pytest
from tests.conftest import DAIRY, LINKS, MILL, OUTFALL, PUMP, RELEASE, ROWS, WELL, csv_bytes, write_archive
from pyspark.sql import functions as F

from regweave.operators import links as lk, quality
from regweave.operators.compare import IncomparableBuilds, link_diff, report_diff, require_same_sources
from regweave.operators.privacy import PersonalTable
from regweave.plans import build as plans
from regweave.plans.landing import AUDIT, MalformedRows, EmptyMember, drift, land_archive, land_table, raw_name
from regweave.registry import LINK_SOURCES, PERSONAL_COLUMNS, SPECS
from regweave.sources.archive import cut_records, manifest, member_records
from regweave.sources.records import parse_records, repair_records
from regweave.sources.storage import Store
from regweave.streaming.drops import land_drops


#: Lines of the report on the small archive, by status.
TALLY = {"ok": 42, "warn": 11, "fail": 0}


def landed(built):
    return {r.table: r for r in built[1].landed}


def test_every_table_lands_with_its_rows(built):
    results = landed(built)
    assert set(results) == set(SPECS)
    assert {t: r.rows for t, r in results.items()} == {t: len(rows) for t, rows in ROWS.items()}


def test_control_bytes_go_and_the_row_stays(built):
    assert {r.MAILING_ADDRESS for r in built[0].read("raw/mailing_address").collect()} == {"7 Elm", None}
    result = landed(built)["mailing_address"]
    assert (result.rows, result.control_bytes, result.bad_bytes) == (2, 8, 0)


def test_bad_utf8_is_repaired_and_counted(built):
    store, _ = built
    result = landed(built)["alternative_name"]
    assert (result.bad_bytes, result.source_replacements) == (2, 0)
    name = store.read("raw/alternative_name").first().ALTERNATIVE_NAME
    assert name == "Pump �house�"


def test_everything_lands_as_text_with_leading_zeros(built):
    raw = built[0].read("raw/facility")
    assert {f.dataType.typeName() for f in raw.schema.fields} == {"string"}
    assert {r.FIPS_CODE for r in raw.collect()} == {"19153", "1915", "66010", "00912"}


def test_quoted_line_breaks_stay_inside_the_field(built):
    raw = built[0].read("raw/facility").filter(F.col("REGISTRY_ID") == PUMP).first()
    assert raw.PRIMARY_NAME == 'Pump\n"house"'


def test_the_audit_log_records_the_run(built):
    store, _ = built
    audit = store.spark.read.parquet(f"{store.root}/{AUDIT}")
    assert audit.count() == 10
    assert audit.agg(F.sum("control_bytes")).first()[0] == 8


def test_normalised_facility(built):
    rows = {r.REGISTRY_ID: r for r in plans.open_layers(built[0]).clean("facility").collect()}
    dairy, mill = rows[DAIRY], rows[MILL]
    assert (dairy.PRIMARY_NAME, dairy.COUNTRY_NAME, dairy.STATE_CODE, dairy.POSTAL_CODE_ZIP5) == (
        "Quarry Lake Dairy", "US", "IA", "50309")
    assert (dairy.LATITUDE83, dairy.CREATE_DATE.year, dairy.UPDATE_DATE.year, dairy.FIPS_CODE_COUNTY5) == (41.59, 1971, 1952, "19153")
    assert (mill.STATE_CODE, mill.STATE_CODE_RAW, mill.FIPS_CODE_COUNTY5, mill.UPDATE_DATE) == (None, "ZQ", None, None)


def test_crosswalk_rows_and_provenance(built):
    store, info = built
    links = {(r.REGISTRY_ID, r.PGM_SYS_ACRNM, r.PGM_SYS_ID): r for r in store.read("crosswalk").collect()}
    assert {k: r.source_table_count for k, r in links.items()} == LINKS and info.crosswalk_rows == len(LINKS)
    assert links[WELL].source_tables == ["alternative_name", "facility_acrnms", "program"]
    assert links[RELEASE].source_tables == ["contact", "facility_acrnms", "naics", "organization"]


def test_crosswalk_sources_in_scan_order(built):
    rows = built[0].read("crosswalk_sources").orderBy("scan_order").collect()
    assert [r.source_table for r in rows] == list(LINK_SOURCES)
    assert len(rows) == 10 and rows[-1].source_table == "facility_acrnms"


def test_water_systems(built):
    store, info = built
    rows = store.read("water_system").collect()
    assert info.water_system_rows == len(rows) == 5
    assert sorted(r.INTEREST_TYPE for r in rows if r.SFDW_ID == "IA7700001") == ["COMMUNITY WATER SYSTEM", "TRANSIENT"]
    by = {r.SFDW_ID: r for r in rows}
    unit = by["GU0000330 0000330CH"]
    assert (unit.PWSID, unit.SYSTEM_FACILITY_ID, unit.PWSID_STATE) == ("GU0000330", "0000330CH", "GU")
    assert by["IA7700001"].SYSTEM_FACILITY_ID is None and by["IA7700001 WELL 3"].SYSTEM_FACILITY_ID == "WELL 3"
    assert by["IA7700001 WELL 3"].INTEREST_TYPE is None and by["IA7700001 WELL 3"].PRIMARY_NAME == "Quarry Lake Dairy"
    assert by["090500012"].PRIMARY_NAME is None and by["090500012"].PWSID_STATE is None


def test_quality_report_on_the_mini_archive(built):
    report = plans.run_quality(built[0])
    lines = {r.name: r for r in report.collect()}
    assert {r.status: r.n for r in quality.tally(report).collect()} == TALLY
    assert lines["orphans.environmental_interest"].value_num == 1
    assert [tuple(s) for s in lines["facility.state_code_out_of_domain"].sample] == [("ZQ", 1)]
    moved = {n for n in lines if n.endswith("century_adjusted")}
    assert moved == {"dates.facility.UPDATE_DATE.century_adjusted", "dates.environmental_interest.END_DATE.century_adjusted"}
    assert lines["dates.facility.UPDATE_DATE.unparseable"].value_num == 1
    assert lines["dates.program.REFRESH_DATE.unparseable"].value_num == 1
    assert lines["facility.fips_code_shapes"].value == "3 usable of 4 non-null"
    assert lines["facility.coordinates_present"].value == "2 / 4 (50.0%)"
    assert lines["facility.coordinates_unusable"].value == "1"
    assert lines["text.replacement_characters"].value_num == 1
    assert lines["crosswalk.in_facility_string_not_program_table"].value_num == 4
    assert lines["crosswalk.in_program_table_not_facility_string"].value_num == 0
    assert lines["crosswalk.single_source_links"].value == "4 / 8"


def test_existing_tables_are_reused_unless_forced(spark, mini_archive, tmp_path):
    store = Store(spark, str(tmp_path))
    first = land_archive(store, mini_archive, only=["sic"])[0]
    again = land_archive(store, mini_archive, only=["sic"])[0]
    forced = land_archive(store, mini_archive, only=["sic"], force=True)[0]
    assert (first.reused, again.reused, forced.reused) == (False, True, False)
    assert again.rows == 1 and again.path == first.path != forced.path
    assert store.current("raw/sic") == forced.path


def test_a_lenient_table_is_not_reused_by_a_strict_run(spark, tmp_path):
    archive = write_archive(tmp_path / "a.zip", {SPECS["sic"].member: csv_bytes("sic") + b"1,2\n"})
    store = Store(spark, str(tmp_path / "s"))
    assert land_archive(store, archive, only=["sic"], fail_on_malformed=False)[0].malformed_rows == 1
    with pytest.raises(MalformedRows):
        land_archive(store, archive, only=["sic"])


def test_an_unfinished_version_is_never_current(spark, mini_archive, tmp_path):
    store = Store(spark, str(tmp_path))
    good = land_archive(store, mini_archive, only=["sic"])[0].path
    (tmp_path / "raw" / "sic" / "v=9").mkdir()
    assert store.current("raw/sic") == good


def test_public_landing_leaves_no_personal_data(spark, mini_archive, tmp_path):
    store = Store(spark, str(tmp_path))
    land_archive(store, mini_archive, only=["contact", "organization"])
    results = land_archive(store, mini_archive, only=["contact", "organization"], public=True)
    assert [r.table for r in results] == ["organization"]
    assert not results[0].reused
    assert not store.has(raw_name("contact"))
    columns = set(store.read(raw_name("organization")).columns)
    assert "ORG_NAME" in columns and not columns & set(PERSONAL_COLUMNS["organization"])
    assert len(list((tmp_path / "raw" / "organization").iterdir())) == 1


def test_a_personal_table_cannot_be_filtered(spark, mini_archive, tmp_path):
    entry = manifest(spark, [mini_archive]).filter(F.col("member") == SPECS["contact"].member).first()
    with pytest.raises(PersonalTable):
        land_table(Store(spark, str(tmp_path)), [entry], SPECS["contact"], public=True)


def test_public_build_moves_counts_but_no_links(spark, mini_archive, built, tmp_path):
    store = Store(spark, str(tmp_path))
    plans.run_all(store, mini_archive, public=True)
    diff = link_diff(built[0].read("crosswalk"), store.read("crosswalk")).collect()
    assert sorted((r.PGM_SYS_ACRNM, r.change) for r in diff) == [("NPDES", "changed"), ("TRIS", "changed")]
    with pytest.raises(IncomparableBuilds):
        require_same_sources(built[0].read("crosswalk_sources"), store.read("crosswalk_sources"))
    changes = report_diff(plans.run_quality(built[0]), plans.run_quality(store)).collect()
    assert {(r.name, r.change) for r in changes} >= {("rows.contact", "changed"), ("orphans.contact", "removed")}


def test_unknown_members_are_reported(spark, mini_archive, tmp_path):
    assert drift(Store(spark, str(tmp_path)), mini_archive) == []
    other = write_archive(tmp_path / "o.zip", {"NEW_FILE.csv": b"A\n1\n", "NOTES.TXT": b"x"})
    assert drift(Store(spark, str(tmp_path)), other) == ["NEW_FILE.csv"]


def test_wrong_width_and_empty_members_fail_and_publish_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    ragged = csv_bytes("sic") + b'"310000000011","NPDES"\n'
    archive = write_archive(tmp_path / "a.zip", {SPECS["sic"].member: ragged,
                                                 SPECS["naics"].member: csv_bytes("naics")[:60].split(b"\n")[0] + b"\n"})
    with pytest.raises(MalformedRows):
        land_archive(store, archive, only=["sic"])
    with pytest.raises(EmptyMember):
        land_archive(store, archive, only=["naics"])
    assert not store.has(raw_name("sic")) and not store.has(raw_name("naics"))
    kept = land_archive(store, archive, only=["sic"], fail_on_malformed=False)[0]
    assert (kept.rows, kept.malformed_rows) == (2, 1)


def test_large_members_spread_over_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("regweave.sources.archive.PARTITION_BYTES", 1 << 18)
    rows = [{**ROWS["sic"][0], "PGM_SYS_ID": f"ID{i}", "SIC_CODE": "line\nbreak" if i % 7 == 0 else "0941"}
            for i in range(60_000)]
    archive = write_archive(tmp_path / "big.zip", {SPECS["sic"].member: csv_bytes("sic", rows, b"\r\n")})
    store = Store(spark, str(tmp_path / "s"))
    result = land_archive(store, archive, only=["sic"])[0]
    raw = store.read("raw/sic")
    assert result.rows == 60_000 and raw.select("PGM_SYS_ID").distinct().count() == 60_000
    assert raw.filter(F.col("SIC_CODE") == "line\nbreak").count() == len(range(0, 60_000, 7))


@pytest.mark.parametrize("size", [1, 7, 64, 65_536])
def test_records_do_not_depend_on_where_reads_fall(size):
    rng = random.Random(7)
    rows = ["".join(rng.choice('ab,"\r\n\x00é') for _ in range(rng.randrange(12))) for _ in range(200)]
    expected = [('"' + r.replace('"', '""') + '",x\n').encode() for r in rows]
    got = [r for block in cut_records(io.BytesIO(b"".join(expected)), size) for r in block.to_pylist()]
    assert got == expected


def test_a_last_record_without_line_end_is_kept():
    assert [r for b in cut_records(io.BytesIO(b"a\nb")) for r in b.to_pylist()] == [b"a\n", b"b"]


@pytest.mark.parametrize("size", [1, 2, 5, 1 << 20])
@pytest.mark.parametrize("body, expected", [
    (b'1,A,5" PIPE,x\n2,"a\nb",c\n', [b'1,A,5" PIPE,x\n', b'2,"a\nb",c\n']),
    (b'a"b\n"c""\n"d,e"\nf', [b'a"b\n', b'"c""\n"d,e"\n', b"f"]),
    (b'"x"y"z\n"q"\r\n', [b'"x"y"z\n', b'"q"\r\n']),
    (b'a,b\r1,"\r"\r2,\r', [b"a,b\r", b'1,"\r"\r', b"2,\r"]),
    (b'\xef\xbb\xbf"A\n",B\r\n1,2', [b'"A\n",B\r\n', b"1,2"]),
    (b'"",""""\n5",6"\n"",""\n', [b'"",""""\n', b'5",6"\n', b'"",""\n']),
    (b"", []),
])
def test_quotes_open_at_field_edges_only(body, expected, size):
    assert [r for block in cut_records(io.BytesIO(body), size) for r in block.to_pylist()] == expected


def _cut_by_state(data):
    """Records by following each byte's state."""
    out, record, state = [], b"", "edge"
    for k, c in enumerate(data):
        byte = data[k:k + 1]
        record += byte
        if state == "quoted":
            state = "maybe" if byte == b'"' else "quoted"
        elif state == "maybe" and byte == b'"':
            state = "quoted"
        elif byte == b'"' and state == "edge":
            state = "quoted"
        elif byte in b",\r\n":
            state = "edge"
            if byte == b"\n" or (byte == b"\r" and data[k + 1:k + 2] != b"\n"):
                out.append(record)
                record = b""
        else:
            state = "plain"
    return out + [record] if record else out


def test_records_of_random_bytes():
    rng = random.Random(3)
    for _ in range(3000):
        data = "".join(rng.choice('ab,"""\r\n') for _ in range(rng.randrange(40))).encode()
        got = [r for block in cut_records(io.BytesIO(data), rng.choice([1, 3, 1000])) for r in block.to_pylist()]
        assert got == _cut_by_state(data), data


def test_lone_quotes_lose_no_row(spark, tmp_path):
    rows = [b'1,A,%d" PIPE,0941' % k if k % 400 == 7 else b"1,A,id%d,0941" % k for k in range(1002)]
    body = b"REGISTRY_ID,PGM_SYS_ACRNM,PGM_SYS_ID,SIC_CODE\r" + b"\r".join(rows)
    archive = write_archive(tmp_path / "a.zip", {SPECS["sic"].member: body})
    store = Store(spark, str(tmp_path / "s"))
    result = land_archive(store, archive, only=["sic"])[0]
    assert (result.rows, result.malformed_rows) == (1002, 0)
    raw = store.read("raw/sic")
    assert raw.filter("SIC_CODE = '0941'").count() == 1002
    assert {r[0] for r in raw.filter("PGM_SYS_ID LIKE '%PIPE'").select("PGM_SYS_ID").collect()} == {
        '7" PIPE', '407" PIPE', '807" PIPE'}


def test_archives_of_one_extract_add_up_and_others_replace(spark, tmp_path):
    def one(name, ids):
        rows = [{**ROWS["sic"][0], "PGM_SYS_ID": i} for i in ids]
        return write_archive(tmp_path / name, {SPECS["sic"].member: csv_bytes("sic", rows)})

    store = Store(spark, str(tmp_path / "s"))
    first, second = one("1.zip", "ab"), one("2.zip", "cde")
    both = land_archive(store, [first, second], only=["sic"])[0]
    assert both.rows == 5 and store.read("raw/sic").count() == 5
    assert land_archive(store, [first, second], only=["sic"])[0].reused
    assert [r.rows for r in land_archive(store, second, only=["sic"])] == [3]
    one("2.zip", "xyzw")  # new content under the old name
    assert [(r.rows, r.reused) for r in land_archive(store, second, only=["sic"])] == [(4, False)]


def test_a_failing_member_leaves_the_others_audited(spark, tmp_path):
    archive = write_archive(tmp_path / "a.zip", {SPECS["sic"].member: csv_bytes("sic") + b"1,2\n",
                                                 SPECS["naics"].member: csv_bytes("naics")})
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(MalformedRows):
        land_archive(store, archive, only=["sic", "naics"])
    assert [r.table for r in spark.read.parquet(f"{store.root}/{AUDIT}").collect()] == ["naics"]


def test_repair_runs_once_and_after_the_exchange(spark, mini_archive):
    entry = manifest(spark, [mini_archive]).filter(F.col("member") == SPECS["sic"].member).first()
    rows = parse_records(repair_records(member_records(spark, mini_archive, entry.member, 1 << 30)), entry.header)
    shown = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = shown.split("RepartitionByExpression")
    assert above.count("is_valid_utf8") + above.count("make_valid") <= 1 and "decode" not in below
    assert "valid" not in below


def test_header_bom_and_bad_bytes(spark, tmp_path):
    heads = {"A.csv": b'\xef\xbb\xbf"A","B ""C"""\r\n1,2\n', "B.csv": b"A,B\xb0\n", "C.csv": b"",
             "D.csv": b'S\x00IC,"x\ny",,"p,q"\n1,2,3,4\n'}
    rows = manifest(spark, [write_archive(tmp_path / "h.zip", heads)]).collect()
    assert {r.member: r.header for r in rows} == {
        "A.csv": ["A", 'B "C"'], "B.csv": ["A", "B�"], "C.csv": None, "D.csv": ["SIC", "x\ny", "", "p,q"]}


def test_random_bytes_repair_like_a_replacing_decoder(spark):
    rng = np.random.default_rng(7)
    pool = np.array([0x41, 0xFF, 0xC3, 0x28, 0xE4, 0xB8, 0xAD, 0x00, 0x1F, 0xF0, 0x9F, 0xEF, 0xBF, 0xBD], np.uint8)
    samples = [bytes(pool[rng.integers(0, len(pool), 40)]) for _ in range(2000)]
    control = bytes(b for b in range(32) if b not in (9, 10, 13))
    rows = repair_records(spark.createDataFrame(list(enumerate(samples)), "i int, record binary")).collect()
    for row in rows:
        stripped = samples[row.i].translate(None, control)
        text = stripped.decode("utf-8", errors="replace")
        marks = stripped.count(b"\xef\xbf\xbd")
        assert row.text == text
        assert row.control_bytes == 40 - len(stripped)
        assert row.source_replacements == marks
        kept = sum(len(c.encode()) for c in text if c != "�") + 3 * marks
        assert row.bad_bytes == len(stripped) - kept


@pytest.mark.parametrize("raw, text, control, bad, marks", [
    (b"hello,world", "hello,world", 0, 0, 0),
    (b"a\tb\r\nc", "a\tb\r\nc", 0, 0, 0),
    (b"\x00" * 20_000 + b"x", "x", 20_000, 0, 0),
    (b"90\xb0 works", "90� works", 0, 1, 0),
    (b"\xff" * 50, "�" * 50, 0, 50, 0),
    ("already � there".encode(), "already � there", 0, 0, 1),
    ("café 中文 😀".encode(), "café 中文 😀", 0, 0, 0),
    (b"\xc3\x00\xa9", "é", 1, 0, 0),
])
def test_byte_repair(spark, raw, text, control, bad, marks):
    row = repair_records(spark.createDataFrame([(raw,)], "record binary")).first()
    assert tuple(row) == (text, control, bad, marks)


def test_fields_split_by_csv_rules(spark):
    records = [b'"a","x\r\ny","q""q"\r\n', b'"",NA,n/a\n', b"\r\n", b'" a ", b,"c, d"\n', b'"\x00","1",2\n']
    frame = repair_records(spark.createDataFrame([(r,) for r in records], "record binary"))
    rows = [tuple(r) for r in parse_records(frame, ["x", "ODD\"NAME", "Z 1"]).collect()]
    assert rows == [("a", "x\r\ny", 'q"q'), (None, None, None), (" a ", " b", "c, d"), (None, "1", "2")]
    kept = parse_records(frame, ["x", "y", "z"], null_tokens=("",)).collect()
    assert tuple(kept[1]) == (None, "NA", "n/a")


def test_exports(spark, built, tmp_path):
    links = built[0].read("crosswalk")
    for suffix in ("parquet", "csv", "tsv"):
        plans.export(links, str(tmp_path / f"x.{suffix}"))
    assert spark.read.parquet(str(tmp_path / "x.parquet")).count() == len(LINKS)
    tsv = spark.read.csv(str(tmp_path / "x.tsv"), sep="\t", header=True)
    assert tsv.filter("PGM_SYS_ACRNM = 'TRIS'").first().source_tables == "[contact, facility_acrnms, naics, organization]"
    assert spark.read.csv(str(tmp_path / "x.csv"), header=True).count() == len(LINKS)
    with pytest.raises(ValueError):
        plans.export(links, str(tmp_path / "x.xlsx"))
    report = plans.run_quality(built[0])
    plans.export_report(report, str(tmp_path / "r.json"), only_problems=True)
    problems = spark.read.json(str(tmp_path / "r.json"))
    assert problems.count() == TALLY["warn"] and set(problems.columns) <= {"name", "status", "value", "detail"}


def test_info_and_ad_hoc_sql(spark, built):
    counts = {r.table: r.n for r in plans.info_listing(built[0]).collect()}
    assert counts == {t: len(rows) for t, rows in ROWS.items()}
    layers = plans.open_layers(built[0])
    rows = layers.query(spark, "SELECT c.PGM_SYS_ID FROM crosswalk c JOIN raw_facility r USING (REGISTRY_ID) "
                               "JOIN facility f USING (REGISTRY_ID) WHERE f.STATE_CODE = 'GU'").collect()
    assert {r[0] for r in rows} == {WELL[2]}


def test_ad_hoc_sql_only_reads_and_sees_no_other_build(spark, built, tmp_path):
    layers = plans.open_layers(built[0])
    layers.query(spark, "SELECT * FROM water_system;").count()
    empty = plans.open_layers(Store(spark, str(tmp_path)))
    for text in ("SELECT * FROM water_system", "DROP TABLE crosswalk", "INSERT INTO crosswalk SELECT 1, 2, 3, 4, 5"):
        with pytest.raises(Exception):
            empty.query(spark, text)
        if not text.startswith("SELECT"):
            with pytest.raises(Exception):
                layers.query(spark, text)
    rows = layers.query(spark, "WITH c AS (SELECT * FROM crosswalk) SELECT PGM_SYS_ID FROM c ORDER BY 1 DESC -- all").collect()
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), reverse=True) and len(rows) == len(LINKS)


def test_a_store_without_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert plans.build(store).tables == []
    assert {r.n for r in plans.info_listing(store).collect()} == {None}


def test_a_build_without_interests_has_no_water_table(spark, mini_archive, tmp_path):
    store = Store(spark, str(tmp_path))
    info = plans.run_all(store, mini_archive, only=["facility", "sic"])
    assert info.crosswalk_rows == 7 and not store.has("water_system")


def test_streamed_drops_land_once(spark, mini_archive, tmp_path):
    inbox, seen = tmp_path / "in", []
    inbox.mkdir()

    def run():
        land_drops(spark, str(inbox), str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), only=["facility", "sic"],
                   done=lambda name, info: seen.append((name, info.crosswalk_rows))).awaitTermination()

    body = open(mini_archive, "rb").read()
    (inbox / "m1.zip").write_bytes(body)
    run()
    (inbox / "m2.zip").write_bytes(body)
    run()
    assert seen == [("m1", 7), ("m2", 7)]
