"""The registered queries: library operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from regweave.functions import repair
from regweave.functions.codes import country_code, fips_shape, state_code, zip5
from regweave.functions.coords import decimal_text, in_bounds, is_unmappable
from regweave.functions.dates import bare_date, pivot_date
from regweave.functions.text import fold_text, fold_upper, null_tokens_to_null
from regweave.layers import Layers
from regweave.operators import integrity, links as lk, quality
from regweave.operators.compare import link_diff, report_diff
from regweave.operators.clean import COUNTY, RAW_STATE
from regweave.operators.privacy import withhold
from regweave.operators.subset import water_system
from regweave.registry import PERSONAL_TABLES, registry_frame
from regweave.sources.records import parse_records, repair_records
from workload import analytics
from workload.bindings import BASE_TABLES, date_text, raw_table, raw_tables, table

Query = Callable[[SparkSession, str], DataFrame]
PIVOT_ACRONYMS = ["SFDW", "NPDES", "AIRS/AFS", "TX-TCEQ ACR"]
# The registry id the lookup query asks for.
LOOKUP_ID = "110000000001"


def layers(spark, sf_dir) -> Layers:
    return Layers(raw_tables(spark, sf_dir))


def build_crosswalk(spark, sf_dir, without=()) -> DataFrame:
    return lk.crosswalk(layers(spark, sf_dir).link_inputs(without))


def _flat(links: DataFrame, *columns: str) -> DataFrame:
    """Array columns joined to text, so both engines print them alike."""
    for c in columns:
        links = links.withColumn(c, F.array_join(c, "|"))
    return links


def built_layers(spark, sf_dir) -> Layers:
    base = layers(spark, sf_dir)
    links = lk.crosswalk(base.link_inputs())
    water = water_system(links, base.clean("environmental_interest"), base.clean("facility"))
    return Layers(base.raw, {"crosswalk": links, "water_system": water})


# -- scalar rules ---------------------------------------------------------------


def clean_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fold_text(F.col("text")).alias("text"),
                       fold_upper(F.concat(F.lit(" "), "lang", F.lit("\t"), "source")).alias("label"))


def parse_date_pivot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    texts = orders.selectExpr("o_orderkey", f"{date_text('o_orderdate')} AS recent",
                              f"{date_text('o_orderdate', 40)} AS early")
    return texts.select("o_orderkey", *[pivot_date(bare_date(F.col(c))).alias(c) for c in ("recent", "early")])


def code_rules(spark, sf_dir):
    raw = raw_table(spark, sf_dir, "mailing_address")
    return raw.select(
        "REGISTRY_ID",
        country_code(fold_upper(F.col("COUNTRY_NAME"))).alias("country"),
        state_code(fold_upper(F.col("STATE_CODE"))).alias("state"),
        zip5(fold_text(F.col("POSTAL_CODE"))).alias("zip5"),
        fold_upper(F.col("MAILING_ADDRESS")).alias("address"),
    )


def coord_bounds(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    text = F.concat(F.lit(" "), F.floor(F.col("c_acctbal") / 50).cast("string"), F.lit(".5"))
    values = customers.select("c_custkey", decimal_text(text).alias("value"))
    return values.select("c_custkey", in_bounds(F.col("value"), -90, 90).alias("latitude"),
                         in_bounds(F.col("value")).alias("longitude"))


def null_tokens(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    word = F.expr(
        "CASE o_custkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN 'NaN' "
        "WHEN 4 THEN 'null' WHEN 5 THEN 'Na' ELSE o_orderpriority END"
    )
    return orders.select("o_orderkey", null_tokens_to_null(word).alias("compatible"),
                         null_tokens_to_null(word, ("",)).alias("empty_only"))


def _damaged(c):
    """A text's bytes with control bytes, bad UTF-8 and U+FFFD worked in."""
    byte = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    for letter, put in (("a", "a\x00\x1f"), ("w", "\xb0"), ("k", "\xef\xbf\xbd"), ("v", "\xe4\xb8.")):
        byte = F.replace(byte, F.lit(letter), F.lit(put))
    return F.encode(byte, "ISO-8859-1")


def repair_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", _damaged(F.col("text")).alias("record"))
    fixed = repair_records(docs)
    return fixed.select("doc_id", "text", "control_bytes", "bad_bytes", "source_replacements")


def strip_control(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    dirty = F.replace(F.col("text"), F.lit("e"), F.lit("e\x00\x08\x1f"))
    clean = repair.strip_control(dirty)
    return talk.select("conv_id", "turn", clean.alias("text"),
                       repair.control_count(dirty, clean).alias("control_bytes"))


def parse_csv_records(spark, sf_dir):
    """Documents written as quoted CSV records with NULs inside, read back."""
    docs = table(spark, sf_dir, "documents")
    quoted = F.replace(F.col("text"), F.lit('"'), F.lit('""'))
    record = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), "lang", F.lit('","'), quoted,
                      F.lit('","\x00\x00",NA,"'), "source", F.lit('"\r\n'))
    raw = docs.select(F.encode(record, "UTF-8").alias("record"))
    return parse_records(repair_records(raw), ["doc_id", "lang", "text", "gone", "token", "source"])


# -- normalised layer and links -------------------------------------------------


def clean_facility(spark, sf_dir):
    return Layers({"facility": raw_table(spark, sf_dir, "facility")}).clean("facility")


def clean_program(spark, sf_dir):
    return Layers({"program": raw_table(spark, sf_dir, "program")}).clean("program")


def explode_links(spark, sf_dir):
    facility = Layers({"facility": raw_table(spark, sf_dir, "facility")})
    return lk.explode_packed(facility.link_inputs()["facility"])


def tagged_union(spark, sf_dir):
    return lk.tagged_union(layers(spark, sf_dir).link_inputs()).drop(lk.BIT)


def crosswalk(spark, sf_dir):
    return _flat(build_crosswalk(spark, sf_dir), "source_tables")


def crosswalk_sources(spark, sf_dir):
    """The denominator, with what each source asserts."""
    inputs = layers(spark, sf_dir).link_inputs()
    asserted = lk.tagged_union(inputs).groupBy("src").agg(F.count("*").alias("assertions"))
    sources = lk.crosswalk_sources(spark, inputs).withColumnRenamed("source_table", "src")
    return sources.join(asserted, "src", "left").select(
        F.col("src").alias("source_table"), "scan_order", F.coalesce("assertions", F.lit(0)).alias("assertions")
    )


def link_agreement(spark, sf_dir):
    return lk.link_agreement(build_crosswalk(spark, sf_dir))


def water_systems(spark, sf_dir):
    return built_layers(spark, sf_dir).built["water_system"]


def program_pivot(spark, sf_dir):
    pivot = lk.program_pivot(build_crosswalk(spark, sf_dir), PIVOT_ACRONYMS)
    return _flat(pivot, *[lk.pivot_column(a) for a in PIVOT_ACRONYMS])


def facility_lookup(spark, sf_dir):
    return _flat(lk.facility_lookup(build_crosswalk(spark, sf_dir), LOOKUP_ID), "source_tables")


def water_population(spark, sf_dir):
    """Ad-hoc SQL over the registered layers: systems by interest type."""
    return built_layers(spark, sf_dir).query(spark, """
        SELECT INTEREST_TYPE, PWSID_STATE, count(*) AS interests, count(DISTINCT PWSID) AS systems,
               count(DISTINCT REGISTRY_ID) AS facilities
        FROM water_system GROUP BY INTEREST_TYPE, PWSID_STATE""")


def raw_against_clean(spark, sf_dir):
    """Ad-hoc SQL across the raw and normalised layers: what the rules changed."""
    return Layers({"facility": raw_table(spark, sf_dir, "facility")}).query(spark, """
        SELECT r.STATE_CODE AS raw_state, f.STATE_CODE AS state, f.COUNTRY_NAME AS country, count(*) AS n
        FROM raw_facility r JOIN facility f ON f.REGISTRY_ID = r.REGISTRY_ID
        GROUP BY r.STATE_CODE, f.STATE_CODE, f.COUNTRY_NAME""")


# -- integrity and quality ------------------------------------------------------


def raw_counts(spark, sf_dir):
    return integrity.row_counts({t: table(spark, sf_dir, t) for t in BASE_TABLES})


def info_listing(spark, sf_dir):
    counts = integrity.row_counts(raw_tables(spark, sf_dir))
    return registry_frame(spark).select("table", "grain").join(counts, "table", "left")


def key_duplicates(spark, sf_dir):
    return integrity.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


def key_profile(spark, sf_dir):
    profile = integrity.key_profile(raw_tables(spark, sf_dir))
    return quality.unpivot(profile).select(F.col("key").alias("measure"), "n")


def orphans(spark, sf_dir):
    interests = raw_table(spark, sf_dir, "environmental_interest")
    return integrity.orphan_rows(interests, raw_table(spark, sf_dir, "facility"))


def unlabelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return integrity.orphan_rows(docs, table(spark, sf_dir, "labels"), "doc_id")


def date_quality(spark, sf_dir):
    """What the dates of all registered columns read as."""
    lines = quality.Dates()(Layers(raw_tables(spark, sf_dir)))
    return lines.select("name", F.col("value_num").alias("n"))


def state_out_of_domain(spark, sf_dir):
    bad = quality.out_of_domain(F.col("STATE_CODE"), F.col(RAW_STATE))
    return quality.top_values_of_all(clean_facility(spark, sf_dir), RAW_STATE, bad)


def fips_shapes(spark, sf_dir):
    shape = fips_shape(F.col("FIPS_CODE")).alias("shape")
    return clean_facility(spark, sf_dir).groupBy(shape).agg(F.count("*").alias("n"))


def fips_disagreement(spark, sf_dir):
    clash = quality.fips_disagrees(fips_shape(F.col("FIPS_CODE")), F.col("STATE_CODE"), F.col(COUNTY))
    return clean_facility(spark, sf_dir).filter(clash).select("REGISTRY_ID", "FIPS_CODE", "STATE_CODE")


def coordinate_coverage(spark, sf_dir):
    latitude, longitude = F.col("LATITUDE83"), F.col("LONGITUDE83")
    return clean_facility(spark, sf_dir).agg(
        F.count("*").alias("total"), F.count(latitude).alias("present"),
        F.count_if(is_unmappable(latitude, longitude)).alias("unusable"))


def marker_chars(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    parts = [
        raw[t].agg(F.count_if(F.col(c).contains(repair.REPLACEMENT)).alias("n"))
        .select(F.lit(t).alias("source_table"), F.lit(c).alias("source_column"), "n")
        for t, c in quality.MARKED_COLUMNS
    ]
    return reduce(DataFrame.unionByName, parts)


def _measurable(spark, sf_dir) -> Layers:
    """Raw tables with the masks of their links: a report counts sources and lists none."""
    raw = raw_tables(spark, sf_dir)
    return Layers(raw, {"crosswalk": lk.link_masks(lk.tagged_union(Layers(raw).link_inputs()))})


def _report(spark, sf_dir):
    return quality.fused_report(_measurable(spark, sf_dir), list(quality.ALL_CHECKS))


def qa_report(spark, sf_dir):
    return _report(spark, sf_dir).select("name", "status", "value", "value_num")


def qa_samples(spark, sf_dir):
    lines = _report(spark, sf_dir).select("name", F.explode("sample").alias("s"))
    return lines.select("name", F.col("s.key").alias("key"), F.col("s.n").alias("n"))


def qa_tally(spark, sf_dir):
    return quality.tally(_report(spark, sf_dir))


# -- privacy and comparison -----------------------------------------------------


def privacy_projection(spark, sf_dir):
    return withhold(raw_table(spark, sf_dir, "organization"), "organization")


def privacy_link_diff(spark, sf_dir):
    """What leaving the personal tables out does to the crosswalk."""
    masks = lk.link_masks(lk.tagged_union(layers(spark, sf_dir).link_inputs()))
    return _flat(lk.without_sources(masks, PERSONAL_TABLES), "before", "after")


def link_difference(spark, sf_dir):
    """Links of a build without the personal tables against those of the whole one."""
    before, after = build_crosswalk(spark, sf_dir, PERSONAL_TABLES), build_crosswalk(spark, sf_dir)
    return _flat(link_diff(before, after), "before", "after")


def privacy_report_diff(spark, sf_dir):
    """The report of all tables against the one without the personal tables."""
    return report_diff(*quality.reports_without(_measurable(spark, sf_dir), list(quality.ALL_CHECKS), tuple(PERSONAL_TABLES)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_text, parse_date_pivot, code_rules, coord_bounds, null_tokens, repair_bytes,
        strip_control, parse_csv_records, clean_facility, clean_program, explode_links,
        tagged_union, crosswalk, crosswalk_sources, link_agreement, water_systems, program_pivot,
        facility_lookup, water_population, raw_against_clean, raw_counts, info_listing,
        key_duplicates, key_profile, orphans, unlabelled_documents, date_quality,
        state_out_of_domain, fips_shapes, fips_disagreement, coordinate_coverage, marker_chars,
        qa_report, qa_samples, qa_tally, privacy_projection, privacy_link_diff,
        link_difference, privacy_report_diff,
    )
} | analytics.QUERIES
