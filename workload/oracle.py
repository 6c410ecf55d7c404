"""The checking SQL: each query's answer worked out independently in DuckDB."""

from __future__ import annotations

from functools import cache

from regweave.functions.codes import COUNTRY_SPELLINGS, STATE_NUMBERS
from regweave.functions.text import NULL_TOKENS
from regweave.operators.quality import MARKED_COLUMNS
from regweave.registry import (
    LINK_SOURCES, LINK_TABLES, PACKED_SOURCE, PERSONAL_COLUMNS, SPECS, spec_names,
)
from workload import analytics_oracle
from workload.bindings import BASE_TABLES, RAW_TABLES, date_text, raw_sql
from workload.queries import LOOKUP_ID, PIVOT_ACRONYMS

_LINK = "REGISTRY_ID, PGM_SYS_ACRNM, PGM_SYS_ID"


def _listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# -- rules ------------------------------------------------------------------------


def text(c: str) -> str:
    """Words joined by single spaces: collapses and trims in one step."""
    words = f"list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')"
    return f"nullif(array_to_string({words}, ' '), '')"


def upper(c: str) -> str:
    return f"upper({text(c)})"


def date(c: str) -> str:
    """Spell the year out in full, then parse with a four-digit year."""
    shape = r"'^\s*([0-9]{1,2}-[A-Za-z]{3}-)([0-9]{1,2})\s*$'"
    year = f"try_cast(regexp_extract({c}, {shape}, 2) AS integer)"
    full = (
        f"regexp_extract({c}, {shape}, 1) || cast({year} + if({year} >= 50, 1900, 2000) AS varchar)"
    )
    return f"cast(try_strptime({full}, '%d-%b-%Y') AS date)"


def year_digits(c: str) -> str:
    return f"try_cast(right(trim({c}), 2) AS integer)"


def country(c: str) -> str:
    pairs = [f"'{s}': '{iso}'" for iso, names in COUNTRY_SPELLINGS.items() for s in names]
    name = upper(c)
    return f"coalesce(map {{{', '.join(pairs)}}}[{name}], {name})"


def state(c: str) -> str:
    return f"if({upper(c)} IN ({_listed(STATE_NUMBERS)}), {upper(c)}, NULL)"


def zip5(c: str) -> str:
    return f"nullif(regexp_extract({text(c)}, '^[0-9]{{5}}'), '')"


def county(fips: str, st: str) -> str:
    numbers = ", ".join(f"'{s}': '{n}'" for s, n in STATE_NUMBERS.items())
    digits = f"regexp_extract({text(fips)}, '^[0-9]{{5}}$')"
    return f"if(left({digits}, 2) = map {{{numbers}}}[{upper(st)}], {digits}, NULL)"


def coordinate(c: str, low: int = -180, high: int = 180) -> str:
    value = f"try_cast(trim({c}) AS double)"
    return f"if({value} >= {low} AND {value} <= {high} AND {value} <> 0, {value}, NULL)"


def _rule(table: str, column: str) -> str:
    if column in SPECS[table].date_columns or column.endswith("_DATE"):
        return date(column)
    if column == "LATITUDE83":
        return coordinate(column, -90, 90)
    if column == "LONGITUDE83":
        return coordinate(column)
    if column == "STATE_CODE":
        return state(column)
    if column == "COUNTRY_NAME":
        return country(column)
    return text(column)


@cache
def clean_sql(table: str) -> str:
    columns = RAW_TABLES[table][2]
    parts = [f"{_rule(table, c)} AS {c}" for c in columns]
    if "POSTAL_CODE" in columns:
        parts.append(f"{zip5('POSTAL_CODE')} AS POSTAL_CODE_ZIP5")
    if "STATE_CODE" in columns:
        parts.append(f"{upper('STATE_CODE')} AS STATE_CODE_RAW")
    if {"FIPS_CODE", "STATE_CODE"} <= set(columns):
        parts.append(f"{county('FIPS_CODE', 'STATE_CODE')} AS FIPS_CODE_COUNTY5")
    # A FROM-less alias clash would let a rule read a cleaned column; raw stays apart.
    return f"SELECT {', '.join(parts)} FROM ({raw_sql(table)}) AS source"


# -- links ------------------------------------------------------------------------

_EXPLODED = """
SELECT REGISTRY_ID,
       CASE WHEN starts_with(item, ':') THEN '' ELSE upper(trim(split_part(item, ':', 1))) END AS PGM_SYS_ACRNM,
       CASE WHEN starts_with(item, ':') THEN trim(item)
            ELSE trim(item[length(split_part(item, ':', 1)) + 2 :]) END AS PGM_SYS_ID
FROM (SELECT REGISTRY_ID, unnest(str_split(PGM_SYS_ACRNMS, ', ')) AS item FROM facility)
WHERE contains(item, ':')"""


def _ctes(*names: str) -> str:
    """WITH clause holding the normalised tables asked for, raw ones as raw_x."""
    bodies = []
    for n in names:
        if n.startswith("raw_"):
            bodies.append(f"{n} AS ({raw_sql(n[4:])})")
        elif n in SPECS:
            bodies.append(f"{n} AS ({clean_sql(n)})")
        elif n == "assertions":
            parts = [f"SELECT {_LINK}, '{t}' AS src FROM {t}" for t in LINK_TABLES]
            parts.append(f"SELECT *, '{PACKED_SOURCE}' AS src FROM ({_EXPLODED})")
            bodies.append("assertions AS (" + " UNION ALL ".join(parts) + ")")
        elif n in ("links", "public_links"):
            rows = "assertions" if n == "links" else "(FROM assertions WHERE src <> 'contact')"
            bodies.append(
                f"{n} AS (SELECT {_LINK}, count(*) AS source_table_count, "
                f"string_agg(src, '|' ORDER BY src) AS source_tables "
                f"FROM (SELECT DISTINCT * FROM {rows}) WHERE REGISTRY_ID IS NOT NULL "
                f"AND PGM_SYS_ACRNM IS NOT NULL AND PGM_SYS_ID IS NOT NULL GROUP BY ALL)"
            )
        elif n == "water_system":
            bodies.append(f"water_system AS ({_WATER})")
    return "WITH " + ",\n".join(bodies) + "\n"


_ALL = tuple(RAW_TABLES)
_CROSSWALK = _ctes(*_ALL, "assertions", "links")

_WATER = f"""
SELECT l.REGISTRY_ID, l.PGM_SYS_ID AS SFDW_ID, regexp_extract(l.PGM_SYS_ID, '^[^ ]*') AS PWSID,
       nullif(regexp_replace(l.PGM_SYS_ID, '^[^ ]* ?', ''), '') AS SYSTEM_FACILITY_ID,
       {state("left(regexp_extract(l.PGM_SYS_ID, '^[^ ]*'), 2)")} AS PWSID_STATE,
       i.INTEREST_TYPE, i.ACTIVE_STATUS, i.START_DATE, i.END_DATE,
       f.PRIMARY_NAME, f.CITY_NAME, f.COUNTY_NAME, f.STATE_CODE, f.FIPS_CODE_COUNTY5,
       f.LATITUDE83, f.LONGITUDE83
FROM links l
LEFT JOIN environmental_interest i USING (REGISTRY_ID, PGM_SYS_ACRNM, PGM_SYS_ID)
LEFT JOIN facility f ON l.REGISTRY_ID = f.REGISTRY_ID
WHERE l.PGM_SYS_ACRNM = 'SFDW'"""


# -- quality ----------------------------------------------------------------------


def _line(name: str, value: str, status: str, number: str | None = None) -> str:
    shown = number or value
    return (
        f"SELECT '{name}' AS name, {status} AS status, cast({value} AS varchar) AS value, "
        f"cast({shown} AS bigint) AS value_num"
    )


def _zero_ok(name: str, count: str, otherwise: str = "warn") -> str:
    return (
        f"SELECT '{name}' AS name, if(n = 0, 'ok', '{otherwise}') AS status, "
        f"cast(n AS varchar) AS value, cast(n AS bigint) AS value_num FROM ({count})"
    )


_SHAPE = (
    "CASE WHEN FIPS_CODE IS NULL THEN 'null' "
    "WHEN length(FIPS_CODE) = 5 AND translate(FIPS_CODE, '0123456789', '') = '' THEN 'county_fips_5' "
    "WHEN length(FIPS_CODE) = 5 AND regexp_full_match(FIPS_CODE, '[A-Z][A-Z][0-9]+') THEN 'usps_prefix_3' "
    "WHEN translate(FIPS_CODE, '0123456789', '') = '' THEN 'numeric_wrong_length' ELSE 'other' END"
)
_BAD_STATE = "STATE_CODE IS NULL AND STATE_CODE_RAW IS NOT NULL"
_UNMAPPABLE = (
    "LATITUDE83 IS NOT NULL AND NOT coalesce(LONGITUDE83 >= -180 AND LONGITUDE83 <= -64 "
    "AND LATITUDE83 >= 17 AND LATITUDE83 <= 72, false)"
)
_CLASH = f"{_SHAPE} = 'county_fips_5' AND STATE_CODE IS NOT NULL AND FIPS_CODE_COUNTY5 IS NULL"
_ADJUSTED = "{c} IS NOT NULL AND {d} IS NOT NULL AND {y} BETWEEN 50 AND 68"
_PACKED_ONLY = "contains('|' || source_tables || '|', '|facility_acrnms|') AND NOT contains('|' || source_tables || '|', '|program|')"
_PROGRAM_ONLY = "contains('|' || source_tables || '|', '|program|') AND NOT contains('|' || source_tables || '|', '|facility_acrnms|')"


def _adjusted(c: str) -> str:
    return f"{date(c)} IS NOT NULL AND {year_digits(c)} BETWEEN 50 AND 68"


def _unparseable(c: str) -> str:
    return f"trim({c}) <> '' AND {date(c)} IS NULL"


_MARKED = (("facility", "PRIMARY_NAME"), ("facility", "LOCATION_ADDRESS"),
           ("alternative_name", "ALTERNATIVE_NAME"), ("organization", "ORG_NAME"),
           ("mailing_address", "MAILING_ADDRESS"))


def _report_lines(without: tuple[str, ...] = (), links: str = "links") -> str:
    held = [t for t in spec_names() if t not in without]
    lines = []
    for t in spec_names():
        if t in without:
            lines.append(f"SELECT 'rows.{t}', 'warn', '0', 0")
        else:
            lines.append(
                f"SELECT 'rows.{t}' AS name, if(n > 0, 'ok', 'fail') AS status, "
                f"cast(n AS varchar) AS value, n AS value_num FROM (SELECT count(*) AS n FROM raw_{t})"
            )
    lines.append(_zero_ok(
        "facility.registry_id_unique",
        "SELECT count(*) AS n FROM (SELECT 1 FROM raw_facility GROUP BY REGISTRY_ID HAVING count(*) > 1)",
        "fail"))
    for t in held:
        if t != "facility":
            lines.append(_zero_ok(
                f"orphans.{t}",
                f"SELECT count(*) AS n FROM raw_{t} c ANTI JOIN raw_facility f ON c.REGISTRY_ID = f.REGISTRY_ID"))
    for t in held:
        for c in SPECS[t].date_columns:
            if c in RAW_TABLES[t][2]:
                lines.append(_zero_ok(
                    f"dates.{t}.{c}.unparseable",
                    f"SELECT count(*) FILTER ({_unparseable(c)}) AS n FROM raw_{t}"))
                lines.append(
                    f"SELECT 'dates.{t}.{c}.century_adjusted', 'warn', cast(n AS varchar), n "
                    f"FROM (SELECT count(*) FILTER ({_adjusted(c)}) AS n FROM raw_{t}) WHERE n > 0")
    lines.append(_zero_ok("facility.state_code_out_of_domain",
                          f"SELECT count(*) AS n FROM facility WHERE {_BAD_STATE}"))
    lines.append(
        "SELECT 'facility.fips_code_shapes', if(u = p, 'ok', 'warn'), "
        "format('{:,} usable of {:,} non-null', u, p), u "
        f"FROM (SELECT count(*) FILTER ({_SHAPE} = 'county_fips_5') AS u, count(FIPS_CODE) AS p FROM facility)")
    lines.append(_zero_ok("facility.fips_state_disagreement",
                          f"SELECT count(*) AS n FROM facility WHERE {_CLASH}"))
    lines.append(
        "SELECT 'facility.coordinates_present', if(100.0 * p / t > 50, 'ok', 'warn'), "
        "format('{:,} / {:,} ({:.1f}%)', p, t, 100.0 * p / t), p "
        "FROM (SELECT count(LATITUDE83) AS p, count(*) AS t FROM facility)")
    lines.append(_zero_ok("facility.coordinates_unusable",
                          f"SELECT count(*) AS n FROM facility WHERE {_UNMAPPABLE}"))
    marks = " + ".join(
        f"(SELECT count(*) FROM raw_{t} WHERE contains({c}, '�'))"
        for t, c in _MARKED if c in RAW_TABLES[t][2])
    lines.append(_zero_ok("text.replacement_characters", f"SELECT {marks} AS n"))
    lines.append(_zero_ok("crosswalk.in_facility_string_not_program_table",
                          f"SELECT count(*) AS n FROM {links} WHERE {_PACKED_ONLY}"))
    lines.append(_zero_ok("crosswalk.in_program_table_not_facility_string",
                          f"SELECT count(*) AS n FROM {links} WHERE {_PROGRAM_ONLY}"))
    lines.append(
        "SELECT 'crosswalk.single_source_links', 'ok', format('{:,} / {:,}', s, t), s "
        f"FROM (SELECT count(*) FILTER (source_table_count = 1) AS s, count(*) AS t FROM {links})")
    return " UNION ALL ".join(lines)


_RAW_ALL = tuple(f"raw_{t}" for t in RAW_TABLES)
_REPORT_CTES = _ctes(*_RAW_ALL, *_ALL, "assertions", "links", "public_links")
_REPORT = f"SELECT name, status, value, value_num FROM ({_report_lines()}) AS r(name, status, value, value_num)"
_PUBLIC_REPORT = (
    "SELECT name, status, value, value_num FROM "
    f"({_report_lines(('contact',), 'public_links')}) AS r(name, status, value, value_num)"
)

_SAMPLES = (
    "SELECT * FROM (SELECT 'facility.state_code_out_of_domain' AS name, STATE_CODE_RAW AS key, count(*) AS n "
    f"FROM facility WHERE {_BAD_STATE} GROUP BY STATE_CODE_RAW ORDER BY n DESC, key LIMIT 20) "
    f"UNION ALL SELECT 'facility.fips_code_shapes', {_SHAPE}, count(*) FROM facility GROUP BY 2 "
    + "".join(
        f"UNION ALL SELECT * FROM (SELECT 'text.replacement_characters', '{t}.{c}', count(*) AS n "
        f"FROM raw_{t} WHERE contains({c}, '�')) WHERE n > 0 "
        for t, c in _MARKED if c in RAW_TABLES[t][2])
)

_PROFILE = " UNION ALL ".join(
    [f"SELECT 'rows.{t}' AS measure, count(*) AS n FROM raw_{t}" for t in RAW_TABLES]
    + ["SELECT 'duplicates.facility', count(*) FROM (SELECT 1 FROM raw_facility GROUP BY REGISTRY_ID HAVING count(*) > 1)"]
    + [f"SELECT 'orphans.{t}', count(*) FROM raw_{t} c ANTI JOIN raw_facility f ON c.REGISTRY_ID = f.REGISTRY_ID"
       for t in RAW_TABLES if t != "facility"]
)

_PIVOT = ", ".join(
    f"coalesce(string_agg(PGM_SYS_ID, '|' ORDER BY PGM_SYS_ID) FILTER (PGM_SYS_ACRNM = '{a}'), '') AS "
    + a.replace("/", "_").replace("-", "_").replace(" ", "_")
    for a in PIVOT_ACRONYMS
)

_TOKEN = (
    "CASE o_custkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN 'NaN' "
    "WHEN 4 THEN 'null' WHEN 5 THEN 'Na' ELSE o_orderpriority END"
)


def _occurs(letter: str) -> str:
    return f"(length(text) - length(replace(text, '{letter}', '')))"


_INFO = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{SPECS[t].grain}' AS grain, (SELECT count(*) FROM raw_{t}) AS n"
    for t in RAW_TABLES
)

_SOURCES = " UNION ALL ".join(
    f"SELECT '{s}' AS source_table, {i} AS scan_order, "
    f"(SELECT count(*) FROM assertions WHERE src = '{s}') AS assertions"
    for i, s in enumerate(LINK_SOURCES)
)

ORACLE: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {text('text')} AS text, upper(lang) || ' ' || upper(source) AS label FROM documents",
    "parse_date_pivot":
        "SELECT o_orderkey, cast(o_orderdate AS date) AS recent, "
        "cast(o_orderdate - INTERVAL 40 YEAR AS date) AS early FROM orders",
    "code_rules":
        f"SELECT REGISTRY_ID, {country('COUNTRY_NAME')} AS country, {state('STATE_CODE')} AS state, "
        f"{zip5('POSTAL_CODE')} AS zip5, {upper('MAILING_ADDRESS')} AS address FROM ({raw_sql('mailing_address')})",
    "coord_bounds":
        f"SELECT c_custkey, {coordinate('t', -90, 90)} AS latitude, {coordinate('t')} AS longitude "
        "FROM (SELECT c_custkey, ' ' || cast(cast(floor(c_acctbal / 50) AS bigint) AS varchar) || '.5' AS t FROM customer)",
    "null_tokens":
        f"SELECT o_orderkey, if(w IN ({_listed(NULL_TOKENS)}), NULL, w) AS compatible, "
        f"nullif(w, '') AS empty_only FROM (SELECT o_orderkey, {_TOKEN} AS w FROM orders)",
    "repair_bytes":
        "SELECT doc_id, replace(replace(replace(text, 'w', '�'), 'k', '�'), 'v', '�.') AS text, "
        f"2 * {_occurs('a')} AS control_bytes, {_occurs('w')} + 2 * {_occurs('v')} AS bad_bytes, "
        f"{_occurs('k')} + {_occurs('�')} AS source_replacements FROM documents",
    "strip_control":
        f"SELECT conv_id, turn, text, 3 * {_occurs('e')} AS control_bytes FROM conversations",
    "parse_csv_records":
        "SELECT cast(doc_id AS varchar) AS doc_id, lang, text, cast(NULL AS varchar) AS gone, "
        "cast(NULL AS varchar) AS token, source FROM documents",
    "clean_facility": clean_sql("facility"),
    "clean_program": clean_sql("program"),
    "explode_links": _ctes("facility") + _EXPLODED,
    "tagged_union": _ctes(*_ALL, "assertions") + "SELECT * FROM assertions",
    "crosswalk": _CROSSWALK + "SELECT * FROM links",
    "crosswalk_sources": _ctes(*_ALL, "assertions") + _SOURCES,
    "link_agreement": _CROSSWALK +
        f"SELECT count(*) FILTER ({_PACKED_ONLY}) AS in_facility_string_not_program_table, "
        f"count(*) FILTER ({_PROGRAM_ONLY}) AS in_program_table_not_facility_string, "
        "count(*) FILTER (source_table_count = 1) AS single_source_links, count(*) AS links FROM links",
    "water_systems": _CROSSWALK + _WATER,
    "program_pivot": _CROSSWALK + f"SELECT REGISTRY_ID, {_PIVOT} FROM links GROUP BY REGISTRY_ID",
    "facility_lookup": _CROSSWALK +
        f"SELECT PGM_SYS_ACRNM, PGM_SYS_ID, source_tables FROM links WHERE REGISTRY_ID = '{LOOKUP_ID}'",
    "water_population": _ctes(*_ALL, "assertions", "links", "water_system") +
        "SELECT INTEREST_TYPE, PWSID_STATE, count(*) AS interests, count(DISTINCT PWSID) AS systems, "
        "count(DISTINCT REGISTRY_ID) AS facilities FROM water_system GROUP BY ALL",
    "raw_against_clean": _ctes("raw_facility", "facility") +
        "SELECT r.STATE_CODE AS raw_state, f.STATE_CODE AS state, f.COUNTRY_NAME AS country, count(*) AS n "
        "FROM raw_facility r JOIN facility f USING (REGISTRY_ID) GROUP BY ALL",
    "raw_counts": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in BASE_TABLES),
    "info_listing": _ctes(*_RAW_ALL) + _INFO,
    "key_duplicates": "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    "key_profile": _ctes(*_RAW_ALL) + _PROFILE,
    "orphans": _ctes("raw_facility", "raw_environmental_interest") +
        "SELECT * FROM raw_environmental_interest WHERE REGISTRY_ID IS NULL "
        "OR REGISTRY_ID NOT IN (SELECT REGISTRY_ID FROM raw_facility WHERE REGISTRY_ID IS NOT NULL)",
    "unlabelled_documents":
        "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "date_quality": _REPORT_CTES + f"SELECT name, value_num AS n FROM ({_REPORT}) WHERE name LIKE 'dates.%'",
    "state_out_of_domain": _ctes("facility") +
        f", bad AS (SELECT STATE_CODE_RAW AS key, count(*) AS n FROM facility WHERE {_BAD_STATE} GROUP BY 1) "
        "SELECT NULL AS key, coalesce(sum(n), 0)::BIGINT AS n, true AS whole FROM bad "
        "UNION ALL (SELECT key, n, false FROM bad ORDER BY n DESC, key LIMIT 20)",
    "fips_shapes": _ctes("facility") + f"SELECT {_SHAPE} AS shape, count(*) AS n FROM facility GROUP BY 1",
    "fips_disagreement": _ctes("facility") +
        f"SELECT REGISTRY_ID, FIPS_CODE, STATE_CODE FROM facility WHERE {_CLASH}",
    "coordinate_coverage": _ctes("facility") +
        "SELECT count(*) AS total, count(LATITUDE83) AS present, "
        f"count(*) FILTER ({_UNMAPPABLE}) AS unusable FROM facility",
    "marker_chars": _ctes(*dict.fromkeys(f"raw_{t}" for t, _ in MARKED_COLUMNS)) + " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, '{c}' AS source_column, count(*) FILTER ({c} LIKE '%�%') AS n FROM raw_{t}"
        for t, c in MARKED_COLUMNS),
    "qa_report": _REPORT_CTES + _REPORT,
    "qa_samples": _REPORT_CTES + _SAMPLES,
    "qa_tally": _REPORT_CTES +
        "SELECT s.status, count(r.name) AS n FROM (VALUES ('ok'), ('warn'), ('fail')) AS s(status) "
        f"LEFT JOIN ({_REPORT}) r ON r.status = s.status GROUP BY s.status",
    "privacy_projection":
        "SELECT " + ", ".join(c for c in RAW_TABLES["organization"][2] if c not in PERSONAL_COLUMNS["organization"])
        + f" FROM ({raw_sql('organization')})",
    "privacy_link_diff": _ctes(*_ALL, "assertions", "links", "public_links") +
        f"SELECT {_LINK}, if(p.source_tables IS NULL, 'removed', 'changed') AS change, "
        "l.source_tables AS before, p.source_tables AS after "
        f"FROM links l LEFT JOIN public_links p USING ({_LINK}) "
        "WHERE l.source_tables IS DISTINCT FROM p.source_tables",
    "link_difference": _ctes(*_ALL, "assertions", "links", "public_links") +
        f"SELECT {_LINK}, if(p.source_tables IS NULL, 'added', 'changed') AS change, "
        "p.source_tables AS before, l.source_tables AS after "
        f"FROM links l LEFT JOIN public_links p USING ({_LINK}) "
        "WHERE l.source_tables IS DISTINCT FROM p.source_tables",
    "privacy_report_diff": _REPORT_CTES +
        "SELECT name, CASE WHEN o.status IS NULL THEN 'added' WHEN w.status IS NULL THEN 'removed' ELSE 'changed' END AS change, "
        "o.status AS old_status, w.status AS new_status, o.value AS old_value, w.value AS new_value "
        f"FROM ({_REPORT}) o FULL JOIN ({_PUBLIC_REPORT}) w USING (name) "
        "WHERE (o.status, o.value) IS DISTINCT FROM (w.status, w.value)",
} | analytics_oracle.ORACLE
