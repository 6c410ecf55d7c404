"""Registry-shaped raw tables derived from the given tables, row by row.

Every expression is written in the SQL both engines share, so the Spark queries
and the checking SQL read the same inputs. No binding groups or joins: a raw
table is one scan of its base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def date_text(ts: str, years_back: int = 0) -> str:
    """A timestamp as upper-case DD-MON-YY."""
    months = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
    return (
        f"lpad(cast(extract(day FROM {ts}) AS string), 2, '0') || '-' || "
        f"substr('{months}', cast(extract(month FROM {ts}) AS int) * 3 - 2, 3) || '-' || "
        f"lpad(cast((extract(year FROM {ts}) - {years_back}) % 100 AS string), 2, '0')"
    )


def _registry_id(key: str) -> str:
    return f"'11' || lpad(cast({key} AS string), 10, '0')"


def _program_id(key: str) -> str:
    return (
        f"CASE {key} % 6 WHEN 0 THEN 'OH' WHEN 1 THEN 'AR' WHEN 2 THEN 'MP' WHEN 3 THEN '06' "
        f"WHEN 4 THEN 'ZZ' ELSE 'AK' END || lpad(cast({key} AS string), 7, '0')"
    )


_LINE_ID = (
    f"{_program_id('l_orderkey')} || CASE WHEN l_linenumber % 3 = 0 "
    "THEN ' ' || cast(l_linenumber AS string) WHEN l_linenumber = 7 THEN ' 7TP UV' ELSE '' END"
)
_LINE_KEY = {
    "REGISTRY_ID": _registry_id("l_orderkey"),
    "PGM_SYS_ACRNM": "CASE l_linestatus WHEN 'F' THEN 'SFDW' ELSE 'NPDES' END",
    "PGM_SYS_ID": _LINE_ID,
}
_ORDER_KEY = {
    "REGISTRY_ID": _registry_id("o_orderkey"),
    "PGM_SYS_ACRNM": "CASE o_orderstatus WHEN 'F' THEN 'SFDW' WHEN 'O' THEN ' NPDES' ELSE 'RCRAINFO' END",
    "PGM_SYS_ID": _program_id("o_orderkey"),
}
_PART_KEY = {
    "REGISTRY_ID": _registry_id("p_partkey"),
    "PGM_SYS_ACRNM": "CASE WHEN p_size % 2 = 0 THEN 'NPDES' ELSE 'AIRS/AFS' END",
    "PGM_SYS_ID": f"CASE WHEN p_size % 7 = 0 THEN NULL ELSE {_program_id('p_partkey')} END",
}
_LINE_DATE = date_text("l_shipdate")
_LINE_DATE_OLD = date_text("l_shipdate", 40)
_PACKED = " || ".join((
    "CASE o_orderkey % 4 WHEN 0 THEN 'SFDW:' || " + f"({_program_id('o_orderkey')})"
    + " || ', NPDES:' || " + f"({_program_id('o_orderkey')})" + " || ' 3'"
    + " WHEN 1 THEN 'sfdw :' || " + f"({_program_id('o_orderkey')})"
    + " || ', NCDB:D06#' || cast(o_orderkey AS string) || ',T, LOOSE'"
    + " WHEN 2 THEN NULL"
    + " ELSE 'NPDES:' || " + f"({_program_id('o_orderkey')})" + " || ', :x, RCRAINFO:' END",
))

#: raw table -> (base table, row predicate or None, column expressions)
RAW_TABLES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "facility": ("orders", None, {
        # Some facilities have no key, some the key of the one before them.
        "REGISTRY_ID": "CASE WHEN o_orderkey % 997 <> 5 THEN CASE o_orderstatus WHEN 'P' THEN '19' ELSE '11' END || "
                       "lpad(cast(CASE WHEN o_orderkey % 499 = 3 THEN o_orderkey - 1 ELSE o_orderkey END AS string), 10, '0') END",
        "PRIMARY_NAME": "'  ' || o_orderpriority || '   WORKS' || chr(9) || cast(o_custkey AS string) "
                        "|| CASE WHEN o_custkey % 50 = 7 THEN ' CAF�' ELSE ' ' END",
        "LOCATION_ADDRESS": "cast(o_custkey AS string) || ' MAIN' || chr(10) || 'ST'",
        "CITY_NAME": "CASE o_custkey % 4 WHEN 0 THEN 'NILES' WHEN 1 THEN ' EL  DORADO' WHEN 2 THEN '' END",
        "COUNTY_NAME": "CASE o_custkey % 3 WHEN 0 THEN 'TRUMBULL' WHEN 1 THEN chr(9) ELSE 'UNION ' END",
        "FIPS_CODE": "CASE o_custkey % 6 WHEN 0 THEN '39155' WHEN 1 THEN '02020' WHEN 2 THEN 'AK090' "
                     "WHEN 3 THEN '04' WHEN 4 THEN 'X-1' END",
        "STATE_CODE": "CASE o_custkey % 7 WHEN 0 THEN ' oh' WHEN 1 THEN 'AK' WHEN 2 THEN 'CA' "
                      "WHEN 3 THEN 'XX' WHEN 4 THEN 'MP' WHEN 5 THEN 'T' || chr(cast(65 + o_custkey % 26 AS int)) ELSE '' END",
        "COUNTRY_NAME": "CASE o_custkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN ' united  states ' "
                        "WHEN 2 THEN 'Canada' WHEN 3 THEN 'Atlantis' ELSE 'U.S.A.' END",
        "POSTAL_CODE": "CASE o_custkey % 3 WHEN 0 THEN lpad(cast(o_custkey AS string), 5, '0') || '-1199' "
                       "WHEN 1 THEN 'ABCDE' ELSE ' ' END",
        "CREATE_DATE": date_text("o_orderdate"),
        "UPDATE_DATE": "CASE o_custkey % 11 WHEN 0 THEN 'garbage' WHEN 1 THEN '  ' WHEN 2 THEN '32-JAN-00' "
                       "WHEN 3 THEN '29-feb-01' WHEN 4 THEN '1-Jul-9' WHEN 5 THEN NULL "
                       f"ELSE {date_text('o_orderdate', 40)} END",
        "PGM_SYS_ACRNMS": _PACKED,
        "LATITUDE83": "CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '1d' "
                      "ELSE cast(o_custkey % 120 - 20 AS string) || '.25' END",
        "LONGITUDE83": "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE ' -' || cast(o_custkey % 200 AS string) || '.5' END",
    }),
    "program": ("lineitem", "l_returnflag = 'N'", {
        **_LINE_KEY,
        "PRIMARY_NAME": "'PROGRAM  ' || cast(l_suppkey AS string)",
        "LAST_REPORTED_DATE": _LINE_DATE,
        "CREATE_DATE": _LINE_DATE_OLD,
        "UPDATE_DATE": "CASE WHEN l_linenumber = 2 THEN 'n/k' ELSE '' END",
        "REFRESH_DATE": "cast(NULL AS string)",
    }),
    "environmental_interest": ("lineitem", "l_returnflag = 'R'", {
        **_LINE_KEY,
        "INTEREST_TYPE": "CASE l_linenumber % 3 WHEN 0 THEN 'WATER TREATMENT  PLANT' "
                         "WHEN 1 THEN 'COMMUNITY WATER SYSTEM' ELSE 'TRANSIENT' END",
        "START_DATE": _LINE_DATE_OLD,
        "END_DATE": _LINE_DATE,
        "ACTIVE_STATUS": "CASE WHEN l_quantity > 25 THEN 'ACTIVE' ELSE 'INACTIVE ' END",
    }),
    "contact": ("lineitem", "l_returnflag = 'A' AND l_linestatus = 'F'", {
        **_LINE_KEY,
        "FULL_NAME": "'PERSON ' || cast(l_suppkey AS string)",
        "EMAIL_ADDRESS": "'p' || cast(l_suppkey AS string) || '@example.com'",
        "START_DATE": _LINE_DATE,
    }),
    "organization": ("lineitem", "l_returnflag = 'A' AND l_linestatus = 'O'", {
        **_LINE_KEY,
        "AFFILIATION_TYPE": "CASE WHEN l_linenumber % 2 = 0 THEN 'OWNER' ELSE 'OPERATOR' END",
        "ORG_NAME": "'ORG ' || cast(l_suppkey AS string) || CASE WHEN l_partkey % 40 = 0 THEN '�' ELSE '' END",
        "EMAIL_ADDRESS": "'o' || cast(l_suppkey AS string) || '@example.com'",
        "PHONE_NUMBER": "'555' || lpad(cast(l_suppkey AS string), 7, '0')",
        "ALTERNATE_PHONE": "''",
        "FAX_NUMBER": "''",
        "END_DATE": _LINE_DATE_OLD,
    }),
    "supplemental_interest": ("orders", None, {
        **_ORDER_KEY,
        "SUP_INTEREST_TYPE": "o_orderpriority",
        "START_DATE": date_text("o_orderdate", 30),
        "UPDATE_DATE": date_text("o_orderdate"),
    }),
    "mailing_address": ("orders", None, {
        **_ORDER_KEY,
        "MAILING_ADDRESS": "cast(o_custkey AS string) || ' NORTH  PARK AVE'",
        "STATE_CODE": "CASE o_custkey % 3 WHEN 0 THEN 'OH' WHEN 1 THEN 'oh ' ELSE 'Q9' END",
        "POSTAL_CODE": "lpad(cast(o_custkey AS string), 9, '4')",
        "COUNTRY_NAME": "'UNITED STATES OF AMERICA'",
    }),
    "alternative_name": ("part", None, {
        **_PART_KEY,
        "ALTERNATIVE_NAME": "p_name || CASE WHEN p_size % 10 = 3 THEN ' 90�' ELSE '' END",
    }),
    "naics": ("part", None, {**_PART_KEY, "NAICS_CODE": "lpad(cast(p_size AS string), 6, '0')"}),
    "sic": ("customer", None, {
        "REGISTRY_ID": _registry_id("c_custkey"),
        "PGM_SYS_ACRNM": "CASE WHEN c_nationkey % 2 = 0 THEN 'TX-TCEQ ACR' ELSE 'SFDW' END",
        "PGM_SYS_ID": _program_id("c_custkey"),
        "SIC_CODE": "lpad(cast(c_nationkey AS string), 4, '0')",
    }),
}


def _bind(base: DataFrame, name: str) -> DataFrame:
    _, rows, columns = RAW_TABLES[name]
    frame = base.filter(rows) if rows else base
    return frame.selectExpr(*[f"{expr} AS {column}" for column, expr in columns.items()])


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table as the landing would leave it: every column text."""
    return _bind(table(spark, sf_dir, RAW_TABLES[name][0]), name)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All ten raw tables; each base table's footer is read once."""
    bases = {b: table(spark, sf_dir, b) for b in {binding[0] for binding in RAW_TABLES.values()}}
    return {name: _bind(bases[binding[0]], name) for name, binding in RAW_TABLES.items()}


def raw_sql(name: str) -> str:
    """The same raw table as SQL text."""
    base, rows, columns = RAW_TABLES[name]
    listed = ", ".join(f"{expr} AS {col}" for col, expr in columns.items())
    return f"SELECT {listed} FROM {base}" + (f" WHERE {rows}" if rows else "")
