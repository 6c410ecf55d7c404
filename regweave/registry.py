"""Which source files exist, how they are keyed, and which parts are personal.

The registry names files, keys and date columns only. Full column lists come
from each file's own header, so a source may gain columns without a code change.
Every source column is a string: codes carry leading zeros and dates carry
two-digit years, so types are given later by explicit rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

REGISTRY_KEY = "REGISTRY_ID"
PROGRAM_KEY = ("PGM_SYS_ACRNM", "PGM_SYS_ID")
LINK_KEY = (REGISTRY_KEY, *PROGRAM_KEY)
PACKED_LINKS = "PGM_SYS_ACRNMS"
PACKED_SOURCE = "facility_acrnms"


@dataclass(frozen=True)
class TableSpec:
    name: str
    member: str
    grain: str
    key: tuple[str, ...]
    date_columns: tuple[str, ...] = ()


# Archive members, declared keys and date columns of the extract.
_INTEREST_DATES = ("START_DATE", "END_DATE", "LAST_REPORTED_DATE", "CREATE_DATE", "UPDATE_DATE")
_SPAN_DATES = ("START_DATE", "END_DATE")
SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("facility", "NATIONAL_FACILITY_FILE.CSV", "a facility",
                  (REGISTRY_KEY,), ("CREATE_DATE", "UPDATE_DATE")),
        TableSpec("program", "NATIONAL_PROGRAM_FILE.CSV", "a program record of a facility",
                  PROGRAM_KEY,
                  ("LAST_REPORTED_DATE", "CREATE_DATE", "UPDATE_DATE", "REFRESH_DATE")),
        TableSpec("environmental_interest", "NATIONAL_ENVIRONMENTAL_INTEREST_FILE.CSV",
                  "a permit or regulatory interest", (*PROGRAM_KEY, "INTEREST_TYPE"),
                  _INTEREST_DATES),
        TableSpec("supplemental_interest", "NATIONAL_SUPP_INTEREST_FILE.CSV",
                  "a state or enforcement interest",
                  (*PROGRAM_KEY, "SUP_PGM_SYS_ACRNM", "SUP_INTEREST_TYPE"), _INTEREST_DATES),
        TableSpec("organization", "NATIONAL_ORGANIZATION_FILE.CSV", "an affiliated organisation",
                  (*PROGRAM_KEY, "AFFILIATION_TYPE", "ORG_NAME"), _SPAN_DATES),
        TableSpec("contact", "NATIONAL_CONTACT_FILE.CSV", "an affiliated person",
                  (*PROGRAM_KEY, "AFFILIATION_TYPE", "FULL_NAME"), _SPAN_DATES),
        TableSpec("mailing_address", "NATIONAL_MAILING_ADDRESS_FILE.CSV", "a mailing address",
                  (*PROGRAM_KEY, "AFFILIATION_TYPE"), _SPAN_DATES),
        TableSpec("alternative_name", "NATIONAL_ALTERNATIVE_NAME_FILE.CSV", "another name in use",
                  (*PROGRAM_KEY, "ALTERNATIVE_NAME")),
        TableSpec("naics", "NATIONAL_NAICS_FILE.CSV", "a NAICS code", (*PROGRAM_KEY, "NAICS_CODE")),
        TableSpec("sic", "NATIONAL_SIC_FILE.CSV", "a SIC code", (*PROGRAM_KEY, "SIC_CODE")),
    )
}

# Tables that assert links directly, in their reporting order.
LINK_TABLES = (
    "program",
    "environmental_interest",
    "supplemental_interest",
    "organization",
    "contact",
    "mailing_address",
    "alternative_name",
    "naics",
    "sic",
)
LINK_SOURCES = (*LINK_TABLES, PACKED_SOURCE)

# What the privacy switch withholds.
PERSONAL_TABLES = frozenset({"contact"})
PERSONAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "contact": ("FULL_NAME", "PHONE_NUMBER", "ALTERNATE_PHONE", "FAX_NUMBER", "EMAIL_ADDRESS"),
    "organization": ("EMAIL_ADDRESS", "PHONE_NUMBER", "ALTERNATE_PHONE", "FAX_NUMBER"),
}


def spec_names() -> list[str]:
    return sorted(SPECS)


def specs_by_member() -> dict[str, TableSpec]:
    return {spec.member: spec for spec in SPECS.values()}


def text_schema(columns: list[str]) -> T.StructType:
    """An all-string schema; nothing is inferred."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def registry_frame(spark):
    """The registry as a small DataFrame, for joins in drift and info reports."""
    rows = [(s.name, s.member, s.grain, list(s.key), list(s.date_columns)) for s in SPECS.values()]
    return spark.createDataFrame(
        rows,
        "table string, member string, grain string, key array<string>, date_columns array<string>",
    )
