"""Tables of one program, derived from the crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regweave.functions.codes import state_code
from regweave.operators.links import ACRONYM, PROGRAM_ID
from regweave.registry import REGISTRY_KEY

# The drinking-water program and the columns its table carries.
WATER_PROGRAM = "SFDW"
INTEREST_COLUMNS = ("INTEREST_TYPE", "ACTIVE_STATUS", "START_DATE", "END_DATE")
FACILITY_COLUMNS = (
    "PRIMARY_NAME", "CITY_NAME", "COUNTY_NAME", "STATE_CODE", "FIPS_CODE_COUNTY5",
    "LATITUDE83", "LONGITUDE83",
)


def program_links(links: DataFrame, program: str) -> DataFrame:
    return links.filter(F.col(ACRONYM) == program).select(REGISTRY_KEY, PROGRAM_ID)


def enrich_links(
    links: DataFrame, interests: DataFrame, facility: DataFrame, program: str
) -> DataFrame:
    """One program's links with their interests and facility, where known.

    Links drive the joins, so one asserted elsewhere still shows, with NULL
    interest fields; one with several interests shows once for each. Both sides
    are filtered and narrowed first, and the join strategy is left to AQE, which
    also splits a facility that holds very many links.
    """
    key = [REGISTRY_KEY, PROGRAM_ID]
    own = interests.filter(F.col(ACRONYM) == program).select(*key, *INTEREST_COLUMNS)
    places = facility.select(REGISTRY_KEY, *FACILITY_COLUMNS)
    return program_links(links, program).join(own, key, "left").join(places, REGISTRY_KEY, "left")


def water_system(links: DataFrame, interests: DataFrame, facility: DataFrame) -> DataFrame:
    """Drinking-water systems, and the facilities and units inside them.

    An identifier is a system id, optionally followed by a space and the id of a
    part; the part may itself hold spaces and is kept whole.
    """
    found = enrich_links(links, interests, facility, WATER_PROGRAM)
    system = F.split_part(PROGRAM_ID, F.lit(" "), F.lit(1))
    space = F.instr(PROGRAM_ID, " ")
    part = F.when(space > 0, F.expr(f"substring({PROGRAM_ID}, instr({PROGRAM_ID}, ' ') + 1)"))
    return found.select(
        REGISTRY_KEY,
        F.col(PROGRAM_ID).alias("SFDW_ID"),
        system.alias("PWSID"),
        part.alias("SYSTEM_FACILITY_ID"),
        state_code(F.upper(F.substring(system, 1, 2))).alias("PWSID_STATE"),
        *INTEREST_COLUMNS,
        *FACILITY_COLUMNS,
    )
