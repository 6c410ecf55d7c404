"""The normalised layer: one rule per column, chosen by the column's role."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from regweave.functions.codes import country_code, county_fips, state_code, zip5
from regweave.functions.coords import COORDINATE_BOUNDS, decimal_text, in_bounds
from regweave.functions.dates import bare_date, pivot_date
from regweave.functions.text import fold_text, fold_upper
from regweave.registry import TableSpec

# Columns with a role of their own, and derived column names.
STATE_COLUMNS = frozenset({"STATE_CODE", "STD_STATE_CODE"})
COUNTRY_COLUMNS = frozenset({"COUNTRY_NAME", "STD_COUNTRY"})
POSTAL_COLUMNS = frozenset({"POSTAL_CODE", "STD_POSTAL_CODE"})
RAW_STATE = "STATE_CODE_RAW"
COUNTY = "FIPS_CODE_COUNTY5"


class DerivedColumnClash(ValueError):
    """A source now ships a column under the name of a derived one."""


def named(column: str) -> Column:
    """A column by its exact name, dots, quotes, spaces and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


@dataclass(frozen=True)
class Rule:
    """How a column is normalised: text is prepared once, then given its type.

    Preparing costs most, and codes are read by several output columns, so the
    two steps are separate projections and the first is never repeated.
    """

    prepare: Callable[[Column], Column]
    finish: Callable[[Column], Column] = lambda c: c


TEXT = Rule(fold_text)
DATE = Rule(bare_date, pivot_date)
STATE = Rule(fold_upper, state_code)
COUNTRY = Rule(fold_upper, country_code)


def rule_for(spec: TableSpec, column: str) -> Rule:
    """The rule of one source column; the first role that fits decides."""
    if column in spec.date_columns or column.endswith("_DATE"):
        return DATE
    if column in COORDINATE_BOUNDS:
        low, high = COORDINATE_BOUNDS[column]
        return Rule(decimal_text, lambda value: in_bounds(value, low, high))
    if column in STATE_COLUMNS:
        return STATE
    if column in COUNTRY_COLUMNS:
        return COUNTRY
    return TEXT


def _derived_rules(columns: list[str]) -> dict[str, tuple]:
    """Columns the layer adds: name -> (rule, prepared source columns it reads)."""
    derived = {f"{c}_ZIP5": (zip5, c) for c in columns if c in POSTAL_COLUMNS}
    if "STATE_CODE" in columns:
        derived[RAW_STATE] = (lambda code: code, "STATE_CODE")
        if "FIPS_CODE" in columns:
            derived[COUNTY] = (county_fips, "FIPS_CODE", "STATE_CODE")
    return derived


def clean_frame(raw: DataFrame, spec: TableSpec, only: tuple[str, ...] = ()) -> DataFrame:
    """Normalise a raw table, or some of its columns, source columns first.

    Two narrow projections: no row is dropped and nothing shuffles. Spark would
    let a duplicate name through and fail much later, at the write, so a clash
    of a derived column with a source column is refused here.
    """
    columns = raw.columns
    derived = _derived_rules(columns)
    clashes = sorted(set(columns) & set(derived))
    if clashes:
        raise DerivedColumnClash(
            f"{spec.name}: source column(s) {', '.join(clashes)} take a derived column's name"
        )
    wanted = only or (*columns, *derived)
    unknown = set(wanted) - set(columns) - set(derived)
    if unknown:
        raise KeyError(f"{spec.name} has no column {', '.join(sorted(unknown))}")

    read = {c for name in wanted for c in (derived[name][1:] if name in derived else (name,))}
    prepared = raw.select(
        *[rule_for(spec, c).prepare(named(c)).alias(c) for c in columns if c in read]
    )
    finished = []
    for name in wanted:
        if name in derived:
            rule, *sources = derived[name]
            finished.append(rule(*map(named, sources)).alias(name))
        else:
            finished.append(rule_for(spec, name).finish(named(name)).alias(name))
    return prepared.select(*finished)
