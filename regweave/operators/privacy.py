"""The privacy policy, applied before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from regweave.registry import PERSONAL_COLUMNS, PERSONAL_TABLES, TableSpec


class PersonalTable(ValueError):
    """Asked to filter a table that is personal as a whole."""


def publishable_tables(specs: list[TableSpec]) -> list[TableSpec]:
    return [s for s in specs if s.name not in PERSONAL_TABLES]


def personal_columns(table: str, columns: list[str]) -> list[str]:
    """The columns of a table the policy withholds."""
    if table in PERSONAL_TABLES:
        return list(columns)
    return [c for c in PERSONAL_COLUMNS.get(table, ()) if c in columns]


def publishable_columns(table: str, columns: list[str]) -> list[str]:
    """What may be written of a mixed table; wholly personal tables are refused."""
    if table in PERSONAL_TABLES:
        raise PersonalTable(f"{table} is entirely personal data: leave the table out")
    withheld = set(personal_columns(table, columns))
    kept = [c for c in columns if c not in withheld]
    if not kept:
        raise ValueError(f"{table}: the policy leaves no column to write")
    return kept


def withhold(frame: DataFrame, table: str) -> DataFrame:
    """The publishable projection of a table; withheld columns are not even read."""
    kept = set(publishable_columns(table, frame.columns))
    return frame.drop(*[c for c in frame.columns if c not in kept])
