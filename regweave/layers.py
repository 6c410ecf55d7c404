"""The relations of one build, and their names for ad-hoc SQL."""

from __future__ import annotations

from dataclasses import dataclass, field
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from regweave.operators.clean import clean_frame
from regweave.registry import LINK_KEY, LINK_TABLES, PACKED_LINKS, REGISTRY_KEY, SPECS

#: view names belong to the session, so queries take turns to use them
_VIEWS = RLock()


@dataclass(frozen=True)
class Layers:
    """Raw tables, their normalised form, and the tables built from them.

    Only what is listed here belongs to the build, so tables of an older build
    open in the same session are never mistaken for this one's; ``query`` sees no others.
    """

    raw: dict[str, DataFrame]
    built: dict[str, DataFrame] = field(default_factory=dict)

    def clean(self, name: str, *columns: str) -> DataFrame:
        """A normalised table, or just some of its columns."""
        return clean_frame(self.raw[name], SPECS[name], columns)

    def link_inputs(self, without=()) -> dict[str, DataFrame]:
        """What a crosswalk reads of each table that asserts links."""
        inputs = {t: self.clean(t, *LINK_KEY) for t in LINK_TABLES if t in self.raw}
        if "facility" in self.raw:
            inputs["facility"] = self.clean("facility", REGISTRY_KEY, PACKED_LINKS)
        return {t: frame for t, frame in inputs.items() if t not in without}

    @property
    def names(self) -> set[str]:
        return {f"raw_{t}" for t in self.raw} | set(self.raw) | set(self.built)

    def relation(self, name: str) -> DataFrame:
        if name in self.built:
            return self.built[name]
        return self.raw[name[4:]] if name.startswith("raw_") else self.clean(name)

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """One Spark SQL query over the raw, normalised and built relations.

        Their views exist only while the query is analysed, so no relation of another
        build answers. As a subquery the text can only read.
        """
        with _VIEWS:
            try:
                for name in self.names:
                    self.relation(name).createOrReplaceTempView(name)
                return spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")
            finally:
                for name in self.names:
                    spark.catalog.dropTempView(name)
