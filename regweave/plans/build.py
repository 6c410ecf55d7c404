"""From landed tables to links, program tables, reports and exports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from regweave.layers import Layers
from regweave.operators import links as lk, quality
from regweave.operators.integrity import row_counts
from regweave.operators.subset import water_system
from regweave.plans.landing import Landed, land_archive, raw_name
from regweave.plans.layout import publish_links
from regweave.registry import SPECS, registry_frame
from regweave.sources.storage import Store

BUILT = ("crosswalk", "crosswalk_sources", "water_system")


class UnknownFormat(ValueError):
    """An export's suffix names no format."""


@dataclass
class Built:
    tables: list[str]
    crosswalk_rows: int = 0
    water_system_rows: int = 0
    landed: list[Landed] = field(default_factory=list)


def open_layers(store: Store, only: list[str] | None = None) -> Layers:
    """The relations a store currently holds; absent ones are simply not there."""
    names = [t for t in sorted(SPECS) if only is None or t in only]
    raw = {t: store.read(raw_name(t)) for t in names if store.has(raw_name(t))}
    return Layers(raw, {t: store.read(t) for t in BUILT if store.has(t)})


def _replace(store: Store, name: str, frame: DataFrame) -> DataFrame:
    path = store.write(name, frame)
    store.keep_only(name, path)
    return store.read(name)


def build(store: Store, *, with_crosswalk: bool = True) -> Built:
    """Materialise the crosswalk, its sources and the drinking-water table.

    They are written because they are joins and folds read again and again; the
    normalised layer stays a projection over the raw tables.
    """
    base = open_layers(store)
    info = Built(sorted(base.raw))
    if not (with_crosswalk and base.raw):
        return info

    # Laid out by facility: a lookup opens its file, a join by facility reads in order.
    links = publish_links(store, lk.crosswalk(base.link_inputs()))
    info.crosswalk_rows = links.count()
    _replace(store, "crosswalk_sources", lk.crosswalk_sources(store.spark, base.raw))
    if {"environmental_interest", "facility"} <= set(base.raw):
        water = water_system(links, base.clean("environmental_interest"), base.clean("facility"))
        info.water_system_rows = _replace(store, "water_system", water).count()
    else:
        store.purge("water_system")  # built from other inputs, it would mislead
    return info


def run_all(store: Store, archive: str | list[str], **landing) -> Built:
    landed = land_archive(store, archive, **landing)
    info = build(store)
    info.landed = landed
    return info


def run_quality(store: Store) -> DataFrame:
    return quality.run_checks(store.spark, open_layers(store))


def info_listing(store: Store) -> DataFrame:
    """Every registered table with its grain and row count, NULL when absent."""
    raw = open_layers(store).raw
    registry = registry_frame(store.spark).select("table", "grain")
    if not raw:
        return registry.withColumn("n", F.lit(None).cast("bigint"))
    return registry.join(row_counts(raw), "table", "left")


def flatten_arrays(frame: DataFrame) -> DataFrame:
    """Array columns as bracketed text, for formats without arrays."""
    arrays = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.ArrayType)]
    texts = {c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]")) for c in arrays}
    return frame.withColumns(texts) if texts else frame


def export(frame: DataFrame, path: str) -> None:
    """Write a result where the suffix says how: .parquet, .csv or .tsv.

    The target is a folder of part files, written in parallel.
    """
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        frame.write.mode("overwrite").parquet(path)
    elif suffix in ("csv", "tsv"):
        separator = "\t" if suffix == "tsv" else ","
        options = {"header": True, "sep": separator, "escape": '"'}
        flatten_arrays(frame).write.mode("overwrite").options(**options).csv(path)
    else:
        raise UnknownFormat(f"cannot export to .{suffix}: use .parquet, .csv or .tsv")


def export_report(report: DataFrame, path: str, *, only_problems: bool = False) -> None:
    """The quality report as JSON lines of name, status, value and detail."""
    lines = report.filter(F.col("status") != quality.OK) if only_problems else report
    lines.select("name", "status", "value", "detail").coalesce(1).write.mode("overwrite").json(path)
