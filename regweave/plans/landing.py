"""Landing an archive: every member becomes a published all-text table."""

from __future__ import annotations

import time
from collections import defaultdict, namedtuple
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, functions as F

from regweave.functions.text import NULL_TOKENS
from regweave.operators.privacy import publishable_columns
from regweave.registry import PERSONAL_TABLES, SPECS, TableSpec, specs_by_member
from regweave.sources.archive import manifest, member_records, unregistered_members
from regweave.sources.records import parse_records, repair_records
from regweave.sources.storage import Store

AUDIT = "ingest_audit"
#: what is recorded of each landing of a table
AUDIT_FIELDS = {
    "table": "string",
    "inputs": "array<string>",
    "path": "string",
    "reused": "boolean",
    "finished": "double",
    "seconds": "double",
    "columns": "array<string>",
    "bytes_out": "bigint",
    "rows": "bigint",
    "malformed_rows": "bigint",
    "control_bytes": "bigint",
    "bad_bytes": "bigint",
    "source_replacements": "bigint",
}
AUDIT_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in AUDIT_FIELDS.items())
Landed = namedtuple("Landed", AUDIT_FIELDS)


class EmptyMember(RuntimeError):
    """A member holds no row."""


class MalformedRows(RuntimeError):
    """Rows with the wrong number of fields, and the policy is to fail."""


def raw_name(table: str) -> str:
    return f"raw/{table}"


def _inputs(entries: list[Row], options: dict) -> list[str]:
    """What a table is made from: members by checksum, and the reading options."""
    members = sorted(f"{e.archive} {e.member} {e.size} {e.crc:08x}" for e in entries)
    return members + [f"{name}={value}" for name, value in sorted(options.items())]


def _earlier(store: Store, table: str, inputs: list[str], columns: list[str]) -> Landed | None:
    """The audit of the current version, if it was landed from just these inputs."""
    path = store.current(raw_name(table))
    if path is None or not store.exists(AUDIT):
        return None
    log = store.spark.read.schema(AUDIT_SCHEMA).parquet(f"{store.root}/{AUDIT}")
    row = log.filter((F.col("path") == path) & ~F.col("reused")).orderBy(F.desc("finished")).first()
    if row is None or row.inputs != inputs or row.columns != columns:
        return None
    return Landed(*row)._replace(reused=True, seconds=0.0)


def land_table(
    store: Store,
    entries: list[Row],
    spec: TableSpec,
    *,
    force: bool = False,
    public: bool = False,
    null_tokens: tuple[str, ...] = NULL_TOKENS,
    fail_on_malformed: bool = True,
) -> Landed:
    """Land a table from its manifest rows, one for each archive that holds a part.

    The rows of all parts add up; a column that a part lacks is NULL there.
    ``public`` withholds personal columns before anything is written.
    """
    if not all(e.header for e in entries):
        raise EmptyMember(f"{spec.member} holds no header")
    kept = [publishable_columns(spec.name, e.header) if public else e.header for e in entries]
    columns = list(dict.fromkeys(c for names in kept for c in names))
    inputs = _inputs(entries, {"null_tokens": null_tokens, "fail_on_malformed": fail_on_malformed})
    if not force and (earlier := _earlier(store, spec.name, inputs, columns)):
        return earlier

    started = time.time()
    audits = [Observation(f"land_{spec.name}_{k}") for k in range(len(entries))]
    parts = [
        parse_records(
            repair_records(member_records(store.spark, e.archive, e.member, e.size)),
            e.header, null_tokens=null_tokens, audit=audit, keep=keep,
        )
        for e, keep, audit in zip(entries, kept, audits)
    ]
    path = store.write(raw_name(spec.name), reduce(_union, parts))
    counts: dict[str, int] = defaultdict(int)
    for audit in audits:
        for name, value in audit.get.items():
            counts[name] += value or 0
    if counts["rows"] == 0:
        store.drop_version(path)
        raise EmptyMember(f"{spec.member} holds no rows")
    if counts["malformed_rows"] and fail_on_malformed:
        store.drop_version(path)
        raise MalformedRows(f"{spec.member}: {counts['malformed_rows']} rows of the wrong width")
    store.keep_only(raw_name(spec.name), path)
    finished = time.time()
    return Landed(
        table=spec.name, inputs=inputs, path=path, reused=False, finished=finished, seconds=finished - started,
        columns=columns, bytes_out=store.size(path), **counts,
    )


def _union(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other, allowMissingColumns=True)


def drift(store: Store, archive: str | list[str]) -> list[str]:
    """Archive members the registry does not know."""
    archives = [archive] if isinstance(archive, str) else list(archive)
    unknown = unregistered_members(store.spark, manifest(store.spark, archives))
    return [row.member for row in unknown.collect()]


def land_archive(
    store: Store,
    archive: str | list[str],
    *,
    force: bool = False,
    public: bool = False,
    only: list[str] | None = None,
    at_once: int = 4,
    **options,
) -> list[Landed]:
    """Land every registered member, several tables at a time.

    Several archives together make one extract: their rows of a table add up. A
    table is reused only if it came from the same members; other archives replace
    it. A public landing leaves wholly personal tables out and deletes what an
    earlier landing may have left of them. If a table fails, the others are still
    landed and audited before the error is raised.
    """
    archives = [archive] if isinstance(archive, str) else list(archive)
    known = specs_by_member()
    wanted = {s for s in SPECS if only is None or s in only}
    if public:
        for table in wanted & PERSONAL_TABLES:
            store.purge(raw_name(table))
        wanted -= PERSONAL_TABLES
    parts: dict[str, list[Row]] = defaultdict(list)
    for row in manifest(store.spark, archives).collect():  # a short row for each member
        if row.member in known and known[row.member].name in wanted:
            parts[known[row.member].name].append(row)
    if missing := wanted - set(parts):
        raise FileNotFoundError(f"{', '.join(archives)}: no member for {', '.join(sorted(missing))}")

    land = inheritable_thread_target(store.spark)(
        lambda name: land_table(store, parts[name], SPECS[name], force=force, public=public, **options)
    )
    # Longest first: a member inflates in one task, so the largest bounds the run.
    names = sorted(parts, key=lambda name: -max(e.size for e in parts[name]))
    with ThreadPoolExecutor(at_once) as pool:
        runs = [pool.submit(land, name) for name in names]
    errors = [e for e in (run.exception() for run in runs) if e]
    results = [run.result() for run in runs if not run.exception()]
    if results:
        store.append(AUDIT, store.spark.createDataFrame(results, AUDIT_SCHEMA).coalesce(1))
    if errors:
        raise errors[0]
    return results
