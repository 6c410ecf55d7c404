"""The quality report: measure everything, change nothing, keep a stable shape.

Each check family names the aggregates it needs of each table and the report
lines they become. A run merges the aggregates of all families, so a relation is
scanned once for these; the fold of all keys, the texts of dates, the sample of states and
the links scan the tables again, each by itself. The few hundred
numbers that come out form one row, from which the lines are rendered. A family whose
input is absent leaves a line that says so; a table that breaks costs its own lines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regweave.functions.codes import FIPS_SHAPES, fips_shape
from regweave.functions.coords import is_unmappable
from regweave.functions.dates import bare_date, century_adjusted, has_text, pivot_date
from regweave.functions.repair import REPLACEMENT
from regweave.operators.clean import COUNTY, RAW_STATE, named
from regweave.operators.integrity import key_profile, row_counts
from regweave.operators.links import link_agreement, mask_agreement
from regweave.layers import Layers
from regweave.registry import REGISTRY_KEY, SPECS, spec_names

OK, WARN, FAIL = "ok", "warn", "fail"
SAMPLE_TYPE = "array<struct<key:string,n:bigint>>"
REPORT_SCHEMA = (
    f"name string, status string, value string, value_num bigint, detail string, sample {SAMPLE_TYPE}"
)
MEASURE_SCHEMA = f"key string, n bigint, sample {SAMPLE_TYPE}"
SAMPLE_SIZE = 20

# The text columns searched for replacement characters.
MARKED_COLUMNS = (
    ("facility", "PRIMARY_NAME"),
    ("facility", "LOCATION_ADDRESS"),
    ("alternative_name", "ALTERNATIVE_NAME"),
    ("organization", "ORG_NAME"),
    ("mailing_address", "MAILING_ADDRESS"),
)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(key: str) -> str:
    return f"try_element_at(numbers, {sql_text(key)})"


def sample(key: str) -> str:
    return f"try_element_at(samples, {sql_text(key)})"


def grouped(n: str) -> str:
    return f"format_number({n}, 0)"


@dataclass(frozen=True)
class Line:
    """One report line; all but the name are SQL over the measured numbers."""

    name: str
    status: str
    value: str
    number: str = "NULL"
    detail: str = "''"
    sample: str = "NULL"
    emit: str = "true"

    def struct(self) -> Column:
        return F.expr(
            f"struct({sql_text(self.name)} AS name, {self.status} AS status, "
            f"cast({self.value} AS string) AS value, cast({self.number} AS bigint) AS value_num, "
            f"{self.detail} AS detail, cast({self.sample} AS {SAMPLE_TYPE}) AS sample, "
            f"{self.emit} AS emit)"
        )


def fixed(name: str, status: str, value: str, detail: str, n: int | None = None) -> Line:
    number = "NULL" if n is None else str(n)
    return Line(name, sql_text(status), sql_text(value), number, sql_text(detail))


def zero_is_ok(name: str, key: str, detail: str, otherwise: str = WARN, sample: str = "NULL") -> Line:
    n = number(key)
    return Line(name, f"if({n} = 0, '{OK}', '{otherwise}')", n, n, detail, sample)


class Family:
    """A group of lines that succeed or fail together."""

    name: str
    requires: tuple[str, ...] = ()
    #: columns of the raw facility table the family reads
    facility_columns: tuple[str, ...] = ()

    def facts(self, layers: Layers) -> dict[str, dict[str, Column]]:
        """Per relation, what is worked out once for each row."""
        return {}

    def counts(self, layers: Layers) -> dict[str, dict[str, Column]]:
        """Per relation, named aggregates over its facts."""
        return {}

    def frames(self, layers: Layers) -> list[Callable[[], DataFrame]]:
        """Measures that are no plain aggregate, each by itself: (key, n, sample) rows."""
        return []

    def lines(self, layers: Layers) -> list[Line]:
        raise NotImplementedError

    def obstacle(self, layers: Layers) -> Line | None:
        """The line that stands in for a family that cannot run."""
        absent = [r for r in self.requires if r not in layers.names]
        if absent:
            return fixed(f"skipped.{self.name}", WARN, "not run", f"needs {', '.join(absent)}")
        if self.facility_columns:
            lacking = set(self.facility_columns) - set(layers.raw["facility"].columns)
            if lacking:
                detail = f"facility has no column {', '.join(sorted(lacking))}"
                return fixed(self.name, FAIL, "error", detail)
        return None

    def __call__(self, layers: Layers) -> DataFrame:
        return fused_report(layers, [self])


class RowCounts(Family):
    name = "check_row_counts"

    def lines(self, layers):
        out = []
        for t in spec_names():
            if t in layers.raw:
                n = number(f"rows.{t}")
                out.append(Line(f"rows.{t}", f"if({n} > 0, '{OK}', '{FAIL}')", n, n))
            else:
                out.append(fixed(f"rows.{t}", WARN, "0", "table not ingested", 0))
        return out


class FacilityKey(Family):
    name = "check_facility_key_unique"
    requires = ("raw_facility",)
    facility_columns = (REGISTRY_KEY,)

    def lines(self, layers):
        detail = sql_text("keys that occur on several facility rows")
        return [zero_is_ok("facility.registry_id_unique", "duplicates.facility", detail, FAIL)]


class Orphans(Family):
    name = "check_orphans"
    requires = ("raw_facility",)
    facility_columns = (REGISTRY_KEY,)

    def lines(self, layers):
        out = []
        for t in spec_names():
            if t == "facility" or t not in layers.raw:
                continue
            name = f"orphans.{t}"
            if REGISTRY_KEY in layers.raw[t].columns:
                out.append(zero_is_ok(name, name, sql_text("rows without a facility row")))
            else:
                out.append(fixed(name, FAIL, "error", f"no column {REGISTRY_KEY}"))
        return out


class Dates(Family):
    name = "check_dates"

    @staticmethod
    def _columns(layers):
        for t in spec_names():
            if t in layers.raw:
                for c in SPECS[t].date_columns:
                    if c in layers.raw[t].columns:
                        yield t, c

    def frames(self, layers):
        columns: dict[str, list[str]] = {}
        for t, c in self._columns(layers):
            columns.setdefault(t, []).append(c)
        return [lambda t=t, cs=cs: self._measured(layers.raw[t], t, cs) for t, cs in columns.items()]

    @staticmethod
    def _measured(raw: DataFrame, t: str, columns: list[str]) -> DataFrame:
        """What a table's date columns read as, in one scan.

        Rows fold to the distinct texts of each column before a text is read: a hundred years
        have 36,525 days, so few are left of any number of rows. Texts that name no day fold by
        their spelling; if all of them differ, each is still read once.
        """
        names = [f"text{i}" for i in range(len(columns))]
        texts = raw.select(*[named(c).alias(n) for c, n in zip(columns, names)])
        folded = texts.groupingSets([[n] for n in names], *names).agg(
            F.grouping_id().alias("column"), F.count("*").alias("n"))
        # A row holds the text of its own column only.
        bare = folded.select("column", "n", F.coalesce(*names).alias("text")).select(
            "column", "n", has_text(F.col("text")).alias("has"), bare_date(F.col("text")).alias("bare"))
        read = bare.select("column", "n", "has", pivot_date(F.col("bare")).alias("day"))

        def total(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

        # A bit of the grouping id is set for each column left out, the first column's highest.
        of = [F.col("column") == (1 << len(names)) - 1 - (1 << len(names) - 1 - i) for i in range(len(names))]
        day = F.col("day")
        measures = {f"total.{t}": total(of[0])}
        for c, its_own in zip(columns, of):
            measures[f"bad.{t}.{c}"] = total(its_own & F.col("has") & day.isNull())
            measures[f"adjusted.{t}.{c}"] = total(its_own & century_adjusted(day))
        return unpivot(read.agg(*[m.alias(key) for key, m in measures.items()]))

    def lines(self, layers):
        out = []
        for t, c in self._columns(layers):
            detail = f"concat('of ', {grouped(number(f'total.{t}'))}, ' rows; read as NULL')"
            out.append(zero_is_ok(f"dates.{t}.{c}.unparseable", f"bad.{t}.{c}", detail))
            moved = number(f"adjusted.{t}.{c}")
            out.append(Line(
                f"dates.{t}.{c}.century_adjusted", f"'{WARN}'", moved, moved,
                sql_text("two-digit years read as 1950-1968, not 2050-2068"), emit=f"{moved} > 0"))
        return out


def out_of_domain(state: Column, raw_state: Column) -> Column:
    return state.isNull() & raw_state.isNotNull()


def _counted(frame: DataFrame, column: str, where: Column) -> DataFrame:
    """How often each value occurs among the rows asked for.

    Those rows are told inside the aggregate: a filter in front of it would be pushed below
    the rules the frame was made with, which then stand once for each use in one method, more
    than the JIT compiles.
    """
    return frame.groupBy(F.col(column).alias("key")).agg(F.count_if(where).alias("n")).filter("n > 0")


def top_values(frame: DataFrame, column: str, where: Column, limit: int = SAMPLE_SIZE) -> DataFrame:
    """The most frequent values, ties in value order."""
    return _counted(frame, column, where).orderBy(F.desc("n"), "key").limit(limit)


def top_values_of_all(frame: DataFrame, column: str, where: Column, limit: int = SAMPLE_SIZE) -> DataFrame:
    """The most frequent values and, first and marked, the number of all rows; from one scan."""
    counts = _counted(frame, column, where).rollup("key").agg(
        F.sum("n").alias("n"), (F.grouping_id() == 1).alias("whole")
    )
    return counts.orderBy(F.desc("whole"), F.desc("n"), "key").limit(limit + 1)


def as_sample(key: str, rows: DataFrame) -> DataFrame:
    """A few (key, n) rows as the one-row sample of a measure, most frequent first."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "key", "n")))
    listed = F.transform(ranked, lambda r: F.struct(r["key"].alias("key"), r["n"].alias("n")))
    return rows.agg(listed.cast(SAMPLE_TYPE).alias("sample")).select(
        F.lit(key).alias("key"), F.lit(None).cast("bigint").alias("n"), "sample"
    )


class StateCodes(Family):
    name = "check_state_codes"
    requires = ("facility",)
    facility_columns = ("STATE_CODE",)

    def facts(self, layers):
        return {"facility": {c: F.col(c) for c in ("STATE_CODE", RAW_STATE)}}

    def counts(self, layers):
        bad = out_of_domain(F.col("STATE_CODE"), F.col(RAW_STATE))
        return {"facility": {"state.bad": F.count_if(bad)}}

    def frames(self, layers):
        bad = out_of_domain(F.col("STATE_CODE"), F.col(RAW_STATE))
        facility = layers.clean("facility", "STATE_CODE", RAW_STATE)
        return [lambda: as_sample("state.bad", top_values(facility, RAW_STATE, bad))]

    def lines(self, layers):
        detail = sql_text("codes outside the postal domain, NULL once normalised")
        return [zero_is_ok("facility.state_code_out_of_domain", "state.bad", detail,
                           sample=sample("state.bad"))]


def fips_disagrees(shape: Column, state: Column, county: Column) -> Column:
    return (shape == "county_fips_5") & state.isNotNull() & county.isNull()


class FipsShapes(Family):
    name = "check_fips_shapes"
    requires = ("facility",)
    facility_columns = ("FIPS_CODE", "STATE_CODE")

    def facts(self, layers):
        kept = {c: F.col(c) for c in ("STATE_CODE", COUNTY)}
        return {"facility": {**kept, "shape": fips_shape(F.col("FIPS_CODE"))}}

    def counts(self, layers):
        shape = F.col("shape")
        counts = {f"fips.{s}": F.count_if(shape == s) for s in FIPS_SHAPES}
        clash = fips_disagrees(shape, F.col("STATE_CODE"), F.col(COUNTY))
        return {"facility": {**counts, "fips.clash": F.count_if(clash)}}

    def lines(self, layers):
        usable = number("fips.county_fips_5")
        present = " + ".join(number(f"fips.{s}") for s in FIPS_SHAPES if s != "null")
        shapes = ", ".join(
            f"struct(-{number(f'fips.{s}')} AS rank, '{s}' AS key, {number(f'fips.{s}')} AS n)"
            for s in FIPS_SHAPES
        )
        seen = f"transform(array_sort(filter(array({shapes}), r -> r.n > 0)), r -> struct(r.key, r.n))"
        return [
            Line("facility.fips_code_shapes", f"if({usable} = {present}, '{OK}', '{WARN}')",
                 f"concat({grouped(usable)}, ' usable of ', {grouped(present)}, ' non-null')",
                 usable, sql_text("only five digits form a county code"), seen),
            zero_is_ok("facility.fips_state_disagreement", "fips.clash",
                       sql_text("five-digit codes whose state digits contradict the state code")),
        ]


class Coordinates(Family):
    name = "check_coordinates"
    requires = ("facility",)
    facility_columns = ("LATITUDE83", "LONGITUDE83")

    def facts(self, layers):
        return {"facility": {c: F.col(c) for c in self.facility_columns}}

    def counts(self, layers):
        latitude, longitude = map(F.col, self.facility_columns)
        return {
            "facility": {
                "coords.rows": F.count("*"),
                "coords.present": F.count(latitude),
                "coords.unusable": F.count_if(is_unmappable(latitude, longitude)),
            }
        }

    def lines(self, layers):
        rows, present, unusable = (number(f"coords.{k}") for k in ("rows", "present", "unusable"))
        percent = f"if({rows} > 0, {present} * 100.0D / {rows}, 0.0D)"
        return [
            Line("facility.coordinates_present", f"if({percent} > 50, '{OK}', '{WARN}')",
                 f"format_string('%s / %s (%.1f%%)', {grouped(present)}, {grouped(rows)}, {percent})",
                 present, sql_text("facilities with a latitude")),
            Line("facility.coordinates_unusable",
                 f"if({present} = 0 OR {unusable} > 0, '{WARN}', '{OK}')",
                 f"if({present} = 0, 'not applicable', cast({unusable} AS string))",
                 f"if({present} = 0, NULL, {unusable})",
                 f"if({present} = 0, 'the extract holds no coordinates to check', "
                 "'a latitude, but no longitude or a point outside the box around the country')"),
        ]


class ReplacementCharacters(Family):
    name = "check_source_mojibake"

    @staticmethod
    def _columns(layers):
        return [(t, c) for t, c in MARKED_COLUMNS if t in layers.raw and c in layers.raw[t].columns]

    def facts(self, layers):
        out: dict[str, dict[str, Column]] = {}
        for t, c in self._columns(layers):
            out.setdefault(f"raw_{t}", {})[f"marked_{c}"] = named(c).contains(REPLACEMENT)
        return out

    def counts(self, layers):
        out: dict[str, dict[str, Column]] = {}
        for t, c in self._columns(layers):
            out.setdefault(f"raw_{t}", {})[f"marks.{t}.{c}"] = F.count_if(f"marked_{c}")
        return out

    def lines(self, layers):
        keys = [f"{t}.{c}" for t, c in self._columns(layers)]
        total = " + ".join(["0"] + [number(f"marks.{k}") for k in keys])
        rows = ", ".join(f"struct('{k}' AS key, {number(f'marks.{k}')} AS n)" for k in keys)
        marked = f"filter(array({rows}), r -> r.n > 0)" if keys else "NULL"
        return [
            Line("text.replacement_characters", f"if({total} = 0, '{OK}', '{WARN}')", total, total,
                 sql_text("rows holding U+FFFD; the audit tells the publisher's from our own"), marked)
        ]


class CrosswalkAgreement(Family):
    name = "check_crosswalk_agreement"
    requires = ("crosswalk",)

    def lines(self, layers):
        of = f"concat('of ', {grouped(number('links'))}, ' links')"
        return [
            zero_is_ok(f"crosswalk.{k}", k, of)
            for k in ("in_facility_string_not_program_table", "in_program_table_not_facility_string")
        ]


class SingleSourceLinks(Family):
    name = "check_single_source_links"
    requires = ("crosswalk",)

    def lines(self, layers):
        n = number("single_source_links")
        return [Line("crosswalk.single_source_links", f"'{OK}'",
                     f"concat({grouped(n)}, ' / ', {grouped(number('links'))})", n,
                     sql_text("links with one asserting source, the weakest evidence"))]


ALL_CHECKS: tuple[Family, ...] = (
    RowCounts(), FacilityKey(), Orphans(), Dates(), StateCodes(), FipsShapes(), Coordinates(),
    ReplacementCharacters(), CrosswalkAgreement(), SingleSourceLinks(),
)


def unpivot(one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame as (key, n, sample) rows."""
    cells = [
        f"struct({sql_text(c)} AS key, cast(`{c}` AS bigint) AS n, cast(NULL AS {SAMPLE_TYPE}) AS sample)"
        for c in one_row.columns
    ]
    return one_row.selectExpr(f"inline(array({', '.join(cells)}))")


#: the check that answers for a job, and its work
Job = tuple[str, Callable[[], list[DataFrame]]]


def _fact_jobs(layers: Layers, families: list[Family]) -> list[Job]:
    """Per relation, one scan for all aggregates that the families ask of it."""
    facts: dict[str, dict[str, Column]] = {}
    counts: dict[str, dict[str, Column]] = {}
    for family in families:
        for relation, columns in family.facts(layers).items():
            facts.setdefault(relation, {}).update(columns)
        for relation, columns in family.counts(layers).items():
            counts.setdefault(relation, {}).update(columns)

    def scan(relation: str) -> list[DataFrame]:
        rows = layers.relation(relation).select(*[c.alias(k) for k, c in facts[relation].items()])
        return [unpivot(rows.agg(*[c.alias(k) for k, c in counts[relation].items()]))]

    return [(families[0].name, lambda r=r: scan(r)) for r in counts]


def _table_counts(frames: dict[str, DataFrame]) -> list[DataFrame]:
    if not frames:
        return []
    return [row_counts(frames).select(
        F.concat(F.lit("rows."), "table").alias("key"), "n", F.lit(None).cast(SAMPLE_TYPE).alias("sample"))]


def _key_jobs(layers: Layers, families: list[Family], *, apart: bool) -> list[Job]:
    """Row counts, duplicate keys and orphans: of all tables at once, or table by table."""
    kinds = {type(f) for f in families}
    counted = dict(layers.raw) if RowCounts in kinds else {}
    keyed: dict[str, DataFrame] = {}
    if kinds & {FacilityKey, Orphans}:
        keyed = {t: f for t, f in layers.raw.items() if REGISTRY_KEY in f.columns}
    if not apart:
        rest = {t: f for t, f in counted.items() if t not in keyed}
        return [
            (Orphans.name, lambda: [unpivot(key_profile(keyed))] if keyed else []),
            (RowCounts.name, lambda: _table_counts(rest)),
        ]
    parent = {t: f for t, f in keyed.items() if t == "facility"}
    return [
        *((Orphans.name, lambda t=t: [unpivot(key_profile({**parent, t: keyed[t]}))]) for t in keyed),
        *((RowCounts.name, lambda t=t: _table_counts({t: counted[t]})) for t in counted),
    ]


def measuring(
    layers: Layers, families: list[Family], *, apart: bool = False, without: tuple[str, ...] | None = None
) -> list[Job]:
    """Jobs that give all numbers the families need, as (key, n, sample) rows; given ``without``,
    also those of the links that remain without some tables.

    ``apart`` gives every family and table a job of its own, so that none can
    spoil another's numbers; some of these are then given by several jobs.
    """
    groups = [[f] for f in families] if apart or not families else [families]
    jobs = [job for group in groups for job in _fact_jobs(layers, group)]
    jobs += [(f.name, lambda frame=frame: [frame()]) for f in families for frame in f.frames(layers)]
    jobs += _key_jobs(layers, families, apart=apart)
    if {type(f) for f in families} & {CrosswalkAgreement, SingleSourceLinks}:
        jobs.append((CrosswalkAgreement.name, lambda: [unpivot(_agreement(layers.built["crosswalk"], without))]))
    return jobs


#: what the measures of a report without some tables start with
REST = "rest."


def _agreement(links: DataFrame, without: tuple[str, ...] | None = None) -> DataFrame:
    """The measures of a crosswalk, or of its masks, which cost no lists of names; of masks also
    those without some tables."""
    if "mask" not in links.columns:
        return link_agreement(links)
    return mask_agreement(links, {"": ()} if without is None else {"": (), REST: without})


def _rendered(measured: DataFrame, lines: list[Line], *, gaps: bool = False, rest: bool = False) -> DataFrame:
    """The lines over (key, n, sample) rows; with ``gaps`` a line without its number is an error,
    with ``rest`` the numbers marked so stand in for the others of their name."""
    entry = F.struct("key", "n")
    sampled = F.when(F.col("sample").isNotNull(), F.struct("key", "sample"))
    facts = measured.agg(
        F.map_from_entries(F.collect_list(F.when(F.col("sample").isNull(), entry))).alias("numbers"),
        F.map_from_entries(F.collect_list(sampled)).alias("samples"),
    )
    if rest:
        marked = F.map_filter("numbers", lambda k, n: k.startswith(REST))
        named = F.transform_keys(marked, lambda k, n: F.substring(k, F.lit(len(REST) + 1), F.length(k)))
        kept = F.map_filter("numbers", lambda k, n: ~F.map_contains_key("numbers", F.concat(F.lit(REST), k)))
        facts = facts.select(F.map_concat(kept, named).alias("numbers"), "samples")
    report = facts.select(F.inline(F.array(*[line.struct() for line in lines])))
    if gaps:
        lost = F.col("value").isNull()
        report = report.withColumns({
            "status": F.when(lost, FAIL).otherwise(F.col("status")),
            "detail": F.when(lost, "its table could not be measured").otherwise(F.col("detail")),
            "value": F.coalesce("value", F.lit("error")),
            "emit": F.coalesce("emit", F.lit(True)),
        })
    return report.filter("emit").drop("emit")


def _laid_out(layers: Layers, families: list[Family]) -> tuple[list[Family], list[Line]]:
    """The families that can run and the lines of all."""
    able, lines = [], []
    for family in families:
        obstacle = family.obstacle(layers)
        if obstacle is None:
            able.append(family)
        lines += [obstacle] if obstacle else family.lines(layers)
    return able, lines


def _united(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        frames = [SparkSession.getActiveSession().createDataFrame([], MEASURE_SCHEMA)]
    return reduce(DataFrame.unionByName, frames)


def fused_report(layers: Layers, families: list[Family]) -> DataFrame:
    """The report as one lazy plan: scan, measure, render."""
    able, lines = _laid_out(layers, families)
    return _rendered(_united([frame for _, job in measuring(layers, able) for frame in job()]), lines)


def reports_without(
    layers: Layers, families: list[Family], withheld: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """The report of all tables and the one without some, rendered from the same measures.

    A table's numbers depend on no other but the facilities', so they stand in both reports; what the
    crosswalk loses is told from its masks, which ``layers`` must hold as its crosswalk.
    """
    if "facility" in withheld:
        raise ValueError("without facilities other tables' numbers change")
    able, lines = _laid_out(layers, families)
    rest = Layers({t: f for t, f in layers.raw.items() if t not in withheld}, layers.built)
    _, fewer = _laid_out(rest, families)
    measured = _united([frame for _, job in measuring(layers, able, without=withheld) for frame in job()])
    return _rendered(measured, lines), _rendered(measured, fewer, rest=True)


def apart_report(spark: SparkSession, layers: Layers, families: list[Family]) -> list[tuple]:
    """The report where some job fails: every line that can be measured, as usual. The
    others keep their names and say ``error``; each check concerned adds a line that tells why."""
    failures: dict[str, dict[str, None]] = {}

    def guarded(name: str, work):
        try:
            return work()
        except Exception as error:  # noqa: BLE001 - it becomes a line of the report
            failures.setdefault(name, {})[str(error)] = None

    able, lines, measured = [], [], {}
    for family in families:
        def prepared(family=family):
            if obstacle := family.obstacle(layers):
                return [obstacle], []
            _fact_jobs(layers, [family])
            return family.lines(layers), [family]

        shown, ready = guarded(family.name, prepared) or ([], [])
        lines += shown
        able += ready
    for name, job in measuring(layers, able, apart=True):
        # A handful of numbers from each job.
        rows = guarded(name, lambda: [row for frame in job() for row in frame.collect()])
        measured.update({(r.key, r.sample is None): r for r in rows or ()})
    lines += [fixed(name, FAIL, "error", "; ".join(texts)) for name, texts in failures.items()]
    frame = spark.createDataFrame(list(measured.values()), MEASURE_SCHEMA)
    return _rendered(frame, lines, gaps=True).collect()


def run_checks(
    spark: SparkSession, layers: Layers, checks: tuple[Callable, ...] = ALL_CHECKS
) -> DataFrame:
    """Run every check; the report always comes out whole.

    The standard families run as one job. Should that job fail, their tables are
    measured one by one. Any other check that raises gives one line. The report is a
    fixed number of short lines, so holding it on the driver is safe.
    """
    families = [c for c in checks if isinstance(c, Family)]
    rows = []
    if families:
        try:
            rows += fused_report(layers, families).collect()
        except Exception:  # noqa: BLE001 - whatever it was shows up again table by table
            rows += apart_report(spark, layers, families)
    for check in (c for c in checks if not isinstance(c, Family)):
        name = getattr(check, "__name__", type(check).__name__)
        try:
            rows += check(layers).collect()
        except Exception as error:  # noqa: BLE001
            rows.append((name, FAIL, "error", None, str(error), None))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def tally(report: DataFrame) -> DataFrame:
    """Lines per status; the three usual ones show even at zero."""
    spark = report.sparkSession
    usual = spark.createDataFrame([(s, 0) for s in (OK, WARN, FAIL)], "status string, n bigint")
    counted = report.select("status", F.lit(1).cast("bigint").alias("n")).unionByName(usual)
    return counted.groupBy("status").agg(F.sum("n").alias("n"))
