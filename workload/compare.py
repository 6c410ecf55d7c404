"""Run queries in both engines and compare columns, row counts and values.

    python -m workload.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from datetime import date, datetime

import duckdb

from workload.bindings import BASE_TABLES


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime) and value.time().isoformat() == "00:00:00":
        return value.date().isoformat()
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both engines agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; {len(only_ours)} / "
            f"{len(only_theirs)} differ, e.g. {only_ours[:2]} against {only_theirs[:2]}"
        )
    return None


def main(argv: list[str]) -> int:
    import time

    from regweave.session import local_session
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, QUERIES[name], ORACLE[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:24} {time.time() - start:6.2f}s  {'same' if problem is None else problem[:1500]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
