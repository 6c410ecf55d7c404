"""The analytics against plain Python, with series that hold most of the rows."""

import math
import random
from bisect import bisect_right
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from statistics import mean, median_low

import pytest
from pyspark.sql import functions as F

from regweave.analytics import decisions, disclosure, dispersion, funding, prices, scan, scores, survival, velocity

DAY = date(2000, 1, 1)


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def skewed(rng, n, names=("a", "b", None)):
    """Group names of which the first holds nine rows in ten."""
    return [names[0] if rng.random() < 0.9 else rng.choice(names[1:]) for _ in range(n)]


# -- running totals ---------------------------------------------------------------


def test_totals_before(spark):
    rng = random.Random(1)
    values = sorted({round(rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 6), 3) for _ in range(400)} | {0.0, -0.0})
    rows = [(g, v, rng.randint(1, 9)) for g, v in zip(skewed(rng, len(values)), values)]
    frame = spark.createDataFrame(rows, "g string, v double, n long")
    piece = scan.value_piece(F.col("v"), 2)
    got = scan.before(frame, ["g"], [F.col("v")], piece, s=(F.sum, F.col("n")), m=(F.max, F.col("n"))).collect()
    assert len(got) == len(rows)
    for r in got:
        old = [n for g, v, n in rows if g == r.g and v < r.v]
        assert (r.s, r.m) == ((sum(old), max(old)) if old else (None, None))
    whole = scan.before(frame, [], [F.col("v")], piece, s=(F.sum, F.col("n")))
    assert all((r.s or 0) == sum(n for _, v, n in rows if v < r.v) for r in whole.collect())
    pieces = [r.p for r in frame.orderBy("v").select(piece.alias("p")).collect()]
    assert pieces == sorted(pieces) and len(set(pieces)) > 20


def test_edges_reach_back(spark):
    rows = [("a", k, k * k % 17) for k in range(50)] + [("b", k, k) for k in range(3)]
    frame = spark.createDataFrame(rows, "g string, _at long, v long")
    blocks = scan.with_edges(frame, 4, 5)
    assert blocks.filter("g = 'a'").select("_block").distinct().count() == 11  # the last holds an edge only
    window = scan.block_window(["g"]).rowsBetween(-4, 0)
    got = scan.without_edges(blocks.withColumn("s", F.sum("v").over(window))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.s == sum(v for g, k, v in rows if g == r.g and r._at - 4 <= k <= r._at)


def test_as_of_takes_the_latest(spark):
    rng = random.Random(2)
    events = [(g, rng.randint(0, 60), rng.randint(0, 9)) for g in skewed(rng, 120)]
    rows = [(k, g, rng.randint(-5, 70)) for k, g in enumerate(skewed(rng, 90))]
    left, right = spark.createDataFrame(rows, "id long, g string, t long"), spark.createDataFrame(events, "g string, t long, v long")
    got = scan.as_of(left, right, ["g"], "t", F.floor(F.col("t") / 7), at="t", v="v").collect()
    assert len(got) == len(rows)
    for r in got:
        old = [(t, v) for g, t, v in events if g == r.g and t <= r.t]
        assert (r.at, r.v) == (max(old) if old else (None, None))


# -- survival ---------------------------------------------------------------------


def curve_of(subjects):
    out, alive, spread = {}, 1.0, 0.0
    for t in sorted({t for t, _ in subjects}):
        at_risk = sum(s >= t for s, _ in subjects)
        events = sum(s == t and e for s, e in subjects)
        alive *= 1 - events / at_risk
        spread += events / (at_risk * (at_risk - events)) if events < at_risk else 0
        out[t] = (at_risk, events, alive, alive * math.sqrt(spread))
    return out


def test_survival_of_a_hot_cohort(spark):
    rng = random.Random(3)
    rows = [(g, rng.randint(0, 300), rng.choice([True, False, None])) for g in skewed(rng, 3000)] + [("x", None, True), ("y", 5, True)]
    curve = survival.product_limit(spark.createDataFrame(rows, "c string, t int, gone boolean"), ["c"], "t", "gone", 16)
    got = curve.collect()
    by = defaultdict(list)
    for c, t, e in rows:
        if t is not None:
            by[c].append((t, bool(e)))
    assert len(got) == sum(len({t for t, _ in own}) for own in by.values())
    for r in got:
        at_risk, events, alive, error = curve_of(by[r.c])[r.t]
        assert (r.at_risk, r.events) == (at_risk, events)
        assert r.censored == sum(t == r.t and not e for t, e in by[r.c])
        assert abs(r.survival - alive) < 1e-9 and abs(r.std_error - error) < 1e-9
    assert [r.survival for r in got if r.c == "y"] == [0.0]
    middles = {r.c: r.median_time for r in survival.median_time(curve, ["c"], "t").collect()}
    for c, own in by.items():
        reached = [t for t, (_, _, alive, _) in curve_of(own).items() if alive <= 0.5]
        assert middles[c] == (min(reached) if reached else None)
    assert survival.product_limit(spark.createDataFrame([], "c string, t int, gone boolean"), ["c"], "t", "gone").count() == 0


def test_a_cohort_runs_in_pieces(spark):
    frame = spark.range(2000).selectExpr("cast(id % 1 AS string) AS c", "cast(id AS int) AS t", "id % 2 = 0 AS gone")
    plan = plan_of(survival.product_limit(frame, ["c"], "t", "gone"))
    windows = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "Window" in line]
    assert windows and all("_group" in w for w in windows)
    assert sum("_piece" in w for w in windows) == len(windows)


def test_cost_per_unit(spark):
    rows = [("p", 10.0, 2.0), ("p", 20.0, 3.0), ("p", None, 3.0), ("p", 5.0, 0.0), ("q", 1.0, None)]
    got = {r.g: r for r in survival.cost_per_unit(spark.createDataFrame(rows, "g string, c double, n double"), ["g"], "c", "n").collect()}
    assert (got["p"].projects, got["p"].without_size, got["p"].cost_per_unit) == (2, 2, 6.0)
    assert (got["q"].projects, got["q"].without_size, got["q"].cost_per_unit) == (0, 1, None)


# -- prices -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def offers(spark):
    rng = random.Random(4)
    rows = [(k, g, round(rng.choice([0.5, 7.25, 10 ** rng.uniform(0, 4)]), 2) if k % 50 else None) for k, g in enumerate(skewed(rng, 2000))]
    return rows, spark.createDataFrame(rows, "id long, g string, price double")


def test_percentile_and_quantiles_are_exact(offers):
    rows, frame = offers
    by = defaultdict(list)
    for _, g, p in rows:
        if p is not None:
            by[g].append(p)
    got = prices.percentile(frame, ["g"], "price").collect()
    assert len(got) == len(rows)
    for r in got:
        own = by[r.g]
        want = None if r.price is None else sum(p < r.price for p in own) / (len(own) - 1)
        assert r.percentile == want
    found = {r.g: (r.low, r.mid) for r in prices.quantiles(frame, ["g"], "price", low=0.1, mid=0.5).collect()}
    for g, own in by.items():
        own.sort()
        assert found[g] == (own[math.ceil(0.1 * len(own)) - 1], median_low(own))


def test_summaries_merge_within_their_error(offers):
    rows, frame = offers
    parts = prices.summary(frame.withColumn("part", F.col("id") % 7), ["g", "part"], "price")
    for r in prices.merged(parts, ["g"]).select("g", prices.summary_count().alias("n"), prices.summary_quantile(0.3).alias("q")).collect():
        own = [p for _, g, p in rows if g == r.g and p is not None]
        low, high = sum(p < r.q for p in own) / len(own), sum(p <= r.q for p in own) / len(own)
        slack = 3 * prices.RANK_ERROR + 1 / len(own)
        assert r.n == len(own) and low - slack <= 0.3 <= high + slack


def test_index_looks_at_the_quarter_before(spark):
    rows = [("c", "2000-Q1", 10.0, 1), ("c", "2000-Q1", 20.0, 2), ("c", "2000-Q1", 30.0, 2), ("c", "2000-Q2", 25.0, 1), ("d", "2000-Q2", None, 1)]
    frame = spark.createDataFrame(rows, "item string, q string, price double, bidder long").withColumn("one", F.lit(1))
    got = {(r.item, r.q): r for r in prices.index(frame, ["item"], "q", "price", "price", "one", "bidder").collect()}
    first, second = got["c", "2000-Q1"], got["c", "2000-Q2"]
    assert (first.bids, first.bidders, first.median_price, first.mean_price, first.spread, first.escalation) == (3, 2, 20.0, 20.0, 1.0, None)
    assert second.escalation == 0.25 and len(got) == 2


# -- funding ----------------------------------------------------------------------


def test_best_match_of_each_side(spark):
    rng = random.Random(5)
    places = [1, 1, 1, 2, None]
    needs = [(k, rng.choice(places), rng.choice([0.0, 100.0, 125.0, round(rng.uniform(90, 400), 2)]), DAY + timedelta(rng.randint(0, 500))) for k in range(150)]
    lines = [(k, rng.choice(places), rng.choice([125.0, 156.25, round(rng.uniform(90, 500), 2)]), DAY + timedelta(rng.randint(-100, 500))) for k in range(200)]
    frames = (spark.createDataFrame(needs, "need long, place long, amount double, due date"),
              spark.createDataFrame(lines, "line long, place long, amount double, opens date"))
    pairs = defaultdict(list)
    wishes = defaultdict(list)
    for n, p, a, due in needs:
        for f, q, b, opens in lines:
            days = (due - opens).days
            if p == q and p is not None and a > 0 and a <= b <= a * 1.25 and 0 <= days < 90:
                pairs[n].append((b - a, days, f))
                wishes[f].append((b - a, days, n))
    found = funding.match(*frames, "place", "2000-06-15")
    got = found.collect()
    assert len(got) == len(needs) and any(pairs.values()) and any(r.mutual for r in got)
    for r in got:
        own = pairs[r.need]
        best = min(own) if own else (None, None, None)
        assert (r.candidates, r.excess, r.days_before, r.line) == (len(own), *best)
        assert r.mutual == (bool(own) and min(wishes[r.line])[2] == r.need)
    due = {r.need: r.months_to_deadline for r in got}
    assert all(due[n] == 0 for n, _, _, d in needs if d == date(2000, 6, 15))
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_matches_list_no_pairs(spark, monkeypatch):
    """A hundred million pairs in one place and quarter, counted and chosen without being listed."""
    monkeypatch.delattr(funding, "candidates")
    n = 10_000
    needs = spark.range(n).selectExpr("id AS need", "1 AS place", "1000.0D + id / 64 AS amount", "date_add(DATE'2000-03-30', int(id % 7)) AS due")
    lines = spark.range(n).selectExpr("id AS line", "1 AS place", "1000.0D + id / 64 AS amount", "DATE'2000-03-01' AS opens")
    got = funding.match(needs, lines, "place", "2000-06-15").collect()
    assert len(got) == n
    assert all((r.candidates, r.line, r.excess, r.days_before, r.mutual) == (n - r.need, r.need, 0.0, 29 + r.need % 7, True) for r in got)


def test_matches_of_repeated_rows_and_ids(spark):
    rng = random.Random(15)

    def rows(date_of):
        amounts = [None, 0.0, 80.0, 100.0, 125.0, float("nan"), round(rng.uniform(70, 130), 1)]
        return [(rng.choice([None, *range(150)]), rng.choice(["a", "a", "b", None]), rng.choice(amounts), rng.choice([None, date_of(), date_of()])) for _ in range(300)]

    needs = spark.createDataFrame(rows(lambda: DAY + timedelta(rng.randint(0, 120))), "need long, place string, amount double, due date")
    lines = spark.createDataFrame(rows(lambda: DAY + timedelta(rng.randint(-60, 120))), "line long, place string, amount double, opens date")
    pairs = funding.candidates(needs, lines, "place").collect()
    least = lambda r, other: (r.excess if r.excess == r.excess else math.inf, r.days_before, (r[other] is not None, r[other] or 0))
    of_need, of_line = defaultdict(list), defaultdict(list)
    for r in pairs:
        of_need[r.need].append(least(r, "line"))
        of_line[r.line].append(least(r, "need"))
    got = funding.match(needs, lines, "place", "2000-06-15").collect()
    assert len(got) == 300 and any(math.isnan(r.excess or 0) for r in got)
    for r in got:
        own = of_need[r.need] if r.need is not None else []
        assert r.candidates == len(own)
        if own:
            best = min(own)
            assert (r.days_before, r.line) == (best[1], best[2][1] if best[2][0] else None)
            assert r.mutual == (r.line is not None and min(of_line[r.line])[2] == (True, r.need))


# -- decisions --------------------------------------------------------------------


def test_decisions_drift(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    filings = [(u, start + timedelta(hours=rng.randint(0, 900)), float(rng.randint(0, 50))) for u in skewed(rng, 300, (1, 2, 3))]
    made = [(k, u, start + timedelta(hours=rng.randint(0, 900)), float(rng.randint(0, 50))) for k, u in enumerate(skewed(rng, 400, (1, 2, 3)))]
    left = spark.createDataFrame(made, "id long, u long, t timestamp, awarded double")
    right = spark.createDataFrame(filings, "u long, t timestamp, requested double")
    piece = F.floor(F.unix_timestamp("t") / 86400)
    cases = decisions.decided(left, right, ["u"], "t", piece)
    rows = {r.id: r for r in cases.collect()}
    assert len(rows) == len(made)
    for k, u, t, a in made:
        old = [(s, v) for w, s, v in filings if w == u and s <= t]
        r = rows[k]
        assert r.spread == (max(old)[1] - a if old else None)
        assert r.days_to_decision == ((t - max(old)[0]).total_seconds() / 86400 if old else None)
    got = decisions.drift(cases, ["u"], ["t", "id"], piece, "spread", 5).collect()
    series = defaultdict(list)
    for r in sorted((x for x in rows.values() if x.spread is not None), key=lambda x: (x.t, x.id)):
        series[r.u].append(r)
    want = {}
    for own in series.values():
        for k, r in enumerate(own):
            last = [x.spread for x in own[max(0, k - 4):k + 1]]
            past = [x.spread for x in own[max(0, k - 9):k - 4]] if k >= 9 else None
            want[r.id] = (mean(last) if k >= 4 else None, mean(last) - mean(past) if past else None)
    assert len(got) == len(want)
    for r in got:
        for a, b in zip((r.rolling, r.drift), want[r.id]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


def test_settlement_gap(spark):
    rows = [("x", True, 2.0), ("x", True, 4.0), ("x", False, 9.0), ("y", True, 1.0), ("y", False, None)]
    got = {r.g: r for r in decisions.settlement_gap(spark.createDataFrame(rows, "g string, s boolean, v double"), ["g"], "s", "v").collect()}
    assert (got["x"].cases, got["x"].settled, got["x"].litigated, got["x"].gap) == (3, 3.0, 9.0, -6.0)
    assert (got["y"].cases, got["y"].settled_share, got["y"].gap) == (1, 1.0, None)


# -- disclosure -------------------------------------------------------------------


def test_obligations_take_filings_in_turn(spark):
    rng = random.Random(7)
    issuers = [(k, DAY + timedelta(rng.randint(0, 400)), "p" if k % 3 else None) for k in range(25)]
    filings = [(k if rng.random() < 0.5 else 0, DAY + timedelta(rng.randint(0, 1500))) for k in list(range(25)) * 8]
    filings += [(1, date(2000, 12, 31)), (1, date(2000, 12, 31)), (1, date(2001, 1, 1))]
    due = disclosure.obligations(spark.createDataFrame(issuers, "issuer long, since date, peers string"), "2003-06-30")
    late = disclosure.lateness(disclosure.matched(due, spark.createDataFrame(filings, "issuer long, filed date")), ["peers"]).collect()
    by = defaultdict(list)
    for r in late:
        by[r.issuer].append(r)
    assert len(by) == 25 and len(late) == sum(len(x) for x in by.values())
    for issuer, since, _ in issuers:
        own = sorted(by[issuer], key=lambda r: r.period_end)
        assert own[0].period_end >= since and (own[0].period_end - since).days < 92 and own[-1].period_end == date(2003, 6, 30)
        assert [r.number for r in own] == list(range(len(own)))
        left = sorted({f for i, f in filings if i == issuer})
        days = []
        for r in own:
            assert r.due == r.period_end + timedelta(45)
            left = left[bisect_right(left, r.period_end):]
            want = left.pop(0) if left else None
            assert r.filed == want and r.filer == (want is not None)
            assert r.days_late == ((want - r.due).days if want else None)
            assert r.own_mean == (mean(days) if days else None)
            days += [r.days_late] if want else []
    groups = defaultdict(list)
    for r in late:
        groups[r.peers, r.period_end].append(r)
    for own in groups.values():
        for r in own:
            others = [x.days_late for x in own if x is not r and x.filer]
            assert (r.peer_mean is None and not others) or abs(r.peer_mean - mean(others)) < 1e-9
            assert r.peer_non_filers == sum(not x.filer for x in own if x is not r)


# -- velocity ---------------------------------------------------------------------


def test_velocity_between_changes(spark):
    rng = random.Random(8)
    rows = {}
    for g in skewed(rng, 1500, ("a", "b", "c")):
        rows[g, DAY + timedelta(rng.randint(0, 4000))] = rng.randint(0, 3)
    table = [(g, d, r) for (g, d), r in rows.items()] + [("a", None, 1), ("a", DAY - timedelta(1), None)]
    frame = velocity.velocity(spark.createDataFrame(table, "g string, d date, r int"), ["g"], "d", "r", 200, 16)
    got = {(r.g, r.d): r for r in frame.collect()}
    want = {}
    for g in "abc":
        old, fast = None, None
        for (h, d), r in sorted(rows.items()):
            if h != g or (old and old[1] == r):
                continue
            speed = (r - old[1]) / (d - old[0]).days if old else None
            more = (speed - fast) / (d - old[0]).days if fast is not None else None
            want[g, d] = (r, speed, more)
            old, fast = (d, r), speed
    assert {k: (r.r, r.velocity, r.acceleration) for k, r in got.items()} == want


# -- dispersion -------------------------------------------------------------------


def test_moments_merge(spark):
    rng = random.Random(9)
    rows = [(g, k % 11, rng.gauss(1e6, 3)) for k, g in enumerate(skewed(rng, 800))] + [("z", 1, 5.0), ("z", 1, None), ("w", 1, None)]
    frame = spark.createDataFrame(rows, "g string, part long, v double")
    got = {r.g: r for r in dispersion.shape(dispersion.merged_moments(dispersion.moments(frame, ["g", "part"], "v"), ["g"])).collect()}
    for g in {g for g, _, v in rows if v is not None}:
        own = [v for h, _, v in rows if h == g and v is not None]
        m = mean(own)
        m2, m3 = sum((v - m) ** 2 for v in own), sum((v - m) ** 3 for v in own)
        r = got[g]
        assert r.n == len(own) and abs(r.mean - m) < 1e-6 and abs(r.m2 - m2) < 1e-6 * max(m2, 1) and abs(r.m3 - m3) < 1e-4 * max(abs(m3), 1e3)
        assert (r.deviation is None) == (len(own) == 1)
    assert "w" not in got


def test_medians_by_bisection(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(g, rng.choice([0, 7, rng.randint(-10**6, 10**6), rng.randint(0, 10)])) for g in skewed(rng, 700)] + [("one", 5), ("big", 2**60), ("big", -2**60), ("none", None)]
    frame = spark.createDataFrame(rows, "g string, v long")
    by = defaultdict(list)
    for g, v in rows:
        if v is not None:
            by[g].append(v)
    want = {g: median_low(own) for g, own in by.items()}
    for cells in (4, 1024):
        monkeypatch.setattr(dispersion, "CELLS", cells)
        if cells == 4:
            small = frame.filter("g <> 'big' OR g IS NULL")
            assert {r.g: r.median for r in dispersion.medians(small, ["g"], "v").collect()} == {g: m for g, m in want.items() if g != "big"}
        else:
            assert {r.g: r.median for r in dispersion.medians(frame, ["g"], "v").collect()} == want
    far = {r.g: r.median_deviation for r in dispersion.median_deviation(frame, ["g"], "v").collect()}
    assert far == {g: median_low([abs(v - want[g]) for v in own]) for g, own in by.items()}


def test_percent_of_benchmark(spark):
    rows = [("a", 150.0, 100.0), ("a", 50.0, 100.0), ("a", 9.0, None), ("b", None, 5.0)]
    got = {r.g: r for r in dispersion.percent_of_benchmark(spark.createDataFrame(rows, "g string, p double, b double"), ["g"], "p", "b").collect()}
    assert (got["a"].compared, got["a"].without_benchmark, got["a"].percent, got["a"].above) == (2, 1, 100.0, 1)
    assert (got["b"].compared, got["b"].without_benchmark, got["b"].percent) == (0, 1, None)


# -- scores -----------------------------------------------------------------------


def test_rank_over_all_rows(spark):
    rng = random.Random(11)
    values = [rng.choice([None, 0.0, 3.5, -2.0, round(rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 9), 4)]) for _ in range(500)]
    frame = scores.dense_rank(spark.createDataFrame(list(enumerate(values)), "id long, v double"), "v")
    places = {v: k + 1 for k, v in enumerate(sorted({v for v in values if v is not None}, reverse=True))}
    got = {r.id: r["rank"] for r in frame.collect()}
    assert got == {k: places.get(v) for k, v in enumerate(values)}
    lines = [x for x in plan_of(frame).split("== Physical Plan ==")[1].splitlines() if "Window [" in x]
    assert lines and all("_group" in x for x in lines)


def test_scores_keep_gaps(spark):
    frame = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, None)], "a int, b int, c int")
    assert [r.total for r in scores.total_score(frame, ["a", "b", "c"]).collect()] == [6, None, None]
    fused = scores.fused_score(frame, {"a": (0.5, 2.0), "b": (0.5, 1.0)}).collect()
    assert Counter((r.score, r.missing) for r in fused) == Counter([(0.75, 0), (0.25, 1), (0.0, 2)])
