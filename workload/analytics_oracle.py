"""The checking SQL of the analytics, each answer worked out with plain windows and joins."""

from __future__ import annotations

from workload.analytics import COMMISSIONS, HORIZON, LAST_CASES, LAST_PERIOD, TODAY

_QUARTER = "year(l_shipdate)::VARCHAR || '-Q' || quarter(l_shipdate)::VARCHAR"

_BIDS = f"""
bids AS (
    SELECT l_orderkey, l_linenumber, l_suppkey, p_type AS item, n_regionkey AS region, {_QUARTER} AS quarter,
           l_quantity, round(l_extendedprice * 100)::BIGINT AS cents, l_extendedprice / l_quantity AS price
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey)"""

_FUNDING = f"""
placed AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, c_nationkey AS place, o_totalprice AS amount, o_orderdate::DATE AS day
    FROM orders JOIN customer ON c_custkey = o_custkey),
needs AS (SELECT o_orderkey AS need, o_custkey, place, amount, day + 180 AS due FROM placed WHERE o_orderstatus = 'O'),
lines AS (SELECT o_orderkey AS line, place, amount AS offered, day AS opens FROM placed WHERE o_orderstatus = 'F'),
pairs AS (
    SELECT need, line, offered - amount AS excess, date_diff('day', opens, due) AS days_before
    FROM needs JOIN lines USING (place)
    WHERE offered >= amount AND offered <= amount * 1.25 AND date_diff('day', opens, due) BETWEEN 0 AND 89),
best AS (
    SELECT *, row_number() OVER (PARTITION BY need ORDER BY excess, days_before, line) AS k,
           count(*) OVER (PARTITION BY need) AS candidates,
           first_value(need) OVER (PARTITION BY line ORDER BY excess, days_before, need) AS wished
    FROM pairs),
distances AS (
    SELECT *, 12 * (year(due) - year(DATE '{TODAY}')) + month(due) - month(DATE '{TODAY}') AS whole,
           day(due) = day(DATE '{TODAY}') OR (due = last_day(due) AND DATE '{TODAY}' = last_day(DATE '{TODAY}')) AS even
    FROM needs),
matched AS (
    SELECT n.need, n.o_custkey, n.place, n.amount, coalesce(b.candidates, 0) AS candidates, b.line, b.excess, b.days_before,
           coalesce(b.wished = n.need, false) AS mutual,
           CASE WHEN even THEN whole ELSE whole + (day(due) - day(DATE '{TODAY}')) / 31.0::DOUBLE END AS months
    FROM distances n LEFT JOIN best b ON b.need = n.need AND b.k = 1)"""

_CASES = f"""
filed AS (SELECT user_id, ts, max(value) AS requested FROM events WHERE event_type = 'click' GROUP BY user_id, ts),
cases AS (
    SELECT e.event_id, e.user_id % {COMMISSIONS} AS commission, e.ts, f.requested - e.value AS spread,
           (epoch_us(e.ts) - epoch_us(f.ts)) / 86400000000::DOUBLE AS days_to_decision
    FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF JOIN filed f ON f.user_id = e.user_id AND f.ts <= e.ts)"""

ORACLE = {
    "survival_curves": f"""
WITH exits AS (
    SELECT o_orderkey, any_value(o_orderdate) AS placed, any_value(o_orderpriority) AS priority,
           min(CASE WHEN l_shipdate > o_orderdate THEN l_shipdate END) AS gone
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY o_orderkey),
subjects AS (
    SELECT year(placed)::INTEGER AS entered, priority, gone IS NOT NULL AS left_queue,
           date_diff('day', placed::DATE, coalesce(gone::DATE, DATE '{HORIZON}')) AS days FROM exits),
seen AS (
    SELECT entered, priority, days, count(*) AS n, count(*) FILTER (left_queue) AS events
    FROM subjects GROUP BY entered, priority, days),
risk AS (
    SELECT *, sum(n) OVER (PARTITION BY entered, priority ORDER BY days DESC)::BIGINT AS at_risk FROM seen),
run AS (
    SELECT *, product(1 - events / at_risk) OVER w AS survival,
           sum(CASE WHEN events < at_risk THEN events / (at_risk * (at_risk - events)) ELSE 0 END) OVER w AS spread
    FROM risk WINDOW w AS (PARTITION BY entered, priority ORDER BY days))
SELECT entered, priority, days::INTEGER AS days, at_risk, events, n - events AS censored,
       round(survival, 6) AS survival, round(survival * sqrt(spread), 6) AS std_error FROM run""",
    "cost_per_unit": """
WITH sized AS (
    SELECT s_nationkey, round(l_extendedprice * 100)::BIGINT AS cost, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS size
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT s_nationkey, count(size) AS projects, count(*) - count(size) AS without_size,
       sum(cost) FILTER (size IS NOT NULL) / sum(size) AS cost_per_unit, min(cost / size) AS least, max(cost / size) AS most
FROM sized GROUP BY s_nationkey""",
    "price_index": f"""
WITH {_BIDS},
cells AS (
    SELECT item, region, quarter, count(*) AS bids, count(DISTINCT l_suppkey) AS bidders,
           quantile_disc(price, 0.5) AS median_price, sum(cents) / sum(l_quantity) AS mean_price,
           max(price) - min(price) AS range
    FROM bids GROUP BY item, region, quarter)
SELECT item, region, quarter, bids, bidders, median_price, mean_price, range / median_price AS spread,
       median_price / lag(median_price) OVER (PARTITION BY item, region ORDER BY quarter) - 1 AS escalation
FROM cells""",
    "bid_percentile": f"""
WITH {_BIDS}
SELECT l_orderkey, l_linenumber, l_suppkey, item, region, quarter,
       percent_rank() OVER (PARTITION BY item, region, quarter ORDER BY price) AS percentile FROM bids""",
    "price_summaries": f"""
WITH {_BIDS}
SELECT item, quarter, count(*) AS bids, true AS "within" FROM bids GROUP BY item, quarter""",
    "funding_match": f"""
WITH {_FUNDING}
SELECT need, place, round(amount, 6) AS amount, candidates, line, round(excess, 6) AS excess, days_before, mutual,
       round(months, 6) AS months_to_deadline FROM matched""",
    "intent_rank": f"""
WITH {_FUNDING},
due AS (
    SELECT o_custkey, count(*) FILTER (line IS NULL) AS unfunded, min(months) FILTER (months >= 0) AS months
    FROM matched GROUP BY o_custkey),
sold AS (
    SELECT o_custkey, 100 * sum(l_quantity) FILTER (l_returnflag = 'R') / sum(l_quantity) AS measured
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey),
rows AS (
    SELECT coalesce(s.o_custkey, d.o_custkey) AS o_custkey, measured, unfunded,
           CASE WHEN months IS NULL THEN 0 ELSE greatest(24 - months, 0) END AS nearness
    FROM sold s FULL JOIN due d ON d.o_custkey = s.o_custkey),
scored AS (
    SELECT o_custkey, measured, unfunded,
           round(CASE WHEN measured IS NULL THEN 0 ELSE 0.5::DOUBLE * least(measured / 60, 1) END
                 + CASE WHEN unfunded IS NULL THEN 0 ELSE 0.3::DOUBLE * least(unfunded / 4, 1) END
                 + 0.2::DOUBLE * least(nearness / 24, 1), 4) AS score,
           (measured IS NULL)::INTEGER + (unfunded IS NULL)::INTEGER AS missing
    FROM rows)
SELECT o_custkey, score, missing, coalesce(measured >= 12, false) AS segment,
       dense_rank() OVER (ORDER BY score DESC) AS rank FROM scored""",
    "decision_drift": f"""
WITH {_CASES},
rolled AS (
    SELECT *, row_number() OVER s AS k, avg(spread) OVER (s ROWS {LAST_CASES - 1} PRECEDING) AS mean,
           avg(spread) OVER (s ROWS BETWEEN {2 * LAST_CASES - 1} PRECEDING AND {LAST_CASES} PRECEDING) AS old
    FROM cases WINDOW s AS (PARTITION BY commission ORDER BY ts, event_id))
SELECT event_id, commission, round(spread, 6) AS spread, round(days_to_decision, 6) AS days_to_decision,
       CASE WHEN k >= {LAST_CASES} THEN round(mean, 6) END AS rolling,
       CASE WHEN k >= {2 * LAST_CASES} THEN round(mean - old, 6) END AS drift FROM rolled""",
    "settlement_gap": f"""
WITH {_CASES}, marked AS (SELECT *, event_id % 3 <> 0 AS agreed FROM cases)
SELECT commission, count(*) AS cases, round(avg(agreed::INTEGER), 6) AS settled_share,
       round(avg(spread) FILTER (agreed), 6) AS settled, round(avg(spread) FILTER (NOT agreed), 6) AS litigated,
       round(avg(spread) FILTER (agreed) - avg(spread) FILTER (NOT agreed), 6) AS gap
FROM marked GROUP BY commission""",
    "filing_lateness": f"""
WITH RECURSIVE filings AS (SELECT DISTINCT o_custkey AS issuer, o_orderdate::DATE AS filed FROM orders),
issuers AS (
    SELECT issuer, any_value(c_mktsegment) AS peers, min(filed) AS since FROM filings JOIN customer ON c_custkey = issuer GROUP BY issuer),
periods AS (
    SELECT issuer, peers, last_day((date_trunc('quarter', since) + to_months((2 + 3 * k)::INTEGER))::DATE) AS period_end, k AS number
    FROM issuers, range(0, 40) t(k)),
due AS (SELECT *, period_end + 45 AS due FROM periods WHERE period_end <= DATE '{LAST_PERIOD}'),
-- one period after another takes the first filing that is left
taken AS (
    SELECT d.issuer, d.number, (SELECT min(f.filed) FROM filings f WHERE f.issuer = d.issuer AND f.filed > d.period_end) AS filed
    FROM due d WHERE d.number = 0
    UNION ALL
    SELECT d.issuer, d.number,
           (SELECT min(f.filed) FROM filings f WHERE f.issuer = d.issuer AND f.filed > greatest(d.period_end, t.filed))
    FROM taken t JOIN due d ON d.issuer = t.issuer AND d.number = t.number + 1 WHERE t.filed IS NOT NULL),
late AS (
    SELECT d.*, t.filed, t.filed IS NOT NULL AS filer, date_diff('day', d.due, t.filed) AS days_late
    FROM due d LEFT JOIN taken t ON t.issuer = d.issuer AND t.number = d.number),
means AS (
    SELECT *, avg(days_late) OVER (PARTITION BY issuer ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS own_mean,
           sum(days_late) OVER g AS everyone, count(days_late) OVER g AS filers, count(*) FILTER (NOT filer) OVER g AS absent
    FROM late WINDOW g AS (PARTITION BY peers, period_end))
SELECT issuer, period_end::VARCHAR AS period_end, filed::VARCHAR AS filed, filer, days_late, own_mean,
       CASE WHEN filers - filer::INTEGER > 0 THEN (everyone - coalesce(days_late, 0)) / (filers - filer::INTEGER) END AS peer_mean,
       absent - (NOT filer)::INTEGER AS peer_non_filers
FROM means""",
    "rate_velocity": """
WITH days AS (
    SELECT l_suppkey, l_shipdate::DATE AS day, max(round(l_discount * 100)::INTEGER) AS rate FROM lineitem GROUP BY ALL),
points AS (
    SELECT * FROM days QUALIFY coalesce(lag(rate) OVER (PARTITION BY l_suppkey ORDER BY day) <> rate, true)),
steps AS (
    SELECT *, rate - lag(rate) OVER s AS change, date_diff('day', lag(day) OVER s, day) AS days
    FROM points WINDOW s AS (PARTITION BY l_suppkey ORDER BY day)),
moves AS (SELECT *, change / days AS velocity FROM steps)
SELECT l_suppkey, day::VARCHAR AS day, rate, change, days, velocity,
       (velocity - lag(velocity) OVER (PARTITION BY l_suppkey ORDER BY day)) / days AS acceleration FROM moves""",
    "rate_dispersion": """
WITH rates AS (
    SELECT p_type AS service, p_brand AS market, l_extendedprice / l_quantity AS price,
           floor(l_extendedprice / l_quantity * 100)::BIGINT AS cents
    FROM lineitem JOIN part ON p_partkey = l_partkey),
middle AS (
    SELECT service, market, count(*) AS n, avg(price) AS mean, stddev_samp(price) AS deviation, stddev_pop(price) AS whole,
           quantile_disc(cents, 0.5) AS median FROM rates GROUP BY service, market)
SELECT service, market, any_value(n) AS n, round(any_value(mean), 4) AS mean, round(any_value(deviation), 4) AS deviation,
       round(any_value(deviation / mean), 4) AS relative,
       round(avg((price - mean) ^ 3) / any_value(whole) ^ 3, 4) AS skewness, any_value(median) AS median,
       quantile_disc(abs(cents - median), 0.5) AS median_deviation
FROM rates JOIN middle USING (service, market) GROUP BY service, market""",
    "benchmark_percent": """
WITH rows AS (
    SELECT s_nationkey, round(l_extendedprice * 100)::BIGINT AS paid,
           round(CASE WHEN p_size % 10 <> 0 THEN p_retailprice END * 100)::BIGINT * l_quantity AS benchmark
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)
SELECT s_nationkey, count(benchmark) AS compared, count(*) - count(benchmark) AS without_benchmark,
       100 * sum(paid) FILTER (benchmark IS NOT NULL) / sum(benchmark) AS percent,
       count(*) FILTER (paid > benchmark) AS above
FROM rows GROUP BY s_nationkey""",
    "portfolio_score": """
WITH axes AS (
    SELECT c_custkey, c_acctbal, (1 + c_custkey % 5)::INTEGER AS derived, (1 + c_nationkey % 5)::INTEGER AS fragmentation,
           CASE WHEN c_acctbal >= 0 THEN least(5, 1 + floor(c_acctbal / 2000)::INTEGER) END AS deadline,
           (1 + length(c_mktsegment) % 5)::INTEGER AS incumbent,
           CASE c_nationkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'moderate' ELSE 'severe' END AS crowding
    FROM customer),
scored AS (SELECT *, derived + fragmentation + deadline + incumbent AS total FROM axes),
totals AS (SELECT total, dense_rank() OVER (ORDER BY total DESC) AS rank FROM (SELECT DISTINCT total FROM scored WHERE total IS NOT NULL)),
places AS (SELECT c_acctbal, dense_rank() OVER (ORDER BY c_acctbal DESC) AS place FROM (SELECT DISTINCT c_acctbal FROM customer))
SELECT c_custkey, derived, fragmentation, deadline, incumbent, scored.total, crowding, rank, place
FROM scored LEFT JOIN totals ON totals.total = scored.total LEFT JOIN places USING (c_acctbal)""",
}
