"""The expected result of every query as SQL over the raw tables.

Written with features Spark does not have (ASOF JOIN, QUALIFY) or that the
library avoids (recursive CTEs, whole-table windows, plain ROLLUP), so that it
tests the library's rewrites instead of repeating them.
"""

from __future__ import annotations

from checks import params as P


def r(x: str, n: int = 1) -> str:
    """Half-away-from-zero rounding of a DOUBLE."""
    s = f"1e{n}"
    return (
        f"(sign(CAST({x} AS DOUBLE))*floor(abs(CAST({x} AS DOUBLE))*{s}+0.5e0)/{s}+0e0)"
    )


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE)/NULLIF(CAST({b} AS DOUBLE),0e0))"


def pct(a: str, b: str, n: int = 1) -> str:
    return r(f"(1e2*{ratio(a, b)})", n)


def chg(cur: str, prev: str) -> str:
    return f"(1e2*{ratio(f'({cur})-({prev})', prev)})"


def whole(x: str) -> str:
    return f"CAST(ROUND({x}, 0) AS BIGINT)"


QL = "CAST(year({0}) AS VARCHAR) || '-Q' || CAST(quarter({0}) AS VARCHAR)"


def ql(day: str) -> str:
    return QL.format(day)


# name -> (needs, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "port": (
        (),
        """SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS port_code,
           n_name AS port_name, 'COUNTRY_' || CAST(n_nationkey AS VARCHAR) AS country,
           r_name AS region, n_nationkey AS nation
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "ship": (
        (),
        """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
           l_orderkey AS order_id, o_custkey AS customer_id,
           'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS origin_port,
           'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dest_port,
           CAST(l_quantity AS DECIMAL(8,2)) AS volume_cbm,
           CAST(o_orderdate AS DATE) AS booked, CAST(o_orderdate AS DATE) AS atd,
           CAST(o_orderdate AS DATE) + 365 AS eta,
           CAST(l_shipdate AS DATE) AS ata_raw,
           CASE WHEN CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE)
                THEN CAST(l_shipdate AS DATE) END AS ata,
           CASE WHEN CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE)
                THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS status,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS freight, o_orderpriority AS currency
           FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
           LEFT JOIN supplier ON l_suppkey = s_suppkey
           LEFT JOIN customer ON o_custkey = c_custkey""",
    ),
    "inv": (
        (),
        """SELECT o_orderkey AS invoice_id, o_orderkey AS shipment_id, o_custkey AS customer_id,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderpriority AS currency,
           CAST(o_orderdate AS DATE) AS issue,
           CAST(o_orderdate AS DATE) + CAST(14*(1+o_orderkey%3) AS INTEGER) AS due,
           CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE)
                + CAST(14*(1+o_orderkey%3) + o_orderkey%21 - 7 AS INTEGER) END AS paid
           FROM orders""",
    ),
    "fx": (
        (),
        """SELECT CAST(CAST(o_orderdate AS DATE) - CAST((least(day(CAST(o_orderdate AS DATE)), 28) - 1) % 7
             + greatest(day(CAST(o_orderdate AS DATE)) - 28, 0) AS INTEGER) AS DATE) AS rate_date,
           o_orderpriority AS currency,
           CAST(1 + (min(o_orderkey) % 100) / 1000e0 AS DECIMAL(10,6)) AS rate
           FROM orders GROUP BY 1, 2""",
    ),
    "usd": (
        ("inv", "fx"),
        """SELECT inv.*, inv.amount * fx.rate AS usd FROM inv ASOF JOIN fx
           ON fx.currency = inv.currency AND inv.issue >= fx.rate_date""",
    ),
    "usdreg": (
        ("usd", "port"),
        """SELECT usd.*, port.region FROM usd
           JOIN customer ON c_custkey = customer_id
           JOIN port ON port.nation = c_nationkey""",
    ),
    "today": (("inv",), "SELECT max(issue) AS d FROM inv"),
    "mile": (
        (),
        """SELECT event_id, user_id AS shipment_id, event_type, ts, c_mktsegment AS location
           FROM events LEFT JOIN customer ON c_custkey = user_id""",
    ),
    "lane": (
        ("ship",),
        """SELECT origin_port, dest_port, booked, count(*) AS n, sum(volume_cbm) AS cbm
           FROM ship GROUP BY ALL""",
    ),
    "act": (
        ("lane",),
        """SELECT booked AS day, dest_port AS port_code, CAST(sum(n) AS BIGINT) AS calls,
           CAST(sum(cbm) AS BIGINT) AS imp, CAST(sum(n) AS BIGINT) AS exp
           FROM lane GROUP BY ALL""",
    ),
    "amax": (("act",), "SELECT max(day) AS d FROM act"),
    "trend": (
        ("act", "amax"),
        """SELECT port_code,
           count(*) FILTER (WHERE day > d - 90) AS days_cur,
           sum(calls) FILTER (WHERE day > d - 90) AS calls_cur,
           sum(calls) FILTER (WHERE day > d - 455 AND day <= d - 365) AS calls_prev,
           sum(imp + exp) FILTER (WHERE day > d - 90) AS tons_cur,
           sum(imp + exp) FILTER (WHERE day > d - 455 AND day <= d - 365) AS tons_prev
           FROM act, amax GROUP BY port_code""",
    ),
    "book": (
        ("ship",),
        """SELECT origin_port, dest_port, count(*) AS n, sum(volume_cbm) AS cbm FROM ship
           WHERE booked > (SELECT max(booked) FROM ship) - 180 GROUP BY ALL""",
    ),
    "portbook": (
        ("book",),
        """SELECT port_code, CAST(sum(n) AS BIGINT) AS n, sum(cbm) AS cbm FROM (
           SELECT origin_port AS port_code, n, cbm FROM book
           UNION ALL SELECT dest_port, n, cbm FROM book) GROUP BY port_code""",
    ),
    "bridge": (
        ("ship", "port"),
        """SELECT DISTINCT l.origin_port, l.dest_port, code FROM
           (SELECT DISTINCT origin_port, dest_port FROM ship) l
           JOIN port a ON a.port_code = l.origin_port JOIN port b ON b.port_code = l.dest_port,
           unnest([a.region, b.region]) AS u(code) WHERE a.region <> b.region""",
    ),
    "strait": (
        ("act", "port"),
        """SELECT day, region AS code, sum(calls) AS n FROM act JOIN port USING (port_code)
           GROUP BY ALL""",
    ),
    "straittrend": (
        ("strait",),
        """SELECT code, count(*) FILTER (WHERE day > d - 90) AS days_cur,
           sum(n) FILTER (WHERE day > d - 90) AS cur,
           sum(n) FILTER (WHERE day > d - 455 AND day <= d - 365) AS prev
           FROM strait, (SELECT max(day) AS d FROM strait) GROUP BY code""",
    ),
    "exposure": (
        ("book", "bridge"),
        """SELECT code, count(DISTINCT origin_port || '>' || dest_port) AS lanes,
           CAST(sum(n) AS BIGINT) AS n, sum(cbm) AS cbm
           FROM book JOIN bridge USING (origin_port, dest_port) GROUP BY code""",
    ),
    "edge": (
        ("ship",),
        """SELECT origin_port, dest_port, CASE WHEN d % 2 = 0 THEN 'sea' ELSE 'rail' END AS mode,
           d AS days, c AS cost FROM (
             SELECT origin_port, dest_port, min(date_diff('day', atd, ata)) AS d, min(freight) AS c
             FROM ship GROUP BY 1, 2)
           WHERE origin_port <> dest_port AND d IS NOT NULL""",
    ),
    "walk": (
        ("edge",),
        """SELECT origin_port AS origin, dest_port AS dest, [origin_port, dest_port] AS path,
           [mode] AS modes, days, CAST(cost AS DECIMAL(18,2)) AS cost, 1 AS legs FROM edge
           UNION ALL
           SELECT w.origin, e.dest_port, list_append(w.path, e.dest_port),
           list_append(w.modes, e.mode), w.days + e.days,
           CAST(w.cost + e.cost AS DECIMAL(18,2)), w.legs + 1
           FROM walk w JOIN edge e ON e.origin_port = w.dest
           WHERE w.legs < 3 AND NOT list_contains(w.path, e.dest_port)""",
    ),
    "req": (
        ("ship", "port"),
        """SELECT DISTINCT s.origin_port, b.region AS city FROM ship s
           JOIN port b ON b.port_code = s.dest_port""",
    ),
    "inland": (
        ("port",),
        """SELECT port_code AS gateway, region AS city,
           CASE WHEN nation % 2 = 1 THEN 'truck' ELSE 'rail' END AS mode,
           1 + nation % 5 AS days, CAST(10 + nation AS DECIMAL(8,2)) AS cost FROM port""",
    ),
    "door": (
        ("req", "walk", "inland", "trend"),
        f"""SELECT q.origin_port, q.city, w.path, array_to_string(w.path, ' → ') AS txt,
           w.dest AS gateway, i.mode,
           CASE WHEN {chg('t.calls_cur', 't.calls_prev')} < -10 THEN 3
                WHEN {chg('t.calls_cur', 't.calls_prev')} < -3 THEN 1 ELSE 0 END AS buffer,
           w.days + 2 + 3 * (w.legs - 1) + i.days
           + CASE WHEN {chg('t.calls_cur', 't.calls_prev')} < -10 THEN 3
                  WHEN {chg('t.calls_cur', 't.calls_prev')} < -3 THEN 1 ELSE 0 END AS total_days,
           w.cost + i.cost + CASE WHEN w.dest = '{P.RISK_PORT}'
                THEN CAST({P.RISK_USD} AS DECIMAL(8,2)) ELSE 0 END AS usd
           FROM req q JOIN walk w ON w.origin = q.origin_port
           JOIN inland i ON i.gateway = w.dest AND i.city = q.city
           LEFT JOIN trend t ON t.port_code = w.dest""",
    ),
    "door3": (
        ("door",),
        """SELECT *, CAST(usd AS DOUBLE) + total_days * 1.5e0 AS score,
           row_number() OVER (PARTITION BY origin_port, city ORDER BY
             CAST(usd AS DOUBLE) + total_days * 1.5e0, txt, mode, total_days, usd) AS rk
           FROM door QUALIFY rk <= 3""",
    ),
    "rfm": (
        ("ship", "fx"),
        f"""SELECT customer_id, date_diff('day', max(booked), DATE '{P.RFM_DAY}') AS recency,
           count(*) AS n, {whole("sum(freight * coalesce(rate, CAST(1 AS DECIMAL(10,6))))")} AS rev
           FROM ship ASOF LEFT JOIN fx ON fx.currency = ship.currency AND ship.booked >= fx.rate_date
           JOIN customer ON c_custkey = customer_id GROUP BY customer_id""",
    ),
    "scored": (
        ("rfm",),
        """SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r_score,
           ntile(5) OVER (ORDER BY n, customer_id) AS f_score,
           ntile(5) OVER (ORDER BY rev, customer_id) AS m_score,
           sum(rev) OVER (ORDER BY rev DESC) AS run, sum(rev) OVER () AS allrev FROM rfm""",
    ),
    "deliv": (
        ("ship",),
        """SELECT shipment_id, origin_port, dest_port, origin_port || ' → ' || dest_port AS lane,
           date_diff('day', atd, ata) AS days, date_diff('day', eta, ata) AS late
           FROM ship WHERE status = 'DELIVERED'""",
    ),
    "lanestat": (
        ("deliv",),
        """SELECT lane, count(*) AS n, CAST(sum(days) AS DOUBLE)/count(days) AS mean,
           sqrt((CAST(count(days) AS DOUBLE)*CAST(sum(days*days) AS DOUBLE)
                 - CAST(sum(days) AS DOUBLE)*CAST(sum(days) AS DOUBLE))
                / NULLIF(CAST(count(days) AS DOUBLE)*(CAST(count(days) AS DOUBLE)-1e0), 0e0)) AS std
           FROM deliv GROUP BY lane""",
    ),
    "onboard": (
        (),
        """SELECT c_custkey AS customer_id, min(CAST(o_orderdate AS DATE)) AS first_day
           FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
    ),
    "prevev": (
        ("mile",),
        """SELECT *, lag(event_type) OVER w AS pe, lag(ts) OVER w AS pt FROM mile
           WINDOW w AS (PARTITION BY shipment_id ORDER BY ts, event_id)""",
    ),
}
RECURSIVE = {"walk"}


def q(body: str, *needs: str) -> str:
    """``body`` preceded by the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    head = "WITH RECURSIVE " if RECURSIVE & set(order) else "WITH "
    return head + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


ON_TIME = pct("count(*) FILTER (WHERE ata <= eta + 2)", "count(ata)")
TRANSIT = r(
    ratio("sum(date_diff('day', atd, ata))", "count(date_diff('day', atd, ata))")
)
SHARE = "CAST({0} AS DOUBLE)/NULLIF(CAST(sum({0}) OVER () AS DOUBLE),0e0)"


def share(x: str) -> str:
    return r("(1e2*(" + SHARE.format(x) + "))")


CALLS_YOY = chg("calls_cur", "calls_prev")
TONS_YOY = chg("tons_cur", "tons_prev")
STRAIT_YOY = chg("cur", "prev")


def _aging(day: str, labels: list[tuple[int | None, str]]) -> str:
    return "CASE " + " ".join(
        f"WHEN date_diff('day', due, {day}) <= {limit} THEN '{name}'" if limit is not None else f"ELSE '{name}'"
        for limit, name in labels
    ) + " END"


AGING = [
    (-1, "1 · Not yet due"),
    (30, "2 · 1-30 days overdue"),
    (60, "3 · 31-60 days overdue"),
    (90, "4 · 61-90 days overdue"),
    (None, "5 · 90+ days overdue"),
]
DASH_AGING = [
    (0, "Not yet due"),
    (30, "1–30 days"),
    (60, "31–60 days"),
    (90, "61–90 days"),
    (None, "90+ days"),
]


def aging_sql(anchor: str) -> str:
    return q(
        f"""SELECT b AS aging_bucket, count(*) AS invoices, {whole('sum(usd)')} AS outstanding_usd,
        {r("(1e2*(CAST(sum(usd) AS DOUBLE)/NULLIF(CAST(sum(sum(usd)) OVER () AS DOUBLE),0e0)))")} AS share_pct,
        count(DISTINCT customer_id) AS customers_affected
        FROM (SELECT *, {_aging(anchor, AGING)} AS b FROM usd, today WHERE paid IS NULL) GROUP BY b""",
        "usd",
        "today",
    )


def fx_part(where: str) -> str:
    return q(f"SELECT rate_date, currency, rate FROM fx WHERE {where}", "fx")


ORACLE: dict[str, str] = {}

ORACLE["m01_executive_kpis"] = q(
    f"""SELECT strftime(m, '%Y-%m') AS month, shipments,
    shipments - lag(shipments) OVER w AS mom_change,
    {pct("shipments - lag(shipments) OVER w", "lag(shipments) OVER w")} AS mom_growth_pct,
    CAST(cbm AS DOUBLE) AS total_cbm, CAST(sum(cbm) OVER w AS DOUBLE) AS cumulative_cbm,
    {r("avg(shipments) OVER (ORDER BY m ROWS 2 PRECEDING)")} AS shipments_3mo_avg,
    active_customers, on_time_pct, avg_transit_days FROM (
      SELECT date_trunc('month', booked) AS m, count(*) AS shipments, round(sum(volume_cbm), 1) AS cbm,
      count(DISTINCT customer_id) AS active_customers, {ON_TIME} AS on_time_pct,
      {TRANSIT} AS avg_transit_days FROM ship GROUP BY 1)
    WINDOW w AS (ORDER BY m)""",
    "ship",
)

ROUTE_TARGETS = "(SELECT port_code FROM port JOIN region ON region = r_name WHERE r_regionkey = 2)"
ORACLE["m02_route_pathfinding"] = q(
    f"""SELECT array_to_string(path, ' → ') AS routing, CAST(legs AS BIGINT) AS legs,
    array_to_string(modes, ' / ') AS modes, days AS transit_days,
    CAST(cost AS DOUBLE) AS cost_per_cbm_usd,
    rank() OVER (ORDER BY cost) AS cost_rank, rank() OVER (ORDER BY days) AS speed_rank
    FROM walk WHERE origin = 'N00' AND dest IN {ROUTE_TARGETS}
    ORDER BY cost, days, routing, modes LIMIT 12""",
    "walk",
    "port",
)

ORACLE["m03_transit_bottlenecks"] = q(
    f"""SELECT stage, location, count(*) AS observations,
    {r("quantile_cont(h, 0.5)/24e0", 2)} AS median_days,
    {r("quantile_cont(h, 0.9)/24e0", 2)} AS p90_days,
    {r("max(h)/24e0", 1)} AS worst_case_days,
    {r(ratio("quantile_cont(h, 0.9)", "quantile_cont(h, 0.5)"), 1)} AS p90_to_median_ratio
    FROM (SELECT pe || ' → ' || event_type AS stage, location,
          CAST(date_diff('hour', pt, ts) AS DOUBLE) AS h FROM prevev WHERE pe IS NOT NULL)
    WHERE h >= 0 GROUP BY stage, location HAVING count(*) >= 40
    ORDER BY p90_days DESC, stage, location LIMIT 15""",
    "prevev",
)

ORACLE["m04_customer_segmentation"] = q(
    f"""SELECT segment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS shipments,
    CAST(sum(rev) AS BIGINT) AS revenue_usd,
    {pct("sum(rev)", "max(allrev)")} AS revenue_share_pct,
    count(*) FILTER (WHERE cum <= 80) AS class_a_customers,
    count(*) FILTER (WHERE cum > 80 AND cum <= 95) AS class_b_customers,
    count(*) FILTER (WHERE cum > 95) AS class_c_customers
    FROM (SELECT *, {pct("run", "allrev")} AS cum,
      CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champion'
           WHEN r_score >= 4 AND f_score >= 3 THEN 'Loyal'
           WHEN r_score <= 2 AND m_score >= 4 THEN 'At Risk (high value)'
           WHEN greatest(r_score, f_score) <= 2 THEN 'Dormant'
           WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Developing'
           ELSE 'Core' END AS segment FROM scored) GROUP BY segment""",
    "scored",
)

ORACLE["m05_cohort_retention"] = q(
    f"""SELECT {ql("cq")} AS cohort, size, max(k) FILTER (WHERE since = 0) AS q0,
    {", ".join(pct(f"max(k) FILTER (WHERE since = {i})", "size", 0) + f" AS q{i}_pct" for i in range(1, 7))}
    FROM (
      SELECT cq, date_diff('quarter', cq, aq) AS since, count(DISTINCT customer_id) AS k
      FROM (SELECT customer_id, date_trunc('quarter', first_day) AS cq FROM onboard)
      JOIN (SELECT DISTINCT customer_id, date_trunc('quarter', booked) AS aq FROM ship)
      USING (customer_id) WHERE aq >= cq GROUP BY 1, 2)
    JOIN (SELECT date_trunc('quarter', first_day) AS cq, count(*) AS size FROM onboard GROUP BY 1)
    USING (cq) GROUP BY cq, size""",
    "onboard",
    "ship",
)

ORACLE["m06_fx_normalized_revenue"] = q(
    f"""SELECT CASE WHEN grouping(region) = 1 THEN '── TOTAL ──' ELSE region END AS region,
    CASE WHEN grouping(region) = 1 THEN '' WHEN grouping(qtr) = 1 THEN 'subtotal'
         ELSE {ql("qtr")} END AS quarter,
    count(*) AS invoices, {whole("sum(usd)")} AS revenue_usd,
    {r(ratio("sum(usd)", "count(*)"), 0)} AS avg_invoice_usd,
    count(DISTINCT currency) AS currencies_billed
    FROM (SELECT *, date_trunc('quarter', issue) AS qtr FROM usdreg) GROUP BY ROLLUP (region, qtr)""",
    "usdreg",
)

ORACLE["m07_receivables_aging"] = aging_sql(f"DATE '{P.AGING_DAY}'")
ORACLE["v4_receivables_aging_anchored"] = aging_sql("d")

ORACLE["m07b_payment_discipline"] = q(
    f"""SELECT customer, invoices, paid, avg_days_late, paid_late_pct, outstanding_usd,
    overdue_90d_usd, dso_days FROM (
      SELECT CASE WHEN grouping(customer_id) = 1 THEN '── ALL CUSTOMERS ──' ELSE max(c_name) END AS customer,
      grouping(customer_id) AS g, customer_id, count(*) AS invoices, count(paid) AS paid,
      {r(ratio("sum(date_diff('day', due, paid))", "count(paid)"))} AS avg_days_late,
      {pct("count(*) FILTER (WHERE paid > due)", "count(paid)")} AS paid_late_pct,
      {whole("sum(usd) FILTER (WHERE paid IS NULL)")} AS outstanding_usd,
      {whole("sum(usd) FILTER (WHERE paid IS NULL AND due < d - 90)")} AS overdue_90d_usd,
      {r("(365e0*" + ratio("sum(usd) FILTER (WHERE paid IS NULL)", "sum(usd) FILTER (WHERE issue > d - 365)") + ")", 0)} AS dso_days
      FROM usd JOIN customer ON c_custkey = customer_id, today
      GROUP BY GROUPING SETS ((customer_id), ())
      HAVING sum(usd) FILTER (WHERE paid IS NULL) > 0)
    ORDER BY g DESC, outstanding_usd DESC, customer_id LIMIT 16""",
    "usd",
    "today",
)

ORACLE["m08_transit_anomalies"] = q(
    f"""SELECT shipment_id, lane, days AS actual_days, {r("mean")} AS lane_avg_days,
    {r("z", 2)} AS z_score, late AS days_late_vs_eta,
    CASE WHEN z > 3 THEN '🔴 investigate' ELSE '🟡 monitor' END AS severity
    FROM (SELECT *, (days - mean)/NULLIF(std, 0e0) AS z FROM deliv JOIN lanestat USING (lane))
    WHERE n >= 30 AND z > 2 ORDER BY z_score DESC, lane, shipment_id, days_late_vs_eta LIMIT 20""",
    "lanestat",
)

ORACLE["v2_robust_anomalies"] = q(
    f"""SELECT shipment_id, lane, days AS actual_days, {r("med")} AS lane_median_days,
    {r("rz", 2)} AS robust_z, {r("(days - mean)/NULLIF(std, 0e0)", 2)} AS classic_z,
    late AS days_late_vs_eta FROM (
      SELECT *, 0.6745e0*(days - med)/NULLIF(mad, 0e0) AS rz FROM deliv JOIN lanestat USING (lane)
      JOIN (SELECT lane, med, median(abs(days - med)) AS mad FROM deliv
            JOIN (SELECT lane, median(days) AS med FROM deliv GROUP BY lane) USING (lane)
            GROUP BY lane, med) USING (lane))
    WHERE n >= 30 AND rz > {P.ROBUST_Z} """,
    "lanestat",
)

STRUCT = f"""SELECT 'A · STRUCTURING' AS screen, c_name AS customer_name,
    CAST(invoice_id AS VARCHAR) AS invoice_id, issue AS issue_date,
    CAST(amount AS DOUBLE) AS amount, k AS evidence_count, CAST(s AS DOUBLE) AS evidence_amount
    FROM (SELECT *, count(*) OVER w AS k, sum(amount) OVER w AS s FROM inv
          WHERE currency = '{P.AML['currency']}' AND amount BETWEEN {P.AML['low']} AND {P.AML['high']}
          WINDOW w AS (PARTITION BY customer_id ORDER BY issue RANGE BETWEEN
            INTERVAL {P.AML['reach_days']} DAYS PRECEDING AND INTERVAL {P.AML['reach_days']} DAYS FOLLOWING))
    JOIN customer ON c_custkey = customer_id WHERE k >= {P.AML['min_cluster']}"""
DUPES = """SELECT 'B · DUPLICATE BILLING' AS screen, c_name AS customer_name,
    l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS invoice_id,
    CAST(o_orderdate AS DATE) AS issue_date, CAST(l_linenumber AS DOUBLE) AS amount,
    k AS evidence_count, CAST(l_linenumber * k AS DOUBLE) AS evidence_amount
    FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS k FROM lineitem)
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE k > 1"""
ORACLE["m09_aml_screening"] = q(f"{STRUCT} UNION ALL {DUPES}", "inv")

ORACLE["v3_aml_normalized"] = q(
    f"""SELECT 'A · STRUCTURING' AS screen, c_name AS customer_name, invoice_id, issue AS issue_date,
    currency, CAST(amount AS DOUBLE) AS amount, k AS evidence_count,
    CAST(round(s, 2) AS DOUBLE) AS evidence_usd
    FROM (SELECT *, count(*) OVER w AS k, sum(usd) OVER w AS s FROM usd
          WHERE usd BETWEEN {P.AML_USD['low']} AND {P.AML_USD['high']}
          WINDOW w AS (PARTITION BY customer_id ORDER BY issue RANGE BETWEEN
            INTERVAL {P.AML_USD['reach_days']} DAYS PRECEDING AND INTERVAL {P.AML_USD['reach_days']} DAYS FOLLOWING))
    JOIN customer ON c_custkey = customer_id WHERE k >= {P.AML_USD['min_cluster']}""",
    "usd",
)


def _check(name: str, severity: str, body: str) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, count(*) AS violations {body}"


DQ = " UNION ALL ".join(
    [
        _check("01 · Shipments with ATA before ATD (time travel)", "critical",
               "FROM ship WHERE ata_raw < atd"),
        _check("02 · Delivered shipments missing arrival date", "critical",
               "FROM ship WHERE status = 'DELIVERED' AND ata_raw IS NULL"),
        _check("03 · Orphan events (no parent shipment)", "critical",
               "FROM mile WHERE shipment_id NOT IN (SELECT order_id FROM ship)"),
        _check("04 · Orphan invoices (no parent shipment)", "critical",
               "FROM inv WHERE invoice_id NOT IN (SELECT order_id FROM ship)"),
        _check("05 · Invoices paid before they were issued", "critical",
               "FROM inv WHERE paid < issue"),
        _check("06 · Shipments referencing unknown ports", "critical",
               f"FROM ship WHERE origin_port NOT IN (SELECT port_code FROM port)"
               f" OR CASE WHEN order_id % {P.LOST_EVERY} = 0 THEN '{P.LOST_PORT}' ELSE dest_port END"
               " NOT IN (SELECT port_code FROM port)"),
        _check("07 · Non-positive volumes or amounts", "critical",
               "FROM ship WHERE volume_cbm <= 0 OR freight <= 0"),
        _check("08 · Currency codes without an FX fixing", "warning",
               f"FROM (SELECT DISTINCT CASE WHEN invoice_id % {P.LOST_EVERY} = 0 THEN '{P.LOST_CURRENCY}' ELSE currency END AS c FROM inv)"
               " WHERE c NOT IN (SELECT currency FROM fx)"),
        _check("09 · Shipments billed more than once (review)", "warning",
               "FROM (SELECT shipment_id FROM inv GROUP BY 1 HAVING count(*) > 1)"),
        _check("10 · Bookings dated before customer onboarding", "warning",
               "FROM ship JOIN onboard USING (customer_id) WHERE booked < first_day + 30"),
        _check("11 · Chokepoint lanes referencing unknown ports", "critical",
               f"FROM bridge WHERE origin_port NOT IN (SELECT port_code FROM port)"
               f" OR CASE WHEN dest_port = '{P.LAST_PORT}' THEN '{P.LOST_PORT}' ELSE dest_port END"
               " NOT IN (SELECT port_code FROM port)"),
    ]
)
DQ_NEEDS = ("ship", "mile", "inv", "port", "fx", "onboard", "bridge")
ORACLE["m10_data_quality"] = q(DQ, *DQ_NEEDS)
ORACLE["i8_quality_gate"] = q(
    f"SELECT * FROM ({DQ}) WHERE severity = 'critical' AND violations > 0", *DQ_NEEDS
)

ORACLE["m11_port_activity"] = q(
    f"""SELECT port_name, region, d AS data_through, days_cur AS days_observed,
    {r(ratio("calls_cur", "days_cur"))} AS ctr_calls_per_day, {r(CALLS_YOY)} AS ctr_calls_yoy_pct,
    {r(ratio("tons_cur", "days_cur") + "/1e3")} AS cargo_kt_per_day, {r(TONS_YOY)} AS cargo_yoy_pct
    FROM trend JOIN port USING (port_code), amax""",
    "trend",
    "port",
)

ORACLE["m12_network_exposure"] = q(
    f"""SELECT port_name, region, n AS shipments_180d, {whole("cbm")} AS cbm_180d,
    {share("cbm")} AS share_of_book_pct, {r(CALLS_YOY)} AS real_calls_yoy_pct,
    CASE WHEN calls_cur IS NULL THEN 'no real data'
      WHEN coalesce(calls_prev, 0) = 0 THEN 'baseline too short'
      WHEN {CALLS_YOY} < -60 AND {TONS_YOY} > -20 THEN '?  feed anomaly — verify source'
      WHEN {CALLS_YOY} < -10 THEN '!! declining traffic' WHEN {CALLS_YOY} < -3 THEN '!  softening'
      WHEN {CALLS_YOY} > 10 THEN '▲ surging (congestion watch)' ELSE 'stable' END AS real_world_signal
    FROM portbook JOIN port USING (port_code) LEFT JOIN trend USING (port_code)""",
    "portbook",
    "port",
    "trend",
)

TOTAL_BOOK = "(SELECT sum(cbm) FROM book)"
ORACLE["m13_chokepoint_exposure"] = q(
    f"""SELECT code || ' passage' AS chokepoint, lanes, n AS shipments_180d, {whole("cbm")} AS cbm_180d,
    {pct("cbm", TOTAL_BOOK)} AS share_of_book_pct, {r(ratio("cur", "days_cur"))} AS transits_per_day,
    {r(STRAIT_YOY)} AS transits_yoy_pct,
    CASE WHEN cur IS NULL THEN 'no real data' WHEN coalesce(prev, 0) = 0 THEN 'baseline too short'
      WHEN days_cur < 60 THEN 'data gap — verify feed'
      WHEN {STRAIT_YOY} < -25 THEN '!! transits collapsing — re-route risk'
      WHEN {STRAIT_YOY} < -8 THEN '!  transits falling' WHEN {STRAIT_YOY} > 8 THEN '▲ transits rising'
      ELSE 'stable' END AS real_world_signal
    FROM exposure LEFT JOIN straittrend USING (code)""",
    "exposure",
    "straittrend",
)

ORACLE["m14_door_to_door_routing"] = q(
    f"""SELECT origin_port || ' → ' || city AS request, rk AS rank, txt || ' ⇒ ' || city AS route,
    gateway, mode AS inland_mode, CAST(total_days AS BIGINT) AS total_days,
    {r("usd")} AS usd_per_cbm, CAST(buffer AS BIGINT) AS real_data_buffer_d, {r("score")} AS score
    FROM door3""",
    "door3",
)

ORACLE["d01_kpi_strip"] = q(
    f"""SELECT count(*) AS shipments,
    count(DISTINCT customer_id) FILTER (WHERE booked > (SELECT max(booked) FROM ship) - 180) AS customers,
    {ON_TIME} AS on_time_pct, {TRANSIT} AS avg_transit FROM ship""",
    "ship",
)
ORACLE["d02_revenue_total"] = q(f"SELECT {whole('sum(usd)')} AS revenue_usd FROM usd", "usd")
ORACLE["d03_receivables_kpi"] = q(
    f"""SELECT {whole("sum(usd)")} AS outstanding_usd,
    {whole("sum(usd) FILTER (WHERE due < d - 90)")} AS overdue90_usd FROM usd, today WHERE paid IS NULL""",
    "usd",
    "today",
)
ORACLE["d04_monthly_volume"] = q(
    "SELECT strftime(booked, '%Y-%m') AS month, count(*) AS shipments FROM ship GROUP BY 1", "ship"
)
ORACLE["d05_revenue_by_region"] = q(
    f"SELECT region, {whole('sum(usd)')} AS revenue_usd FROM usdreg GROUP BY region", "usdreg"
)
ORACLE["d06_port_table"] = q(
    f"""SELECT port_code, port_name, country, region, CAST(cbm AS DOUBLE) AS cbm180,
    {r("CAST(tons_cur AS DOUBLE)/90e0/1e3")} AS kt_day, {r(TONS_YOY)} AS yoy
    FROM port LEFT JOIN portbook USING (port_code) LEFT JOIN trend USING (port_code)""",
    "port",
    "portbook",
    "trend",
)
ORACLE["d07_weekly_series"] = q(
    """SELECT port_code, count(*) AS weeks, string_agg(CAST(t AS VARCHAR), ',' ORDER BY wk) AS series
    FROM (SELECT port_code, date_trunc('week', day) AS wk, CAST(sum(imp + exp) AS BIGINT) AS t
          FROM act, amax WHERE day > d - 182 GROUP BY 1, 2) GROUP BY port_code""",
    "act",
    "amax",
)
ORACLE["d08_aging_dashboard"] = q(
    f"""SELECT {_aging("d", DASH_AGING)} AS bucket, {whole("sum(usd)")} AS usd
    FROM usd, today WHERE paid IS NULL GROUP BY 1""",
    "usd",
    "today",
)
ORACLE["d09_chokepoint_compact"] = q(
    f"""SELECT code || ' passage' AS chokepoint, {pct("cbm", TOTAL_BOOK)} AS share_of_book_pct,
    {r(STRAIT_YOY)} AS transits_yoy_pct FROM exposure LEFT JOIN straittrend USING (code)""",
    "exposure",
    "straittrend",
)
ORACLE["d10_busiest_lanes"] = q(
    """SELECT origin_port, dest_port, count(*) AS shipments FROM ship GROUP BY 1, 2
    ORDER BY shipments DESC, origin_port, dest_port LIMIT 10""",
    "ship",
)
ORACLE["d11_monthly_on_time"] = q(
    f"SELECT strftime(booked, '%Y-%m') AS month, {ON_TIME} AS on_time_pct FROM ship GROUP BY 1",
    "ship",
)
ORACLE["d12_headline_facts"] = q(
    f"""SELECT peak_month, peak_shipments, top_region, top_region_pct, up_port, up_pct, down_port,
    down_pct, idle_ports, overdue_pct FROM
    (SELECT m AS peak_month, n AS peak_shipments FROM
       (SELECT strftime(booked, '%Y-%m') AS m, count(*) AS n FROM ship GROUP BY 1) ORDER BY n DESC, m LIMIT 1),
    (SELECT region AS top_region, {r("1e2*CAST(v AS DOUBLE)/CAST(sum(v) OVER () AS DOUBLE)", 0)} AS top_region_pct
       FROM (SELECT region, {whole("sum(usd)")} AS v FROM usdreg GROUP BY 1) ORDER BY v DESC LIMIT 1),
    (SELECT first(port_name ORDER BY yoy DESC, kt DESC, port_code DESC) FILTER (WHERE live) AS up_port,
       max(yoy) FILTER (WHERE live) AS up_pct,
       first(port_name ORDER BY yoy, kt DESC, port_code) FILTER (WHERE live) AS down_port,
       min(yoy) FILTER (WHERE live) AS down_pct,
       coalesce(string_agg(port_name, ', ' ORDER BY port_name) FILTER (WHERE kt = 0), '') AS idle_ports
     FROM (SELECT *, kt <> 0 AND yoy IS NOT NULL AS live FROM (
       SELECT port_code, port_name, {r("CAST(tons_cur AS DOUBLE)/90e0/1e3")} AS kt, {r(TONS_YOY)} AS yoy
       FROM port LEFT JOIN trend USING (port_code)))),
    (SELECT {pct(whole("sum(usd) FILTER (WHERE due < d - 90)"), whole("sum(usd)"), 0)} AS overdue_pct
       FROM usd, today WHERE paid IS NULL)""",
    "ship",
    "usdreg",
    "port",
    "trend",
    "today",
)
ORACLE["d13_named_routes"] = q(
    f"""SELECT a.port_name || ' → ' || city AS request, rk AS rank,
    (SELECT string_agg(p.port_name, ' → ' ORDER BY u.i)
       FROM (SELECT unnest(path) AS code, generate_subscripts(path, 1) AS i) u
       JOIN port p ON p.port_code = u.code) || ' ⇒ ' || city AS route,
    mode, CAST(total_days AS BIGINT) AS days, {r("usd")} AS usd
    FROM door3 JOIN port a ON a.port_code = door3.origin_port""",
    "door3",
    "port",
)
ORACLE["d14_port_legend"] = q("SELECT port_code, port_name, country FROM port", "port")

ORACLE["v1_yearly_growth"] = q(
    f"""SELECT strftime(a.m, '%Y-%m') AS month, a.n AS shipments, b.n AS shipments_year_ago,
    {pct("a.n - b.n", "b.n")} AS yoy_growth_pct
    FROM dense a LEFT JOIN dense b ON b.m = a.m - INTERVAL 12 MONTH""",
    "ship",
).replace(
    "SELECT strftime(a.m",
    """SELECT * FROM (WITH c AS (SELECT date_trunc('month', booked) AS m, count(*) AS n FROM ship GROUP BY 1),
    dense AS (SELECT g.m, coalesce(c.n, 0) AS n FROM
      (SELECT unnest(generate_series((SELECT min(m) FROM c), (SELECT max(m) FROM c), INTERVAL 1 MONTH)) AS m) g
      LEFT JOIN c ON c.m = g.m)
    SELECT strftime(a.m""",
    1,
) + ")"

# -- ingest ------------------------------------------------------------------

ORACLE["i1_csv_load"] = (
    "SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS customer_name,"
    " c_mktsegment AS industry, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS credit_limit_usd FROM customer"
)
FEED = f"(SELECT rate_date, currency, CAST(rate + 1 AS DECIMAL(10,6)) AS rate FROM fx WHERE {P.UPSERT_WHERE})"
ORACLE["i2_keyed_upsert"] = q(
    f"""SELECT fx.rate_date, fx.currency, CAST(coalesce(f.rate, fx.rate) AS DOUBLE) AS rate_to_usd
    FROM fx LEFT JOIN {FEED} f ON f.rate_date = fx.rate_date AND f.currency = fx.currency""",
    "fx",
)
OVERRIDE = f"(SELECT rate_date, currency, CAST(rate + 2 AS DECIMAL(10,6)) AS rate FROM fx WHERE {P.OVERRIDE_WHERE})"
ORACLE["i3_source_override"] = q(
    f"""SELECT rate_date, currency, CAST(rate AS DOUBLE) AS rate_to_usd FROM fx
    WHERE NOT (currency IN (SELECT currency FROM {OVERRIDE}) AND rate_date >= (SELECT min(rate_date) FROM {OVERRIDE}))
    UNION ALL SELECT rate_date, currency, CAST(rate AS DOUBLE) FROM {OVERRIDE}""",
    "fx",
)
ORACLE["i4_load_profile"] = q(
    """SELECT count(*) AS row_count, min(rate_date) AS first_date, max(rate_date) AS last_date,
    string_agg(DISTINCT currency, ', ' ORDER BY currency) AS currency_list FROM fx""",
    "fx",
)


def _c(table: str, name: str, count: str, body: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, CAST({count} AS BIGINT) AS violations {body}"


ORACLE["i5_declared_constraints"] = " UNION ALL ".join(
    [
        _c("lineitem", "unique: l_orderkey, l_linenumber", "coalesce(sum(k - 1), 0)",
           "FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber)"),
        _c("lineitem", "not null: l_orderkey", "count(*)", "FROM lineitem WHERE l_orderkey IS NULL"),
        _c("lineitem", "not null: l_linenumber", "count(*)", "FROM lineitem WHERE l_linenumber IS NULL"),
        _c("lineitem", "not null: l_shipdate", "count(*)", "FROM lineitem WHERE l_shipdate IS NULL"),
        _c("lineitem", "check: returned", "count(*)", "FROM lineitem WHERE NOT (l_returnflag IN ('R', 'A'))"),
        _c("lineitem", "check: quantity", "count(*)", "FROM lineitem WHERE NOT (l_quantity > 1)"),
        _c("lineitem", "reference: l_orderkey -> orders", "count(*)",
           "FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)"),
        _c("orders", "unique: o_orderkey", "coalesce(sum(k - 1), 0)",
           "FROM (SELECT count(*) AS k FROM orders GROUP BY o_orderkey)"),
        _c("orders", "not null: o_orderkey", "count(*)", "FROM orders WHERE o_orderkey IS NULL"),
        _c("orders", "reference: o_custkey -> customer", "count(*)",
           f"FROM orders WHERE CASE WHEN o_orderkey % {P.LOST_EVERY} = 0 THEN -o_custkey ELSE o_custkey END"
           " NOT IN (SELECT c_custkey FROM customer)"),
        _c("customer", "unique: c_custkey", "coalesce(sum(k - 1), 0)",
           "FROM (SELECT count(*) AS k FROM customer GROUP BY c_custkey)"),
        _c("customer", "not null: c_custkey", "count(*)", "FROM customer WHERE c_custkey IS NULL"),
    ]
)
ORACLE["i6_feature_flatten"] = """SELECT CAST(ts AS DATE) AS activity_date, 'P-' || event_type AS port_code,
    event_type AS portwatch_id, 'feed ' || event_type AS portwatch_name,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS portcalls_container,
    CAST(event_id AS BIGINT) AS import_total_tons FROM events"""
ORACLE["i7_fx_normalise"] = q(
    f"""SELECT rate_date, currency,
    CAST(CAST(round(CASE WHEN currency = '{P.BANK_CURRENCY}' THEN 1e0/(CAST(rate AS DOUBLE)*2e0)
      ELSE 1e0/CAST(rate AS DOUBLE) END, 6) AS DECIMAL(10,6)) AS DOUBLE) AS rate_to_usd
    FROM fx WHERE rate_date >= DATE '{P.FEED_START}'""",
    "fx",
)
ORACLE["i9_freshness"] = """SELECT CAST(max(o_orderdate) AS DATE) AS data_through,
    'data through ' || CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS stamp FROM orders"""
ORACLE["i10_publish"] = q(
    f"""SELECT 'monthly_volume' AS mart, 'Monthly volume' AS title,
      (SELECT count(*) FROM (SELECT DISTINCT date_trunc('month', booked) FROM ship)) AS row_count
    UNION ALL SELECT 'duplicate_billing', 'Duplicate billing', (SELECT count(*) FROM ({DUPES}))
    UNION ALL SELECT 'shipments', 'Shipments', (SELECT count(*) FROM lineitem)""",
    "ship",
)

# -- single primitives ---------------------------------------------------------

ORACLE["p23_asof_inner"] = q(
    "SELECT invoice_id, issue AS issue_date, CAST(usd AS DOUBLE) AS amount_usd FROM usd", "usd"
)
ORACLE["p24_asof_left"] = q(
    """SELECT invoice_id, fx.rate_date IS NOT NULL AS priced, CAST(inv.amount * coalesce(rate, 1) AS DOUBLE) AS amount_usd
    FROM inv ASOF LEFT JOIN fx ON fx.currency = inv.currency AND inv.issue >= fx.rate_date""",
    "inv",
    "fx",
)
ORACLE["p23_asof_timestamps"] = """SELECT e.event_id, e.event_type, p.event_id AS purchase_id, p.value AS purchase_value
    FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
    ON p.user_id = e.user_id AND e.ts >= p.ts"""
ORACLE["p26_anti_join"] = """SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)"""
ORACLE["p30_bounded_paths"] = q(
    """SELECT origin, dest, array_to_string(path, ' → ') AS routing, array_to_string(modes, ' / ') AS modes,
    CAST(days AS BIGINT) AS days, CAST(cost AS DOUBLE) AS cost, CAST(legs AS BIGINT) AS legs FROM walk""",
    "walk",
)
ORACLE["p44_rollup"] = """SELECT coalesce(r_name, 'all') AS region, coalesce(n_name, 'all') AS nation,
    CAST(grouping(r_name) + grouping(n_name) AS BIGINT) AS level, count(*) AS customers,
    CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name)"""
ORACLE["p45_grouping_sets"] = """SELECT coalesce(o_orderpriority, 'total') AS priority,
    CAST(grouping(o_orderpriority) AS BIGINT) AS is_total, count(*) AS orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount
    FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())"""
ORACLE["p47_quantiles"] = f"""SELECT l_returnflag AS flag, {r("quantile_cont(l_quantity, 0.5)", 4)} AS median_qty,
    {r("quantile_cont(l_quantity, 0.9)", 4)} AS p90_qty, max(l_quantity) AS max_qty
    FROM lineitem GROUP BY 1"""
ORACLE["p47_quantiles_continuous"] = "SELECT l_returnflag AS flag, l_linestatus AS status, " + ", ".join(
    f"{r(f'quantile_cont(CAST(l_extendedprice AS DOUBLE), {share})', 4)} AS {name}"
    for name, share in (("p25_price", 0.25), ("median_price", 0.5), ("p99_price", 0.99))
) + " FROM lineitem GROUP BY 1, 2"
ORACLE["p48_sample_stddev"] = q(
    f"""SELECT lane, n AS lane_n, {r("mean", 6)} AS mean_days, {r("std", 6)} AS std_days FROM lanestat""",
    "lanestat",
)
ORACLE["p61_previous_event"] = q(
    """SELECT event_id, shipment_id, event_type, pe AS prev_event, date_diff('hour', pt, ts) AS hours
    FROM prevev""",
    "prevev",
)
ORACLE["p62_running_share"] = q(
    f"""SELECT invoice_id, CAST(sum(amount) OVER (ORDER BY amount DESC) AS DOUBLE) AS running,
    {r("1e2*CAST(sum(amount) OVER (ORDER BY amount DESC) AS DOUBLE)/CAST(sum(amount) OVER () AS DOUBLE)", 4)} AS cumulative_pct
    FROM inv""",
    "inv",
)
ORACLE["p64_symmetric_range"] = q(
    """SELECT invoice_id, customer_id, count(*) OVER w AS cluster_size,
    CAST(sum(amount) OVER w AS DOUBLE) AS cluster_amount FROM inv WINDOW w AS (
      PARTITION BY customer_id ORDER BY issue RANGE BETWEEN INTERVAL 14 DAYS PRECEDING AND INTERVAL 14 DAYS FOLLOWING)""",
    "inv",
)
ORACLE["p67_ntile"] = """SELECT o_orderkey AS order_id,
    ntile(5) OVER (ORDER BY CAST(o_totalprice AS DECIMAL(12,2)), o_orderkey) AS by_amount,
    ntile(5) OVER (ORDER BY o_custkey DESC, o_orderkey) AS by_customer,
    ntile(5) OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END, o_orderkey) AS by_hot_value
    FROM orders"""
ORACLE["p68_rank"] = """SELECT l_orderkey AS order_id, l_linenumber AS line,
    rank() OVER (ORDER BY l_quantity) AS up, rank() OVER (ORDER BY l_quantity DESC) AS down FROM lineitem"""
ORACLE["p82_hours_crossed"] = """SELECT event_id, date_diff('hour', TIMESTAMP '2024-01-01 00:59:00', ts) AS hours FROM events"""
ORACLE["p83_quarters_crossed"] = """SELECT o_orderkey AS order_id,
    date_diff('quarter', DATE '1995-03-31', CAST(o_orderdate AS DATE)) AS quarters FROM orders"""
