import datetime as dt

import pytest

from tests.conftest import day, got
from tradelane.marts import finance

TODAY = day("2026-06-30")


def ago(n):
    return (TODAY - dt.timedelta(days=n)).isoformat()


@pytest.fixture(scope="module")
def t(table, ports):
    def inv(i, customer, amount, currency, issued, due, paid=None):
        return dict(invoice_id=f"I{i}", shipment_id=f"S{i % 3}", customer_id=customer, amount=amount,
                    currency=currency, issue_date=issued, due_date=due, paid_date=paid)

    overdue = [-1, 0, 1, 30, 31, 60, 61, 90, 91]
    rows = [inv(i, 1 + i % 2, 100 + i, "USD", ago(200), ago(n)) for i, n in enumerate(overdue)]
    rows += [
        inv(20, 3, 1000, "EUR", ago(0), ago(-30), None),
        inv(21, 3, 500, "EUR", ago(400), ago(370), ago(360)),  # paid 10 days late
        inv(22, 3, 700, "EUR", ago(5000), ago(4970)),  # before the first rate
        inv(23, 2, 50, "USD", ago(50), ago(40), ago(45)),  # paid early
        inv(24, 9, 50, "USD", ago(50), ago(40)),  # customer not on file
    ]
    return {
        "invoices": table("invoices", rows),
        "fx_rates": table("fx_rates", [
            dict(rate_date="2024-01-01", currency="USD", rate_to_usd=1),
            dict(rate_date="2024-01-01", currency="EUR", rate_to_usd="1.1"),
            dict(rate_date=ago(10), currency="EUR", rate_to_usd="1.2")]),
        "customers": table("customers", [dict(customer_id=i, customer_name=f"C{i}") for i in (1, 2, 3)]),
        "shipments": table("shipments", [
            dict(shipment_id="S0", origin_port="CNSHA"), dict(shipment_id="S1", origin_port="DEHAM"),
            dict(shipment_id="S2", origin_port="NLRTM")]),
        "ports": ports,
    }


def test_aging_boundaries(t):
    out = {r[0][0]: tuple(r)[1:] for r in got(finance.receivables_aging(t, TODAY))}
    # day -1 and the EUR bill; day 0 counts as 1-30; one day either side of each limit
    assert {k: v[0] for k, v in out.items()} == {"1": 2, "2": 3, "3": 3, "4": 2, "5": 1}
    assert out["1"][1] == 100 + 1200 and out["2"][1] == 101 + 102 + 103
    assert out["1"][3] == 2 and abs(sum(v[2] for v in out.values()) - 100) < 0.5


def test_dashboard_puts_day_zero_in_not_yet_due(t):
    assert got(finance.aging_dashboard(t)) == [
        ("Not yet due", 100 + 101 + 1200), ("1–30 days", 102 + 103), ("31–60 days", 104 + 105 + 50),
        ("61–90 days", 106 + 107), ("90+ days", 108)]


def test_totals_agree_across_marts(t):
    aging = sum(r[0] for r in got(finance.receivables_aging(t), "outstanding_usd"))
    kpi = got(finance.receivables_kpi(t))[0]
    dash = sum(r[0] for r in got(finance.aging_dashboard(t), "usd"))
    assert aging == kpi[0] == dash and kpi[1] == 108


def test_rollup_with_subtotals(t):
    out = got(finance.fx_normalized_revenue(t))
    regions = [r[0] for r in out]
    assert regions == sorted(regions[:-1]) + [finance.TOTAL_LABEL]
    total = out[-1]
    assert total[1] == "" and total[2] == 13  # the bill before the first rate is out
    assert total[3] == got(finance.revenue_total(t))[0][0]
    subtotals = {r[0]: r for r in out if r[1] == finance.SUBTOTAL_LABEL}
    assert sum(r[2] for r in subtotals.values()) == 13
    assert total[5] == 2
    by_region = dict(got(finance.revenue_by_region(t)))
    assert {k: v[3] for k, v in subtotals.items()} == by_region


def test_payment_discipline(t):
    out = {r[0]: r for r in finance.payment_discipline(t).collect()}
    total = out[finance.ALL_CUSTOMERS_LABEL]
    assert list(out)[0] == finance.ALL_CUSTOMERS_LABEL
    # the unknown customer is out of every row, also of the total
    assert total.invoices == 12 and total.paid == 2
    assert total.avg_days_late == 2.5 and total.paid_late_pct == 50.0
    assert total.outstanding_usd == sum(range(100, 109)) + 1200 and total.overdue_90d_usd == 108
    assert out["C3"].outstanding_usd == 1200 and out["C3"].overdue_90d_usd is None
    assert out["C3"].dso_days == 365.0  # all of the year's sales are open
    assert [r for r in out][1] == "C3"


def test_top_keeps_the_total_row(t):
    assert [r[0] for r in got(finance.payment_discipline(t, top=1), "customer")] == [
        finance.ALL_CUSTOMERS_LABEL, "C3"]


def test_segments_and_classes(table, t):
    ships = []
    for c in range(1, 11):  # customer c: c shipments of 100*c, newer for higher c
        for k in range(c):
            ships.append(dict(shipment_id=f"{c}-{k}", customer_id=c, freight_amount=100 * c,
                              currency="XXX" if c == 10 else "USD", booked_date=ago(300 - 20 * c + k)))
    tables = {**t, "shipments": table("shipments", ships),
              "customers": table("customers", [dict(customer_id=c) for c in range(1, 12)])}
    out = {r.segment: r for r in finance.customer_segmentation(tables, TODAY).collect()}
    assert sum(r.customers for r in out.values()) == 10
    assert sum(r.shipments for r in out.values()) == 55
    # an unknown currency counts at 1.0
    assert sum(r.revenue_usd for r in out.values()) == 100 * sum(c * c for c in range(1, 11))
    assert out["Champion"].customers == 4 and out["Dormant"].customers == 4
    classes = [sum(r[k] for r in out.values()) for k in ("class_a_customers", "class_b_customers", "class_c_customers")]
    # shares from the top: 26.0 47.0 63.6 76.4 85.7 92.2 96.4 98.7 99.7 100.0
    assert classes == [4, 2, 4]


def test_one_pass_gives_the_region_and_the_overdue_totals(t):
    out = {r.region: r for r in finance.billing_by_region(t).collect()}
    kpi = finance.receivables_kpi(t).first()
    assert {k: round(r.billed) for k, r in out.items()} == dict(got(finance.revenue_by_region(t)))
    assert round(sum(r.open for r in out.values())) == kpi.outstanding_usd
    assert round(sum(r.overdue or 0 for r in out.values())) == kpi.overdue90_usd
    # a bill of no known shipment counts among the open ones, in no region
    lost = finance.billing_by_region({**t, "shipments": t["shipments"].where("shipment_id <> 'S0'")}).collect()
    assert sum(r.open for r in lost) == sum(r.open for r in out.values())
    assert None in {r.region for r in lost}
