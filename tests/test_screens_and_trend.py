import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import day, got
from tradelane.marts import finance, network
from tradelane.operators import screening, stats, trend


def invoice(i, customer, amount, issued, currency="USD", shipment=None, paid=None, due=None):
    return dict(invoice_id=f"I{i}", shipment_id=shipment or f"S{i}", customer_id=customer, amount=amount,
                currency=currency, issue_date=issued, due_date=due or issued, paid_date=paid)


@pytest.fixture(scope="module")
def customers(table):
    return table("customers", [dict(customer_id=i, customer_name=f"C{i}", onboarded_date="2024-07-01")
                               for i in range(1, 6)])


@pytest.fixture(scope="module")
def bills(table):
    return table("invoices", [
        # four bills two days apart: every one of them sees the whole cluster
        invoice(1, 1, "9596.55", "2025-09-10"), invoice(2, 1, "9403.88", "2025-09-12"),
        invoice(3, 1, "9424.22", "2025-09-14"), invoice(4, 1, "9515.35", "2025-09-16"),
        # 14 days either side of the middle one, 28 between the outer two
        invoice(5, 2, "9000.00", "2025-01-01"), invoice(6, 2, "9999.99", "2025-01-15"),
        invoice(7, 2, "9500.00", "2025-01-29"),
        # 15 days apart: no cluster of three
        invoice(8, 3, "9500", "2025-01-01"), invoice(9, 3, "9500", "2025-01-16"),
        invoice(10, 3, "9500", "2025-01-31"),
        # amounts outside the band, other currency
        invoice(11, 4, "8999.99", "2025-03-01"), invoice(12, 4, "10000.00", "2025-03-01"),
        invoice(13, 4, "9500", "2025-03-01"), invoice(14, 4, "9500", "2025-03-01", "EUR"),
        # the same shipment and amount twice, and one more with another amount
        invoice(15, 5, "3680.41", "2025-05-08", shipment="D1"),
        invoice(16, 5, "3680.41", "2025-05-11", shipment="D1"),
        invoice(17, 5, "3680.42", "2025-05-11", shipment="D1"),
    ])


def test_structuring_finds_whole_clusters(bills, customers):
    out = finance.structuring({"invoices": bills, "customers": customers})
    found = {r[0]: (r[1], r[2]) for r in got(out, "invoice_id", "evidence_count", "evidence_amount")}
    assert found == {"I1": (4, 37940.0), "I2": (4, 37940.0), "I3": (4, 37940.0), "I4": (4, 37940.0),
                     "I6": (3, 28499.99)}


def test_a_trailing_window_would_miss_members(bills):
    trailing = Window.partitionBy("customer_id").orderBy(F.unix_date("issue_date")).rangeBetween(-14, 0)
    near = bills.where("customer_id = 1").withColumn("k", F.count("*").over(trailing))
    assert near.where("k >= 3").count() == 2


def test_duplicates_flag_original_and_copy(bills, customers):
    out = finance.duplicate_billing({"invoices": bills, "customers": customers})
    assert sorted(got(out, "invoice_id", "evidence_count", "evidence_amount")) == [
        ("I15", 2, 7360.82), ("I16", 2, 7360.82)]


def test_both_screens_in_order(bills, customers):
    out = finance.aml_screening({"invoices": bills, "customers": customers})
    assert [r[0][0] for r in got(out, "screen")] == ["A"] * 5 + ["B"] * 2


def test_normalized_screen_crosses_currencies(table, customers):
    t = {
        "invoices": table("invoices", [
            invoice(1, 1, "4700", "2025-09-10", "EUR"), invoice(2, 1, "9400", "2025-09-11"),
            invoice(3, 1, "4600", "2025-09-12", "EUR"), invoice(4, 1, "9400", "2025-09-12", "XXX")]),
        "fx_rates": table("fx_rates", [dict(rate_date="2025-01-01", currency="EUR", rate_to_usd=2),
                                       dict(rate_date="2025-01-01", currency="USD", rate_to_usd=1)]),
        "customers": customers,
    }
    assert got(finance.structuring_normalized(t), "invoice_id", "currency", "evidence_count", "evidence_usd") == [
        ("I1", "EUR", 3, 28000.0), ("I2", "USD", 3, 28000.0), ("I3", "EUR", 3, 28000.0)]


def test_window_runs_over_days_not_rows(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}", day("2025-01-01") + dt.timedelta(days=i % 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string, d date")
    w = Window.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(-3, 3)
    want = df.withColumn("n", F.count("*").over(w)).where("n >= 5").select("id", "n")
    out = screening.windowed_clusters(df, "k", "d", F.col("id"), 3, 5).select("id", "cluster_size")
    assert sorted(got(out)) == sorted(got(want))


ANCHOR = day("2026-06-30")


def test_trend_windows_are_half_open(spark):
    back = [0, 89, 90, 364, 365, 454, 455, 456]
    rows = [("p", ANCHOR - dt.timedelta(days=n), 2**i) for i, n in enumerate(back)] + [("q", ANCHOR - dt.timedelta(days=200), 5)]
    df = spark.createDataFrame(rows, "port string, d date, v int")
    out = trend.period_over_period(df, "port", "d", ANCHOR, {"v": F.col("v")})
    assert sorted(got(out, "port", "days_cur", "v_cur", "v_prev")) == [
        ("p", 2, 1 + 2, 16 + 32), ("q", 0, None, None)]


@pytest.mark.parametrize("cur, prev, tons_cur, tons_prev, want", [
    (None, 100, 1, 1, network.NO_DATA),
    (50, None, 1, 1, network.SHORT_BASELINE),
    (50, 0, 1, 1, network.SHORT_BASELINE),
    (39, 100, 81, 100, network.FEED_ANOMALY),
    (39, 100, 80, 100, network.DECLINING),
    (39, 100, 81, None, network.DECLINING),  # no tonnage baseline: the guard does not hold
    (40, 100, 100, 100, network.DECLINING),  # exactly -60 is not below -60
    (89, 100, 100, 100, network.DECLINING),
    (90, 100, 100, 100, network.SOFTENING),
    (96, 100, 100, 100, network.SOFTENING),
    (97, 100, 100, 100, network.STABLE),
    (110, 100, 100, 100, network.STABLE),
    (111, 100, 100, 100, network.SURGING),
])
def test_port_signal(spark, cur, prev, tons_cur, tons_prev, want):
    df = spark.createDataFrame([(cur, prev, tons_cur, tons_prev)], "a bigint, b bigint, c bigint, d bigint")
    assert got(df.select(network.port_signal(*[F.col(c) for c in "abcd"]))) == [(want,)]


@pytest.mark.parametrize("days, cur, prev, want", [
    (90, None, 10, network.NO_DATA), (90, 5, 0, network.SHORT_BASELINE), (59, 5, 100, network.DATA_GAP),
    (60, 74, 100, network.COLLAPSING), (60, 75, 100, network.FALLING), (60, 91, 100, network.FALLING),
    (60, 92, 100, network.STABLE), (60, 108, 100, network.STABLE), (60, 109, 100, network.RISING),
])
def test_strait_signal(spark, days, cur, prev, want):
    df = spark.createDataFrame([(days, cur, prev)], "a bigint, b bigint, c bigint")
    assert got(df.select(network.strait_signal(*[F.col(c) for c in "abc"]))) == [(want,)]


def test_lane_statistics(spark):
    rows = [("a", v) for v in (2, 4, 4, 4, 5, 5, 7, 9)] + [("one", 3)] + [("same", 6)] * 3 + [("a", None)]
    df = spark.createDataFrame(rows, "lane string, days bigint")
    counts = stats.value_counts(df, ["lane"], "days")
    out = {r[0]: tuple(r)[1:] for r in stats.mean_and_spread(counts, ["lane"], "days").collect()}
    assert out["a"][:2] == (9, 5.0) and abs(out["a"][2] - (32 / 7) ** 0.5) < 1e-12
    assert out["one"] == (1, 3.0, None) and out["same"] == (3, 6.0, 0.0)
    robust = {r.lane: (r["median"], r.mad) for r in stats.median_and_mad(counts, ["lane"], "days").collect()}
    assert robust == {"a": (4.5, 0.5), "one": (3.0, 0.0), "same": (6.0, 0.0)}
