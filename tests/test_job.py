import datetime as dt
import json
import os

import pytest

from tests.test_finance import TODAY, ago
from tradelane import job
from tradelane.operators.quality import QualityGateError
from tradelane.sources import manifest, publish, tables


def write(root, frames):
    for name, df in frames.items():
        tables.write_csv(df, f"{root}/{name}.csv")


@pytest.fixture(scope="module")
def frames(table, ports, routes):
    lanes = [("CNSHA", "NLRTM"), ("UAODS", "CNSHA"), ("DEHAM", "USNYC")]
    ships, events, bills = [], [], []
    for i in range(120):
        booked = TODAY - dt.timedelta(days=5 * i + 1)
        arrived = booked + dt.timedelta(days=20 + i % 4)
        origin, dest = lanes[i % 3]
        ships.append(dict(shipment_id=f"S{i}", customer_id=1 + i % 4, origin_port=origin, dest_port=dest, service="LCL",
                          volume_cbm=1 + i % 9, weight_kg=10, booked_date=booked, etd=booked, eta=arrived, atd=booked,
                          ata=arrived, status="DELIVERED", freight_amount=100 + i, currency="EUR" if i % 2 else "USD"))
        for n, kind in enumerate(("BOOKED", "DEPARTED", "ARRIVED")):
            events.append(dict(event_id=3 * i + n, shipment_id=f"S{i}", event_type=kind, location=origin,
                               event_time=dt.datetime.combine(booked, dt.time()) + dt.timedelta(days=n * (2 + i % 3))))
        bills.append(dict(invoice_id=f"I{i}", shipment_id=f"S{i}", customer_id=1 + i % 4, amount=200 + i,
                          currency="EUR" if i % 2 else "USD", issue_date=booked, due_date=booked + dt.timedelta(days=30),
                          paid_date=None if i < 20 else booked + dt.timedelta(days=25)))
    return {
        "ports": ports.fillna(0.0), "shipping_routes": routes,
        "customers": table("customers", [dict(customer_id=c, customer_name=f"C{c}", country="PL", industry="x",
                                              onboarded_date="2024-01-01", credit_limit_usd=1) for c in range(1, 5)]),
        "shipments": table("shipments", ships), "shipment_events": table("shipment_events", events),
        "invoices": table("invoices", bills),
        "fx_rates": table("fx_rates", [dict(rate_date="2023-01-01", currency=c, rate_to_usd=r) for c, r in (("USD", 1), ("EUR", "1.1"))]),
    }


def config(root, **more):
    return job.Config(csv_dir=f"{root}/csv", table_dir=f"{root}/tables", out_dir=f"{root}/out", **more)


def test_whole_run(spark, frames, table, tmp_path):
    write(f"{tmp_path}/csv", frames)
    feeds = {
        "port_activity_daily": table("port_activity_daily", [
            dict(activity_date=TODAY - dt.timedelta(days=n), port_code=p, portwatch_id="x", portcalls_container=5,
                 import_total_tons=10, export_total_tons=10) for n in range(460) for p in ("CNSHA", "NLRTM")]),
        "fx_rates": table("fx_rates", [dict(rate_date=ago(100), currency="EUR", rate_to_usd="1.5")]),
    }
    write(f"{tmp_path}/feeds", feeds)
    inland = table("inland_legs", [dict(from_port="NLRTM", dest_city="Kyiv", mode="rail", distance_km=1, transit_days=2, cost_per_cbm=3)])
    write(str(tmp_path), {"inland_legs": inland})
    cfg = config(tmp_path, feeds={n: f"{tmp_path}/feeds/{n}.csv" for n in feeds}, inland_csv=f"{tmp_path}/inland_legs.csv")
    catalogue = job.run(spark, cfg)
    names = {r.mart for r in catalogue.collect()}
    assert names >= {"executive_kpis", "door_to_door_routing", "headline_facts", "data_quality"}
    for name in names:
        publish.read(spark, cfg.out_dir, name).count()
    revenue = publish.read(spark, cfg.out_dir, "revenue_total").first()[0]
    # EUR bills of the last hundred days at the feed's rate, older ones at the base rate
    want = sum((200 + i) * (1 if i % 2 == 0 else 1.5 if 5 * i + 1 <= 100 else 1.1) for i in range(120))
    assert revenue == round(want)
    assert publish.read(spark, cfg.out_dir, "freshness").first()[0] == TODAY
    assert any(p.startswith("month=") for p in os.listdir(f"{cfg.table_dir}/shipments"))


def test_a_bad_load_fails_after_publishing(spark, frames, table, tmp_path):
    bad = frames["shipments"].union(frames["shipments"].limit(1).replace("S0", "SX").withColumn("ata", frames["shipments"].atd - 1))
    write(f"{tmp_path}/csv", {**frames, "shipments": bad.select(*frames["shipments"].columns)})
    cfg = config(tmp_path, only=("executive_kpis", "freshness"))
    with pytest.raises(QualityGateError, match="time travel"):
        job.run(spark, cfg)
    assert publish.read(spark, cfg.out_dir, "executive_kpis").count() > 0
    assert {r.mart for r in publish.catalogue(spark, cfg.out_dir).collect()} == {
        "data_quality", "declared_constraints", "executive_kpis", "freshness"}
    assert publish.read(spark, cfg.out_dir, "freshness").first()[1] == "no cache"


def page(*rows):
    return json.dumps({"features": [{"attributes": dict(date=str(d), portid=p, portname="n", portcalls_container=n)} for d, p, n in rows]})


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_raw_feeds_merge_by_key_and_keep_older_days(spark, frames, tmp_path):
    write(f"{tmp_path}/csv", frames)
    ports = tmp_path / "ports"
    put(tmp_path, "codes.csv", "portwatch_id,port_code\nport1,CNSHA\n")
    d1, d2, d3 = (TODAY - dt.timedelta(days=n) for n in (70, 3, 2))
    put(ports, "page1.json", page((d1, "port1", 1), (d2, "port1", 2), (d2, "other", 9)))
    put(tmp_path / "fx", "a.json", json.dumps({"rates": {ago(100): {"EUR": 0.5, "USD": 1.0}}}))
    bank = [dict(exchangedate=dt.date.fromisoformat(ago(100)).strftime("%d.%m.%Y"), rate=0.25, rate_per_unit=None)]
    put(tmp_path / "bank", "a.json", json.dumps(bank))
    cfg = config(
        tmp_path, raw={"port_activity_daily": str(ports), "fx_rates": str(tmp_path / "fx")},
        codes={"port_activity_daily": str(tmp_path / "codes.csv")}, banks={"EUR": str(tmp_path / "bank")},
        only=("load_profile", "revenue_total"))
    first = job.run(spark, cfg)
    assert {r.mart: r.row_count for r in first.collect()}["load_profile"] == 3
    # the next feed no longer carries the oldest day; within it the later row and the later file win
    cfg.raw["port_activity_daily"] = str(tmp_path / "ports2")
    put(tmp_path / "ports2", "page1.json", page((d2, "port1", 5), (d2, "port1", 6), (d3, "port1", 7)))
    put(tmp_path / "ports2", "page2.json", page((d3, "port1", 8)))
    job.run(spark, cfg)
    stored = tables.stored_table(spark, cfg.table_dir, "port_activity_daily")
    assert sorted((r.activity_date, r.portcalls_container) for r in stored.collect()) == [(d1, 1), (d2, 6), (d3, 8)]
    profile = {r.table_name: r for r in publish.read(spark, cfg.out_dir, "load_profile").collect()}
    assert profile["port_activity_daily"].row_count == 3 and profile["port_activity_daily"].first_date == d1
    assert profile["fx_rates"].currency_list == "EUR, USD" and profile["chokepoint_transits_daily"].row_count == 0
    # the bank's list beats the rate map: 1 / 0.25 from a hundred days ago on
    want = sum((200 + i) * (1 if i % 2 == 0 else 4 if 5 * i + 1 <= 100 else 1.1) for i in range(120))
    assert publish.read(spark, cfg.out_dir, "revenue_total").first()[0] == round(want)


def test_a_broken_key_fails_the_gate(spark, frames, tmp_path):
    twice = frames["customers"].union(frames["customers"].limit(1))
    write(f"{tmp_path}/csv", {**frames, "customers": twice})
    with pytest.raises(QualityGateError, match="customers, unique: customer_id: 1"):
        job.run(spark, config(tmp_path, only=("freshness",)))


def test_the_last_line_of_a_csv_feed_wins(spark, frames, table, tmp_path):
    write(f"{tmp_path}/csv", frames)
    lines = ["rate_date,currency,rate_to_usd", f"{ago(9)},EUR,2.0", f"{ago(9)},EUR,3.0"]
    put(tmp_path, "fx.csv", "\n".join(lines) + "\n")
    cfg = config(tmp_path, feeds={"fx_rates": str(tmp_path / "fx.csv")})
    rates = job.load(spark, cfg)["fx_rates"].where(f"rate_date = DATE'{ago(9)}'").collect()
    assert [float(r.rate_to_usd) for r in rates] == [3.0]


def test_broken_pages_and_feeds_do_not_stop_a_run(spark, frames, tmp_path):
    write(f"{tmp_path}/csv", frames)
    put(tmp_path, "codes.csv", "portwatch_id,port_code\nport1,CNSHA\n")
    put(tmp_path, "straits.csv", "portwatch_id,chokepoint_code\nchokepoint1,SUEZ\n")
    days = [TODAY - dt.timedelta(days=n) for n in range(10)]
    for n, d in enumerate(days):
        text = page((d, "port1", n)) if n != 4 else page((d, "port1", n))[:-7]
        put(tmp_path / "ports", f"page{n}.json", text)
    put(tmp_path / "ports", "page_error.json", json.dumps({"error": "busy"}))
    put(tmp_path / "fx", "a.json", json.dumps({"rates": {ago(100): {"EUR": 0.5}}}))
    put(tmp_path / "fx", "b.json", "<html>down</html>")
    cfg = config(
        tmp_path, raw={"port_activity_daily": str(tmp_path / "ports"), "fx_rates": str(tmp_path / "fx"),
                       "chokepoint_transits_daily": str(tmp_path / "not_there")},
        codes={"port_activity_daily": str(tmp_path / "codes.csv"), "chokepoint_transits_daily": str(tmp_path / "straits.csv")},
        only=("quarantine", "revenue_total"))
    job.run(spark, cfg)
    stored = tables.stored_table(spark, cfg.table_dir, "port_activity_daily")
    assert {r.activity_date for r in stored.collect()} == {d for n, d in enumerate(days) if n != 4}
    left = {(r.feed, r.file, r.reason[:12]) for r in publish.read(spark, cfg.out_dir, "quarantine").collect()}
    assert left == {
        ("port_activity_daily", "page4.json", "not the decl"), ("port_activity_daily", "page_error.json", "no features"),
        ("fx_rates", "b.json", "not the decl"), ("chokepoint_transits_daily", None, "[PATH_NOT_FO")}
    want = sum((200 + i) * (1 if i % 2 == 0 else 2 if 5 * i + 1 <= 100 else 1.1) for i in range(120))
    assert publish.read(spark, cfg.out_dir, "revenue_total").first()[0] == round(want)


def test_a_merge_that_fails_half_way_changes_nothing(spark, table, tmp_path, monkeypatch):
    def feed(*rows):
        return table("port_activity_daily", [dict(activity_date=d, port_code="CNSHA", portwatch_id="x", portcalls_container=n) for d, n in rows])

    def stored():
        rows = tables.stored_table(spark, str(tmp_path), "port_activity_daily").collect()
        return sorted((str(r.activity_date), r.portcalls_container, r.month) for r in rows)

    merge = lambda *rows: tables.merge_table(spark, feed(*rows), str(tmp_path), "port_activity_daily", "activity_date")
    merge(("2025-01-30", 1), ("2025-02-01", 2))
    before = [("2025-01-30", 1, "2025-01"), ("2025-02-01", 2, "2025-02")]
    assert stored() == before
    reader = tables.stored_table(spark, str(tmp_path), "port_activity_daily")

    def stopped(*_):
        raise RuntimeError("lost between the two writes")

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", stopped)
        with pytest.raises(RuntimeError):
            merge(("2025-02-01", 9), ("2025-03-01", 3))
    assert stored() == before
    # a manifest begun and not finished does not count either
    put(tmp_path / "port_activity_daily" / "_manifests" / "000002", "part-0.parquet", "half")
    assert stored() == before
    merge(("2025-02-01", 5), ("2025-03-01", 3))
    assert stored() == [before[0], ("2025-02-01", 5, "2025-02"), ("2025-03-01", 3, "2025-03")]
    assert reader.count() == 2  # a reader of the old state is not disturbed
    root = f"{tmp_path}/port_activity_daily"
    assert manifest.numbers(spark, root) == [1, 3]
    assert len(manifest.unnamed(spark, root, "version=*", "version", keep=1)) == 1  # the failed merge's
    assert tables.read_table(spark, str(tmp_path), "port_activity_daily").count() == 3


def test_a_table_without_manifest_is_taken_over(spark, table, tmp_path):
    rows = [dict(activity_date=d, port_code="CNSHA", portwatch_id="x", portcalls_container=1) for d in ("2025-01-30", "2025-02-01")]
    tables.write_table(table("port_activity_daily", rows), f"{tmp_path}/port_activity_daily", "activity_date")
    new = table("port_activity_daily", [{**rows[0], "portcalls_container": 7}])
    out = tables.merge_table(spark, new, str(tmp_path), "port_activity_daily", "activity_date")
    assert sorted(r.portcalls_container for r in out.collect()) == [1, 7]


def test_a_failing_mart_leaves_the_last_run(spark, tmp_path):
    out = str(tmp_path)
    first = {"a": ("A", lambda: spark.range(3)), "b": ("B", lambda: spark.range(4))}
    publish.publish(spark, first, out)

    def fails():
        raise ValueError("no such column")

    with pytest.raises(ValueError):
        publish.publish(spark, {"a": ("A", lambda: spark.range(30)), "b": ("B", fails)}, out)
    assert publish.read(spark, out, "a").count() == 3
    publish.publish(spark, {"a": ("A", lambda: spark.range(30))}, out)
    assert publish.read(spark, out, "a").count() == 30
    with pytest.raises(KeyError):
        publish.read(spark, out, "b")
    assert publish.catalogue(spark, f"{out}/none").count() == 0


def test_profile_lists_up_to_its_limit(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, i % 9 + 1), f"c{i % 5}") for i in range(50)] + [(None, None)], "day date, code string")
    assert tables.profile(df, "day", "code", limit=5).first() == (51, dt.date(2025, 1, 1), dt.date(2025, 1, 9), "c0, c1, c2, c3, c4")
    with pytest.raises(Exception, match="more than 4 distinct values of code"):
        tables.profile(df, "day", "code", limit=4).collect()
