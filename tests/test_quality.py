import re

import pytest

from tests.conftest import got
from tradelane.marts import quality as suite
from tradelane.operators import quality
from tradelane.schemas import TABLES, Table

GOOD_SHIP = dict(shipment_id="S1", customer_id=1, origin_port="CNSHA", dest_port="NLRTM", volume_cbm=1,
                 booked_date="2025-01-02", atd="2025-01-03", ata="2025-01-20", status="DELIVERED",
                 freight_amount=10, currency="USD")
GOOD_INVOICE = dict(invoice_id="I1", shipment_id="S1", customer_id=1, amount=5, currency="USD",
                    issue_date="2025-01-02", due_date="2025-02-02", paid_date="2025-01-02")
GOOD_EVENT = dict(event_id=1, shipment_id="S1", event_type="BOOKED", event_time="2025-01-02T00:00:00", location="X")


@pytest.fixture(scope="module")
def clean(table, ports):
    return {
        "ports": ports,
        "customers": table("customers", [dict(customer_id=1, onboarded_date="2025-01-01")]),
        "shipments": table("shipments", [GOOD_SHIP]),
        "shipment_events": table("shipment_events", [GOOD_EVENT]),
        "invoices": table("invoices", [GOOD_INVOICE]),
        "fx_rates": table("fx_rates", [dict(rate_date="2025-01-01", currency="USD", rate_to_usd=1)]),
        "lane_chokepoints": table("lane_chokepoints", [dict(origin_port="CNSHA", dest_port="NLRTM", chokepoint_code="SUEZ")]),
    }


def counts(t):
    return {r.check_name[:2]: r.violations for r in suite.data_quality(t).collect()}


def test_clean_tables_have_no_violations(clean):
    out = suite.data_quality(clean).collect()
    assert len(out) == 11 and all(r.violations == 0 for r in out)
    keys = [(r.severity, r.check_name) for r in out]
    assert keys == sorted(keys)
    quality.gate(suite.data_quality(clean))


def ship(**change):
    return ("shipments", [GOOD_SHIP, {**GOOD_SHIP, "shipment_id": "S2", **change}])


def invoice(**change):
    return ("invoices", [GOOD_INVOICE, {**GOOD_INVOICE, "invoice_id": "I2", "shipment_id": "S1", **change}])


@pytest.mark.parametrize("check, broken, also", [
    ("01", ship(ata="2025-01-02"), {}),
    ("02", ship(ata=None), {}),
    ("03", ("shipment_events", [GOOD_EVENT] + [{**GOOD_EVENT, "event_id": i, "shipment_id": "S9"} for i in (2, 3)]), {"03": 2}),
    ("04", invoice(shipment_id="S9"), {}),
    ("05", invoice(paid_date="2025-01-01"), {"09": 1}),
    ("06", ship(origin_port="NOPE"), {}),
    ("06", ship(dest_port="NOPE"), {}),
    ("07", ship(volume_cbm=0), {}),
    ("07", ship(freight_amount=-1), {}),
    ("08", invoice(currency="GBP"), {"09": 1}),
    ("09", invoice(), {}),
    ("10", ship(booked_date="2024-12-31"), {}),
    ("11", ("lane_chokepoints", [dict(origin_port="CNSHA", dest_port="NOPE", chokepoint_code="SUEZ")]), {}),
])
def test_each_check_finds_its_violation(clean, table, check, broken, also):
    name, rows = broken
    out = counts({**clean, name: table(name, rows)})
    assert out == {**{k: 0 for k in out}, check: 1, **also}


def test_gate_raises_on_critical_and_ignores_warnings(clean, table):
    quality.gate(suite.data_quality({**clean, "invoices": table(*invoice())}))
    with pytest.raises(quality.QualityGateError, match="time travel"):
        quality.gate(suite.data_quality({**clean, "shipments": table(*ship(ata="2025-01-02"))}))


def test_declared_constraints(spark, table, ports, routes):
    bad = table("shipping_routes", [
        dict(route_id=1, origin_port="CNSHA", dest_port="NLRTM", mode="sea", transit_days=1, cost_per_cbm=1),
        dict(route_id=1, origin_port="CNSHA", dest_port="NOPE", mode="air", transit_days=0, cost_per_cbm=0),
        dict(route_id=1, origin_port=None, dest_port="NLRTM", mode="rail", transit_days=2, cost_per_cbm=1),
    ])
    out = {r.constraint_name: r.violations for r in
           quality.declared({"ports": ports, "shipping_routes": bad}, TABLES).collect()}
    assert out["unique: route_id"] == 2 and out["not null: origin_port"] == 1
    assert out["reference: dest_port -> ports"] == 1 and out["reference: origin_port -> ports"] == 0
    assert out["check: mode"] == out["check: transit_days"] == out["check: cost_per_cbm"] == 1
    good = quality.declared({"ports": ports, "shipping_routes": routes}, TABLES)
    assert good.where("violations > 0").count() == 0


def test_null_orphans_are_counted(spark):
    child = spark.createDataFrame([(1,), (None,), (None,), (7,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(got(quality.orphans(child, "k", parent, "k")), key=str) == [(7, 1), (None, 2)]


def test_a_check_without_rows_is_zero(spark):
    spec = {"t": Table("", key=("k",), checks={"pos": "k > 0"})}
    out = quality.declared({"t": spark.createDataFrame([], "k int")}, spec)
    assert {r.violations for r in out.collect()} == {0}


def test_declared_reads_each_table_once_and_has_one_exchange_of_keys(spark):
    specs = {
        "child": Table("", key=("a", "b"), required=("p",), references={"p": ("parent", "k"), "q": ("parent", "k")},
                       checks={"a": "a > 0"}),
        "parent": Table("", key=("k",)),
    }
    child = [(1, "1:2", 5, 7), (1, "1:2", 5, None), (11, ":2", 5, 8), (1, None, None, 7), (1, None, 9, 7), (0, "", 5, 7)]
    frames = {
        "child": spark.createDataFrame(child, "a int, b string, p int, q int").repartition(2),
        "parent": spark.createDataFrame([(5,), (7,), (7,), (None,)], "k bigint").repartition(2),  # another type
    }
    out = quality.declared(frames, specs)
    got_ = {(r.table_name, r.constraint_name): r.violations for r in out.collect()}
    assert got_ == {
        ("child", "not null: a"): 0, ("child", "not null: b"): 2, ("child", "not null: p"): 1, ("child", "check: a"): 1,
        ("child", "unique: a, b"): 2, ("child", "reference: p -> parent"): 1, ("child", "reference: q -> parent"): 1,
        ("parent", "not null: k"): 1, ("parent", "unique: k"): 1,
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 2  # one reading a table
    physical = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    # keys, then one total per constraint
    assert len(re.findall(r"hashpartitioning\(_no#\d+, _key", physical)) == 1 and physical.count("hashpartitioning(") == 2
    assert "SortMergeJoin" not in physical
