import datetime as dt

import pytest

from tests.conftest import day, got
from tradelane.marts import network
from tradelane.schemas import lookup_tables

END = day("2026-07-17")


def feed(code, cur_calls, prev_calls, tons_cur=1000, tons_prev=1000, days=90):
    rows = []
    for n in range(days):
        for back, calls, tons in ((n, cur_calls, tons_cur), (n + 365, prev_calls, tons_prev)):
            if calls is not None:
                rows.append(dict(activity_date=END - dt.timedelta(days=back), port_code=code, portwatch_id="x",
                                 portcalls_container=calls, import_total_tons=tons, export_total_tons=0))
    return rows


@pytest.fixture(scope="module")
def activity(table):
    rows = feed("CNSHA", 20, 20) + feed("UAODS", 0, 0, 0, 0) + feed("PLGDN", 94, 100) + feed("DEHAM", 98, 100)
    rows += feed("AEJEA", 10, 100, 1000, 1000) + feed("NLRTM", 80, 100, 3000, 2000)
    return table("port_activity_daily", rows)


@pytest.fixture(scope="module")
def ships(table):
    def ship(i, a, b, booked, volume):
        return dict(shipment_id=f"S{i}", customer_id=1, origin_port=a, dest_port=b, booked_date=booked, volume_cbm=volume)

    return table("shipments", [
        ship(1, "CNSHA", "NLRTM", "2026-06-30", 60), ship(2, "CNSHA", "NLRTM", "2026-01-02", 20),
        ship(3, "CNSHA", "NLRTM", "2026-01-01", 999),  # 180 days back: out
        ship(4, "USNYC", "BRSSZ", "2026-05-01", 20), ship(5, "AEJEA", "UAODS", "2026-05-01", 100)])


@pytest.fixture(scope="module")
def t(spark, ports, activity, ships, table):
    transits = [dict(transit_date=END - dt.timedelta(days=n + back), chokepoint_code=c, n_container=k)
                for n in range(90) for c, back, k in (("SUEZ", 0, 9), ("SUEZ", 365, 10), ("DOVER", 0, 7), ("MALACC", 365, 5))]
    transits += [dict(transit_date=END - dt.timedelta(days=n + back), chokepoint_code="BOSPOR", n_container=5)
                 for n in range(50) for back in (0, 365)]
    return {**lookup_tables(spark), "ports": ports, "port_activity_daily": activity, "shipments": ships,
            "chokepoint_transits_daily": table("chokepoint_transits_daily", transits)}


def test_port_activity(t):
    out = {r.port_name: r for r in network.port_activity(t).collect()}
    assert out["Rotterdam"].ctr_calls_yoy_pct == -20.0 and out["Rotterdam"].cargo_yoy_pct == 50.0
    assert out["Rotterdam"].ctr_calls_per_day == 80.0 and out["Rotterdam"].cargo_kt_per_day == 3.0
    assert out["Odesa"].ctr_calls_yoy_pct is None and out["Odesa"].data_through == END
    assert list(out)[-1] == "Odesa" and list(out)[0] == "Rotterdam"  # no baseline sorts last


def test_network_exposure(t):
    out = got(network.network_exposure(t))
    assert [r[0] for r in out] == ["Jebel Ali", "Odesa", "Shanghai", "Rotterdam", "Santos", "New York"]
    rows = {r[0]: r[1:] for r in out}
    assert rows["Shanghai"] == ("Asia", 2, 80, 20.0, 0.0, network.STABLE)
    assert rows["Rotterdam"][4:] == (-20.0, network.DECLINING)
    assert rows["Jebel Ali"][4:] == (-90.0, network.FEED_ANOMALY)
    assert rows["Odesa"][4:] == (None, network.SHORT_BASELINE)
    assert rows["New York"][4:] == (None, network.NO_DATA)


def test_a_shared_lane_summary_gives_the_same_book(t):
    daily = network.daily_lanes(t["shipments"])
    assert got(network.network_exposure({**t, "lane_daily": daily})) == got(network.network_exposure(t))


def test_chokepoint_exposure(t):
    out = {r[0]: tuple(r)[1:] for r in got(network.chokepoint_exposure(t))}
    # book 200: both lanes pass Suez (180), only Shanghai-Rotterdam passes Dover and Malacca
    assert out["Suez Canal"] == (2, 3, 180, 90.0, 9.0, -10.0, network.FALLING)
    assert out["Dover Strait"] == (1, 2, 80, 40.0, 7.0, None, network.SHORT_BASELINE)
    assert out["Malacca Strait"][-1] == network.NO_DATA
    assert out["Bosporus Strait"][-1] == network.DATA_GAP
    assert "Oresund Strait" not in out
    compact = {r[0]: tuple(r)[1:] for r in got(network.chokepoint_compact(t))}
    assert compact == {k: (v[3], v[5]) for k, v in out.items()}


def test_port_table_keeps_every_port(t):
    out = {r.port_code: r for r in network.port_table(t).collect()}
    assert len(out) == 16
    assert out["NLRTM"].kt_day == 3.0 and out["NLRTM"].cbm180 == 80.0
    assert out["BRSSZ"].cbm180 == 20.0 and out["BRSSZ"].kt_day is None
    assert out["UAODS"].kt_day == 0.0 and out["UAODS"].yoy is None


def test_weekly_series(t):
    out = {r.port_code: r for r in network.weekly_series(t).collect()}
    tons = [int(x) for x in out["CNSHA"].series.split(",")]
    assert sum(tons) == 90 * 1000 and out["CNSHA"].weeks == len(tons) == 14
    assert tons[-1] == 5000  # 2026-07-17 is a Friday


@pytest.fixture(scope="module")
def door(t, routes, table):
    legs = [("UAODS", "Poltava", "truck", 2, 27), ("UAODS", "Kyiv", "truck", 2, 22),
            ("PLGDN", "Poltava", "truck", 4, 62), ("PLGDN", "Kyiv", "truck", 3, 50),
            ("PLGDN", "Kyiv", "rail", 6, 36), ("PLGDN", "Poltava", "rail", 7, 44),
            ("DEHAM", "Poltava", "truck", 5, 78), ("DEHAM", "Kyiv", "truck", 4, 66)]
    inland = table("inland_legs", [dict(from_port=a, dest_city=b, mode=c, transit_days=d, cost_per_cbm=e, distance_km=1)
                                   for a, b, c, d, e in legs])
    return {**t, "shipping_routes": routes, "inland_legs": inland}


def test_door_to_door(door):
    out = got(network.door_to_door_routing(door))
    best = {r[0]: r for r in out if r[1] == 1}
    # leg days, inland days, two days at the origin and three at each change; leg costs, inland leg, the gateway's risk
    assert best == {
        "CNSHA → Kyiv": ("CNSHA → Kyiv", 1, "CNSHA → EGALY → UAODS ⇒ Kyiv", "UAODS", "truck",
                         15 + 6 + 2 + 2 + 3, 50.0 + 25 + 22 + 12, 0, 151.0),
        "CNSHA → Poltava": ("CNSHA → Poltava", 1, "CNSHA → EGALY → UAODS ⇒ Poltava", "UAODS", "truck",
                            15 + 6 + 2 + 2 + 3, 50.0 + 25 + 27 + 12, 0, 156.0),
        "CNSZX → Poltava": ("CNSZX → Poltava", 1, "CNSZX → CNSHA → EGALY → UAODS ⇒ Poltava", "UAODS", "truck",
                            2 + 15 + 6 + 2 + 2 + 3 + 3, 10.0 + 50 + 25 + 27 + 12, 0, 173.5),
    }
    assert {r[3] for r in out} == {"UAODS", "PLGDN"}


def test_named_routes(door):
    out = got(network.named_routes(door))
    assert out[0] == ("Shanghai → Kyiv", 1, "Shanghai → Alexandria → Odesa ⇒ Kyiv", "truck", 28, 109.0)


def test_legend(t):
    assert got(network.port_legend(t))[0] == ("EGALY", "Alexandria", "Egypt")
