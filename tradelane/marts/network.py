"""Routes, port and strait trends, exposure of the booked volume to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelane.functions.dates import after, day, days_before, latest
from tradelane.functions.num import (
    as_double,
    change_pct,
    det_round,
    pct,
    ratio,
    raw_change_pct,
    whole,
)
from tradelane.operators import paths, rank, trend
from tradelane.schemas import PORT_RISK
from tradelane.session import materialize

Tables = dict[str, DataFrame]

BOOK_DAYS = 180
NO_DATA = "no real data"

# Signal labels.
SHORT_BASELINE = "baseline too short"
FEED_ANOMALY = "?  feed anomaly — verify source"
DECLINING = "!! declining traffic"
SOFTENING = "!  softening"
SURGING = "▲ surging (congestion watch)"
DATA_GAP = "data gap — verify feed"
COLLAPSING = "!! transits collapsing — re-route risk"
FALLING = "!  transits falling"
RISING = "▲ transits rising"
STABLE = "stable"


def _edges(t: Tables) -> DataFrame:
    return t["shipping_routes"].select(
        F.col("origin_port").alias("origin"),
        F.col("dest_port").alias("dest"),
        "mode",
        F.col("transit_days").alias("days"),
        F.col("cost_per_cbm").alias("cost"),
    )


def route_paths(
    t: Tables, origin: str, targets: list[str] | DataFrame, max_legs: int = 3
) -> DataFrame:
    spark = t["shipping_routes"].sparkSession
    source = spark.createDataFrame([(origin,)], "node string")
    if not isinstance(targets, DataFrame):
        targets = spark.createDataFrame([(x,) for x in targets], "node string")
    return paths.expand(_edges(t), source, targets, max_legs)


def route_pathfinding(
    t: Tables,
    origin: str = "UAODS",
    targets: list[str] | DataFrame | tuple = ("CNSHA",),
    max_legs: int = 3,
    top: int | None = 12,
) -> DataFrame:
    """Routes with their place among all routes by cost and by days; the ``top`` cheapest, or all."""
    if isinstance(targets, tuple):
        targets = list(targets)
    options = materialize(route_paths(t, origin, targets, max_legs), "paths")
    order = [as_double("cost"), "days", paths.path_text("path"), paths.path_text("modes", " / ")]
    if top is None:
        ranked = rank.rank(rank.rank(options, "cost", "cost_rank"), "days", "speed_rank")
    else:
        ranked = _among(options, options.orderBy(*order).limit(top))
    return ranked.orderBy(*order).select(
        paths.path_text("path").alias("routing"),
        "legs",
        paths.path_text("modes", " / ").alias("modes"),
        F.col("days").alias("transit_days"),
        as_double("cost").alias("cost_per_cbm_usd"),
        "cost_rank",
        "speed_rank",
    )


def _among(options: DataFrame, kept: DataFrame) -> DataFrame:
    """A few ``kept`` options with their ranks: what is cheaper or faster is counted in one pass."""
    rows = kept.collect()  # the top of a report
    values = {c: sorted({r[c] for r in rows}) for c in ("cost", "days")}
    below = [F.count_if(F.col(c) < F.lit(v)).alias(f"{c}_{i}") for c, vs in values.items() for i, v in enumerate(vs)]
    found = options.agg(*below).first() if rows else {}
    ranks = {(c, v): found[f"{c}_{i}"] + 1 for c, vs in values.items() for i, v in enumerate(vs)}
    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in ("cost_rank", "speed_rank"))])
    return options.sparkSession.createDataFrame([(*r, ranks["cost", r.cost], ranks["days", r.days]) for r in rows], schema)


def _tons() -> Column:
    return F.col("import_total_tons") + F.col("export_total_tons")


def port_trend(t: Tables, as_of: dt.date | None = None) -> tuple[DataFrame, dt.date]:
    activity = t["port_activity_daily"]
    as_of = as_of or latest(activity, "activity_date")
    measures = {"calls": F.col("portcalls_container"), "tons": _tons()}
    return (
        trend.period_over_period(activity, "port_code", "activity_date", as_of, measures),
        as_of,
    )


def port_activity(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    w, anchor = port_trend(t, as_of)
    return (
        w.join(t["ports"].select("port_code", "port_name", "region"), "port_code")
        .select(
            "port_name",
            "region",
            day(anchor).alias("data_through"),
            F.col("days_cur").alias("days_observed"),
            det_round(ratio(F.col("calls_cur"), F.col("days_cur")), 1).alias("ctr_calls_per_day"),
            change_pct(F.col("calls_cur"), F.col("calls_prev")).alias("ctr_calls_yoy_pct"),
            det_round(
                ratio(F.col("tons_cur"), F.col("days_cur")) / F.lit(1000.0), 1
            ).alias("cargo_kt_per_day"),
            change_pct(F.col("tons_cur"), F.col("tons_prev")).alias("cargo_yoy_pct"),
        )
        .orderBy(F.desc_nulls_last("cargo_yoy_pct"), "port_name")
    )


def lane_book(t: Tables, as_of: dt.date | None = None, days: int = BOOK_DAYS) -> DataFrame:
    """Shipments and volume per lane over the last ``days`` booking days.

    ``t["lane_daily"]`` (see :func:`daily_lanes`) is used when present, so
    several exposure marts share one pass over the shipments.
    """
    daily = t.get("lane_daily")
    if daily is None:
        as_of = as_of or latest(t["shipments"], "booked_date")
        daily = daily_lanes(after(t["shipments"], "booked_date", days_before(as_of, days)))
    else:
        as_of = as_of or latest(daily, "booked_date")
    return (
        after(daily, "booked_date", days_before(as_of, days))
        .groupBy("origin_port", "dest_port")
        .agg(F.sum("n").alias("n"), F.sum("cbm").alias("cbm"))
    )


def daily_lanes(shipments: DataFrame, *extra: Column) -> DataFrame:
    """Shipments per lane and booking day: count, volume and any extra aggregates."""
    return shipments.groupBy("origin_port", "dest_port", "booked_date").agg(
        F.count("*").alias("n"), F.sum("volume_cbm").alias("cbm"), *extra
    )


def port_book(t: Tables, as_of: dt.date | None = None, days: int = BOOK_DAYS) -> DataFrame:
    """The lane book seen from both ends of each lane."""
    return (
        lane_book(t, as_of, days)
        .select(F.explode(F.array("origin_port", "dest_port")).alias("port_code"), "n", "cbm")
        .groupBy("port_code")
        .agg(F.sum("n").alias("shipments_180d"), F.sum("cbm").alias("cbm"))
    )


def port_signal(calls_cur: Column, calls_prev: Column, tons_cur: Column, tons_prev: Column) -> Column:
    calls = raw_change_pct(calls_cur, calls_prev)
    tons = raw_change_pct(tons_cur, tons_prev)
    return trend.signal(
        [
            (calls_cur.isNull(), NO_DATA),
            (calls_prev.isNull() | (calls_prev == 0), SHORT_BASELINE),
            # calls collapse while tonnage holds: the feed, not the port
            ((calls < -60) & (tons > -20), FEED_ANOMALY),
            (calls < -10, DECLINING),
            (calls < -3, SOFTENING),
            (calls > 10, SURGING),
        ],
        STABLE,
    )


def network_exposure(
    t: Tables, as_of: dt.date | None = None, book_as_of: dt.date | None = None
) -> DataFrame:
    w, _ = port_trend(t, as_of)
    everything = Window.orderBy(F.lit(1)).rowsBetween(  # one row per port
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return (
        port_book(t, book_as_of)
        .join(t["ports"].select("port_code", "port_name", "region"), "port_code")
        .join(w, "port_code", "left")
        .orderBy(F.desc("cbm"), "port_code")
        .select(
            "port_name",
            "region",
            "shipments_180d",
            whole(F.col("cbm")).alias("cbm_180d"),
            pct(F.col("cbm"), F.sum("cbm").over(everything)).alias("share_of_book_pct"),
            change_pct(F.col("calls_cur"), F.col("calls_prev")).alias("real_calls_yoy_pct"),
            port_signal(
                F.col("calls_cur"), F.col("calls_prev"), F.col("tons_cur"), F.col("tons_prev")
            ).alias("real_world_signal"),
        )
    )


def strait_signal(days_cur: Column, cur: Column, prev: Column, min_days: int = 60) -> Column:
    change = raw_change_pct(cur, prev)
    return trend.signal(
        [
            (cur.isNull(), NO_DATA),
            (prev.isNull() | (prev == 0), SHORT_BASELINE),
            (days_cur < min_days, DATA_GAP),
            (change < -25, COLLAPSING),
            (change < -8, FALLING),
            (change > 8, RISING),
        ],
        STABLE,
    )


def _strait_exposure(t: Tables, as_of: dt.date | None, book_as_of: dt.date | None) -> DataFrame:
    book = materialize(lane_book(t, book_as_of), "lane-book")  # at most one row per lane
    transits = t["chokepoint_transits_daily"]
    as_of = as_of or latest(transits, "transit_date")
    w = trend.period_over_period(
        transits, "chokepoint_code", "transit_date", as_of, {"n": F.col("n_container")},
        keys=t["chokepoints"],
    )
    total = book.agg(F.sum("cbm").alias("cbm")).first()["cbm"]
    exposure = (
        book.join(t["lane_chokepoints"], ["origin_port", "dest_port"])
        .groupBy("chokepoint_code")
        .agg(
            F.count_distinct(F.struct("origin_port", "dest_port")).alias("lanes"),
            F.sum("n").alias("shipments_180d"),
            F.sum("cbm").alias("cbm"),
        )
    )
    return (
        exposure.join(t["chokepoints"].select("chokepoint_code", "chokepoint_name"), "chokepoint_code")
        .join(w, "chokepoint_code", "left")
        .withColumn("share_of_book_pct", pct(F.col("cbm"), F.lit(total)))
        .withColumn("transits_yoy_pct", change_pct(F.col("n_cur"), F.col("n_prev")))
    )


def chokepoint_exposure(
    t: Tables, as_of: dt.date | None = None, book_as_of: dt.date | None = None
) -> DataFrame:
    return (
        _strait_exposure(t, as_of, book_as_of)
        .orderBy(F.desc("cbm"), "chokepoint_code")
        .select(
            F.col("chokepoint_name").alias("chokepoint"),
            "lanes",
            "shipments_180d",
            whole(F.col("cbm")).alias("cbm_180d"),
            "share_of_book_pct",
            det_round(ratio(F.col("n_cur"), F.col("days_cur")), 1).alias("transits_per_day"),
            "transits_yoy_pct",
            strait_signal(F.col("days_cur"), F.col("n_cur"), F.col("n_prev")).alias(
                "real_world_signal"
            ),
        )
    )


def chokepoint_compact(
    t: Tables, as_of: dt.date | None = None, book_as_of: dt.date | None = None
) -> DataFrame:
    return (
        _strait_exposure(t, as_of, book_as_of)
        .orderBy(F.desc("cbm"), "chokepoint_code")
        .select(
            F.col("chokepoint_name").alias("chokepoint"), "share_of_book_pct", "transits_yoy_pct"
        )
    )


def congestion_days(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Buffer days per gateway port from its container-call trend."""
    w, _ = port_trend(t, as_of)
    change = raw_change_pct(F.col("calls_cur"), F.col("calls_prev"))
    return w.select(
        "port_code",
        F.when(change < -10, 3).when(change < -3, 1).otherwise(0).alias("penalty_days"),
    )


def gateways(t: Tables, port_risk: dict[str, float] | None = None, as_of: dt.date | None = None) -> DataFrame:
    """What lies behind each gateway, one row per inland leg: days and cost with delay and risk put in."""
    spark = t["inland_legs"].sparkSession
    risk = spark.createDataFrame(
        list((PORT_RISK if port_risk is None else port_risk).items()), "gateway string, risk double"
    ).withColumn("risk", F.col("risk").cast("decimal(8,2)"))
    buffer = F.coalesce("penalty_days", F.lit(0)).cast("bigint")
    return (
        t["inland_legs"]
        .select(F.col("from_port").alias("gateway"), "dest_city", F.col("mode").alias("inland_mode"), "transit_days", "cost_per_cbm")
        .join(risk, "gateway", "left")
        .join(congestion_days(t, as_of).withColumnRenamed("port_code", "gateway"), "gateway", "left")
        .select(
            "gateway", "dest_city", "inland_mode", buffer.alias("buffer"), (F.col("transit_days") + buffer).alias("more_days"),
            "cost_per_cbm", F.coalesce("risk", F.lit(0)).alias("risk"),
        )
    )


def _door_to_door(
    t: Tables,
    port_risk: dict[str, float] | None = None,
    day_value: float = 1.5,
    origin_dwell: int = 2,
    transship_dwell: int = 3,
    max_legs: int = 3,
    top: int = 3,
    as_of: dt.date | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """The ``top`` options per request, by value, with their paths.

    Paths are cut off as soon as they cannot be among the best any more; everything behind the
    gateway is one small table, written first so that its size is known.
    """
    requests = t["route_requests"]
    behind = materialize(
        gateways(t, port_risk, as_of).join(requests.select("dest_city").distinct(), "dest_city", "left_semi"), "gateways"
    )
    legs = paths.best(
        _edges(t),
        requests.select(F.col("origin_port").alias("origin"), F.col("dest_city").alias("goal")),
        behind.select(
            F.col("gateway").alias("node"), F.col("dest_city").alias("goal"), F.col("more_days").alias("days"),
            (F.col("cost_per_cbm") + F.col("risk")).alias("cost"),
        ),
        top,
        day_value,
        max_legs,
        origin_dwell,
        transship_dwell,
        names,
    ).withColumnsRenamed({"origin": "origin_port", "dest": "gateway", "goal": "dest_city"})
    options = (
        requests.join(legs, ["origin_port", "dest_city"])
        .join(behind, ["gateway", "dest_city"])
        .withColumn("total_days", F.col("days") + F.col("more_days"))
        .withColumn("usd", F.col("cost") + F.col("cost_per_cbm") + F.col("risk"))
        .withColumn("value", as_double("usd") + F.col("total_days") * F.lit(day_value))
        .withColumn("text", paths.path_text("path"))
    )
    best = Window.partitionBy("origin_port", "dest_city").orderBy(
        "value", "text", "inland_mode", "total_days", "usd"
    )
    chosen = options.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return chosen.orderBy("origin_port", "dest_city", "rank")


def door_to_door_routing(t: Tables, port_risk: dict[str, float] | None = None, **params) -> DataFrame:
    """Best door-to-door options per request; parameters as in :func:`_door_to_door`."""
    return _door_to_door(t, port_risk, **params).select(
        F.concat("origin_port", F.lit(paths.ARROW), "dest_city").alias("request"),
        F.col("rank").cast("bigint").alias("rank"),
        F.concat("text", F.lit(" ⇒ "), "dest_city").alias("route"),
        "gateway",
        "inland_mode",
        "total_days",
        det_round(as_double("usd"), 1).alias("usd_per_cbm"),
        F.col("buffer").alias("real_data_buffer_d"),
        det_round(F.col("value"), 1).alias("score"),
    )


def named_routes(t: Tables, **params) -> DataFrame:
    """The chosen door-to-door routes with port names instead of codes."""
    names = t["ports"].select(F.col("port_code").alias("node"), F.col("port_name").alias("name"))
    return _door_to_door(t, names=names, **params).select(
        F.concat(F.get("names", F.lit(0)), F.lit(paths.ARROW), "dest_city").alias("request"),
        F.col("rank").cast("bigint").alias("rank"),
        F.concat(paths.path_text("names"), F.lit(" ⇒ "), "dest_city").alias("route"),
        F.col("inland_mode").alias("mode"),
        F.col("total_days").alias("days"),
        det_round(as_double("usd"), 1).alias("usd"),
    )


def port_tonnage(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Ports of the feed with kt/day over the fixed window length and the change on the year before."""
    w, _ = port_trend(t, as_of)
    return w.select(
        "port_code",
        det_round(
            as_double("tons_cur") / F.lit(float(trend.WINDOW_DAYS)) / F.lit(1000.0), 1
        ).alias("kt_day"),
        change_pct(F.col("tons_cur"), F.col("tons_prev")).alias("yoy"),
    )


def port_table(
    t: Tables, as_of: dt.date | None = None, book_as_of: dt.date | None = None
) -> DataFrame:
    """All ports with 180-day volume and tonnage."""
    return (
        t["ports"]
        .select("port_code", "port_name", "country", "region")
        .join(port_book(t, book_as_of), "port_code", "left")
        .join(port_tonnage(t, as_of), "port_code", "left")
        .select(
            "port_code",
            "port_name",
            "country",
            "region",
            as_double("cbm").alias("cbm180"),
            "kt_day",
            "yoy",
        )
        .orderBy(F.desc_nulls_last("kt_day"), "port_code")
    )


def weekly_tonnage(t: Tables, as_of: dt.date | None = None, days: int = 182) -> DataFrame:
    """Tonnage per port and ISO week, oldest first."""
    activity = t["port_activity_daily"]
    as_of = as_of or latest(activity, "activity_date")
    return (
        after(activity, "activity_date", days_before(as_of, days))
        .groupBy("port_code", F.trunc("activity_date", "week").alias("week"))
        .agg(F.coalesce(F.sum(_tons()), F.lit(0)).cast("bigint").alias("tons"))
    )


def weekly_series(t: Tables, as_of: dt.date | None = None, days: int = 182) -> DataFrame:
    """One ordered list per port; a list holds one entry per week of the window."""
    return (
        weekly_tonnage(t, as_of, days)
        .groupBy("port_code")
        .agg(F.array_sort(F.collect_list(F.struct("week", "tons"))).alias("s"))
        .select(
            "port_code",
            F.size("s").cast("bigint").alias("weeks"),
            F.array_join(F.transform("s", lambda x: x["tons"].cast("string")), ",").alias("series"),
        )
        .orderBy("port_code")
    )


def port_legend(t: Tables) -> DataFrame:
    return t["ports"].select("port_code", "port_name", "country").orderBy("port_name")
