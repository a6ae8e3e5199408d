"""Shipment volume, service level, stage durations, anomalies, cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.functions.dates import (
    days_between,
    hours_crossed,
    latest,
    month_label,
    quarter_label,
    quarter_start,
    quarters_crossed,
    shift,
)
from tradelane.functions.num import change_pct, det_round, pct, ratio
from tradelane.operators import stats
from tradelane.operators.paths import ARROW
from tradelane.operators.sequence import with_previous
from tradelane.session import materialize

Tables = dict[str, DataFrame]

ON_TIME_TOLERANCE_DAYS = 2
ACTIVE_DAYS = 180


def arrived() -> Column:
    return F.col("ata").isNotNull()


def on_time(tolerance: int = ON_TIME_TOLERANCE_DAYS) -> Column:
    return F.col("ata") <= F.date_add("eta", tolerance)


def _service_level(tolerance: int) -> list[Column]:
    # a row without eta or atd has no verdict, as AVG over NULL would have it
    return [
        F.count(F.when(arrived(), F.lit(1))).alias("_arrived"),
        F.count(F.when(on_time(tolerance), F.lit(1))).alias("_on_time"),
        F.sum(F.when(arrived(), F.datediff("ata", "atd"))).alias("_days"),
        F.count(F.when(arrived(), F.datediff("ata", "atd"))).alias("_timed"),
    ]


def _on_time_pct() -> Column:
    return pct(F.col("_on_time"), F.col("_arrived"))


def _avg_transit() -> Column:
    return det_round(ratio(F.col("_days"), F.col("_timed")), 1)


def monthly(shipments: DataFrame, tolerance: int = ON_TIME_TOLERANCE_DAYS) -> DataFrame:
    """One row per booking month."""
    return (
        shipments.groupBy(F.trunc("booked_date", "month").alias("month"))
        .agg(
            F.count("*").alias("shipments"),
            F.round(F.sum("volume_cbm"), 1).alias("total_cbm"),
            F.count_distinct("customer_id").alias("active_customers"),
            *_service_level(tolerance),
        )
    )


def executive_kpis(t: Tables, tolerance: int = ON_TIME_TOLERANCE_DAYS) -> DataFrame:
    by_month = Window.orderBy("month")  # one row per month
    before = F.lag("shipments").over(by_month)
    last3 = by_month.rowsBetween(-2, 0)
    return (
        monthly(t["shipments"], tolerance)
        .select(
            F.col("month").alias("_m"),
            month_label(F.col("month")).alias("month"),
            "shipments",
            (F.col("shipments") - before).alias("mom_change"),
            change_pct(F.col("shipments"), before).alias("mom_growth_pct"),
            F.col("total_cbm").cast("double").alias("total_cbm"),
            F.sum("total_cbm").over(by_month).cast("double").alias("cumulative_cbm"),
            det_round(
                ratio(F.sum("shipments").over(last3), F.count("shipments").over(last3)), 1
            ).alias("shipments_3mo_avg"),
            "active_customers",
            _on_time_pct().alias("on_time_pct"),
            _avg_transit().alias("avg_transit_days"),
        )
        .orderBy("_m")
        .drop("_m")
    )


def yearly_growth(t: Tables, months_back: int = 12) -> DataFrame:
    """Month against the same month a year ago; months without bookings count as 0."""
    counts = (
        t["shipments"]
        .groupBy(F.trunc("booked_date", "month").alias("month"))
        .agg(F.count("*").alias("n"))
        .where(F.col("month").isNotNull())
    )
    span = counts.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    calendar = span.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    dense = calendar.join(counts, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).cast("bigint").alias("shipments")
    )
    ago = F.lag("shipments", months_back).over(Window.orderBy("month"))
    return (
        dense.select(
            F.col("month").alias("_m"),
            month_label(F.col("month")).alias("month"),
            "shipments",
            ago.alias("shipments_year_ago"),
            change_pct(F.col("shipments"), ago).alias("yoy_growth_pct"),
        )
        .orderBy("_m")
        .drop("_m")
    )


def transit_bottlenecks(t: Tables, min_observations: int = 40, top: int | None = 15) -> DataFrame:
    events = t["shipment_events"].select(
        "shipment_id", "event_id", "event_type", "event_time", "location"
    )
    pairs = with_previous(
        events,
        ["shipment_id"],
        ["event_time", "event_id"],
        {"event_type": "prev_event", "event_time": "prev_time"},
        F.date_trunc("minute", "event_time"),
    )
    gaps = pairs.select(
        F.concat("prev_event", F.lit(ARROW), "event_type").alias("stage"),
        "location",
        hours_crossed(F.col("prev_time"), F.col("event_time")).alias("hours"),
    ).where(F.col("stage").isNotNull() & (F.col("hours") >= 0))
    # whole hours: count each length once, then take quantiles over the counts
    counts = stats.value_counts(gaps, ["stage", "location"], "hours")
    shape = counts.groupBy("stage", "location").agg(
        F.sum("n").alias("observations"),
        F.percentile("hours", F.lit(0.5), F.col("n")).alias("_median"),
        F.percentile("hours", F.lit(0.9), F.col("n")).alias("_p90"),
        F.max("hours").alias("_max"),
    )
    result = shape.where(F.col("observations") >= min_observations).select(
        "stage",
        "location",
        "observations",
        det_round(F.col("_median") / 24.0, 2).alias("median_days"),
        det_round(F.col("_p90") / 24.0, 2).alias("p90_days"),
        det_round(F.col("_max").cast("double") / 24.0, 1).alias("worst_case_days"),
        det_round(ratio(F.col("_p90"), F.col("_median")), 1).alias("p90_to_median_ratio"),
    )
    ordered = result.orderBy(F.desc("p90_days"), "stage", "location")
    return ordered if top is None else ordered.limit(top)


def lane_text() -> Column:
    return F.concat("origin_port", F.lit(ARROW), "dest_port")


def _delivered(t: Tables) -> DataFrame:
    return (
        t["shipments"]
        .where(F.col("status") == "DELIVERED")
        .select(
            "shipment_id",
            "origin_port",
            "dest_port",
            days_between(F.col("atd"), F.col("ata")).alias("actual_days"),
            days_between(F.col("eta"), F.col("ata")).alias("days_late_vs_eta"),
        )
    )


LANE = ["origin_port", "dest_port"]


def _z() -> Column:
    return ratio(F.col("actual_days") - F.col("mean"), F.col("std"))


def transit_anomalies(
    t: Tables,
    z_threshold: float = 2.0,
    severe: float = 3.0,
    min_shipments: int = 30,
    top: int | None = 20,
) -> DataFrame:
    delivered = _delivered(t)
    counts = stats.value_counts(delivered, LANE, "actual_days")
    # written out so that the planner sees its true size when joining it back
    lanes = materialize(
        stats.mean_and_spread(counts, LANE, "actual_days").where(
            F.col("lane_n") >= min_shipments
        ),
        "lane-stats",
    )
    result = (
        delivered.join(lanes, LANE)
        .withColumn("_z", _z())
        .where(F.col("_z") > z_threshold)
        .select(
            "shipment_id",
            lane_text().alias("lane"),
            "actual_days",
            det_round(F.col("mean"), 1).alias("lane_avg_days"),
            det_round(F.col("_z"), 2).alias("z_score"),
            "days_late_vs_eta",
            # fixed values: severity labels
            F.when(F.col("_z") > severe, "🔴 investigate")
            .otherwise("🟡 monitor")
            .alias("severity"),
        )
    )
    ordered = result.orderBy(F.desc("z_score"), "lane", "shipment_id", "days_late_vs_eta")
    return ordered if top is None else ordered.limit(top)


# Fixed value: makes the MAD comparable with a standard deviation
# (Iglewicz and Hoaglin, 1993).
MAD_SCALE = 0.6745


def robust_anomalies(
    t: Tables,
    z_threshold: float = 3.5,
    min_shipments: int = 30,
    top: int | None = None,
) -> DataFrame:
    """Median/MAD score beside the classic one, worst first."""
    delivered = _delivered(t).where(F.col("actual_days").isNotNull())
    counts = materialize(stats.value_counts(delivered, LANE, "actual_days"), "lane-days")
    lanes = materialize(
        stats.median_and_mad(counts, LANE, "actual_days")
        .where(F.col("lane_n") >= min_shipments)
        .drop("lane_n")
        .join(stats.mean_and_spread(counts, LANE, "actual_days"), LANE),
        "lane-robust",
    )
    score = F.lit(MAD_SCALE) * (F.col("actual_days") - F.col("median"))
    result = (
        delivered.join(lanes, LANE)
        .withColumn("_rz", score / F.nullif(F.col("mad"), F.lit(0.0)))
        .where(F.col("_rz") > z_threshold)
        .select(
            "shipment_id",
            lane_text().alias("lane"),
            "actual_days",
            det_round(F.col("median"), 1).alias("lane_median_days"),
            det_round(F.col("_rz"), 2).alias("robust_z"),
            det_round(_z(), 2).alias("classic_z"),
            "days_late_vs_eta",
        )
    )
    ordered = result.orderBy(F.desc("robust_z"), "lane", "shipment_id", "days_late_vs_eta")
    return ordered if top is None else ordered.limit(top)


def cohort_retention(t: Tables, quarters: int = 6) -> DataFrame:
    cohorts = t["customers"].select(
        "customer_id", quarter_start(F.col("onboarded_date")).alias("cohort_q")
    )
    active = (
        t["shipments"]
        .select("customer_id", quarter_start(F.col("booked_date")).alias("active_q"))
        .distinct()
    )
    # a customer is active once per quarter, so counting rows counts customers
    matrix = (
        cohorts.join(active, "customer_id")
        .where(F.col("active_q") >= F.col("cohort_q"))
        .withColumn("since", quarters_crossed(F.col("cohort_q"), F.col("active_q")))
        .groupBy("cohort_q")
        .agg(*[F.count(F.when(F.col("since") == q, 1)).alias(f"n{q}") for q in range(quarters + 1)])
    )
    size = cohorts.groupBy("cohort_q").agg(F.count("*").alias("size"))

    def seen(q: int) -> Column:  # NULL where a cohort has no such quarter
        return F.nullif(F.col(f"n{q}"), F.lit(0).cast("bigint"))

    return (
        matrix.join(size, "cohort_q")
        .select(
            F.col("cohort_q").alias("_q"),
            quarter_label(F.col("cohort_q")).alias("cohort"),
            "size",
            seen(0).alias("q0"),
            *[pct(seen(q), F.col("size"), 0).alias(f"q{q}_pct") for q in range(1, quarters + 1)],
        )
        .orderBy("_q")
        .drop("_q")
    )


def kpi_strip(
    t: Tables,
    tolerance: int = ON_TIME_TOLERANCE_DAYS,
    as_of: dt.date | None = None,
    active_days: int = ACTIVE_DAYS,
) -> DataFrame:
    shipments = t["shipments"]
    as_of = as_of or latest(shipments, "booked_date")
    recent = F.col("booked_date") > shift(as_of, -active_days)
    return shipments.agg(
        F.count("*").alias("shipments"),
        F.count_distinct(F.when(recent, F.col("customer_id"))).alias("customers"),
        *_service_level(tolerance),
    ).select(
        "shipments",
        "customers",
        _on_time_pct().alias("on_time_pct"),
        _avg_transit().alias("avg_transit"),
    )


def monthly_volume(t: Tables) -> DataFrame:
    """Shipments per booking month; from ``t["lane_daily"]``, if there is one, without reading the facts."""
    daily = t.get("lane_daily")
    rows, n = (t["shipments"], F.count("*")) if daily is None else (daily, F.sum("n"))
    return (
        rows.groupBy(month_label(F.col("booked_date")).alias("month"))
        .agg(n.alias("shipments"))
        .orderBy("month")
    )


def monthly_on_time(t: Tables, tolerance: int = ON_TIME_TOLERANCE_DAYS) -> DataFrame:
    return (
        t["shipments"]
        .groupBy(month_label(F.col("booked_date")).alias("month"))
        .agg(*_service_level(tolerance))
        .select("month", _on_time_pct().alias("on_time_pct"))
        .orderBy("month")
    )


def busiest_lanes(t: Tables, top: int = 10) -> DataFrame:
    return (
        t["shipments"]
        .groupBy("origin_port", "dest_port")
        .agg(F.count("*").alias("shipments"))
        .orderBy(F.desc("shipments"), "origin_port", "dest_port")
        .limit(top)
    )
