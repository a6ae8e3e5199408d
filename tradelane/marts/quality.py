"""The data-quality suite of the freight tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelane.operators import quality
from tradelane.operators.quality import CRITICAL, WARNING

Tables = dict[str, DataFrame]

# Check names.
TIME_TRAVEL = "01 · Shipments with ATA before ATD (time travel)"
NO_ARRIVAL = "02 · Delivered shipments missing arrival date"
ORPHAN_EVENTS = "03 · Orphan events (no parent shipment)"
ORPHAN_INVOICES = "04 · Orphan invoices (no parent shipment)"
EARLY_PAYMENT = "05 · Invoices paid before they were issued"
UNKNOWN_PORTS = "06 · Shipments referencing unknown ports"
NON_POSITIVE = "07 · Non-positive volumes or amounts"
NO_FIXING = "08 · Currency codes without an FX fixing"
BILLED_TWICE = "09 · Shipments billed more than once (review)"
EARLY_BOOKING = "10 · Bookings dated before customer onboarding"
UNKNOWN_LANE_PORTS = "11 · Chokepoint lanes referencing unknown ports"


def _with_ports(lanes: DataFrame, ports: DataFrame) -> DataFrame:
    """Adds ``unknown``: whether either end of the lane is not a known port."""
    known = ports.select("port_code", F.lit(True).alias("known"))
    origin = known.toDF("origin_port", "_o")
    dest = known.toDF("dest_port", "_d")
    return (
        lanes.join(origin, "origin_port", "left")
        .join(dest, "dest_port", "left")
        .withColumn("unknown", F.col("_o").isNull() | F.col("_d").isNull())
    )


def data_quality(t: Tables) -> DataFrame:
    shipments, invoices, ports = t["shipments"], t["invoices"], t["ports"]

    def hits(condition: Column, out: str) -> Column:
        return F.count(F.when(condition, 1)).alias(out)

    # every check on shipment rows comes from one pass: counted per lane, so that
    # ports meet lanes, and per customer and day, so that customers meet days
    by_lane, by_day = ["origin_port", "dest_port"], ["customer_id", "booked_date"]
    counted = shipments.groupingSets([by_lane, by_day], *by_lane, *by_day).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("n"),
        hits(F.col("ata") < F.col("atd"), "time_travel"),
        hits((F.col("status") == "DELIVERED") & F.col("ata").isNull(), "no_arrival"),
        hits((F.col("volume_cbm") <= 0) | (F.col("freight_amount") <= 0), "non_positive"),
    )
    lane = F.col("_set") == 0b0011
    early = F.col("booked_date") < F.col("onboarded_date")
    on_shipments = quality.stacked(
        _with_ports(counted, ports).join(
            t["customers"].select("customer_id", "onboarded_date"), "customer_id", "left"
        ),
        [
            (TIME_TRAVEL, CRITICAL, F.sum(F.when(lane, F.col("time_travel")))),
            (NO_ARRIVAL, CRITICAL, F.sum(F.when(lane, F.col("no_arrival")))),
            (NON_POSITIVE, CRITICAL, F.sum(F.when(lane, F.col("non_positive")))),
            (UNKNOWN_PORTS, CRITICAL, F.sum(F.when(lane & F.col("unknown"), F.col("n")))),
            (EARLY_BOOKING, WARNING, F.sum(F.when(~lane & early, F.col("n")))),
        ],
    )
    # invoices and events are counted per shipment and meet the shipments together
    known = shipments.select("shipment_id").distinct().withColumn("known", F.lit(True))
    billed = invoices.groupBy("shipment_id").agg(
        F.count("*").alias("bills"), hits(F.col("paid_date") < F.col("issue_date"), "early")
    )
    events = t["shipment_events"].groupBy("shipment_id").agg(F.count("*").alias("events"))
    children = billed.unionByName(events, allowMissingColumns=True).join(
        known, "shipment_id", "left"
    )
    lost = F.col("known").isNull()
    on_children = quality.stacked(
        children,
        [
            (ORPHAN_EVENTS, CRITICAL, F.sum(F.when(lost, F.col("events")))),
            (ORPHAN_INVOICES, CRITICAL, F.sum(F.when(lost, F.col("bills")))),
            (EARLY_PAYMENT, CRITICAL, F.sum("early")),
            (BILLED_TWICE, WARNING, F.count(F.when(F.col("bills") > 1, 1))),
        ],
    )
    currencies = quality.orphans(invoices, "currency", t["fx_rates"], "currency")
    bridge = _with_ports(t["lane_chokepoints"], ports)
    return quality.union(
        [
            on_shipments,
            on_children,
            quality.total(currencies, NO_FIXING, WARNING, F.count("*")),
            quality.total(
                bridge, UNKNOWN_LANE_PORTS, CRITICAL, F.count(F.when(F.col("unknown"), 1))
            ),
        ]
    ).orderBy("severity", "check_name")
