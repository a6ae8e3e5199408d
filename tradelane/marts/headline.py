"""One row of plain facts drawn from the other marts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.functions.num import pct, whole
from tradelane.marts import finance, network, operations

Tables = dict[str, DataFrame]


def _month_number():
    """Whole number that grows with a ``yyyy-MM`` label (the earlier of two peaks wins)."""
    return F.replace(F.col("month"), F.lit("-")).cast("int")


def headline_facts(
    t: Tables,
    as_of: dt.date | None = None,
    consignments: DataFrame | None = None,
) -> DataFrame:
    """``consignments``: what invoices refer to, where that is not ``t["shipments"]``."""
    peak = operations.monthly_volume(t).agg(
        F.max_by("month", F.struct("shipments", F.negate(_month_number()))).alias("peak_month"),
        F.max("shipments").alias("peak_shipments"),
    )
    # one row per region, the last for bills of no known port: few rows, which give both facts
    billing = finance.billing_by_region(
        {**t, "shipments": t["shipments"] if consignments is None else consignments}
    )
    usd = F.when(F.col("region").isNotNull(), whole(F.col("billed")))
    money = billing.agg(
        F.max_by("region", F.when(usd.isNotNull(), F.struct(usd, "region"))).alias("top_region"),
        pct(F.max(usd), F.sum(usd), 0).alias("top_region_pct"),
        pct(whole(F.sum("overdue")), whole(F.sum("open")), 0).alias("overdue_pct"),
    )
    ports = t["ports"].select("port_code", "port_name").join(network.port_tonnage(t, as_of), "port_code", "left")
    live = (F.col("kt_day") != 0) & F.col("yoy").isNotNull()
    # equal changes: the port with more tonnage, as in the ordered port table
    trends = ports.agg(
        F.max_by("port_name", F.when(live, F.struct("yoy", "kt_day", "port_code"))).alias("up_port"),
        F.max(F.when(live, F.col("yoy"))).alias("up_pct"),
        F.min_by("port_name", F.when(live, F.struct("yoy", F.negate("kt_day"), "port_code"))).alias("down_port"),
        F.min(F.when(live, F.col("yoy"))).alias("down_pct"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(F.col("kt_day") == 0, F.col("port_name")))), ", "
        ).alias("idle_ports"),
    )
    # three one-row results: stacked, then each column has a single value
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [peak, money, trends])
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])
