"""Freight tables derived from the supplied star schema.

A line item is a shipment from the supplier's nation to the customer's nation,
an order is an invoice, an order priority is a currency.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradelane.functions.dates import latest
from tradelane.functions.num import money
from tradelane.marts.network import daily_lanes
from tradelane.session import materialize

_SCHEMAS: dict[str, StructType] = {}


class Bound:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:  # footers are read once per table
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # -- dimensions ---------------------------------------------------------

    @staticmethod
    def port_code(key: str):
        return F.concat(F.lit("N"), F.lpad(F.col(key).cast("string"), 2, "0"))

    @cached_property
    def ports(self) -> DataFrame:
        return (
            self.raw("nation")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                self.port_code("n_nationkey").alias("port_code"),
                F.col("n_name").alias("port_name"),
                F.concat(F.lit("COUNTRY_"), F.col("n_nationkey").cast("string")).alias("country"),
                F.col("r_name").alias("region"),
                F.col("n_nationkey").alias("nation"),
            )
        )

    @cached_property
    def _first_orders(self) -> DataFrame:
        return (
            self.raw("orders")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.to_date(F.min("o_orderdate")).alias("onboarded_date"))
        )

    def customers(self, onboarded: bool = False, delay: int = 0) -> DataFrame:
        df = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("industry"),
        )
        if not onboarded:
            return df
        firsts = self._first_orders.withColumn(
            "onboarded_date", F.date_add("onboarded_date", delay)
        )
        return df.join(firsts, "customer_id", "left")

    # -- facts --------------------------------------------------------------

    def shipments(self, lanes: bool = True, raw_arrival: bool = False) -> DataFrame:
        """Line items as shipments. Ports are joined in only when asked for.

        All lookups are left joins on unique keys, so leaving one out changes
        columns but never rows.
        """
        orders = self.raw("orders").select(
            "o_orderkey",
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("booked_date"),
            F.col("o_orderpriority").alias("currency"),
        )
        df = self.raw("lineitem").join(
            orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )
        if lanes:
            origin = self.raw("supplier").select(
                "s_suppkey", self.port_code("s_nationkey").alias("origin_port")
            )
            dest = self.raw("customer").select(
                "c_custkey", self.port_code("c_nationkey").alias("dest_port")
            )
            df = df.join(origin, F.col("l_suppkey") == F.col("s_suppkey"), "left").join(
                dest, F.col("customer_id") == F.col("c_custkey"), "left"
            )
        shipped = F.to_date("l_shipdate")
        done = shipped >= F.col("booked_date")
        arrival = shipped if raw_arrival else F.when(done, shipped)
        return df.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("shipment_id"),
            F.col("l_orderkey").alias("order_id"),
            "customer_id",
            *(["origin_port", "dest_port"] if lanes else []),
            money("l_quantity", 8).alias("volume_cbm"),
            "booked_date",
            F.col("booked_date").alias("atd"),
            F.date_add("booked_date", 365).alias("eta"),
            arrival.alias("ata"),
            F.when(done, "DELIVERED").otherwise("IN_TRANSIT").alias("status"),
            money("l_extendedprice").alias("freight_amount"),
            "currency",
        )

    @cached_property
    def consignments(self) -> DataFrame:
        """One row per order: what an invoice refers to."""
        dest = self.raw("customer").select(
            F.col("c_custkey").alias("o_custkey"), self.port_code("c_nationkey").alias("origin_port")
        )
        return (
            self.raw("orders")
            .join(dest, "o_custkey", "left")
            .select(F.col("o_orderkey").alias("shipment_id"), "origin_port")
        )

    @cached_property
    def invoices(self) -> DataFrame:
        key = F.col("o_orderkey")
        issue = F.to_date("o_orderdate")
        due = F.date_add(issue, (F.lit(14) * (key % 3 + 1)).cast("int"))
        return self.raw("orders").select(
            key.alias("invoice_id"),
            key.alias("shipment_id"),
            F.col("o_custkey").alias("customer_id"),
            money("o_totalprice").alias("amount"),
            F.col("o_orderpriority").alias("currency"),
            issue.alias("issue_date"),
            due.alias("due_date"),
            F.when(
                F.col("o_orderstatus") != "O", F.date_add(due, (key % 21 - 7).cast("int"))
            ).alias("paid_date"),
        )

    @cached_property
    def billing_lines(self) -> DataFrame:
        """Line items as invoices whose (shipment, amount) repeat."""
        return (
            self.raw("lineitem")
            .join(
                self.raw("orders").select(
                    "o_orderkey",
                    F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("issue_date"),
                ),
                F.col("l_orderkey") == F.col("o_orderkey"),
            )
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                    "invoice_id"
                ),
                F.col("l_orderkey").alias("shipment_id"),
                "customer_id",
                money("l_linenumber").alias("amount"),
                "issue_date",
            )
        )

    @cached_property
    def fx(self) -> DataFrame:
        """Sparse fixings; a small table, written once like any stored rate table.

        Every order counts, on the last of the days 1, 8, 15 and 22 at or before its own.
        """
        date = F.to_date("o_orderdate")
        number = F.dayofmonth(date)
        back = (F.least(number, F.lit(28)) - 1) % 7 + F.greatest(number - 28, F.lit(0))
        day = F.date_sub(date, back)
        rates = (
            self.raw("orders")
            .groupBy(day.alias("rate_date"), F.col("o_orderpriority").alias("currency"))
            .agg(F.min("o_orderkey").alias("k"))
            .select(
                "rate_date",
                "currency",
                (F.lit(1) + (F.col("k") % 100) / F.lit(1000.0))
                .cast("decimal(10,6)")
                .alias("rate_to_usd"),
            )
        )
        return materialize(rates, "fx")

    @cached_property
    def milestones(self) -> DataFrame:
        where = self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("location")
        )
        return (
            self.raw("events")
            .join(where, "user_id", "left")
            .select(
                "event_id",
                F.col("user_id").alias("shipment_id"),
                "event_type",
                F.col("ts").alias("event_time"),
                "location",
            )
        )

    # -- daily summaries and the graph ---------------------------------------

    @cached_property
    def lane_daily(self) -> DataFrame:
        """Lanes by booking day: one pass over the shipments serves every summary."""
        daily = daily_lanes(
            self.shipments(),
            F.min(F.datediff("ata", "atd")).alias("fastest"),
            F.min("freight_amount").alias("cheapest"),
        )
        return materialize(daily, "lane-daily")

    @cached_property
    def last_day(self) -> dt.date:
        return latest(self.lane_daily, "booked_date")

    @cached_property
    def activity(self) -> DataFrame:
        """Arrivals per port and day; from the lane summary where that exists already."""
        if "lane_daily" in self.__dict__:
            arrivals, n, cbm = self.lane_daily, F.sum("n"), F.sum("cbm")
        else:
            arrivals, n, cbm = self.shipments(), F.count("*"), F.sum("volume_cbm")
        daily = (
            arrivals.groupBy(
                F.col("booked_date").alias("activity_date"), F.col("dest_port").alias("port_code")
            )
            .agg(n.alias("n"), cbm.alias("cbm"))
            .select(
                "activity_date",
                "port_code",
                F.col("n").alias("portcalls_container"),
                F.col("cbm").cast("bigint").alias("import_total_tons"),
                F.col("n").alias("export_total_tons"),
            )
        )
        return materialize(daily, "activity")

    @cached_property
    def transits(self) -> DataFrame:
        return (
            self.activity.join(self.ports, "port_code")
            .groupBy(
                F.col("activity_date").alias("transit_date"),
                F.col("region").alias("chokepoint_code"),
            )
            .agg(F.sum("portcalls_container").alias("n_container"))
        )

    @cached_property
    def chokepoints(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_name").alias("chokepoint_code"),
            F.concat(F.col("r_name"), F.lit(" passage")).alias("chokepoint_name"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        """Booked lanes between two regions pass both regions' straits."""
        region = self.ports.select("port_code", "region")
        lanes = self.lane_daily.select("origin_port", "dest_port").distinct()
        return (
            lanes.join(region.toDF("origin_port", "r1"), "origin_port")
            .join(region.toDF("dest_port", "r2"), "dest_port")
            .where(F.col("r1") != F.col("r2"))
            .select(
                "origin_port", "dest_port", F.explode(F.array("r1", "r2")).alias("chokepoint_code")
            )
        )

    @cached_property
    def routes(self) -> DataFrame:
        """One edge per booked lane with a known arrival: its fastest days and lowest freight."""
        if "lane_daily" in self.__dict__:
            rows, days, cost = self.lane_daily, F.col("fastest"), F.col("cheapest")
        else:
            rows, days, cost = self.shipments(), F.datediff("ata", "atd"), F.col("freight_amount")
        lanes = (
            rows.groupBy("origin_port", "dest_port")
            .agg(F.min(days).alias("transit_days"), F.min(cost).alias("cost_per_cbm"))
            .where(
                (F.col("origin_port") != F.col("dest_port")) & F.col("transit_days").isNotNull()
            )
        )
        edges = lanes.select(
            "origin_port",
            "dest_port",
            F.when(F.col("transit_days") % 2 == 0, "sea").otherwise("rail").alias("mode"),
            F.col("transit_days").cast("bigint").alias("transit_days"),
            "cost_per_cbm",
        )
        return materialize(edges, "routes")

    @cached_property
    def requests(self) -> DataFrame:
        """Every nation asks for a way to every region it ships to."""
        region = self.ports.select(
            F.col("port_code").alias("dest_port"), F.col("region").alias("dest_city")
        )
        return (
            self.lane_daily.select("origin_port", "dest_port")
            .distinct()
            .join(region, "dest_port")
            .select("origin_port", "dest_city")
            .distinct()
        )

    @cached_property
    def inland(self) -> DataFrame:
        n = F.col("nation")
        return self.ports.select(
            F.col("port_code").alias("from_port"),
            F.col("region").alias("dest_city"),
            F.when(n % 2 == 1, "truck").otherwise("rail").alias("mode"),
            (n % 5 + 1).cast("bigint").alias("transit_days"),
            (n + 10).cast("decimal(8,2)").alias("cost_per_cbm"),
        )

    # -- table sets -----------------------------------------------------------

    def booking(self, lanes: bool = False) -> dict[str, DataFrame]:
        return {"shipments": self.shipments(lanes)}

    def billing(self) -> dict[str, DataFrame]:
        return {
            "invoices": self.invoices,
            "fx_rates": self.fx,
            "customers": self.customers(),
            "shipments": self.consignments,
            "ports": self.ports,
        }

    def network(self) -> dict[str, DataFrame]:
        return {
            "lane_daily": self.lane_daily,
            "ports": self.ports,
            "port_activity_daily": self.activity,
        }

    def straits(self) -> dict[str, DataFrame]:
        return {
            **self.network(),
            "chokepoints": self.chokepoints,
            "lane_chokepoints": self.bridge,
            "chokepoint_transits_daily": self.transits,
        }

    def routing(self) -> dict[str, DataFrame]:
        return {
            **self.network(),
            "shipping_routes": self.routes,
            "inland_legs": self.inland,
            "route_requests": self.requests,
        }
