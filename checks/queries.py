"""Every operator and mart over the supplied tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import params as P
from checks.bindings import Bound
from tradelane.functions.dates import hours_crossed, quarters_crossed
from tradelane.functions.num import det_round, money
from tradelane.marts import finance, headline, network, operations, quality
from tradelane.operators import asof, paths, rank, screening, sequence, stats
from tradelane.operators import quality as quality_ops
from tradelane.schemas import Table
from tradelane.session import new_path
from tradelane.sources import feeds, merge, publish, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RFM_DAY = dt.date.fromisoformat(P.RFM_DAY)
RISK = {P.RISK_PORT: P.RISK_USD}


def query(build: Callable[[Bound], DataFrame]) -> Callable[[Bound], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Bound(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# -- analytical marts ----------------------------------------------------------


@query
def m01_executive_kpis(b: Bound) -> DataFrame:
    return operations.executive_kpis(b.booking())


@query
def m02_route_pathfinding(b: Bound) -> DataFrame:
    region = b.raw("region").where(F.col("r_regionkey") == 2).select(F.col("r_name").alias("region"))
    targets = b.ports.join(region, "region").select(F.col("port_code").alias("node"))
    return network.route_pathfinding({"shipping_routes": b.routes}, "N00", targets)


@query
def m03_transit_bottlenecks(b: Bound) -> DataFrame:
    return operations.transit_bottlenecks({"shipment_events": b.milestones})


@query
def m04_customer_segmentation(b: Bound) -> DataFrame:
    t = {"shipments": b.shipments(lanes=False), "fx_rates": b.fx, "customers": b.customers()}
    return finance.customer_segmentation(t, RFM_DAY)


@query
def m05_cohort_retention(b: Bound) -> DataFrame:
    return operations.cohort_retention(
        {"customers": b.customers(onboarded=True), "shipments": b.shipments(lanes=False)}
    )


@query
def m06_fx_normalized_revenue(b: Bound) -> DataFrame:
    return finance.fx_normalized_revenue(b.billing())


@query
def m07_receivables_aging(b: Bound) -> DataFrame:
    return finance.receivables_aging(b.billing(), dt.date.fromisoformat(P.AGING_DAY))


@query
def v4_receivables_aging_anchored(b: Bound) -> DataFrame:
    return finance.receivables_aging(b.billing())


@query
def m07b_payment_discipline(b: Bound) -> DataFrame:
    return finance.payment_discipline(b.billing())


@query
def m08_transit_anomalies(b: Bound) -> DataFrame:
    return operations.transit_anomalies(b.booking(lanes=True))


@query
def v2_robust_anomalies(b: Bound) -> DataFrame:
    return operations.robust_anomalies(b.booking(lanes=True), z_threshold=P.ROBUST_Z)


@query
def m09_aml_screening(b: Bound) -> DataFrame:
    bills = {"invoices": b.invoices.withColumn("invoice_id", F.col("invoice_id").cast("string"))}
    customers = {"customers": b.customers()}
    return finance.aml_screening(
        {**bills, **customers}, {"invoices": b.billing_lines, **customers}, **P.AML
    )


@query
def v3_aml_normalized(b: Bound) -> DataFrame:
    return finance.structuring_normalized(b.billing(), **P.AML_USD)


def _quality(b: Bound) -> DataFrame:
    def lost(key: str, column: str, value: str):
        hit = F.col(key) % P.LOST_EVERY == 0
        return F.when(hit, F.lit(value)).otherwise(F.col(column))

    shipments = (
        b.shipments(raw_arrival=True)
        .withColumn("dest_port", lost("order_id", "dest_port", P.LOST_PORT))
        .withColumn("shipment_id", F.col("order_id"))
    )
    lane_end = F.when(F.col("dest_port") == P.LAST_PORT, P.LOST_PORT).otherwise(F.col("dest_port"))
    return quality.data_quality(
        {
            "shipments": shipments,
            "invoices": b.invoices.withColumn(
                "currency", lost("invoice_id", "currency", P.LOST_CURRENCY)
            ),
            "shipment_events": b.milestones,
            "ports": b.ports,
            "fx_rates": b.fx,
            "customers": b.customers(onboarded=True, delay=30),
            "lane_chokepoints": b.bridge.withColumn("dest_port", lane_end),
        }
    )


@query
def m10_data_quality(b: Bound) -> DataFrame:
    return _quality(b)


@query
def m11_port_activity(b: Bound) -> DataFrame:
    return network.port_activity({"ports": b.ports, "port_activity_daily": b.activity})


@query
def m12_network_exposure(b: Bound) -> DataFrame:
    return network.network_exposure(b.network(), b.last_day, b.last_day)


@query
def m13_chokepoint_exposure(b: Bound) -> DataFrame:
    return network.chokepoint_exposure(b.straits(), b.last_day, b.last_day)


@query
def m14_door_to_door_routing(b: Bound) -> DataFrame:
    return network.door_to_door_routing(b.routing(), RISK, as_of=b.last_day)


@query
def v1_yearly_growth(b: Bound) -> DataFrame:
    return operations.yearly_growth(b.booking())


# -- dashboard marts -----------------------------------------------------------


@query
def d01_kpi_strip(b: Bound) -> DataFrame:
    return operations.kpi_strip(b.booking())


@query
def d02_revenue_total(b: Bound) -> DataFrame:
    return finance.revenue_total(b.billing())


@query
def d03_receivables_kpi(b: Bound) -> DataFrame:
    return finance.receivables_kpi(b.billing())


@query
def d04_monthly_volume(b: Bound) -> DataFrame:
    return operations.monthly_volume(b.booking())


@query
def d05_revenue_by_region(b: Bound) -> DataFrame:
    return finance.revenue_by_region(b.billing())


@query
def d06_port_table(b: Bound) -> DataFrame:
    return network.port_table(b.network(), b.last_day, b.last_day)


@query
def d07_weekly_series(b: Bound) -> DataFrame:
    return network.weekly_series({"port_activity_daily": b.activity})


@query
def d08_aging_dashboard(b: Bound) -> DataFrame:
    return finance.aging_dashboard(b.billing())


@query
def d09_chokepoint_compact(b: Bound) -> DataFrame:
    return network.chokepoint_compact(b.straits(), b.last_day, b.last_day)


@query
def d10_busiest_lanes(b: Bound) -> DataFrame:
    return operations.busiest_lanes(b.booking(lanes=True))


@query
def d11_monthly_on_time(b: Bound) -> DataFrame:
    return operations.monthly_on_time(b.booking())


@query
def d12_headline_facts(b: Bound) -> DataFrame:
    billing = b.billing()
    t = {**b.network(), "invoices": billing["invoices"], "fx_rates": b.fx}
    return headline.headline_facts(t, b.last_day, b.consignments)


@query
def d13_named_routes(b: Bound) -> DataFrame:
    return network.named_routes(b.routing(), port_risk=RISK, as_of=b.last_day)


@query
def d14_port_legend(b: Bound) -> DataFrame:
    return network.port_legend({"ports": b.ports})


# -- ingest, load and publish --------------------------------------------------


@query
def i1_csv_load(b: Bound) -> DataFrame:
    path = new_path(b.spark, "csv")
    source = b.raw("customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("industry"),
        money("c_acctbal").alias("credit_limit_usd"),
    )
    tables.write_csv(source, path)
    loaded = tables.read_csv(b.spark, path, source.schema)
    return loaded.withColumn("credit_limit_usd", F.col("credit_limit_usd").cast("double"))


FX_KEY = ["rate_date", "currency"]


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.withColumn("rate_to_usd", F.col("rate_to_usd").cast("double"))


def _raised(fx: DataFrame, where: str, by: int) -> DataFrame:
    return fx.where(where).withColumn(
        "rate_to_usd", (F.col("rate_to_usd") + by).cast("decimal(10,6)")
    )


@query
def i2_keyed_upsert(b: Bound) -> DataFrame:
    return _as_doubles(merge.upsert(b.fx, _raised(b.fx, P.UPSERT_WHERE, 1), FX_KEY))


@query
def i3_source_override(b: Bound) -> DataFrame:
    feed = _raised(b.fx, P.OVERRIDE_WHERE, 2)
    return _as_doubles(merge.override(b.fx, feed, FX_KEY, "currency", "rate_date"))


@query
def i4_load_profile(b: Bound) -> DataFrame:
    return tables.profile(b.fx, "rate_date", "currency")


CONSTRAINTS = {
    "lineitem": Table(
        "",
        key=("l_orderkey", "l_linenumber"),
        required=("l_shipdate",),
        references={"l_orderkey": ("orders", "o_orderkey")},
        checks={"returned": "l_returnflag IN ('R', 'A')", "quantity": "l_quantity > 1"},
    ),
    "orders": Table(
        "", key=("o_orderkey",), references={"o_custkey": ("customer", "c_custkey")}
    ),
    "customer": Table("", key=("c_custkey",)),
}


@query
def i5_declared_constraints(b: Bound) -> DataFrame:
    lost = F.col("o_orderkey") % P.LOST_EVERY == 0
    orders = b.raw("orders").withColumn(
        "o_custkey", F.when(lost, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    )
    frames = {"lineitem": b.raw("lineitem"), "orders": orders, "customer": b.raw("customer")}
    return quality_ops.declared(frames, CONSTRAINTS)


@query
def i6_feature_flatten(b: Bound) -> DataFrame:
    """Two-feature payloads: dates as text in even events and epoch ms in odd ones."""
    events = b.raw("events")
    k = F.get_json_object("props", "$.k")
    day = F.to_date("ts")
    text = F.concat(F.lit('"'), F.date_format(day, "yyyy-MM-dd"), F.lit('"'))
    millis = (F.unix_date(day).cast("bigint") * 86_400_000).cast("string")
    feature = F.concat(
        F.lit('{"attributes":{"date":'),
        F.when(F.col("event_id") % 2 == 0, text).otherwise(millis),
        F.lit(',"portid":"'), F.col("event_type"),
        F.lit('","portname":"feed '), F.col("event_type"),
        F.lit('","portcalls_container":'), k,
        F.lit(',"import":'), F.col("event_id").cast("string"), F.lit("}}"),
    )
    unknown = F.lit(',{"attributes":{"date":"2024-01-01","portid":"nowhere"}}')
    payloads = events.select(
        F.concat(F.lit('{"features":['), feature, unknown, F.lit("]}")).alias("body")
    )
    codes = events.select(F.col("event_type").alias("portwatch_id")).distinct().withColumn(
        "port_code", F.concat(F.lit("P-"), F.col("portwatch_id"))
    )
    wanted = {k: feeds.PORT_ATTRIBUTES[k] for k in ("portcalls_container", "import")}
    return feeds.flatten_features(payloads, "body", wanted, codes, "port_code", "activity_date")


@query
def i7_fx_normalise(b: Bound) -> DataFrame:
    """Units-per-USD maps plus a central-bank list that overrides one currency."""
    start = dt.date.fromisoformat(P.FEED_START)
    fx = b.fx
    units = F.col("rate_to_usd").cast("double")
    by_day = fx.select(
        F.lit(1).alias("seq"),
        F.create_map(
            F.col("rate_date").cast("string"), F.create_map("currency", units)
        ).alias("rates"),
    )
    bank = fx.where(F.col("currency") == P.BANK_CURRENCY).select(
        F.lit(2).alias("seq"),
        F.date_format("rate_date", "dd.MM.yyyy").alias("exchangedate"),
        units.alias("rate"),
        (units * 2).alias("rate_per_unit"),
    )
    fixings = feeds.rates_by_day(by_day, "rates", start, "seq").unionByName(
        feeds.central_bank_list(bank, P.BANK_CURRENCY, start, "seq")
    )
    return _as_doubles(merge.latest_per_key(fixings, FX_KEY, "seq"))


@query
def i8_quality_gate(b: Bound) -> DataFrame:
    return quality_ops.failing(_quality(b))


@query
def i9_freshness(b: Bound) -> DataFrame:
    orders = b.raw("orders").select(F.to_date("o_orderdate").alias("day"))
    return tables.freshness(orders, "day")


@query
def i10_publish(b: Bound) -> DataFrame:
    booking = b.booking()
    billed = {"invoices": b.billing_lines, "customers": b.customers()}

    def monthly_volume() -> DataFrame:
        return operations.monthly_volume(booking)

    def duplicate_billing() -> DataFrame:
        return finance.duplicate_billing(billed)

    def shipments() -> DataFrame:
        return booking["shipments"]

    marts = {
        "monthly_volume": ("Monthly volume", monthly_volume),
        "duplicate_billing": ("Duplicate billing", duplicate_billing),
        "shipments": ("Shipments", shipments),
    }
    catalogue = publish.publish(b.spark, marts, new_path(b.spark, "marts"))
    return publish.with_counts(b.spark, catalogue).select("mart", "title", "row_count")


# -- single primitives -----------------------------------------------------------


@query
def p23_asof_inner(b: Bound) -> DataFrame:
    usd = asof.usd(b.invoices, b.fx, "issue_date")
    return usd.select(
        "invoice_id", "issue_date", F.col("amount_usd").cast("double").alias("amount_usd")
    )


@query
def p24_asof_left(b: Bound) -> DataFrame:
    rates = b.fx.withColumn("priced", F.lit(True))
    joined = asof.join_daily(
        b.invoices, rates, ["currency"], "issue_date", "rate_date", "left"
    )
    rate = F.coalesce("rate_to_usd", F.lit(Decimal(1)))
    return joined.select(
        "invoice_id",
        F.coalesce("priced", F.lit(False)).alias("priced"),
        (F.col("amount") * rate).cast("double").alias("amount_usd"),
    )


@query
def p23_asof_timestamps(b: Bound) -> DataFrame:
    events = b.raw("events")
    purchase = F.col("event_type") == "purchase"
    bought = events.where(purchase).select(
        "user_id",
        "ts",
        F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"),
    )
    other = events.where(~purchase).select("event_id", "event_type", "user_id", "ts")
    joined = asof.join_sliced(other, bought, ["user_id"], "ts", "ts", "left")
    return joined.select("event_id", "event_type", "purchase_id", "purchase_value")


@query
def p26_anti_join(b: Bound) -> DataFrame:
    seen = b.raw("events").select(F.col("user_id").alias("customer_id")).distinct()
    return b.customers().select("customer_id", "customer_name").join(seen, "customer_id", "left_anti")


@query
def p30_bounded_paths(b: Bound) -> DataFrame:
    edges = b.routes.toDF("origin", "dest", "mode", "days", "cost")
    found = paths.expand(edges, edges.select(F.col("origin").alias("node")))
    return found.select(
        "origin",
        "dest",
        paths.path_text("path").alias("routing"),
        paths.path_text("modes", " / ").alias("modes"),
        "days",
        F.col("cost").cast("double").alias("cost"),
        "legs",
    )


@query
def p44_rollup(b: Bound) -> DataFrame:
    nations = (
        b.raw("customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count("*").alias("n"), F.sum(money("c_acctbal")).alias("bal"))
        .join(b.raw("nation"), "n_nationkey")
        .join(b.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        nations.rollup("r_name", "n_name")
        .agg(
            (F.grouping("r_name") + F.grouping("n_name")).cast("bigint").alias("level"),
            F.sum("n").alias("customers"),
            F.sum("bal").cast("double").alias("balance"),
        )
        .select(
            F.coalesce("r_name", F.lit("all")).alias("region"),
            F.coalesce("n_name", F.lit("all")).alias("nation"),
            "level",
            "customers",
            "balance",
        )
    )


@query
def p45_grouping_sets(b: Bound) -> DataFrame:
    per = b.raw("orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("v")
    )
    return (
        per.groupingSets([["o_orderpriority"], []], "o_orderpriority")
        .agg(
            F.grouping("o_orderpriority").cast("bigint").alias("is_total"),
            F.sum("n").alias("orders"),
            F.sum("v").cast("double").alias("amount"),
        )
        .select(
            F.coalesce("o_orderpriority", F.lit("total")).alias("priority"),
            "is_total",
            "orders",
            "amount",
        )
    )


@query
def p47_quantiles(b: Bound) -> DataFrame:
    counts = stats.value_counts(b.raw("lineitem"), ["l_returnflag"], "l_quantity")
    return counts.groupBy(F.col("l_returnflag").alias("flag")).agg(
        det_round(F.percentile("l_quantity", F.lit(0.5), F.col("n")), 4).alias("median_qty"),
        det_round(F.percentile("l_quantity", F.lit(0.9), F.col("n")), 4).alias("p90_qty"),
        F.max("l_quantity").alias("max_qty"),
    )


@query
def p47_quantiles_continuous(b: Bound) -> DataFrame:
    shares = {"p25_price": 0.25, "median_price": 0.5, "p99_price": 0.99}
    out = stats.quantiles(b.raw("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", shares)
    return out.select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        *[det_round(F.col(name), 4).alias(name) for name in shares],
    )


@query
def p48_sample_stddev(b: Bound) -> DataFrame:
    delivered = operations._delivered(b.booking(lanes=True))
    counts = stats.value_counts(delivered, operations.LANE, "actual_days")
    return stats.mean_and_spread(counts, operations.LANE, "actual_days").select(
        operations.lane_text().alias("lane"),
        "lane_n",
        det_round(F.col("mean"), 6).alias("mean_days"),
        det_round(F.col("std"), 6).alias("std_days"),
    )


@query
def p61_previous_event(b: Bound) -> DataFrame:
    pairs = sequence.with_previous(
        b.milestones,
        ["shipment_id"],
        ["event_time", "event_id"],
        {"event_type": "prev_event", "event_time": "prev_time"},
        F.date_trunc("minute", "event_time"),
    )
    return pairs.select(
        "event_id",
        "shipment_id",
        "event_type",
        "prev_event",
        hours_crossed(F.col("prev_time"), F.col("event_time")).alias("hours"),
    )


@query
def p62_running_share(b: Bound) -> DataFrame:
    df = b.invoices.select("invoice_id", "amount")
    shares = rank.running_total(
        df, "amount", "amount", True, "run", "all"
    )
    return shares.select(
        "invoice_id",
        F.col("run").cast("double").alias("running"),
        det_round(
            F.lit(100.0) * F.col("run").cast("double") / F.col("all").cast("double"), 4
        ).alias("cumulative_pct"),
    )


@query
def p64_symmetric_range(b: Bound) -> DataFrame:
    clusters = screening.windowed_clusters(
        b.invoices, "customer_id", "issue_date", F.col("amount"), 14, 1
    )
    return clusters.select(
        "invoice_id",
        "customer_id",
        "cluster_size",
        F.col("cluster_amount").cast("double").alias("cluster_amount"),
    )


@query
def p67_ntile(b: Bound) -> DataFrame:
    df = b.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_custkey").alias("customer"),
        F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("hot"),
    )
    tiles = [
        rank.Tile("by_amount", "amount"),
        rank.Tile("by_customer", "customer", descending=True),
        rank.Tile("by_hot_value", "hot"),
    ]
    return rank.ntile(df, tiles, "order_id").select(
        "order_id", "by_amount", "by_customer", "by_hot_value"
    )


@query
def p68_rank(b: Bound) -> DataFrame:
    df = b.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), "l_quantity"
    )
    up = rank.rank(df, "l_quantity", "up")
    ranked = rank.rank(up, "l_quantity", "down", descending=True)
    return ranked.select("order_id", "line", "up", "down")


@query
def p82_hours_crossed(b: Bound) -> DataFrame:
    start = F.lit("2024-01-01 00:59:00").cast("timestamp_ntz")
    return b.raw("events").select(
        "event_id", hours_crossed(start, F.col("ts")).alias("hours")
    )


@query
def p83_quarters_crossed(b: Bound) -> DataFrame:
    return b.raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        quarters_crossed(F.lit(dt.date(1995, 3, 31)), F.to_date("o_orderdate")).alias("quarters"),
    )
