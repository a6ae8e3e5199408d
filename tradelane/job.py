"""A whole run: CSV tables and feeds in, result tables out, quality gate last."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelane.marts import finance, headline, network, operations, quality
from tradelane.operators import quality as checks
from tradelane.schemas import TABLES
from tradelane.session import materialize
from tradelane.sources import feeds, merge, publish, tables

log = logging.getLogger(__name__)

FEEDS_AND_LOOKUPS = {
    "port_activity_daily", "chokepoint_transits_daily", "inland_legs",
    "chokepoints", "lane_chokepoints", "cities", "route_requests",
}
CORE = [name for name in TABLES if name not in FEEDS_AND_LOOKUPS]
MONTHLY = {"shipments": "booked_date", "invoices": "issue_date", "shipment_events": "event_time"}


@dataclass
class Config:
    csv_dir: str  # one <table>.csv per core table
    table_dir: str  # Parquet tables
    out_dir: str  # result tables
    feeds: dict[str, str] = field(default_factory=dict)  # table -> CSV of a trusted feed
    # table -> folder of raw JSON files: feature pages, or rate maps for fx_rates
    raw: dict[str, str] = field(default_factory=dict)
    # table of feature pages -> CSV of (portwatch_id, the table's own code)
    codes: dict[str, str] = field(default_factory=dict)
    # currency -> folder of a central bank's lists; they beat the rate maps
    banks: dict[str, str] = field(default_factory=dict)
    rates_from: dt.date = dt.date(1970, 1, 1)  # older raw fixings are left out
    inland_csv: str | None = None
    recency_day: dt.date | None = None  # None: newest booking
    aging_day: dt.date | None = None  # None: newest invoice
    route: tuple[str, str] = ("UAODS", "CNSHA")
    only: tuple[str, ...] | None = None  # publish these marts (and data_quality) only


# Feed table -> its date column, its code column, the attributes of its raw features.
FEED_TABLES = {
    "port_activity_daily": ("activity_date", "port_code", feeds.PORT_ATTRIBUTES),
    "chokepoint_transits_daily": ("transit_date", "chokepoint_code", feeds.STRAIT_ATTRIBUTES),
}


def feature_feed(spark: SparkSession, cfg: Config, name: str) -> DataFrame | None:
    """The rows of a port or strait feed, last one per key; ``None`` where there is no feed."""
    spec = TABLES[name]
    day, code, attributes = FEED_TABLES[name]
    if name in cfg.raw:
        codes = tables.read_csv(spark, cfg.codes[name], f"portwatch_id string, {code} string")
        pages = feeds.payloads(spark, cfg.raw[name])
        rows = feeds.flatten_features(pages, "body", attributes, codes, code, day, "version", strict=False)
    elif name in cfg.feeds:
        rows = tables.read_versioned_csv(spark, cfg.feeds[name], spec.schema)
    else:
        return None
    return merge.latest_per_key(rows, spec.key, "version")


def fx_feed(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """Trusted fixings, last one per key: a CSV, or rate maps under central banks' lists."""
    spec = TABLES["fx_rates"]
    parts = []
    if "fx_rates" in cfg.raw:
        parts.append(feeds.rate_files(spark, cfg.raw["fx_rates"], cfg.rates_from))
    for currency, folder in cfg.banks.items():
        parts.append(feeds.bank_files(spark, folder, currency, cfg.rates_from))
    if not parts and "fx_rates" in cfg.feeds:
        parts.append(tables.read_versioned_csv(spark, cfg.feeds["fx_rates"], spec.schema))
    if not parts:
        return None
    return materialize(merge.latest_per_key(checks.union(parts), spec.key, "version"), "fx-feed")


def load(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Core tables, feeds merged in, literal lookups; all as Parquet but the lookups."""
    loaded = tables.ingest(spark, cfg.csv_dir, cfg.table_dir, CORE, MONTHLY)
    failed: list[tuple[str, str]] = []

    def isolated(name: str, bring: Callable[[], DataFrame], before: Callable[[], DataFrame]) -> DataFrame:
        """What ``bring`` gives, or the state before where the feed cannot be read."""
        try:
            return bring()
        except (PySparkException, Py4JJavaError) as e:
            log.warning("feed %s left as it was: %s", name, e)
            failed.append((name, str(e).splitlines()[0][:500]))
            return before()

    for name, (day, _, _) in FEED_TABLES.items():
        stored = partial(tables.stored_table, spark, cfg.table_dir, name)

        def merged(name=name, day=day, stored=stored) -> DataFrame:
            feed = feature_feed(spark, cfg, name)
            return stored() if feed is None else tables.merge_table(spark, feed, cfg.table_dir, name, day)

        loaded[name] = isolated(name, merged, stored)
    base = loaded["fx_rates"]

    def fixings() -> DataFrame:
        feed = fx_feed(spark, cfg)
        if feed is None:
            return base
        spec = TABLES["fx_rates"]
        rates = materialize(merge.override(base, feed, spec.key, "currency", "rate_date"), "fx-merged")
        tables.write_table(rates, f"{cfg.table_dir}/fx_rates_merged")
        return tables.read_table(spark, cfg.table_dir, "fx_rates_merged")

    def last_fixings() -> DataFrame:
        try:
            return tables.read_table(spark, cfg.table_dir, "fx_rates_merged")
        except AnalysisException:  # no feed was ever read
            return base

    loaded["fx_rates"] = isolated("fx_rates", fixings, last_fixings)
    loaded["quarantine"] = quarantine(spark, cfg, failed)
    if cfg.inland_csv:
        loaded["inland_legs"] = tables.read_csv(
            spark, cfg.inland_csv, TABLES["inland_legs"].schema
        )
    # one pass over the shipments for all exposure marts
    lanes = network.daily_lanes(loaded["shipments"])
    tables.write_table(lanes, f"{cfg.table_dir}/lane_daily", "booked_date")
    by_month = lanes.schema.add("month", "string")
    loaded["lane_daily"] = spark.read.schema(by_month).parquet(f"{cfg.table_dir}/lane_daily")
    return {**tables.lookup_tables(spark), **loaded}


QUARANTINE = "feed string, file string, reason string, n_chars bigint"


def quarantine(spark: SparkSession, cfg: Config, failed: list[tuple[str, str]]) -> DataFrame:
    """Payloads left out of a run, and feeds that could not be read at all (no ``file``)."""
    whole = {name for name, _ in failed}
    parts = [spark.createDataFrame([(name, None, reason, None) for name, reason in failed], QUARANTINE)]
    for name, folder in cfg.raw.items():
        if name in whole:
            continue
        pages = feeds.payloads(spark, folder)
        if name in FEED_TABLES:
            bad = feeds.broken_pages(pages, "body", FEED_TABLES[name][2])
        else:
            bad = feeds.broken(pages, "body", feeds.RATE_MAPS, "rates")
        parts.append(bad.select(F.lit(name).alias("feed"), "file", "reason", "n_chars"))
    return checks.union(parts)


def load_profile(t: dict[str, DataFrame]) -> DataFrame:
    """Rows and span of every feed, and the currencies of the fixings."""
    parts = [("fx_rates", tables.profile(t["fx_rates"], "rate_date", "currency"))]
    parts += [(name, tables.profile(t[name], day)) for name, (day, _, _) in FEED_TABLES.items()]
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in parts]
    whole = named[0]
    for df in named[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def declared(t: dict[str, DataFrame]) -> DataFrame:
    """Every declared key, required column, reference and value check of the loaded tables."""
    return checks.declared(t, TABLES, [name for name in TABLES if name in t])


def marts(t: dict[str, DataFrame], cfg: Config) -> dict[str, tuple[str, object, str]]:
    """Name -> (title, builder, source). Builders run one by one when published."""
    recency = cfg.recency_day or operations.latest(t["shipments"], "booked_date")
    named = {
        "executive_kpis": (
            "Executive KPIs",
            lambda: operations.executive_kpis(t),
            "operations.executive_kpis",
        ),
        "yearly_growth": (
            "Growth against last year",
            lambda: operations.yearly_growth(t),
            "operations.yearly_growth",
        ),
        "route_pathfinding": (
            "Cheapest routes",
            lambda: network.route_pathfinding(t, cfg.route[0], [cfg.route[1]]),
            "network.route_pathfinding",
        ),
        "transit_bottlenecks": (
            "Transit bottlenecks",
            lambda: operations.transit_bottlenecks(t),
            "operations.transit_bottlenecks",
        ),
        "customer_segmentation": (
            "Customer segments",
            lambda: finance.customer_segmentation(t, recency),
            "finance.customer_segmentation",
        ),
        "cohort_retention": (
            "Cohort retention",
            lambda: operations.cohort_retention(t),
            "operations.cohort_retention",
        ),
        "fx_normalized_revenue": (
            "Revenue in USD",
            lambda: finance.fx_normalized_revenue(t),
            "finance.fx_normalized_revenue",
        ),
        "receivables_aging": (
            "Receivables aging",
            lambda: finance.receivables_aging(t, cfg.aging_day),
            "finance.receivables_aging",
        ),
        "aging_dashboard": (
            "Receivables by bucket",
            lambda: finance.aging_dashboard(t),
            "finance.aging_dashboard",
        ),
        "payment_discipline": (
            "Payment discipline",
            lambda: finance.payment_discipline(t),
            "finance.payment_discipline",
        ),
        "transit_anomalies": (
            "Transit anomalies",
            lambda: operations.transit_anomalies(t),
            "operations.transit_anomalies",
        ),
        "robust_anomalies": (
            "Robust anomalies",
            lambda: operations.robust_anomalies(t),
            "operations.robust_anomalies",
        ),
        "aml_screening": (
            "Billing screens",
            lambda: finance.aml_screening(t),
            "finance.aml_screening",
        ),
        "structuring_normalized": (
            "Structuring in USD",
            lambda: finance.structuring_normalized(t),
            "finance.structuring_normalized",
        ),
        "data_quality": ("Data quality", lambda: quality.data_quality(t), "quality.data_quality"),
        "port_activity": (
            "Port activity",
            lambda: network.port_activity(t),
            "network.port_activity",
        ),
        "network_exposure": (
            "Network exposure",
            lambda: network.network_exposure(t),
            "network.network_exposure",
        ),
        "chokepoint_exposure": (
            "Chokepoint exposure",
            lambda: network.chokepoint_exposure(t),
            "network.chokepoint_exposure",
        ),
        "kpi_strip": ("Key figures", lambda: operations.kpi_strip(t), "operations.kpi_strip"),
        "revenue_total": ("Revenue", lambda: finance.revenue_total(t), "finance.revenue_total"),
        "receivables_kpi": (
            "Receivables",
            lambda: finance.receivables_kpi(t),
            "finance.receivables_kpi",
        ),
        "monthly_volume": (
            "Monthly volume",
            lambda: operations.monthly_volume(t),
            "operations.monthly_volume",
        ),
        "monthly_on_time": (
            "On time by month",
            lambda: operations.monthly_on_time(t),
            "operations.monthly_on_time",
        ),
        "revenue_by_region": (
            "Revenue by region",
            lambda: finance.revenue_by_region(t),
            "finance.revenue_by_region",
        ),
        "port_table": ("Ports", lambda: network.port_table(t), "network.port_table"),
        "weekly_series": (
            "Weekly tonnage",
            lambda: network.weekly_series(t),
            "network.weekly_series",
        ),
        "chokepoint_compact": (
            "Straits",
            lambda: network.chokepoint_compact(t),
            "network.chokepoint_compact",
        ),
        "busiest_lanes": (
            "Busiest lanes",
            lambda: operations.busiest_lanes(t),
            "operations.busiest_lanes",
        ),
        "headline_facts": (
            "Headline facts",
            lambda: headline.headline_facts(t),
            "headline.headline_facts",
        ),
        "port_legend": ("Port codes", lambda: network.port_legend(t), "network.port_legend"),
        "freshness": (
            "Freshness",
            lambda: tables.freshness(t["port_activity_daily"], "activity_date"),
            "tables.freshness",
        ),
        "quarantine": ("Payloads and feeds left out", lambda: t["quarantine"], "job.quarantine"),
        "load_profile": ("Loaded feeds", lambda: load_profile(t), "job.load_profile"),
        "declared_constraints": ("Declared constraints", lambda: declared(t), "job.declared"),
    }
    if "inland_legs" in t:
        named["door_to_door_routing"] = (
            "Door to door",
            lambda: network.door_to_door_routing(t),
            "network.door_to_door_routing",
        )
        named["named_routes"] = (
            "Door to door, port names",
            lambda: network.named_routes(t),
            "network.named_routes",
        )
    return named


#: Published by every run: the gate reads them.
GATED = ("data_quality", "declared_constraints")


def run(spark: SparkSession, cfg: Config, gate: bool = True) -> DataFrame:
    """Load, publish every mart, then fail on critical violations or broken constraints.

    Returns the catalogue with row counts. The results are on disk before the gate
    can raise, so a failed run can be looked into (``publish.read``). Broken payloads and feeds
    do not stop a run: ``quarantine`` lists them, and their tables keep what was stored.
    """
    loaded = load(spark, cfg)
    wanted = marts(loaded, cfg)
    if cfg.only is not None:
        wanted = {n: m for n, m in wanted.items() if n in cfg.only or n in GATED}
    catalogue = publish.publish(spark, wanted, cfg.out_dir)
    if gate:
        broken = publish.read(spark, cfg.out_dir, "declared_constraints").select(
            F.concat_ws(", ", "table_name", "constraint_name").alias("check_name"),
            F.lit(checks.CRITICAL).alias("severity"),
            "violations",
        )
        checks.gate(publish.read(spark, cfg.out_dir, "data_quality").unionByName(broken))
    return publish.with_counts(spark, catalogue)
