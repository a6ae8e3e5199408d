"""Revenue, receivables, payment behaviour, customer value, billing screens."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.functions.dates import (
    day,
    days_between,
    latest,
    quarter_label,
    quarter_start,
    shift,
)
from tradelane.functions.num import as_double, det_round, pct, ratio, whole
from tradelane.operators import asof, rank, screening
from tradelane.session import materialize

Tables = dict[str, DataFrame]

# Labels of total rows.
TOTAL_LABEL = "── TOTAL ──"
SUBTOTAL_LABEL = "subtotal"
ALL_CUSTOMERS_LABEL = "── ALL CUSTOMERS ──"


def _daily_usd(t: Tables, invoices: DataFrame, keys: list[str]) -> DataFrame:
    """Invoices added up per (keys, currency, day) and then converted.

    All invoices of one currency and day share one rate, so the conversion
    meets the small daily totals and the fact rows are shuffled once, already
    combined. Columns: keys, currency, n, amount, amount_usd.
    """
    daily = invoices.groupBy(*keys, "currency", "issue_date").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    return asof.usd(daily, t["fx_rates"], "issue_date")


def _with_origin(t: Tables, invoices: DataFrame) -> DataFrame:
    return invoices.join(t["shipments"].select("shipment_id", "origin_port"), "shipment_id")


def _regions(t: Tables) -> DataFrame:
    return t["ports"].select(F.col("port_code").alias("origin_port"), "region")


def fx_normalized_revenue(t: Tables) -> DataFrame:
    billed = _with_origin(t, t["invoices"]).withColumn(
        "qtr", quarter_start(F.col("issue_date"))
    )
    # ports and quarters are few: roll up small rows, where the Expand of
    # ROLLUP and of COUNT(DISTINCT) costs nothing
    small = (
        _daily_usd(t, billed, ["origin_port", "qtr"])
        .join(_regions(t), "origin_port")
        .groupBy("region", "qtr", "currency")
        .agg(F.sum("n").alias("n"), F.sum("amount_usd").alias("usd"))
    )
    rolled = small.rollup("region", "qtr").agg(
        F.grouping("region").alias("_gr"),
        F.grouping("qtr").alias("_gq"),
        F.sum("n").alias("invoices"),
        F.sum("usd").alias("_usd"),
        F.count_distinct("currency").alias("currencies_billed"),
    )
    return (
        rolled.orderBy("_gr", "region", "_gq", "qtr")
        .select(
            F.when(F.col("_gr") == 1, TOTAL_LABEL).otherwise(F.col("region")).alias("region"),
            F.when((F.col("_gq") == 1) & (F.col("_gr") == 0), SUBTOTAL_LABEL)
            .when(F.col("_gq") == 1, "")
            .otherwise(quarter_label(F.col("qtr")))
            .alias("quarter"),
            "invoices",
            whole(F.col("_usd")).alias("revenue_usd"),
            det_round(ratio(F.col("_usd"), F.col("invoices")), 0).alias("avg_invoice_usd"),
            "currencies_billed",
        )
    )


def revenue_total(t: Tables) -> DataFrame:
    return _daily_usd(t, t["invoices"], []).agg(whole(F.sum("amount_usd")).alias("revenue_usd"))


def revenue_by_region(t: Tables) -> DataFrame:
    return (
        _daily_usd(t, _with_origin(t, t["invoices"]), ["origin_port"])
        .join(_regions(t), "origin_port")
        .groupBy("region")
        .agg(whole(F.sum("amount_usd")).alias("revenue_usd"))
        .orderBy(F.desc("revenue_usd"), "region")
    )


def _open(t: Tables) -> DataFrame:
    return t["invoices"].where(F.col("paid_date").isNull())


# Aging labels, upper limit in days overdue (None = no limit).
AGING_BUCKETS = [
    (-1, "1 · Not yet due"),
    (30, "2 · 1-30 days overdue"),
    (60, "3 · 31-60 days overdue"),
    (90, "4 · 61-90 days overdue"),
    (None, "5 · 90+ days overdue"),
]
# The dashboard's labels; here a bill due today is not yet due.
DASHBOARD_BUCKETS = [
    (0, "Not yet due"),
    (30, "1–30 days"),
    (60, "31–60 days"),
    (90, "61–90 days"),
    (None, "90+ days"),
]


def bucket(days: Column, buckets: list[tuple[int | None, str]]) -> Column:
    label = None
    for limit, name in buckets:
        if limit is None:
            return label.otherwise(name)
        label = F.when(days <= limit, name) if label is None else label.when(days <= limit, name)
    return label


def receivables_aging(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Open items in USD by days overdue at ``as_of`` (newest invoice day if not given)."""
    as_of = as_of or latest(t["invoices"], "issue_date")
    overdue = F.datediff(day(as_of), F.col("due_date"))
    usd = asof.usd(
        _open(t).withColumn("aging_bucket", bucket(overdue, AGING_BUCKETS)),
        t["fx_rates"],
        "issue_date",
    )
    per_bucket = usd.groupBy("aging_bucket").agg(
        F.count("*").alias("invoices"),
        F.sum("amount_usd").alias("usd"),
        F.count_distinct("customer_id").alias("customers_affected"),
    )
    everything = Window.orderBy(F.lit(1)).rowsBetween(  # five rows
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return per_bucket.select(
        "aging_bucket",
        "invoices",
        whole(F.col("usd")).alias("outstanding_usd"),
        pct(F.col("usd"), F.sum("usd").over(everything)).alias("share_pct"),
        "customers_affected",
    ).orderBy("aging_bucket")


def receivables_kpi(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    as_of = as_of or latest(t["invoices"], "issue_date")
    late = F.col("due_date") < shift(as_of, -90)
    usd = _daily_usd(t, _open(t).withColumn("late", late), ["late"])
    return usd.agg(
        whole(F.sum("amount_usd")).alias("outstanding_usd"),
        whole(F.sum(F.when(F.col("late"), F.col("amount_usd")))).alias("overdue90_usd"),
    )


def billing_by_region(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    """USD billed, open and more than 90 days late per region, from one pass over the invoices.

    Bills of an unknown shipment or port stand under the region NULL. ``shipment_id`` is a key
    of the shipments.
    """
    as_of = as_of or latest(t["invoices"], "issue_date")
    amount, unpaid = F.col("amount"), F.col("paid_date").isNull()
    origins = t["shipments"].select("shipment_id", "origin_port")
    daily = (
        t["invoices"].join(origins, "shipment_id", "left")
        .groupBy("origin_port", "currency", "issue_date")
        .agg(
            F.sum(amount).alias("billed"),
            F.sum(F.when(unpaid, amount)).alias("open"),
            F.sum(F.when(unpaid & (F.col("due_date") < shift(as_of, -90)), amount)).alias("overdue"),
        )
    )
    rates = t["fx_rates"].select("currency", "rate_date", "rate_to_usd")
    return (
        asof.join_daily(daily, rates, ["currency"], "issue_date", "rate_date")
        .join(_regions(t), "origin_port", "left")
        .groupBy("region")
        .agg(*[F.sum(F.col(c) * F.col("rate_to_usd")).alias(c) for c in ("billed", "open", "overdue")])
    )


def aging_dashboard(t: Tables, as_of: dt.date | None = None) -> DataFrame:
    as_of = as_of or latest(t["invoices"], "issue_date")
    label = bucket(F.datediff(day(as_of), F.col("due_date")), DASHBOARD_BUCKETS)
    usd = _daily_usd(t, _open(t).withColumn("bucket", label), ["bucket"])
    position = F.array_position(
        F.array(*[F.lit(name) for _, name in DASHBOARD_BUCKETS]), F.col("bucket")
    )
    return (
        usd.groupBy("bucket")
        .agg(whole(F.sum("amount_usd")).alias("usd"))
        .orderBy(position)
    )


def payment_discipline(
    t: Tables,
    as_of: dt.date | None = None,
    overdue_days: int = 90,
    sales_days: int = 365,
    top: int | None = 15,
) -> DataFrame:
    """Who pays late, what is open, DSO; a total row and the largest debtors."""
    as_of = as_of or latest(t["invoices"], "issue_date")
    usd = asof.usd(t["invoices"], t["fx_rates"], "issue_date")
    unpaid = F.col("paid_date").isNull()
    amount = F.col("amount_usd")
    # every figure is additive: add up per customer once, then group those rows
    # again for the total instead of doubling the invoices
    per_customer = usd.groupBy("customer_id").agg(
        F.count("*").alias("invoices"),
        F.count("paid_date").alias("paid"),
        F.sum(F.datediff("paid_date", "due_date").cast("bigint")).alias("late_days"),
        F.count(F.when(F.col("paid_date") > F.col("due_date"), 1)).alias("late"),
        F.sum(F.when(unpaid, amount)).alias("open"),
        F.sum(
            F.when(unpaid & (F.col("due_date") < shift(as_of, -overdue_days)), amount)
        ).alias("overdue"),
        F.sum(F.when(F.col("issue_date") > shift(as_of, -sales_days), amount)).alias("sales"),
    )
    names = t["customers"].select("customer_id", "customer_name")
    known = per_customer.join(names.select("customer_id"), "customer_id", "left_semi")
    sums = ["invoices", "paid", "late_days", "late", "open", "overdue", "sales"]
    grouped = (
        known.groupingSets([["customer_id"], []], "customer_id")
        .agg(
            F.grouping("customer_id").alias("_total"),
            *[F.sum(c).alias(c) for c in sums],
        )
        .where(F.col("open") > 0)
    )
    figures = grouped.select(
        "invoices",
        "paid",
        det_round(ratio(F.col("late_days"), F.col("paid")), 1).alias("avg_days_late"),
        pct(F.col("late"), F.col("paid")).alias("paid_late_pct"),
        whole(F.col("open")).alias("outstanding_usd"),
        whole(F.col("overdue")).alias("overdue_90d_usd"),
        det_round(F.lit(float(sales_days)) * ratio(F.col("open"), F.col("sales")), 0).alias(
            "dso_days"
        ),
        "_total",
        "customer_id",
    )
    rank_by = [F.desc("_total"), F.desc("outstanding_usd"), F.asc("customer_id")]
    if top is not None:
        figures = figures.orderBy(*rank_by).limit(top + 1)
    label = F.when(F.col("_total") == 1, ALL_CUSTOMERS_LABEL).otherwise(F.col("customer_name"))
    return (
        figures.join(names, "customer_id", "left")  # names only for the rows shown
        .orderBy(*rank_by)
        .withColumn("customer", label)
        .select("customer", *[c for c in figures.columns if c not in ("_total", "customer_id")])
    )


def customer_activity(t: Tables, as_of: dt.date) -> DataFrame:
    """Per customer: days since the last booking, shipments, revenue in USD."""
    revenue = asof.usd(
        t["shipments"].select("customer_id", "booked_date", "freight_amount", "currency"),
        t["fx_rates"],
        "booked_date",
        "freight_amount",
        how="left",
        out="usd",
        default=F.lit(Decimal("1.0")),
    )
    per_customer = revenue.groupBy("customer_id").agg(
        days_between(F.max("booked_date"), day(as_of)).alias("days_since_last"),
        F.count("*").alias("shipment_count"),
        whole(F.sum("usd")).alias("revenue_usd"),
    )
    return per_customer.join(t["customers"].select("customer_id"), "customer_id", "left_semi")


def segment(r: Column, f: Column, m: Column) -> Column:
    # fixed values: segment names and limits; the first rule that holds decides
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champion")
        .when((r >= 4) & (f >= 3), "Loyal")
        .when((r <= 2) & (m >= 4), "At Risk (high value)")
        .when((r <= 2) & (f <= 2), "Dormant")
        .when((r >= 4) & (f <= 2), "New / Developing")
        .otherwise("Core")
    )


RFM_TILES = [
    rank.Tile("r_score", "days_since_last", descending=True),  # recent = 5
    rank.Tile("f_score", "shipment_count"),
    rank.Tile("m_score", "revenue_usd"),
]


def rfm_scores(t: Tables, as_of: dt.date, tiles: int = 5) -> DataFrame:
    activity = materialize(customer_activity(t, as_of), "customer-activity")
    return rank.ntile(activity, RFM_TILES, "customer_id", tiles)


def customer_segmentation(
    t: Tables, as_of: dt.date, a_limit: float = 80.0, b_limit: float = 95.0
) -> DataFrame:
    scored = rfm_scores(t, as_of)
    shares = rank.running_total(scored, "revenue_usd", "revenue_usd", True, "_run", "_all")
    cumulative = pct(F.col("_run"), F.col("_all"))
    per_segment = (
        shares.withColumn("segment", segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))
        .withColumn("_cum", cumulative)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum("shipment_count").alias("shipments"),
            F.sum("revenue_usd").alias("revenue_usd"),
            F.max("_all").alias("_all"),
            F.count(F.when(F.col("_cum") <= a_limit, 1)).alias("class_a_customers"),
            F.count(
                F.when((F.col("_cum") > a_limit) & (F.col("_cum") <= b_limit), 1)
            ).alias("class_b_customers"),
            F.count(F.when(F.col("_cum") > b_limit, 1)).alias("class_c_customers"),
        )
    )
    return per_segment.select(
        "segment",
        "customers",
        "shipments",
        "revenue_usd",
        pct(F.col("revenue_usd"), F.col("_all")).alias("revenue_share_pct"),
        "class_a_customers",
        "class_b_customers",
        "class_c_customers",
    ).orderBy(F.desc("revenue_usd"), "segment")


# Screen names.
STRUCTURING = "A · STRUCTURING"
DUPLICATE_BILLING = "B · DUPLICATE BILLING"


def structuring(
    t: Tables,
    currency: str = "USD",
    low: str = "9000",
    high: str = "9999.99",
    reach_days: int = 14,
    min_cluster: int = 3,
) -> DataFrame:
    """Just-below-threshold invoices of one customer bunched in time."""
    near = t["invoices"].where(
        (F.col("currency") == currency)
        & F.col("amount").between(Decimal(low), Decimal(high))
    )
    return (
        screening.windowed_clusters(
            near, "customer_id", "issue_date", F.col("amount"), reach_days, min_cluster
        )
        .join(t["customers"].select("customer_id", "customer_name"), "customer_id")
        .select(
            F.lit(STRUCTURING).alias("screen"),
            "customer_name",
            "invoice_id",
            "issue_date",
            as_double("amount").alias("amount"),
            F.col("cluster_size").alias("evidence_count"),
            as_double("cluster_amount").alias("evidence_amount"),
        )
    )


def duplicate_billing(t: Tables) -> DataFrame:
    """Invoices of one shipment over the same amount."""
    return (
        screening.repeated(t["invoices"], ["shipment_id", "amount"])
        .join(t["customers"].select("customer_id", "customer_name"), "customer_id")
        .select(
            F.lit(DUPLICATE_BILLING).alias("screen"),
            "customer_name",
            "invoice_id",
            "issue_date",
            as_double("amount").alias("amount"),
            F.col("copies").alias("evidence_count"),
            as_double(F.col("amount") * F.col("copies")).alias("evidence_amount"),
        )
    )


def aml_screening(t: Tables, billing: Tables | None = None, **limits) -> DataFrame:
    """Both screens. ``billing`` may hold another invoice table for the second one."""
    return (
        structuring(t, **limits)
        .unionByName(duplicate_billing(billing or t))
        .orderBy("screen", "customer_name", "issue_date", "invoice_id")
    )


def structuring_normalized(
    t: Tables,
    low: str = "9000",
    high: str = "9999.99",
    reach_days: int = 14,
    min_cluster: int = 3,
) -> DataFrame:
    """Structuring screen over USD equivalents, whatever the billing currency."""
    usd = asof.usd(t["invoices"], t["fx_rates"], "issue_date")
    near = usd.where(F.col("amount_usd").between(Decimal(low), Decimal(high)))
    return (
        screening.windowed_clusters(
            near, "customer_id", "issue_date", F.col("amount_usd"), reach_days, min_cluster
        )
        .join(t["customers"].select("customer_id", "customer_name"), "customer_id")
        .select(
            F.lit(STRUCTURING).alias("screen"),
            "customer_name",
            "invoice_id",
            "issue_date",
            "currency",
            as_double("amount").alias("amount"),
            F.col("cluster_size").alias("evidence_count"),
            as_double(F.round("cluster_amount", 2)).alias("evidence_usd"),
        )
        .orderBy("customer_name", "issue_date", "invoice_id")
    )
