"""Raw feed payloads into table rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PORT_ATTRIBUTES = {
    "portcalls_container": "portcalls_container int",
    "portcalls": "portcalls_total int",
    "import_container": "import_container_tons bigint",
    "import": "import_total_tons bigint",
    "export_container": "export_container_tons bigint",
    "export": "export_total_tons bigint",
}
STRAIT_ATTRIBUTES = {
    "n_container": "n_container int",
    "n_cargo": "n_cargo int",
    "n_total": "n_total int",
    "capacity_container": "capacity_container bigint",
}


def feed_day(raw: Column) -> Column:
    """A date given as ``yyyy-MM-dd...`` text or as epoch milliseconds."""
    millis = raw.try_cast("bigint")
    as_text = F.try_to_date(F.substring(raw, 1, 10), "yyyy-MM-dd")
    return F.coalesce(
        as_text, F.date_add(F.lit(dt.date(1970, 1, 1)), F.floor(millis / 86_400_000).cast("int"))
    )


#: Holds a payload's text where it cannot be parsed.
CORRUPT = "_corrupt"
_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _page_schema(attributes: dict[str, str]) -> str:
    fields = ", ".join(f"{name}: string" for name in ["date", "portid", "portname", *attributes])
    return f"features: array<struct<attributes: struct<{fields}>>>"


def broken(payloads: DataFrame, body: str, schema: str, needed: str, version: str = "version") -> DataFrame:
    """``file, reason, n_chars`` of payloads that are no JSON of ``schema`` (fields of a struct) or lack ``needed``."""
    parsed = F.from_json(body, f"struct<{schema}, {CORRUPT}: string>", _LENIENT)
    return (
        payloads.select(F.col(version).cast("string").alias("file"), parsed.alias("p"), F.char_length(body).cast("bigint").alias("n_chars"))
        .select(
            "file",
            F.when(F.col("p").isNull() | F.col(f"p.{CORRUPT}").isNotNull(), "not the declared JSON")
            .when(F.col(f"p.{needed}").isNull(), f"no {needed}")
            .alias("reason"),
            "n_chars",
        )
        .where("reason is not null")
    )


def broken_pages(payloads: DataFrame, body: str, attributes: dict[str, str], version: str = "version") -> DataFrame:
    """The payloads that :func:`flatten_features` leaves out where it is not strict."""
    return broken(payloads, body, _page_schema(attributes), "features", version)


def flatten_features(
    payloads: DataFrame,
    body: str,
    attributes: dict[str, str],
    codes: DataFrame,
    code: str,
    day: str,
    version: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """``{"features": [{"attributes": {...}}]}`` texts to one typed row per feature.

    ``attributes`` maps a payload field to a typed output column. ``codes`` maps
    ``portwatch_id`` to the table's own ``code``; features of unknown ids go.
    ``version`` names a column that orders the payloads; it comes out last, as
    (version, place in the payload). A payload that is no such text fails the read, or is left
    out where not ``strict``: :func:`broken_pages` names it.
    """
    schema = _page_schema(attributes)
    order = F.lit(None) if version is None else F.col(version)
    if strict:
        page = F.from_json(body, f"struct<{schema}>", {"mode": "FAILFAST"})
    else:
        page = F.from_json(body, f"struct<{schema}, {CORRUPT}: string>", _LENIENT)
    parsed = payloads.select(page.alias("p"), order.alias("_version"))
    if not strict:
        parsed = parsed.where(F.col(f"p.{CORRUPT}").isNull())
    rows = parsed.select(F.posexplode("p.features").alias("_at", "f"), "_version").select(
        "f.attributes.*", F.struct("_version", "_at").alias("_version")
    )
    columns = []
    for name, typed in attributes.items():
        out, kind = typed.split()
        columns.append(F.col(name).cast(kind).alias(out))
    return (
        rows.select(
            feed_day(F.col("date")).alias(day),
            F.col("portid").alias("portwatch_id"),
            F.coalesce("portname", F.lit("")).alias("portwatch_name"),
            *columns,
            *([] if version is None else [F.col("_version").alias(version)]),
        )
        .join(codes.select("portwatch_id", code), "portwatch_id")
        .select(day, code, "portwatch_id", "portwatch_name", *[a.split()[0] for a in attributes.values()],
                *([] if version is None else [version]))
    )


RATE = T.DecimalType(10, 6)


def _inverse(units_per_usd: Column) -> Column:
    """USD per unit, six digits."""
    return F.round(F.lit(1.0) / F.nullif(units_per_usd, F.lit(0.0)), 6).cast(RATE)


def rates_by_day(payloads: DataFrame, rates: str, start: dt.date, version: str) -> DataFrame:
    """``map<date, map<currency, units per USD>>`` to fixings from ``start`` on."""
    days = payloads.select(version, F.explode(rates).alias("_day", "_fixes"))
    return (
        days.select(
            version, F.to_date("_day").alias("rate_date"), F.explode("_fixes").alias("currency", "_u")
        )
        .where(F.col("rate_date") >= F.lit(start))
        .select("rate_date", "currency", _inverse(F.col("_u")).alias("rate_to_usd"), version)
    )


def central_bank_list(records: DataFrame, currency: str, start: dt.date, version: str) -> DataFrame:
    """Records with ``exchangedate`` as dd.mm.yyyy; a per-unit rate is preferred when set."""
    per_unit = F.nullif(F.col("rate_per_unit"), F.lit(0.0))
    return (
        records.withColumn("rate_date", F.to_date("exchangedate", "dd.MM.yyyy"))
        .where(F.col("rate_date") >= F.lit(start))
        .select(
            "rate_date",
            F.lit(currency).alias("currency"),
            _inverse(F.coalesce(per_unit, F.col("rate"))).alias("rate_to_usd"),
            version,
        )
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of a folder as one text ``body``; ``version`` is the file name, so a later name wins."""
    return spark.read.text(folder, wholetext=True).select(
        F.col("value").alias("body"), F.col("_metadata.file_name").alias("version")
    )


RATE_MAPS = "rates: map<string, map<string, double>>"


def rate_files(spark: SparkSession, folder: str, start: dt.date, rank: int = 0) -> DataFrame:
    """Files ``{"rates": {date: {currency: units per USD}}}`` as versioned fixings; broken files are left out
    (``broken(payloads, "body", RATE_MAPS, "rates")`` names them)."""
    schema = f"struct<{RATE_MAPS}, {CORRUPT}: string>"
    texts = payloads(spark, folder).select(
        F.from_json("body", schema, _LENIENT).alias("p"),
        F.struct(F.lit(rank).alias("rank"), "version").alias("version"),
    ).where(F.col(f"p.{CORRUPT}").isNull())
    return rates_by_day(texts.select("version", "p.rates"), "rates", start, "version")


def bank_files(spark: SparkSession, folder: str, currency: str, start: dt.date, rank: int = 1) -> DataFrame:
    """Files ``[{exchangedate, rate, rate_per_unit}]`` of one currency as versioned fixings."""
    schema = "array<struct<exchangedate: string, rate: double, rate_per_unit: double>>"
    records = payloads(spark, folder).select(
        F.explode(F.from_json("body", schema, {"mode": "FAILFAST"})).alias("r"),
        F.struct(F.lit(rank).alias("rank"), "version").alias("version"),
    )
    return central_bank_list(records.select("version", "r.*"), currency, start, "version")
