import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, dec, got
from tradelane import session
from tradelane.functions.dates import after
from tradelane.schemas import TABLES, lookup_tables
from tradelane.sources import feeds, merge, publish, tables


def fx(table, *rows):
    return table("fx_rates", [dict(rate_date=d, currency=c, rate_to_usd=r) for d, c, r in rows])


def plain(df):
    return sorted((r.rate_date.isoformat(), r.currency, float(r.rate_to_usd)) for r in df.collect())


def test_csv_round_trip_and_failfast(spark, table, tmp_path):
    df = table("customers", [dict(customer_id=1, customer_name="A, \"quoted\"", country="PL", industry="x",
                                  onboarded_date="2025-01-02", credit_limit_usd="12.50"),
                             dict(customer_id=2, customer_name="OÜ", country="EE", industry="y",
                                  onboarded_date="2025-01-03", credit_limit_usd="1")])
    path = str(tmp_path / "c")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path, df.schema)
    assert back.schema == df.schema and sorted(got(back)) == sorted(got(df))
    bad = tmp_path / "bad.csv"
    bad.write_text("customer_id,customer_name,country,industry,onboarded_date,credit_limit_usd\nx,a,b,c,2025-01-01,1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        tables.read_csv(spark, str(bad), df.schema).collect()


def test_upsert(table):
    base = fx(table, ("2025-01-01", "EUR", 1), ("2025-01-02", "EUR", 2))
    feed = fx(table, ("2025-01-02", "EUR", 9), ("2025-01-03", "EUR", 3)).withColumn("extra", F.lit(1))
    out = merge.upsert(base, feed, ["rate_date", "currency"])
    assert plain(out) == [("2025-01-01", "EUR", 1.0), ("2025-01-02", "EUR", 9.0), ("2025-01-03", "EUR", 3.0)]
    assert out.columns == base.columns


def test_override_clears_covered_currencies_from_the_global_start(table):
    base = fx(table, ("2025-01-01", "EUR", 1), ("2025-01-02", "EUR", 1), ("2025-01-03", "EUR", 1),
              ("2025-01-01", "GBP", 1), ("2025-01-02", "GBP", 1), ("2025-01-05", "GBP", 1), ("2025-01-05", "USD", 1))
    # GBP starts later than EUR, still its rows from EUR's start go
    feed = fx(table, ("2025-01-02", "EUR", 5), ("2025-01-04", "GBP", 6))
    out = merge.override(base, feed, ["rate_date", "currency"], "currency", "rate_date")
    assert plain(out) == [("2025-01-01", "EUR", 1.0), ("2025-01-01", "GBP", 1.0), ("2025-01-02", "EUR", 5.0),
                          ("2025-01-04", "GBP", 6.0), ("2025-01-05", "USD", 1.0)]
    assert plain(merge.override(base, feed.where("false"), ["rate_date", "currency"], "currency", "rate_date")) == plain(base)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x", 10), ("a", 2, None, 20), ("b", 1, "z", 30)], "k string, seq int, v string, w int")
    assert sorted(got(merge.latest_per_key(df, ["k"], "seq"))) == [("a", None, 20), ("b", "z", 30)]
    assert sorted(got(merge.latest_per_key(df.drop("v"), ["k"], "seq"))) == [("a", 20), ("b", 30)]


def test_profile_and_freshness(table):
    df = fx(table, ("2025-01-01", "GBP", 1), ("2025-01-09", "EUR", 2), ("2025-01-02", "EUR", 2))
    assert got(tables.profile(df, "rate_date", "currency")) == [(3, day("2025-01-01"), day("2025-01-09"), "EUR, GBP")]
    assert got(tables.profile(df, "rate_date")) == [(3, day("2025-01-01"), day("2025-01-09"))]
    assert got(tables.freshness(df, "rate_date")) == [(day("2025-01-09"), "data through 2025-01-09")]
    assert got(tables.freshness(df.where("false"), "rate_date")) == [(None, "no cache")]


def test_flatten_features(spark):
    body = ('{"features":[{"attributes":{"date":"2026-01-02","portid":"port1","portname":"One","portcalls_container":3,'
            '"portcalls":9,"import_container":1,"import":5000000000,"export_container":null,"export":2}},'
            '{"attributes":{"date":1767398400000,"portid":"port1","portcalls_container":4}},'
            '{"attributes":{"date":"2026-01-03T00:00:00","portid":"portX","portcalls_container":4}}]}')
    codes = spark.createDataFrame([("port1", "CNSHA")], "portwatch_id string, port_code string")
    df = spark.createDataFrame([(body,), ('{"features":[]}',)], "body string")
    out = feeds.flatten_features(df, "body", feeds.PORT_ATTRIBUTES, codes, "port_code", "activity_date")
    assert out.columns == TABLES["port_activity_daily"].schema.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in TABLES["port_activity_daily"].schema]
    assert sorted(got(out), key=str) == [
        (day("2026-01-02"), "CNSHA", "port1", "One", 3, 9, 1, 5000000000, None, 2),
        (day("2026-01-03"), "CNSHA", "port1", "", 4, None, None, None, None, None)]


def test_fx_feeds(spark):
    start = day("2025-01-02")
    maps = spark.createDataFrame(
        [(1, {"2025-01-01": {"EUR": 2.0}, "2025-01-02": {"EUR": 3.0, "GBP": 4.0}}), (2, {"2025-01-02": {"EUR": 0.8}})],
        "seq int, rates map<string, map<string, double>>")
    out = feeds.rates_by_day(maps, "rates", start, "seq")
    last = merge.latest_per_key(out, ["rate_date", "currency"], "seq")
    assert plain(last) == [("2025-01-02", "EUR", 1.25), ("2025-01-02", "GBP", 0.25)]
    bank = spark.createDataFrame([("02.01.2025", 400.0, 40.0, 1), ("03.01.2025", 50.0, None, 1), ("04.01.2025", 50.0, 0.0, 1),
                                  ("31.12.2024", 1.0, None, 1)], "exchangedate string, rate double, rate_per_unit double, seq int")
    assert plain(feeds.central_bank_list(bank, "UAH", start, "seq")) == [
        ("2025-01-02", "UAH", 0.025), ("2025-01-03", "UAH", 0.02), ("2025-01-04", "UAH", 0.02)]


def test_monthly_layout_prunes(spark, table, tmp_path):
    df = fx(table, ("2025-01-31", "EUR", 1), ("2025-02-01", "EUR", 2), ("2025-02-02", "EUR", 2))
    tables.write_table(df, str(tmp_path / "fx_rates"), "rate_date")
    assert sorted(p for p in os.listdir(tmp_path / "fx_rates") if p.startswith("month")) == ["month=2025-01", "month=2025-02"]
    back = tables.read_table(spark, str(tmp_path), "fx_rates")
    assert plain(back) == plain(df)
    recent = after(back, "rate_date", day("2025-02-01"))
    assert plain(recent) == [("2025-02-02", "EUR", 2.0)]
    assert len(recent.select("rate_date").inputFiles()) >= 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(rate_date), GreaterThan(rate_date" in plan


def test_publish_writes_everything_and_counts(spark, tmp_path):
    marts = {"a": ("Table A", lambda: spark.range(1000)), "b": ("Table B", lambda: spark.range(3).where("id > 5"))}
    catalogue = publish.publish(spark, marts, str(tmp_path))
    assert sorted(got(publish.with_counts(spark, catalogue).select("mart", "title", "row_count"))) == [
        ("a", "Table A", 1000), ("b", "Table B", 0)]
    assert publish.catalogue(spark, str(tmp_path)).count() == 2


class FakeSession:
    """A session whose cluster names a shared folder."""

    def __init__(self, folder):
        self.conf = self
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_the_configured_shared_folder_wins():
    assert session.shared_dir(FakeSession("s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert session.new_path(FakeSession("/mnt/x"), "fx").startswith("/mnt/x/fx-")


def test_materialize_reads_back_what_it_wrote(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    out = session.materialize(spark.range(5).withColumn("d", F.lit(dec("1.50"))), "x")
    assert out.count() == 5 and len(os.listdir(tmp_path)) == 1
    assert out.inputFiles()[0].startswith("file://" + str(tmp_path))


def test_lookup_tables(spark):
    t = lookup_tables(spark)
    assert t["chokepoints"].count() == 8 and t["lane_chokepoints"].count() == 43
    assert t["cities"].count() == 5 and t["route_requests"].count() == 3
