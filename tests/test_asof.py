import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import day, got
from tradelane.operators import asof

RATES = [
    ("EUR", "2025-01-05", "1.10"), ("EUR", "2025-01-10", "1.20"), ("EUR", "2025-02-20", "1.30"),
    ("GBP", "2025-01-07", "1.40"),
]
FACTS = [
    (1, "EUR", "2025-01-04"),  # before the first rate
    (2, "EUR", "2025-01-05"),  # exact
    (3, "EUR", "2025-02-19"),  # in a gap
    (4, "EUR", "2030-01-01"),  # long after the last rate
    (5, "GBP", "2025-06-01"),  # after the key's last, beyond other keys' too
    (6, "XXX", "2025-01-06"),  # unknown currency
    (7, "GBP", "2025-01-07"),
    (8, "EUR", None),
    (9, None, "2025-01-06"),
]
WANT = {2: "1.10", 3: "1.20", 4: "1.30", 5: "1.40", 7: "1.40"}


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame([(c, day(d), Decimal(r)) for c, d, r in RATES],
                                 "currency string, rate_date date, rate decimal(10,6)")


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([(i, c, day(d)) for i, c, d in FACTS],
                                 "id int, currency string, issued date")


@pytest.fixture(params=["broadcast", "shuffle"])
def any_join(spark, request):
    """Both ways the planner may choose for the calendar."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "10m" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set(name, before)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_daily_join(facts, rates, how, any_join):
    out = dict(got(asof.join_daily(facts, rates, ["currency"], "issued", "rate_date", how)
                   .select("id", F.col("rate").cast("decimal(10,2)").cast("string"))))
    want = dict(WANT) if how == "inner" else {i: WANT.get(i) for i, _, _ in FACTS}
    assert out == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_on_dates(facts, rates, how):
    out = dict(got(asof.join_sliced(facts, rates, ["currency"], "issued", "rate_date", how)
                   .select("id", F.col("rate").cast("decimal(10,2)").cast("string"))))
    want = dict(WANT) if how == "inner" else {i: WANT.get(i) for i, _, _ in FACTS}
    assert out == want


def test_plan_is_an_equi_join(facts, rates, any_join):
    df = asof.join_daily(facts, rates, ["currency"], "issued", "rate_date")
    plan = df._jdf.queryExecution().executedPlan().toString()
    kind = "BroadcastHashJoin" if any_join == "broadcast" else "SortMergeJoin"
    assert f"{kind} [currency" in plan and "NestedLoop" not in plan


def test_no_rates_at_all(facts, rates):
    none = rates.where("false")
    assert asof.join_daily(facts, none, ["currency"], "issued", "rate_date").count() == 0
    left = asof.join_daily(facts, none, ["currency"], "issued", "rate_date", "left")
    assert left.where("rate IS NOT NULL").count() == 0 and left.count() == len(FACTS)


def test_repeated_rate_day_does_not_repeat_facts(spark, facts, rates):
    twice = rates.union(rates.where("rate_date = DATE'2025-01-10'"))
    out = asof.join_daily(facts, twice, ["currency"], "issued", "rate_date")
    assert out.count() == len(WANT)


def brute_force(left, right):
    out = {}
    for i, key, t in left:
        best = max((r for r in right if r[0] == key and r[1] <= t), key=lambda r: r[1], default=None)
        out[i] = best[2] if best else None
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed, any_join):
    rng = random.Random(seed)
    start = dt.datetime(2025, 1, 1)
    # one key holds half of everything
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice("abcd")
    minutes = rng.sample(range(60 * 24 * 40), 600)
    right = [(key(), start + dt.timedelta(minutes=m), n) for n, m in enumerate(minutes[:120])]
    left = [(i, key(), start + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    want = brute_force(left, right)
    ldf = spark.createDataFrame(left, "id int, k string, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, v int")
    out = asof.join_sliced(ldf, rdf, ["k"], "t", "rt", "left").select("id", "v")
    assert dict(got(out)) == want

    ldays = [(i, k, t.date()) for i, k, t in left]
    per_day = {}
    for k, t, v in right:
        per_day[k, t.date()] = v
    rdays = [(k, d, v) for (k, d), v in per_day.items()]
    want = brute_force(ldays, rdays)
    ldf = spark.createDataFrame(ldays, "id int, k string, t date")
    rdf = spark.createDataFrame(rdays, "k string, rt date, v int")
    out = asof.join_daily(ldf, rdf, ["k"], "t", "rt", "left").select("id", "v")
    assert dict(got(out)) == want


def test_repeated_rates_give_the_largest_whatever_the_order(spark, facts, rates):
    other = rates.withColumn("rate", F.col("rate") + 1)
    want = {i: f"{Decimal(r) + 1:.2f}" for i, r in WANT.items()}
    for both in (rates.union(other), other.union(rates).repartition(7)):
        for join in (asof.join_daily, asof.join_sliced):
            out = join(facts, both, ["currency"], "issued", "rate_date")
            assert dict(got(out.select("id", F.col("rate").cast("decimal(10,2)").cast("string")))) == want


def test_sliced_join_reads_each_side_once_and_keeps_repeated_times(spark, tmp_path):
    at = dt.datetime(2025, 1, 1, 12)
    left = [(i, "hot", at + dt.timedelta(minutes=i % 3)) for i in range(900)] + [(900, "cold", at)]
    right = [("hot", at, 1), ("hot", at, 2), ("hot", at + dt.timedelta(minutes=2), 3), ("hot", at + dt.timedelta(minutes=2), 3)]
    spark.createDataFrame(left, "id int, k string, t timestamp_ntz").write.parquet(f"{tmp_path}/left")
    spark.createDataFrame(right, "k string, rt timestamp_ntz, v int").write.parquet(f"{tmp_path}/right")
    ldf, rdf = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("left", "right"))
    out = asof.join_sliced(ldf, rdf, ["k"], "t", "rt", "left")
    assert dict(got(out.select("id", "v"))) == {i: None if i == 900 else 3 if i % 3 == 2 else 2 for i, _, _ in left}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count(f"{tmp_path}/left") == 1 and "Window" not in plan
