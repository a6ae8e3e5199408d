import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import got
from tradelane.operators.sequence import with_previous


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_lag(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2025, 3, 1)
    rows = []
    for i in range(400):
        who = "hot" if rng.random() < 0.4 else rng.choice("abcdef")
        # many events share a minute, some days are empty
        at = start + dt.timedelta(minutes=rng.choice([0, 1, 2, 1440, 1500, 2880 * 3, 100_000]) + i % 5)
        rows.append((i, who, at, f"t{i % 7}"))
    df = spark.createDataFrame(rows, "id int, who string, at timestamp_ntz, kind string")
    w = Window.partitionBy("who").orderBy("at", "id")
    want = df.select("id", F.lag("kind").over(w), F.lag("at").over(w))
    out = with_previous(df, ["who"], ["at", "id"], {"kind": "pk", "at": "pa"}, F.to_date("at"))
    assert sorted(got(out, "id", "pk", "pa"), key=str) == sorted(got(want), key=str)


def test_null_values_in_the_previous_row_stay_null(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (2, "a", 2, "x"), (3, "a", 12, "y")],
                               "id int, who string, at int, kind string")
    out = with_previous(df, ["who"], ["at"], {"kind": "pk", "id": "pid"}, F.col("at").cast("int") / 10)
    assert sorted(got(out, "id", "pk", "pid"), key=str) == [(1, None, None), (2, None, 1), (3, "x", 2)]
