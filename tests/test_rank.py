import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import got
from tradelane.operators import rank


def frame(spark, values):
    return spark.createDataFrame(
        [(i, v, (v or 3) * 7 % 11) for i, v in enumerate(values)], "id int, v int, w int"
    )


rng = random.Random(7)
CASES = {
    "spread": [rng.randrange(10**6) for _ in range(503)],
    "all ties": [5] * 57,
    "third in one value": [0 if i % 3 == 0 else rng.randrange(-50, 50) for i in range(601)],
    "two hot values": [rng.choice([1, 1, 9, 9, i]) for i in range(400)],
    "fewer than tiles": [3, 1, 2],
    "nulls": [None if i % 4 == 0 else i % 9 for i in range(203)],
    "nulls only": [None] * 23,
    "one row": [4],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_ntile_equals_one_big_window(spark, case):
    df = frame(spark, CASES[case])
    tiles = [rank.Tile("up", "v"), rank.Tile("down", "v", True), rank.Tile("other", "w")]
    want = df.select(
        "id",
        F.ntile(5).over(Window.orderBy("v", "id")).alias("up"),
        F.ntile(5).over(Window.orderBy(F.desc("v"), "id")).alias("down"),
        F.ntile(5).over(Window.orderBy("w", "id")).alias("other"),
    )
    out = rank.ntile(df, tiles, "id", 5, slices=8)
    assert sorted(got(out, "id", "up", "down", "other")) == sorted(got(want))


@pytest.mark.parametrize("case", [c for c in CASES if c != "none"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_total_and_rank(spark, case, descending):
    df = frame(spark, CASES[case])
    w = Window.orderBy(F.desc("v") if descending else F.asc("v"))
    want = df.select("id", F.sum("w").over(w).alias("run"), F.rank().over(w).alias("rk"))
    for slices in (None, 7):
        out = rank.running_total(df, "v", "w", descending, "run", "all", slices)
        out = rank.rank(out, "v", "rk", descending, slices)
        assert out.columns == ["id", "v", "w", "run", "all", "rk"]
        assert sorted(got(out, "id", "run", "rk")) == sorted(got(want))
        assert {r[0] for r in got(out, "all")} == {sum(r[0] for r in got(df, "w"))}


def test_no_task_orders_the_whole_table(spark):
    df = frame(spark, CASES["spread"])
    out = rank.ntile(df, [rank.Tile("up", "v")], "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_plan_does_not_grow_with_rows(spark):
    """No cut is a literal: plans of a hundred and of two hundred thousand rows are as long."""

    def plans(n):
        df = spark.range(n).select("id", (F.col("id") * 7919 % 100_003).alias("v"), F.lit(1).alias("w"))
        shares = rank.running_total(df, "v", "w", True, "run", "all")
        tiled = rank.ntile(df, [rank.Tile("up", "v")], "id")
        return [len(re.sub(r"[\d.]+|file:\S+", "", x._jdf.queryExecution().optimizedPlan().toString())) for x in (shares, tiled)]

    assert all(abs(a - b) < 40 for a, b in zip(plans(100), plans(200_000)))


def test_very_many_slices(spark):
    n = 20_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 5003).alias("v"))
    out = rank.ntile(rank.rank(df, "v", "rk", slices=1500), [rank.Tile("t", "v", True)], "id", 7, slices=1500)
    hot = out.where("v = 0 AND id % 3 = 0").select("rk").distinct().collect()
    assert [r.rk for r in hot] == [1]
    w = Window.orderBy(F.desc("v"), "id")
    want = df.select("id", F.rank().over(Window.orderBy("v")).alias("rk"), F.ntile(7).over(w).alias("t"))
    assert out.select("id", "rk", "t").exceptAll(want).count() == 0
