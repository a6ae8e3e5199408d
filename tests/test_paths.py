from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import got
from tradelane.marts import network
from tradelane.operators import paths


def edges(spark, rows):
    return spark.createDataFrame(
        [(a, b, m, d, Decimal(c)) for a, b, m, d, c in rows],
        "origin string, dest string, mode string, days int, cost decimal(8,2)",
    )


def nodes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "node string")


GRAPH = [
    ("a", "b", "sea", 1, 10), ("a", "b", "rail", 2, 5),  # two modes on one pair
    ("b", "a", "sea", 1, 1),  # back: cycle
    ("b", "c", "sea", 1, 1), ("c", "d", "sea", 1, 1), ("d", "e", "sea", 1, 1),
    ("a", "a", "sea", 1, 1),  # self-loop
    ("x", "y", "sea", 1, 1),  # unreachable
]


def test_all_simple_paths(spark):
    out = paths.expand(edges(spark, GRAPH), nodes(spark, "a"))
    texts = sorted((r.path, r.legs) for r in out.select(paths.path_text("path", ">").alias("path"), "legs").collect())
    # a self-loop can only be a first leg: later legs never return to a seen node
    assert texts == [
        ("a>a", 1), ("a>a>b", 2), ("a>a>b", 2), ("a>a>b>c", 3), ("a>a>b>c", 3),
        ("a>b", 1), ("a>b", 1), ("a>b>c", 2), ("a>b>c", 2), ("a>b>c>d", 3), ("a>b>c>d", 3),
    ]
    assert all(t.count("e") == 0 for t, _ in texts)  # four legs away


def test_target_filter_equals_filtering_everything(spark):
    e = edges(spark, GRAPH)
    every = paths.expand(e, nodes(spark, "a"))
    for target in "bcde":
        aimed = paths.expand(e, nodes(spark, "a"), nodes(spark, target))
        assert sorted(map(str, got(aimed))) == sorted(map(str, got(every.where(f"dest = '{target}'"))))


def test_two_modes_keep_their_own_sums(spark):
    out = paths.expand(edges(spark, GRAPH), nodes(spark, "a"), nodes(spark, "c"), 3, 2, 3)
    out = out.where("path[1] <> 'a' AND legs = 2")
    assert sorted(got(out.selectExpr("array_join(modes, '/')", "days", "double(cost)"))) == [
        ("rail/sea", 2 + 1 + 2 + 3, 6.0), ("sea/sea", 1 + 1 + 2 + 3, 11.0)]


def test_single_leg(spark):
    out = paths.expand(edges(spark, GRAPH), nodes(spark, "b"), nodes(spark, "c"), 1)
    assert got(out, "origin", "dest", "legs") == [("b", "c", 1)]


def test_cheapest_routes_to_shanghai(routes):
    out = network.route_pathfinding({"shipping_routes": routes}, "UAODS", ["CNSHA"])
    assert got(out) == [
        ("UAODS → EGALY → CNSHA", 2, "sea / sea", 6 + 15, 65.0, 1, 1),
        ("UAODS → PLGDN → CNSHA", 2, "rail / sea", 3 + 30, 90.0, 2, 2),
    ]


def test_names_replace_codes_in_order(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["c", "zz", "a"])], "id int, path array<string>")
    names = spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), ("c", "Gamma")], "node string, name string")
    out = paths.with_names(df, names, ["id"], "path", "text")
    assert sorted(got(out)) == [(1, "Alpha → Beta → Gamma"), (2, "Gamma → zz → Alpha")]


def test_worse_parallel_edges_change_no_best_path(spark):
    import random

    rng = random.Random(3)
    rows = [(a, b, f"m{i}", rng.randrange(1, 9), rng.randrange(1, 30)) for a in "abcd" for b in "bcde" if a != b for i in range(5)]
    e = edges(spark, rows)

    def best(frame):
        out = paths.expand(frame, nodes(spark, "a"), nodes(spark, "e", "d"))
        value = F.col("cost").cast("double") + F.col("days") * 1.5
        w = Window.partitionBy("dest").orderBy(value, paths.path_text("path"), "days", "cost")
        return sorted(got(out.withColumn("n", F.row_number().over(w)).where("n <= 2"), "dest", "n", "path", "days", "cost"))

    few = paths.best_edges(e, 2, 1.5)
    assert few.count() < len(rows) / 2 and best(few) == best(e)
    # equal edges all stay: which of them counts is for the caller to say
    same = edges(spark, [("a", "b", m, 2, 7) for m in "xyz"] + [("a", "b", "w", 4, 4)])
    assert paths.best_edges(same, 1, 1.5).count() == 4


def test_names_grow_with_the_path(spark):
    names = spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), ("d", "Delta")], "node string, name string")
    out = paths.expand(edges(spark, GRAPH), nodes(spark, "a"), nodes(spark, "d"), names=names)
    assert {tuple(r.names) for r in out.where("path[1] <> 'a'").collect()} == {("Alpha", "Beta", "c", "Delta")}


def test_ranks_of_the_kept_are_ranks_among_all(routes):
    every = {(r.routing, r.modes, r.transit_days, r.cost_per_cbm_usd): (r.cost_rank, r.speed_rank)
             for r in network.route_pathfinding({"shipping_routes": routes}, "UAODS", ["CNSHA", "NLRTM"], top=None).collect()}
    few = network.route_pathfinding({"shipping_routes": routes}, "UAODS", ["CNSHA", "NLRTM"], top=2).collect()
    assert all(every[r.routing, r.modes, r.transit_days, r.cost_per_cbm_usd] == (r.cost_rank, r.speed_rank) for r in few)
    assert network.route_pathfinding({"shipping_routes": routes.limit(0)}, "UAODS", ["CNSHA"]).count() == 0


def test_branch_and_bound_finds_the_best_of_every_request(spark):
    import random

    for seed, keep, legs in ((1, 1, 3), (2, 3, 3), (3, 2, 4), (4, 3, 2), (5, 2, 1)):
        rng = random.Random(seed)
        some = "abcdefghij"
        rows = [(a, b, f"m{i}", rng.randrange(1, 9), rng.randrange(1, 20)) for a in some for b in some
                for i in range(rng.randrange(3)) if rng.random() < 0.6]  # self-loops and parallel edges, many equal values
        e = edges(spark, rows)
        asked = spark.createDataFrame([(a, g) for a in "abcx" for g in "PQR"], "origin string, goal string")
        ends = spark.createDataFrame(
            [(n, g, rng.randrange(5), Decimal(rng.randrange(9))) for n in "ghij" for g in "PQ" for _ in range(2)] + [("b", "P", 0, Decimal(0))],
            "node string, goal string, more int, extra decimal(8,2)")

        def chosen(found):
            value = (F.col("cost") + F.col("extra")).cast("double") + (F.col("days") + F.col("more")) * 1.5
            w = Window.partitionBy("origin", "goal").orderBy("value", paths.path_text("path"), paths.path_text("modes"), "extra", "more")
            goals = ["dest", "goal"] if "goal" in found.columns else "dest"
            all_ends = found.join(ends.withColumnRenamed("node", "dest"), goals).join(asked, ["origin", "goal"])
            best = all_ends.withColumn("value", value).withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep)
            return sorted(got(best, "origin", "goal", "n", "path", "modes", "days", "cost", "value"))

        every = paths.expand(e, asked.select(F.col("origin").alias("node")), ends.select("node").distinct(), legs, 2, 3)
        few = paths.best(e, asked, ends.selectExpr("node", "goal", "more AS days", "extra AS cost"), keep, 1.5, legs, 2, 3)
        assert chosen(few) == chosen(every) and len(chosen(few)) > 4
        assert few.count() == few.distinct().count()
        if legs > 2:  # of what is listed per origin and end there
            assert few.count() < every.count() / 4


def test_branch_and_bound_of_nothing(spark):
    none = edges(spark, [])
    asked = spark.createDataFrame([("a", "P")], "origin string, goal string")
    ends = spark.createDataFrame([("b", "P", 1, Decimal(1))], "node string, goal string, days int, cost decimal(8,2)")
    names = spark.createDataFrame([("a", "Alpha")], "node string, name string")
    assert paths.best(none, asked, ends, 3, 1.5, names=names).count() == 0
    one = paths.best(edges(spark, [("a", "b", "sea", 1, 1)]), asked, ends, 3, 1.5, names=names)
    assert got(one, "path", "names", "legs") == [(["a", "b"], ["Alpha", "b"], 1)]
