"""Simple paths of bounded length over a directed edge table."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelane.session import materialize

ARROW = " → "


def best_edges(edges: DataFrame, keep: int, day_value: float) -> DataFrame:
    """The ``keep`` best parallel edges of every pair of nodes by cost and valued days, equal ones all.

    For the ``keep`` best paths by that value no other edge is of use: a path over a worse one
    stands behind ``keep`` paths over the same nodes. Values are exact decimals.
    """
    value = F.col("cost").cast("decimal(18,2)") + F.col("days") * F.lit(Decimal(str(day_value)))
    order = Window.partitionBy("origin", "dest").orderBy(value)
    return edges.withColumn("_n", F.rank().over(order)).where(F.col("_n") <= keep).drop("_n")


def expand(
    edges: DataFrame,
    sources: DataFrame,
    targets: DataFrame | None = None,
    max_legs: int = 3,
    first_leg_days: int = 0,
    next_leg_days: int = 0,
    names: DataFrame | None = None,
) -> DataFrame:
    """All cycle-free paths of 1..``max_legs`` edges from the source nodes.

    ``edges`` has ``origin, dest, mode, days, cost``; ``sources`` and
    ``targets`` have ``node``. The depth is a constant, so the recursion is
    unrolled into ``max_legs`` equi-joins. With targets given, the last and
    widest hop meets only edges that end in a target. With ``names`` (``node, name``)
    the labels of a path's nodes grow beside it in ``names``; a node without a name is its own.
    """
    edges = edges.select("origin", "dest", "mode", "days", "cost")
    if names is not None:
        for end in ("origin", "dest"):
            label = names.select(F.col("node").alias(end), F.col("name").alias(f"{end}_name"))
            edges = edges.join(label, end, "left").withColumn(f"{end}_name", F.coalesce(f"{end}_name", end))
    goal = None
    if targets is not None:
        goal = targets.select(F.col("node").alias("dest"))
    starts = sources.select(F.col("node").alias("origin"))

    frontier = edges.join(starts, "origin", "left_semi").select(
        "origin",
        "dest",
        F.array("origin", "dest").alias("path"),
        F.array("mode").alias("modes"),
        (F.col("days") + first_leg_days).cast("bigint").alias("days"),
        F.col("cost").cast("decimal(18,2)").alias("cost"),
        F.lit(1).cast("bigint").alias("legs"),
        *([F.array("origin_name", "dest_name").alias("names")] if names is not None else []),
    )
    hop = edges.select(
        F.col("origin").alias("_from"), F.col("dest").alias("_to"), F.col("mode").alias("_mode"),
        F.col("days").alias("_days"), F.col("cost").alias("_cost"),
        *([F.col("dest_name").alias("_name")] if names is not None else []),
    )
    found = [frontier]
    for leg in range(2, max_legs + 1):
        if leg == max_legs and goal is not None:
            hop = hop.join(goal.toDF("_to"), "_to", "left_semi")
        frontier = (
            frontier.join(hop, F.col("dest") == F.col("_from"))
            .where(~F.array_contains(F.col("path"), F.col("_to")))
            .select(
                "origin",
                F.col("_to").alias("dest"),
                F.array_append("path", F.col("_to")).alias("path"),
                F.array_append("modes", F.col("_mode")).alias("modes"),
                (F.col("days") + F.col("_days") + next_leg_days).alias("days"),
                (F.col("cost") + F.col("_cost")).cast("decimal(18,2)").alias("cost"),
                F.lit(leg).cast("bigint").alias("legs"),
                *([F.array_append("names", F.col("_name")).alias("names")] if names is not None else []),
            )
        )
        found.append(frontier)
    if goal is None:
        return reduce(DataFrame.unionByName, found)
    # the last hop of a longer walk has met the goal already
    done = found[1:][-1:] if max_legs > 1 else []
    rest = found[: max_legs - len(done)]
    ended = reduce(DataFrame.unionByName, rest).join(goal, "dest", "left_semi")
    return reduce(DataFrame.unionByName, [ended, *done]).select(*frontier.columns)


def _ahead(hops: DataFrame, ends: DataFrame, legs: int) -> DataFrame:
    """Per ``node, goal``: ``ahead_0``, the least that ends a path here, and ``ahead_i``, the least
    that 1 to ``i`` further edges and an end add."""
    steps = [ends.groupBy("node", "goal").agg(F.min("value").alias("value"))]
    least = steps[0]
    for _ in range(legs):
        onward = (
            hops.join(least.select(F.col("node").alias("dest"), "goal", F.col("value").alias("rest")), "dest")
            .groupBy(F.col("origin").alias("node"), "goal")
            .agg(F.min(F.col("value") + F.col("rest")).cast("decimal(30,10)").alias("value"))
        )
        steps.append(onward)
        least = steps[0].unionByName(onward)
    tagged = reduce(DataFrame.unionByName, [step.withColumn("i", F.lit(i)) for i, step in enumerate(steps)])
    return tagged.groupBy("node", "goal").agg(
        *[F.min(F.when(F.col("i") == i, F.col("value"))).alias(f"ahead_{i}") for i in range(legs + 1)]
    )


def best(
    edges: DataFrame,
    requests: DataFrame,
    ends: DataFrame,
    keep: int,
    day_value: float,
    max_legs: int = 3,
    first_leg_days: int = 0,
    next_leg_days: int = 0,
    names: DataFrame | None = None,
) -> DataFrame:
    """Per request the paths of 1..``max_legs`` edges among which its ``keep`` best are found.

    ``requests`` has ``origin, goal``; ``ends`` has ``node, goal, days, cost``: what is added where a
    path ends at ``node`` for ``goal``. A path's value is its cost plus ``day_value`` per day. The
    result has the columns of :func:`expand` and ``goal``, equal values all included.

    Branch and bound, one exchange by request and leg. Backwards from the ends, the least value
    still to come is found for every node and goal. Forwards, a path goes on only if its value and
    that least are within the ``keep`` best whole paths known for its request, and if it is among the
    ``keep`` best over the same nodes to the same node. Values are exact decimals. A leg's rows are
    written, so what a lost executor costs is one leg.
    """
    day = F.lit(Decimal(str(day_value)))

    def worth(days: Column) -> Column:
        return (F.col("cost").cast("decimal(18,2)") + days * day).cast("decimal(30,10)")

    edges = materialize(best_edges(edges.select("origin", "dest", "mode", "days", "cost"), keep, day_value), "edges")
    ahead = _ahead(
        edges.select("origin", "dest", worth(F.col("days") + next_leg_days).alias("value")),
        ends.select("node", "goal", worth(F.col("days")).alias("value")),
        max_legs - 1,
    )
    ahead = materialize(ahead, "ahead").withColumnRenamed("node", "dest")
    more = []
    if names is not None:
        more = ["names"]
        for end in ("origin", "dest"):
            label = names.select(F.col("node").alias(end), F.col("name").alias(f"{end}_name"))
            edges = edges.join(label, end, "left").withColumn(f"{end}_name", F.coalesce(f"{end}_name", end))
    columns = ["origin", "goal", "dest", "path", "modes", "days", "cost", "legs", *more]
    hop = edges.select(
        F.col("origin").alias("_from"), F.col("dest").alias("_to"), F.col("mode").alias("_mode"),
        F.col("days").alias("_days"), F.col("cost").alias("_cost"), *[F.col("dest_name").alias("_name") for _ in more],
    )
    frontier = edges.join(requests.select("origin", "goal").distinct(), "origin").select(
        "origin", "goal", "dest", F.array("origin", "dest").alias("path"), F.array("mode").alias("modes"),
        (F.col("days") + first_leg_days).cast("bigint").alias("days"), F.col("cost").cast("decimal(18,2)").alias("cost"),
        F.lit(1).cast("bigint").alias("legs"), *[F.array("origin_name", "dest_name").alias("names") for _ in more],
    )

    def within(value: str) -> Column:
        return F.col(value).isNotNull() & (F.col("_limit").isNull() | (F.col(value) <= F.col("_limit")))

    request = Window.partitionBy("origin", "goal")
    alike = Window.partitionBy("origin", "goal", "dest", "_nodes").orderBy("value")
    kept = None
    for leg in range(1, max_legs + 1):
        if leg > 1:
            frontier = (
                kept.where("_going").join(hop, F.col("dest") == F.col("_from"))
                .where(~F.array_contains(F.col("path"), F.col("_to")))
                .select(
                    "origin", "goal", F.col("_to").alias("dest"), F.array_append("path", F.col("_to")).alias("path"),
                    F.array_append("modes", F.col("_mode")).alias("modes"),
                    (F.col("days") + F.col("_days") + next_leg_days).alias("days"),
                    (F.col("cost") + F.col("_cost")).cast("decimal(18,2)").alias("cost"),
                    F.lit(leg).cast("bigint").alias("legs"), *[F.array_append("names", F.col("_name")).alias("names") for _ in more],
                )
            )
        rest = F.col(f"ahead_{max_legs - leg}") if leg < max_legs else F.lit(None)
        rows = (
            frontier.join(ahead, ["dest", "goal"])
            .withColumn("value", worth(F.col("days")))
            .withColumn("_whole", (F.col("value") + F.col("ahead_0")).cast("decimal(30,10)"))
            .withColumn("_least", (F.col("value") + rest).cast("decimal(30,10)"))
            .select(*columns, "value", "_whole", "_least")
        )
        if kept is not None:  # whole paths of fewer legs stay in the contest
            rows = rows.unionByName(kept.where("_ended").select(*columns, "value", "_whole", F.lit(None).cast("decimal(30,10)").alias("_least")))
        place = F.row_number().over(request.orderBy(F.asc_nulls_last("_whole")))
        rows = (
            rows.withColumn("_nodes", F.array_sort("path"))
            .withColumn("_limit", F.when(place == keep, F.col("_whole")))
            .withColumn("_limit", F.max("_limit").over(request))
        )
        kept = rows.withColumn("_ended", within("_whole"))
        if leg < max_legs:
            kept = (
                kept.withColumn("_going", within("_least") & (F.rank().over(alike) <= keep))
                .where(F.col("_ended") | F.col("_going"))
                .select(*columns, "value", "_whole", "_ended", "_going")
            )
            kept = materialize(kept, "paths")
    return kept.where("_ended").select(columns)


def path_text(col: Column | str = "path", sep: str = ARROW) -> Column:
    return F.array_join(F.col(col) if isinstance(col, str) else col, sep)


def with_names(
    df: DataFrame, names: DataFrame, key: list[str], path: str, out: str, sep: str = ARROW
) -> DataFrame:
    """Replace node codes along ``path`` by their names, keeping the order.

    ``names`` has ``node, name``; ``key`` identifies a row of ``df``. A code
    without a name stays as it is. Each regrouped list is one path long.
    """
    steps = df.select(*key, F.posexplode(path).alias("_pos", "node")).join(names, "node", "left")
    labels = steps.groupBy(*key).agg(
        F.array_sort(
            F.collect_list(F.struct("_pos", F.coalesce("name", "node").alias("_label")))
        ).alias("_steps")
    )
    return labels.select(
        *key, F.array_join(F.transform("_steps", lambda s: s["_label"]), sep).alias(out)
    )
