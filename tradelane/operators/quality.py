"""Data-quality checks as violation counts, few scans, and the gate on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelane.schemas import Table

CRITICAL = "critical"
WARNING = "warning"


class QualityGateError(RuntimeError):
    """A critical check found violations."""


def stacked(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One pass for any number of counts: ``check_name, severity, violations``.

    Each check is (name, severity, aggregate over ``df``).
    """
    counts = df.agg(
        *[
            F.coalesce(count, F.lit(0)).cast("bigint").alias(f"c{i}")
            for i, (_, _, count) in enumerate(checks)
        ]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(severity).alias("severity"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, (name, severity, _) in enumerate(checks)
        ]
    )
    return counts.select(F.explode(lines).alias("r")).select("r.*")


def rows_where(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Like :func:`stacked`, with a row predicate in place of an aggregate."""
    return stacked(df, [(n, s, F.count(F.when(condition, 1))) for n, s, condition in checks])


def total(df: DataFrame, name: str, severity: str, violations: Column) -> DataFrame:
    """A single check whose count is an aggregate over ``df``."""
    return stacked(df, [(name, severity, violations)])


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows use each: ``key, n``.

    Rows are counted per key before the anti-join, so a key with very many
    rows is a single row in the join. NULL keys are orphans too.
    """
    counts = child.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n"))
    return counts.join(
        parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti"
    ).withColumnRenamed("_key", key)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _key_text(columns: Sequence[Column]) -> Column:
    """Text that is equal for equal keys only; NULLs are equal."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def declared(
    tables: dict[str, DataFrame], specs: dict[str, Table], names: Sequence[str] | None = None
) -> DataFrame:
    """Declared constraints as checks: ``table_name, constraint_name, violations``.

    Key: rows beyond the first of each key. Required: NULLs. Reference:
    non-NULL values missing in the parent. Check: rows where it is false.

    Every table is read once: a row says, for each constraint it has a part in, the constraint's
    number and the key (its own, one it refers to, one it offers to others). All tables' keys meet
    in one exchange, counted on the map side first, so a key held by very many rows is few there.
    """
    labels: list[tuple[str, str]] = []
    lines: dict[str, list[Column]] = {name: [] for name in tables}
    unique, reference = [], []

    def add(table: str, label: str) -> int:
        labels.append((table, label))
        return len(labels) - 1

    def line(number: int, key: Column, mine: int = 1, when: Column | None = None) -> Column:
        said = F.struct(F.lit(number).alias("_no"), key.alias("_key"), F.lit(mine).cast("bigint").alias("_mine"))
        return said if when is None else F.when(when, said)

    for name in names or list(tables):
        spec, df = specs[name], tables[name]
        for column in [*spec.key, *spec.required]:
            number = add(name, f"not null: {column}")
            lines[name].append(line(number, F.lit(""), when=F.col(column).isNull()))
        for label, predicate in spec.checks.items():
            lines[name].append(line(add(name, f"check: {label}"), F.lit(""), when=~F.expr(predicate)))
        if spec.key:
            unique.append(add(name, "unique: " + ", ".join(spec.key)))
            lines[name].append(line(unique[-1], _key_text([F.col(c) for c in spec.key])))
        for column, (parent, parent_key) in spec.references.items():
            if parent not in tables:
                continue
            reference.append(add(name, f"reference: {column} -> {parent}"))
            own, kind = F.col(column), tables[parent].schema[parent_key].dataType
            if df.schema[column].dataType != kind:
                own = own.cast(kind)
            lines[name].append(line(reference[-1], _key_text([own]), when=F.col(column).isNotNull()))
            lines[parent].append(line(reference[-1], _key_text([F.col(parent_key)]), mine=0))
    said = union([
        tables[name].select(F.inline(F.array_compact(F.array(*parts)))) for name, parts in lines.items() if parts
    ])
    keys = said.groupBy("_no", "_key").agg(F.sum("_mine").alias("n"), F.min("_mine").alias("_least"))
    number = F.col("_no")
    wrong = (
        F.when(number.isin(unique), F.col("n") - 1)
        .when(number.isin(reference), F.when(F.col("_least") == 1, F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    totals = keys.groupBy("_no").agg(F.sum(wrong).alias("_n"))
    named = [
        F.struct(F.lit(i).alias("_no"), F.lit(t).alias("table_name"), F.lit(c).alias("constraint_name"))
        for i, (t, c) in enumerate(labels)
    ]
    listed = said.sparkSession.range(1).select(F.inline(F.array(*named)))
    return (
        listed.join(F.broadcast(totals), "_no", "left")  # a row per constraint
        .select("table_name", "constraint_name", F.coalesce("_n", F.lit(0)).cast("bigint").alias("violations"))
        .orderBy("table_name", "constraint_name")
    )


def failing(checks: DataFrame) -> DataFrame:
    return checks.where((F.col("severity") == CRITICAL) & (F.col("violations") > 0))


def gate(checks: DataFrame) -> None:
    """Raise if a critical check has violations. ``checks`` is one row per check."""
    bad = failing(checks).orderBy("check_name").collect()
    if bad:
        lines = "; ".join(f"{r['check_name']}: {r['violations']}" for r in bad)
        raise QualityGateError(lines)
