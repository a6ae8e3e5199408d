"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return ("ts", value.isoformat())
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return repr(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in data), key=lambda t: tuple(map(repr, t))
    )


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN"}


def check(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """``None`` when rows, column names and types agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows(df.columns, df.collect())
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    theirs = rows(columns, res.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    types = {c: (SPARK_KIND.get(t, t), kinds[c]) for c, t in df.dtypes}
    off = {c: t for c, t in types.items() if t[0] != t[1]}
    if ours != theirs:
        gone = [x for x in theirs if x not in set(ours)][:3]
        extra = [x for x in ours if x not in set(theirs)][:3]
        return f"{len(ours)} vs {len(theirs)} rows\n   ours   {extra}\n   theirs {gone}\n   types {off}"
    if off:
        return f"types {off}"
    return None if ours else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            problem = check(spark, con, name, sf_dir)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {time.time() - t0:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
