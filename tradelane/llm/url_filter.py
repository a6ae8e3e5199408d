"""URL filtering by host-suffix and path-prefix expressions.

Rules are a table (``host, path, verdict``). Every distinct (host, path) of the urls is
expanded into its host suffixes times the path prefixes that some rule is long enough for, each
expression is digested, and digests are joined to the rules' on a short prefix, then
confirmed in full. The longest rule that fits decides (then the longest host, then block).

Only expressions that hit a rule go on, one winner per url; the urls are joined back by row
values, so a hot host is one distinct expression set per path. Rules are a joined table of any
size: whether it is broadcast is left to the planner's size check.

Null urls and urls without ``://`` have an empty host and path and get the default verdict, as
do urls that no rule fits. Repeated rows are judged alike. An empty host label is no rule's host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import read

#: The contract's rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
#: Hex digits of a digest that the join is on.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` and ``path``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return df.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn("path", path)


def judge(urls: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``urls`` (with ``host, path``) plus ``rule`` and ``verdict``."""
    rules = rules.select("host", "path", "verdict").withColumn("text", F.concat("host", "path"))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # at most a url's length
    digests = rules.select(
        F.sha2("text", 256).alias("_digest"), F.col("text").alias("_rule"),
        F.struct(
            F.length("text").alias("size"), F.length("host").alias("host_size"),
            (F.col("verdict") == "block").alias("block"), F.col("text").alias("rule"), F.col("verdict").alias("verdict"),
        ).alias("_won"),
    ).withColumn("_short", F.substring("_digest", 1, SHORT))
    known = urls.select("host", "path").distinct().where("host != ''")
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    expressions = (
        known.withColumn("_suffix", F.explode(suffixes))
        .withColumn("_size", F.explode(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")))
        .where((F.length("path") >= F.col("_size")) & (F.col("_suffix") != ""))
        .withColumn("_digest", F.sha2(F.concat("_suffix", F.substring("path", F.lit(1), F.col("_size"))), 256))
        .withColumn("_short", F.substring("_digest", 1, SHORT))
    )
    won = (
        expressions.join(digests.withColumnRenamed("_digest", "_full"), "_short")
        .where("_digest = _full")
        .groupBy("host", "path")
        .agg(F.max("_won").alias("_won"))
    )
    return (
        urls.join(won, ["host", "path"], "left")
        .withColumn("rule", F.col("_won.rule"))
        .withColumn("verdict", F.coalesce("_won.verdict", F.lit(default)))
        .select(*urls.columns, "rule", "verdict")
    )


def op6_url_filters(spark, sf_dir) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = split_url(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path")
    return judge(pages, rules)


SQL = rf"""
WITH rules(h, p, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
u AS (SELECT row_number() OVER () AS k, page_id,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT k, page_id, regexp_extract(rest, '^[^/?#]*') AS host0, rest FROM u),
v AS (SELECT k, page_id, translate(host0, '{UPPER}', '{LOWER}') AS host,
        regexp_extract(substr(rest, length(host0) + 1), '^[^?#]*') AS path FROM s),
m AS (SELECT v.k, h || p AS rule, verdict,
        row_number() OVER (PARTITION BY v.k ORDER BY length(h || p) DESC, length(h) DESC) AS r
      FROM v JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM v LEFT JOIN m ON v.k = m.k AND m.r = 1
"""
