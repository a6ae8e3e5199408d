"""Line-first cleaning: lines are judged one by one, failing ones are removed, and documents
that lose too much text are rejected.

A line with a word fails as

* punctuation: more than one ``!`` or ``?`` for every two words, or more than one of
  ``#*$%&<>`` for every two words;
* navigation: more than one ``|`` for every three words;
* boilerplate: it holds one of ``BOILERPLATE``, or equals an earlier line of the text.

A document is kept if it passes the base rules (20 words; at most 30 % of the words in
8-word windows found twice) and its failing lines hold at most 30 % of its word characters.

Each text is judged by itself, so there is no shuffle. Words are ``[^\\x20\\x09-\\x0D]+``.
Null and empty texts have no words and are not kept. Repeated rows are judged alike; other
columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, read

#: Lower-case phrases of lines that are not prose.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "terms of use",
    "terms of service",
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST_PERCENT = 30
WINDOW = 8
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` (a power of two) words that occurs twice or more."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    span = 1
    while span < window:  # ranks of twice as long windows, exactly
        _, rank = np.unique(rank[:-span] * (int(rank.max()) + 1) + rank[span:], return_inverse=True)
        span *= 2
    start = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[start] += 1
    np.subtract.at(edge, start + window, 1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def judge_line(line: str, n: int) -> str | None:
    """Why a line of ``n`` words fails, or ``None``."""
    if 2 * (line.count("!") + line.count("?")) > n:
        return "punctuation"
    if 2 * sum(map(line.count, "#*$%&<>")) > n:
        return "punctuation"
    if 3 * line.count("|") > n:
        return "navigation"
    low = line.lower()
    return "boilerplate" if any(x in low for x in BOILERPLATE) else None


def judge(text: str | None) -> dict:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    seen, left, lost, again = set(), [], 0, 0
    for line in text.split("\n"):
        size = len(line) - sum(map(line.count, SPACES))
        if not size:
            left.append(line)
            continue
        n = len(line.encode("utf-8", "surrogatepass").split())
        repeat = line in seen
        seen.add(line)
        again += repeat
        if repeat or judge_line(line, n):
            lost += size
        else:
            left.append(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": again,
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": not failed and 100 * lost <= MAX_LOST_PERCENT * chars,
        "clean": "\n".join(left) if lost else text,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean"


def _judged(batch: pa.RecordBatch, at: int, *extra: str) -> dict[str, pa.Array]:
    rows = [judge(t) for t in batch.column(at).to_pylist()]
    kinds = dict.fromkeys(COUNTS, pa.int64()) | {"base_failed": pa.bool_(), "kept": pa.bool_(), "clean": pa.string()}
    return {c: pa.array([r[c] for r in rows], kinds[c]) for c in (*COUNTS, "base_failed", "kept", *extra)}


def clean(docs: DataFrame) -> DataFrame:
    """The documents kept, with their failing lines removed and ``n_chars`` counted anew."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    packed = docs.toDF(*names)
    schema = ", ".join(f"`{n}` {t}" for n, (_, t) in zip(names, packed.dtypes, strict=True))

    def make():
        def step(batch):
            found = _judged(batch, at, "clean")
            columns = batch.columns
            columns[at] = found["clean"]
            return pa.RecordBatch.from_arrays(columns, names).filter(found["kept"])

        return step

    out = arrow_map(packed, make, schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op3_quality_rules(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")

    def make():
        def step(batch):
            found = _judged(batch, 1)
            return pa.RecordBatch.from_arrays([batch.column(0), *found.values()], ["doc_id", *found])

        return step

    return arrow_map(docs, make, f"doc_id bigint, {VERDICT}")


_W = r"[^\x20\x09-\x0D]+"
_COUNT = "(length({0}) - length(regexp_replace({0}, '{1}', '', 'g')))"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '{_W}') AS w FROM d),
v AS (SELECT k, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) > 8),
v2 AS (SELECT k, i, array_to_string(w[i:i + 7], ' ') AS s FROM v),
v3 AS (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS n FROM v2),
rep AS (SELECT k, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM v3 WHERE n > 1) GROUP BY k),
l0 AS (SELECT k, unnest(string_split(text, chr(10))) AS line,
              unnest(range(len(string_split(text, chr(10))))) AS j FROM d),
l1 AS (SELECT k, line, j, len(regexp_extract_all(line, '{_W}')) AS n,
              length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS size,
              row_number() OVER (PARTITION BY k, line ORDER BY j) > 1 AS again FROM l0),
l2 AS (SELECT k, count(*) FILTER (WHERE again) AS n_dup_lines,
              coalesce(sum(size) FILTER (WHERE again
                OR 2 * {_COUNT.format("line", "[!?]")} > n
                OR 2 * {_COUNT.format("line", "[#*$%&<>]")} > n
                OR 3 * {_COUNT.format("line", "[|]")} > n
                OR regexp_matches(lower(line), '{"|".join(BOILERPLATE)}')), 0) AS lost
       FROM l1 WHERE n > 0 GROUP BY k),
t AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST({_COUNT.format("text", "[#*$%&|<>]")} AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM w LEFT JOIN rep USING (k) LEFT JOIN l2 USING (k)),
u AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {MAX_LOST_PERCENT} * word_chars AS kept FROM u
"""
