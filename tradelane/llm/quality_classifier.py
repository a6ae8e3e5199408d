"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Only the
counts of their vote patterns (at most 3 to the number of labellers, whatever the corpus)
reach the driver, where expectation-maximisation finds each labeller's accuracy and the
posterior of every pattern. The posteriors label a bounded sample (``SAMPLE`` documents by
hash, or a little over by chance; the vote counts cover all), on which a linear scorer over hashed byte trigrams and
hashed shape buckets is trained: shard by shard, weights averaged. The scorer then judges every
document. No given label is used.

Null and empty texts have no features: score 0, not kept. Texts of any length are read whole.
Equal rows get equal scores; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, read

#: Documents the scorer is trained on, and the shards they are dealt to.
SAMPLE, SHARDS = 16_000, 8
SIZE = 4096
GOOD, ABSTAIN, BAD = 2, 1, 0


#: A word of letters, closed by at most one mark.
PLAIN = re.compile(rb"(?<!\S)[A-Za-z'\x80-\xff-]+[.,;:]?(?!\S)")


def measures(text: bytes) -> list[float]:
    """What the labellers look at."""
    words = text.split()
    n = max(len(words), 1)
    letters = sum(map(text.count, (b"e", b"a", b"i", b"n"))) + 1
    capitals = sum(map(text.count, (b"E", b"A", b"I", b"N")))
    symbols = sum(map(text.count, (b"#", b"*", b"$", b"%", b"&")))
    return [
        symbols / n,
        capitals / (letters + capitals),
        (text.count(b"!") + text.count(b"?")) / n,
        (text.count(b"|") + text.count(b"<")) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        (1 - len(set(words)) / n) * min(1.0, n / 40),
        1 - (len(set(zip(words, words[1:], strict=False))) + 1) / n,
        1 - sum(1 for _ in PLAIN.finditer(text)) / n,
        n / (text.count(b".") + 1) / 200,
    ]


#: Per measure: at most this is a vote for good (None: never), at least that one for bad.
LIMITS = [
    (None, 0.4), (None, 0.5), (None, 0.3), (None, 0.3), (None, 0.3), (None, 0.8), (None, 0.5), (0.05, 0.3), (None, 0.5)
]


def votes(values: list[float]) -> list[int]:
    return [
        BAD if v >= bad else GOOD if good is not None and v <= good else ABSTAIN
        for v, (good, bad) in zip(values, LIMITS, strict=True)
    ]


def features(text: bytes, values: list[float]) -> np.ndarray:
    """Unit vector of hashed byte trigrams, then hashed buckets of the measures."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    out = np.zeros(SIZE, dtype=np.float32)
    if len(data) > 2:
        h = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out += np.bincount(h >> np.uint32(20), minlength=SIZE)
        out /= np.sqrt(np.square(out).sum())
    for i, v in enumerate(values):
        bucket = min(max(int(v * 10), 0), 15)
        out[(i * 16 + bucket) * 37 % SIZE] += 0.5
    return out


def patterns(docs: DataFrame) -> dict[int, int]:
    """Documents per vote pattern."""

    def make():
        def step(batch):
            codes = [_code(votes(measures(t))) for t in batch.column(0).to_pylist() if t]
            code, n = np.unique(np.array(codes, dtype=np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

        return step

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    found = arrow_map(texts, make, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    return {r.code: r.n for r in sorted(found)}


def _code(v: list[int]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


def estimate(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Posterior of good for each vote pattern, by expectation-maximisation.

    ``right[j]`` is the chance that labeller ``j`` is right when it votes; those that
    abstain say nothing.
    """
    if not counts:
        return {}
    codes = np.array(sorted(counts))
    n = np.array([counts[c] for c in codes], dtype=float)
    vote = codes[:, None] // 3 ** np.arange(len(LIMITS)) % 3
    up, down = vote == GOOD, vote == BAD
    right, prior = np.full(len(LIMITS), 0.8), 0.8
    for _ in range(rounds):
        lean = np.log(prior / (1 - prior)) + (up.astype(float) - down) @ np.log(right / (1 - right))
        good = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
        agree = ((up * good[:, None] + down * (1 - good)[:, None]) * n[:, None]).sum(axis=0)
        # ten votes, eight of them right, stand for what is known beforehand
        right = np.clip((agree + 8) / (((up | down) * n[:, None]).sum(axis=0) + 10), 0.55, 0.95)
        prior = np.clip((good * n).sum() / n.sum(), 0.05, 0.95)
    return dict(zip(codes.tolist(), good.tolist(), strict=True))


def fit(x: np.ndarray, target: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic regression by accelerated gradient; classes weigh alike. Last weight: constant."""
    x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    good = target.sum()
    weight = np.where(target > 0.5, 0.5 / max(good, 1), 0.5 / max(len(target) - good, 1)).astype(np.float32)
    target = target.astype(np.float32)
    w, ahead = np.zeros(x.shape[1], dtype=np.float32), np.zeros(x.shape[1], dtype=np.float32)
    for k in range(steps):
        p = 1 / (1 + np.exp(-(x @ ahead)))
        new = ahead - np.float32(2) * ((weight * (p - target)) @ x + np.float32(1e-5) * ahead)
        ahead = new + (new - w) * np.float32(k / (k + 3))
        w = new
    return w


def train(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    counts = patterns(docs)
    posterior = estimate(counts)
    if not counts:
        return np.zeros(SIZE + 1)
    share = min(1.0, sample / sum(counts.values()))
    mark = F.xxhash64("doc_id", "text")
    chosen = docs.where("text != ''").where(F.pmod(mark, F.lit(1 << 20)) < int(share * (1 << 20))).select(
        mark.alias("mark"), F.pmod(F.shiftright(mark, 24), F.lit(SHARDS)).alias("shard"), F.col("text").cast("binary").alias("text")
    )

    def shard(table: pa.Table) -> pa.Table:
        table = table.sort_by("mark")
        rows, target = [], []
        for t in table.column("text").to_pylist():
            m = measures(t)
            rows.append(features(t, m))
            target.append(posterior[_code(votes(m))])
        w = fit(np.stack(rows), np.array(target))
        return pa.table({"shard": [table.column("shard")[0].as_py()], "n": [len(rows)], "w": [w.tolist()]})

    parts = chosen.groupBy("shard").applyInArrow(shard, "shard bigint, n bigint, w array<double>").collect()
    if not parts:
        return np.zeros(SIZE + 1)
    parts.sort(key=lambda r: r.shard)
    return np.average([r.w for r in parts], axis=0, weights=[r.n for r in parts])


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with a last column ``name``, the chance that the text is good."""
    return _scored(docs, weights).toDF(*docs.columns, name)


def _scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The columns of ``docs`` as ``_0``, ``_1`` and so on, then ``_score``."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    packed = docs.toDF(*names)
    schema = ", ".join(f"`{n}` {t}" for n, (_, t) in zip(names, packed.dtypes, strict=True))

    def make():
        def step(batch):
            out = []
            for t in batch.column(at).to_pylist():
                t = (t or "").encode("utf-8", "surrogatepass")
                lean = float(features(t, measures(t)) @ weights[:-1] + weights[-1]) if t else None
                out.append(0.0 if lean is None else round(1 / (1 + np.exp(-min(max(lean, -50), 50))), 6))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*names, "_score"])

        return step

    return arrow_map(packed, make, f"{schema}, _score double")


def keep(docs: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """The documents the scorer calls good, columns as they are, whatever their names.

    The scorer is trained on ``corpus`` (default: ``docs``). Where rules have cleaned ``docs``
    already, pass the table before them: labellers learn little where nothing bad is left.
    """
    weights = train(docs if corpus is None else corpus)
    return _scored(docs, weights).where("_score >= 0.5").drop("_score").toDF(*docs.columns)


def op4_quality_classifier(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs)).select("doc_id", "score", (F.col("score") >= 0.5).alias("kept"))
