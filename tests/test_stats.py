import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelane.operators import stats

SHARES = {"least": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "most": 1.0}


def wanted(values):
    good = [v for v in values if v is not None and math.isfinite(v)]
    return [float(np.quantile(good, s)) if good else None for s in SHARES.values()]


@pytest.mark.parametrize("buckets", [2, 16, 4096])
def test_quantiles_equal_a_sort(spark, buckets):
    rng = np.random.default_rng(1)
    groups = {
        "spread": rng.normal(size=300).tolist(),
        "far apart": [10.0**k for k in range(-300, 300, 40)] + [-1e308, 1e308, 0.0],
        "ties": [2.5] * 40 + [7.0] * 2 + [None, math.nan, math.inf, -math.inf],
        "one": [3.0],
        "two": [1.0, 2.0],
        "nothing": [None, math.nan],
        None: rng.exponential(size=77).tolist(),
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    out = {r.k: r for r in stats.quantiles(df, ["k"], "v", SHARES, buckets).collect()}
    assert set(out) == set(groups)
    for k, values in groups.items():
        got = [out[k][name] for name in SHARES]
        assert got == [None if w is None else pytest.approx(w, rel=1e-9) for w in wanted(values)], k


def test_a_million_unlike_values(spark):
    df = spark.range(1_000_000, numPartitions=4).select(F.lit(1).alias("k"), (F.col("id") * 611_953 % 1_000_003 / 7).alias("v"))
    values = np.sort(np.arange(1_000_000) * 611_953 % 1_000_003 / 7)
    row = stats.quantiles(df, ["k"], "v", {"low": 0.001, "median": 0.5, "high": 0.9}).first()
    for name, share in (("low", 0.001), ("median", 0.5), ("high", 0.9)):
        assert row[name] == pytest.approx(float(np.quantile(values, share)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert stats.quantiles(empty, ["k"], "v", SHARES).count() == 0
    with pytest.raises(ValueError):
        stats.quantiles(empty, ["k"], "v", {"x": 1.5})
