import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.functions.ranking import Quantile, exact_quantiles, positives_in_top_k, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; values repeat heavily."""
    random.seed(3)
    rows = [("hot", random.choice([0.0, 1.0, 5.0, random.lognormvariate(0, 3)])) for _ in range(9000)]
    rows += [("cold", float(i)) for i in range(7)] + [("one", 3.5)]
    return spark.createDataFrame(rows, "k string, x double").repartition(8).cache(), rows


@pytest.mark.parametrize("accuracy", [50, 500])
def test_quantiles_equal_numpy(skewed, accuracy):
    df, rows = skewed
    probs = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    got = exact_quantiles(
        df, ["k"], {f"q{i}": Quantile("x", p) for i, p in enumerate(probs)}, accuracy
    ).collect()
    assert len(got) == 3
    for r in got:
        values = [x for k, x in rows if k == r["k"]]
        for i, p in enumerate(probs):
            assert r[f"q{i}"] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_without_key_and_with_nulls(spark):
    df = spark.range(2001).select(
        F.col("id").cast("double").alias("a"), F.when(F.col("id") < 3, F.col("id")).alias("b"),
        F.lit(None).cast("double").alias("c"),
    )
    r = exact_quantiles(df, [], {n: Quantile(n, 0.5) for n in "abc"}).first()
    assert (r["a"], r["b"], r["c"]) == (1000.0, 1.0, None)


def test_running_totals_equal_brute_force(skewed):
    df, rows = skewed
    out = running_totals(df, ["k"], "x", {"n": F.lit(1)}, buckets=8).where("k = 'hot'").collect()
    values = [x for k, x in rows if k == "hot"]
    assert sum(r["n"] for r in out) == len(values)
    for r in random.sample(out, 50):
        assert r["cum_n"] == sum(v >= r["x"] for v in values)


def test_top_k_breaks_ties_by_id(spark):
    rows = [(f"{i:010d}", float(i % 3), i % 5 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "npi string, s double, y boolean")
    cuts = {str(k): F.lit(k) for k in (1, 50, 133, 134, 200, 400)}
    got = {r["cutoff"]: r for r in positives_in_top_k(df, [], "s", "y", "npi", cuts).collect()}
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k, r in got.items():
        assert r["hits"] == sum(x[2] for x in ranked[: int(k)])
        assert (r["n"], r["positives"]) == (400, 80)


@pytest.mark.parametrize("at", [lambda n: n - 1, lambda n: F.lit(0)])
def test_a_missed_bracket_raises(spark, at):
    df = spark.range(20000).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(Exception, match="outside its bracket"):
        exact_quantiles(df, [], {"q": Quantile("x", 0.5, at)}).collect()
