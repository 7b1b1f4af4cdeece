import random

import pytest
from pyspark.sql import functions as F

from claimlens.operators import evaluation, explain, prepare, reports, scoring
from claimlens.schemas import FEATURE_DESCRIPTIONS, ML_FEATURES

LAYERS = "if_anomaly_score double, xgb_fraud_prob double, graph_anomaly_score double"


def score(spark, rows, weights=None):
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], LAYERS)
    return [r["risk_score"] for r in scoring.ensemble_score(df, weights).collect()]


def test_ensemble(spark):
    assert score(spark, [(0, 0, 0)] * 10) == [0.0] * 10
    assert score(spark, [(1, 1, 1)] * 10) == [100.0] * 10
    random.seed(0)
    assert all(0 <= s <= 100 for s in score(spark, [[random.random() for _ in range(3)] for _ in range(50)]))
    a, b = score(spark, [(0.1, 0.9, 0), (0.9, 0.1, 0)])
    assert a > b
    assert score(spark, [(1, 0.5, 0)], {"isolation_forest": 1.0, "xgboost": 0.0, "graph": 0.0}) == [100.0]
    assert score(spark, [(0.5, 0, 0.5)]) == [pytest.approx(50)]


def tiers(df):
    return {r["risk_tier"]: r["count"] for r in df.groupBy("risk_tier").count().collect()}


def test_risk_tiers(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("risk_score"))
    assert tiers(scoring.risk_tiers(df)) == {"Low": 40, "Moderate": 40, "Elevated": 15, "High": 4, "Critical": 1}
    flat = spark.range(10).select(F.lit(5.0).alias("risk_score"))
    assert tiers(scoring.risk_tiers(flat)) == {"Low": 10}


def test_fixed_tiers(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (80.0,), (100.0,)], "risk_score double")
    assert [r["risk_tier"] for r in scoring.fixed_tiers(df).collect()] == ["Low", "Moderate", "High", "Critical"]


def ranked(spark, labels, scores):
    rows = [(f"{i:010d}", float(s), bool(y), "S") for i, (y, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "npi string, risk_score double, is_excluded boolean, provider_specialty string")


@pytest.mark.parametrize(
    "labels,scores,k,expected",
    [
        ([1, 1, 1, 0, 0, 0, 0, 0], [0.9, 0.8, 0.7, 0.3, 0.2, 0.1, 0.05, 0.01], 3, 1.0),
        ([0, 0, 0, 0, 0, 1, 1, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.1, 0.05, 0.01], 3, 0.0),
        ([1, 0, 1, 0, 0], [0.9, 0.8, 0.7, 0.2, 0.1], 4, 0.5),
        ([1, 0, 1], [0.9, 0.5, 0.1], 100, 2 / 3),
    ],
)
def test_precision_at_k(spark, labels, scores, k, expected):
    r = evaluation.precision_at_k(ranked(spark, labels, scores), (k,), clamp=True).first()
    assert r["precision"] == pytest.approx(expected)


def test_average_precision_groups_ties(spark):
    df = evaluation.scored(ranked(spark, [1, 0, 1, 0], [0.9, 0.9, 0.5, 0.1]))
    # thresholds 0.9: 1 of 2, 0.5: 2 of 3
    assert evaluation.average_precision(df).first()["pr_auc"] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)
    assert evaluation.roc_auc(df).first()["roc_auc"] == pytest.approx((1.5 + 1) / 4)


def test_no_positives(spark):
    rows = {r["metric"]: r["value"] for r in evaluation.evaluate(ranked(spark, [0, 0], [1, 2])).collect()}
    assert rows == {"n_test": 2.0, "n_positive": 0.0, "pr_auc": None}


RISK = [
    ("1234567890", "Doe", "John", "Cardiology", "TX", 85.2, "Critical", True, 0.9, 0.85, 0.7),
    ("0987654321", "Smith", "Jane", "Cardiology", "TX", 42.1, "Moderate", False, 0.4, 0.35, 0.3),
    ("1111111111", "Jones", "Bob", "Dermatology", "CA", 15.0, "Low", False, 0.1, 0.05, 0.2),
]


@pytest.fixture(scope="module")
def risk(spark):
    cols = (
        "npi string, provider_last_name string, provider_first_name string, provider_specialty string,"
        " provider_state string, risk_score double, risk_tier string, is_excluded boolean, " + LAYERS
    )
    return spark.createDataFrame(RISK, cols)


def test_lookup(risk):
    r = reports.provider_lookup(risk, "1234567890").first()
    assert (r["risk_score"], r["risk_tier"], r["provider_name"]) == (85.2, "Critical", "John Doe")
    assert reports.provider_lookup(risk, "9999999999").count() == 0
    with pytest.raises(ValueError):
        reports.provider_lookup(risk, "abc")


def test_listing_and_stats(risk):
    assert [r["risk_score"] for r in reports.top_risk(risk).collect()] == [85.2, 42.1, 15.0]
    assert reports.top_risk(risk, specialty="cardio").count() == 2
    assert reports.top_risk(risk, state="ca").count() == 1
    assert all(r["risk_score"] >= 40 for r in reports.top_risk(risk, min_score=40).collect())
    assert reports.top_risk(risk, specialty="card.*", literal=True).count() == 0
    with pytest.raises(ValueError):
        reports.top_risk(risk, limit=0)
    assert reports.top_risk(risk, limit=501).count() == 3
    s = reports.dataset_stats(risk).first()
    assert (s["total_providers"], s["total_excluded"]) == (3, 1)
    hist = {r["label"]: r["providers"] for r in reports.score_histogram(risk).collect()}
    assert len(hist) == 20 and hist["85-90"] == 1 and hist["0-5"] == 0


def test_descriptions_cover_every_feature():
    assert list(FEATURE_DESCRIPTIONS) == ML_FEATURES and len(ML_FEATURES) == 32


def test_explanation_text(spark, risk):
    contributors = spark.createDataFrame(
        [("1234567890", 1, "zscore_total_services", "Billing volume", 4.5, 0.3, "increases risk")],
        "npi string, position int, feature string, description string, value double, impact double, direction string",
    )
    text = {r["npi"]: r["narrative"] for r in explain.explain_providers(risk, contributors).collect()}
    full = text["1234567890"]
    for part in ("1234567890", "85/100", "Critical", "review", "not an accusation", "1. Billing volume (value: 4.50) — increases risk"):
        assert part in full
    assert explain.STRONGEST in full and explain.STRONGEST not in text["1111111111"]


def test_rule_narrative_and_peers(spark):
    df = spark.createDataFrame(
        [("1", 85.0, 3.26, -2.5, 1.5, 10.0)],
        "npi string, risk_score double, zscore_total_services double, zscore_avg_charge double,"
        " throughput_utilization double, total_services double",
    )
    text = explain.rule_narrative(df).first()["narrative"].split("\n\n")
    assert text[0].startswith("**Score 85 of 100: far outside the usual range.**")
    assert text[2] == "- Total Services: **3.3 deviations above** the mean of its peers."
    assert text[3].startswith("- Avg Charge: **2.5 deviations below**")
    assert "150%" in text[4] and len(text) == 5
    peer = explain.peer_comparison(df).first()
    assert (peer["metric"], peer["value_text"], peer["zscore_text"]) == ("Total Services", "10.00", "3.26")


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(2500).select(F.format_string("%010d", "id").alias("npi"), (F.col("id") % 50 == 0).alias("is_excluded"))
    counts = {(r["is_excluded"], r["split"]): r["count"] for r in prepare.stratified_split(df).groupBy("is_excluded", "split").count().collect()}
    assert counts == {(True, "test"): 10, (True, "train"): 40, (False, "test"): 490, (False, "train"): 1960}
    a = prepare.stratified_split(df).where("split = 'test'").select("npi")
    assert a.exceptAll(prepare.stratified_split(df.repartition(3)).where("split = 'test'").select("npi")).count() == 0


def test_impute_median_and_infinity(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", float("inf")), ("e", float("nan"))], "npi string, f double")
    out = {r["npi"]: r["f"] for r in prepare.impute(df, ["f"]).collect()}
    assert out == {"a": 1.0, "b": 3.0, "c": 3.0, "d": 0.0, "e": 3.0}


def counted_rows(spark, df):
    """``df`` behind a step that counts the rows worked out, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_split_and_profile_work_their_rows_out_once(spark):
    """Cut-offs and medians read a stored table; the plan behind the rows, with its shuffles, is not run for each."""
    rows = spark.range(600).select(
        F.lpad(F.col("id").cast("string"), 10, "0").alias("npi"),
        (F.col("id") % 10 == 0).alias("is_excluded"),
        (F.col("id") * 1.0).alias("risk_score"),
        *[(F.col("id") * (k + 1.0)).alias(c) for k, c in enumerate(reports.PROFILE_METRICS)],
    )
    counted, seen = counted_rows(spark, rows)
    split = prepare.stratified_split(counted).groupBy("is_excluded", "split").count().collect()
    assert {(r[0], r[1]): r[2] for r in split} == {(True, "train"): 48, (True, "test"): 12, (False, "train"): 432, (False, "test"): 108}
    # once for the cut-offs and once for the rows themselves
    assert seen.value == 1200
    counted, seen = counted_rows(spark, rows)
    found = {r["cohort"]: r["total_medicare_payments"] for r in reports.top_profile(counted).collect()}
    assert found == {"top": 587.0, "population": 299.5} and seen.value == 600
