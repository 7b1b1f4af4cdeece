"""Queries: model layers, attributions, narratives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..operators import boosting, explain, forest, prepare
from ..operators.explain import DIVERGENCE, FINDING, KEY_ANOMALIES, OPENINGS, OUTLIER, PEER_METRICS, THROUGHPUT
from ..schemas import SQL_FEATURES
from . import pipeline, testbed
from .catalog import half_up, half_up_sql, query
from .oracles import block, sql
from .queries_features import inputs
from .queries_scoring import risk
from .training import train


def dataset(spark, d):
    """Imputed SQL features with the debt label and a split; no other column is kept, and the mart is worked out once."""
    mart = pipeline.build_mart(inputs(spark, d)).mart.select("npi", *SQL_FEATURES)
    debt = testbed.providers(spark, d).select("npi", (F.col("c_acctbal") < 0).alias("is_excluded"))
    split = materialize(prepare.stratified_split(materialize(mart.join(debt, "npi"))))
    return materialize(prepare.impute(split, SQL_FEATURES, split.where("split = 'train'")))


# fitted models by session and folder: five queries share one full-size training
_models = {}


def full_model(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _models:
        rows = dataset(spark, d)
        _models[key] = rows, boosting.fit_boosted(rows, SQL_FEATURES)
    return _models[key]


def forget_models() -> None:
    _models.clear()


@query("iforest_scores")
def iforest_scores(spark, d):
    rows = forest.isolation_forest_scores(dataset(spark, d), SQL_FEATURES)
    return rows.select("npi", "split", F.round("if_anomaly_score", 6).alias("if_anomaly_score"), "is_anomaly")


@query("boosted_scores")
def boosted_scores(spark, d):
    rows, fitted = full_model(spark, d)
    return boosting.boosted_scores(rows, fitted).select("npi", "split", "is_excluded", "xgb_fraud_prob")


@query("feature_importance")
def feature_importance(spark, d):
    return boosting.feature_importance(spark, full_model(spark, d)[1])


@query("attributions")
def attributions(spark, d):
    return boosting.attributions(*full_model(spark, d))


@query("top_contributors")
def top_contributors(spark, d):
    return explain.contributors(boosting.strongest(*full_model(spark, d)))


@query("explanations")
def explanations(spark, d):
    top = explain.contributors(boosting.strongest(*full_model(spark, d)))
    return explain.explain_providers(risk(spark, d), top).select("npi", "provider_name", "risk_tier", "narrative")


@query("trained_risk_table")
def trained_risk_table(spark, d):
    start = inputs(spark, d)
    tables = pipeline.build_mart(start)
    features = pipeline.build_features(start, tables)
    return train(features, start.labels, tables.mix).risk_table


FEATURES = ["zscore_total_services", "zscore_total_payments", "zscore_total_beneficiaries",
            "zscore_services_per_bene", "zscore_unique_hcpcs", "zscore_avg_charge"]


def flagged(spark, d):
    table = pipeline.build_features(inputs(spark, d)).drop("is_excluded", "provider_specialty", "provider_state")
    return risk(spark, d).select("npi", "risk_score").join(table, "npi", "left")


def _fmt(text: str, *args: str) -> str:
    quoted = text.replace("'", "''")
    return f"printf('{quoted}', {', '.join(args)})"


def _narrative_sql() -> str:
    opening = f"ELSE {_fmt(OPENINGS[-1][1], 'risk_score')} END"
    for floor, text in reversed(OPENINGS[:-1]):
        opening = f"WHEN risk_score >= {floor} THEN {_fmt(text, 'risk_score')} {opening}"
    found = ", ".join(
        f"CASE WHEN abs({c}) >= 2 THEN {{'size': abs({c}), 'name': '{c.removeprefix('zscore_').replace('_', ' ').title()}', 'z': {c}}} END"
        for c in FEATURES
    )
    line = _fmt(FINDING, "f['name']", "f['size']", "CASE WHEN f['z'] > 0 THEN 'above' ELSE 'below' END")
    return f"""
        SELECT npi, array_to_string(list_filter(
            list_concat([opening], CASE WHEN len(lines) > 0 THEN ['{KEY_ANOMALIES}'] ELSE [] END, lines,
              [CASE WHEN throughput_utilization > 1 THEN {_fmt(THROUGHPUT, 'throughput_utilization * 100')} END,
               CASE WHEN jsd_vs_specialty > 0.7 THEN {_fmt(DIVERGENCE, 'jsd_vs_specialty')} END,
               CASE WHEN mahalanobis_pvalue < 0.01 THEN {_fmt(OUTLIER, 'mahalanobis_pvalue')} END]),
            lambda x: x IS NOT NULL), chr(10) || chr(10)) AS narrative
        FROM (SELECT *, CASE {opening} AS opening,
                     list_transform(list_reverse_sort(list_filter([{found}], lambda x: x IS NOT NULL))[1:5],
                                    lambda f: {line}) AS lines
              FROM narrative_input)
    """


block(
    "narrative_input",
    ["risk", "full_features"],
    """
    SELECT r.npi, r.risk_score, f.* EXCLUDE (npi) FROM risk r LEFT JOIN full_features f USING (npi)
    """,
)


@query("narratives", sql(_narrative_sql(), "narrative_input"))
def narratives(spark, d):
    return explain.rule_narrative(flagged(spark, d))


@query(
    "peer_comparison",
    sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT npi, '{label}' AS metric, {half_up_sql(c, 6)} AS value, "
            + (f"round(zscore_{c}, 6)" if f"zscore_{c}" in FEATURES else "NULL::DOUBLE")
            + " AS zscore FROM mart"
            for c, label in PEER_METRICS.items()
        )
        + ") WHERE value IS NOT NULL",
        "mart",
    ),
)
def peer_comparison(spark, d):
    rows = explain.peer_comparison(pipeline.build_mart(inputs(spark, d)).mart)
    return rows.select("npi", "metric", half_up(F.col("value"), 6).alias("value"), F.round("zscore", 6).alias("zscore"))
