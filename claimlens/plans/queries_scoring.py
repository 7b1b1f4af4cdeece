"""Queries: ensemble, tiers, evaluation metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation, features, reports, scoring
from . import testbed
from .catalog import query, rounded
from .oracles import block, seeded, sql

block(
    "layers",
    ["who"],
    """
    SELECT npi, last_name AS provider_last_name, first_name AS provider_first_name,
           segment AS provider_specialty, state AS provider_state, c_acctbal < 0 AS is_excluded,
           (c_custkey * 7919 % 1000) / 999.0::DOUBLE AS if_anomaly_score,
           (c_custkey * 104729 % 997) / 996.0::DOUBLE AS xgb_fraud_prob,
           (c_custkey * 31 % 101) / 100.0::DOUBLE AS graph_anomaly_score
    FROM who
    """,
)
block(
    "scores",
    ["layers"],
    """
    SELECT *, least(greatest((0.25::DOUBLE * if_anomaly_score + 0.5::DOUBLE * xgb_fraud_prob
                              + 0.25::DOUBLE * graph_anomaly_score) * 100, 0), 100) AS risk_score
    FROM layers
    """,
)
block(
    "risk",
    ["scores"],
    """
    SELECT s.*, CASE WHEN risk_score <= e[2] THEN 'Low' WHEN risk_score <= e[3] THEN 'Moderate'
                     WHEN risk_score <= e[4] THEN 'Elevated' WHEN risk_score <= e[5] THEN 'High'
                     ELSE 'Critical' END AS risk_tier
    FROM scores s,
         (SELECT quantile_cont(risk_score, [0.0, 0.4, 0.8, 0.95, 0.99, 1.0]) AS e FROM scores)
    """,
)
block(
    "docs",
    [],
    """
    SELECT lpad(CAST(doc_id AS VARCHAR), 10, '0') AS npi, lang AS provider_specialty,
           CAST(n_chars AS DOUBLE) AS risk_score, quality = 1 AS is_excluded
    FROM labels JOIN documents USING (doc_id)
    """,
)


def curve_block(name: str, source: str, key: str | None = None) -> None:
    part = f"PARTITION BY {key} " if key else ""
    cols = f"{key}, " if key else ""
    block(
        name,
        [source],
        f"""
        SELECT *, sum(n) OVER ({part}ORDER BY risk_score DESC) AS cum_n,
               sum(pos) OVER ({part}ORDER BY risk_score DESC) AS cum_pos,
               sum(n) OVER ({part.strip()}) AS rows_, sum(pos) OVER ({part.strip()}) AS positives
        FROM (SELECT {cols}risk_score, count(*) AS n, count(*) FILTER (WHERE is_excluded) AS pos
              FROM {source} GROUP BY {cols}risk_score)
        """,
    )


curve_block("curve", "risk")
curve_block("doc_curve", "docs")
curve_block("spec_curve", "risk", "provider_specialty")
AP = "sum(pos / nullif(positives, 0) * cum_pos / cum_n)"
AUC = (
    "sum(pos * (rows_ - positives - (cum_n - cum_pos) + 0.5 * (n - pos)))"
    " / nullif(max(positives * (rows_ - positives)), 0)"
)


def layers(spark, d):
    return testbed.scored_providers(spark, d)


def scores(spark, d):
    return scoring.ensemble_score(layers(spark, d))


def risk(spark, d):
    return scoring.risk_table(scores(spark, d))


@query("ensemble_score", sql("SELECT npi, round(risk_score, 6) AS risk_score FROM scores", "scores"))
def ensemble_score(spark, d):
    return rounded(scores(spark, d), {"npi": None, "risk_score": 6})


@query(
    "ensemble_unsupervised",
    sql(
        "SELECT npi, round(least(greatest((0.6 * if_anomaly_score + 0.4 * graph_anomaly_score) * 100, 0), 100), 6)"
        " AS risk_score FROM layers",
        "layers",
    ),
)
def ensemble_unsupervised(spark, d):
    blank = layers(spark, d).withColumn("xgb_fraud_prob", F.lit(0.0))
    return rounded(scoring.ensemble_score(blank), {"npi": None, "risk_score": 6})


@query(
    "calibrate_scores",
    sql(
        """
        SELECT npi, round((hi - raw) / (hi - lo + 1e-10), 6) AS score
        FROM (SELECT npi, -if_anomaly_score - 0.5 * graph_anomaly_score AS raw FROM layers),
             (SELECT min(-if_anomaly_score - 0.5 * graph_anomaly_score) AS lo,
                     max(-if_anomaly_score - 0.5 * graph_anomaly_score) AS hi FROM layers)
        """,
        "layers",
    ),
)
def calibrate_scores(spark, d):
    raw = layers(spark, d).withColumn("raw", -F.col("if_anomaly_score") - 0.5 * F.col("graph_anomaly_score"))
    return rounded(scoring.calibrate(raw, "raw", "score"), {"npi": None, "score": 6})


@query("risk_tiers", sql("SELECT npi, risk_tier FROM risk", "risk"))
def risk_tiers(spark, d):
    return scoring.risk_tiers(scores(spark, d)).select("npi", "risk_tier")


@query(
    "fixed_tiers",
    sql(
        """
        SELECT npi, CASE WHEN risk_score <= 20 THEN 'Low' WHEN risk_score <= 40 THEN 'Moderate'
               WHEN risk_score <= 60 THEN 'Elevated' WHEN risk_score <= 80 THEN 'High'
               ELSE 'Critical' END AS risk_tier FROM scores
        """,
        "scores",
    ),
)
def fixed_tiers(spark, d):
    return scoring.fixed_tiers(scores(spark, d)).select("npi", "risk_tier")


RISK_CHECK = {
    "npi": None, "provider_last_name": None, "provider_first_name": None, "provider_specialty": None,
    "provider_state": None, "is_excluded": None, "risk_score": 6, "if_anomaly_score": 6,
    "xgb_fraud_prob": 6, "graph_anomaly_score": 6, "risk_tier": None,
}


@query(
    "risk_table",
    sql(
        "SELECT npi, provider_last_name, provider_first_name, provider_specialty, provider_state, is_excluded,"
        " round(risk_score, 6) AS risk_score, round(if_anomaly_score, 6) AS if_anomaly_score,"
        " round(xgb_fraud_prob, 6) AS xgb_fraud_prob, round(graph_anomaly_score, 6) AS graph_anomaly_score,"
        " risk_tier FROM risk",
        "risk",
    ),
)
def risk_table(spark, d):
    return rounded(risk(spark, d), RISK_CHECK)


@query(
    "score_quantiles",
    sql(
        "SELECT round(quantile_cont(risk_score, 0.4), 6) AS p40, round(quantile_cont(risk_score, 0.6), 6) AS p60,"
        " round(quantile_cont(risk_score, 0.95), 6) AS p95 FROM scores",
        "scores",
    ),
)
def score_quantiles(spark, d):
    from ..functions.ranking import Quantile, exact_quantiles

    specs = {f"p{int(q * 100)}": Quantile("risk_score", q) for q in (0.4, 0.6, 0.95)}
    return rounded(exact_quantiles(scores(spark, d), [], specs), {"p40": 6, "p60": 6, "p95": 6})


# --- evaluation ------------------------------------------------------------


@query(
    "precision_at_k",
    sql(
        """
        SELECT k, CAST(count(*) FILTER (WHERE is_excluded) AS BIGINT) AS hits,
               round(count(*) FILTER (WHERE is_excluded) / k, 6) AS "precision"
        FROM (SELECT is_excluded, row_number() OVER (ORDER BY risk_score DESC, npi) AS r,
                     count(*) OVER () AS n FROM risk),
             (SELECT unnest([10, 25, 50, 100, 200, 500]::BIGINT[]) AS k)
        WHERE r <= k AND k <= n GROUP BY k
        """,
        "risk",
    ),
)
def precision_at_k(spark, d):
    return rounded(evaluation.precision_at_k(risk(spark, d)), {"k": None, "hits": None, "precision": 6})


AP_SQL = "SELECT max(rows_)::BIGINT AS n, max(positives)::BIGINT AS positives, round({}, 6) AS {} FROM {}"


@query("average_precision", sql(AP_SQL.format(AP, "pr_auc", "curve"), "curve"))
def average_precision(spark, d):
    rows = evaluation.scored(risk(spark, d))
    return rounded(evaluation.average_precision(rows), {"n": None, "positives": None, "pr_auc": 6})


@query("roc_auc", sql(AP_SQL.format(AUC, "roc_auc", "curve"), "curve"))
def roc_auc(spark, d):
    rows = evaluation.scored(risk(spark, d))
    return rounded(evaluation.roc_auc(rows), {"n": None, "positives": None, "roc_auc": 6})


@query("document_average_precision", sql(AP_SQL.format(AP, "pr_auc", "doc_curve"), "doc_curve"))
def document_average_precision(spark, d):
    rows = evaluation.scored(testbed.labelled_documents(spark, d))
    return rounded(evaluation.average_precision(rows), {"n": None, "positives": None, "pr_auc": 6})


@query("document_roc_auc", sql(AP_SQL.format(AUC, "roc_auc", "doc_curve"), "doc_curve"))
def document_roc_auc(spark, d):
    rows = evaluation.scored(testbed.labelled_documents(spark, d))
    return rounded(evaluation.roc_auc(rows), {"n": None, "positives": None, "roc_auc": 6})


@query(
    "precision_at_recall",
    sql(
        """
        SELECT target_recall, round(recall, 6) AS recall, round("precision", 6) AS "precision",
               round(threshold, 6) AS threshold
        FROM (
            SELECT t AS target_recall, cum_pos / positives AS recall, cum_pos / cum_n AS "precision",
                   risk_score AS threshold,
                   row_number() OVER (PARTITION BY t ORDER BY abs(cum_pos / positives - t), risk_score) AS r
            FROM curve, (SELECT unnest([0.5, 0.7, 0.9]::DOUBLE[]) AS t)
        ) WHERE r = 1
        """,
        "curve",
    ),
)
def precision_at_recall(spark, d):
    rows = evaluation.scored(risk(spark, d))
    return rounded(
        evaluation.precision_at_recall(rows),
        {"target_recall": None, "recall": 6, "precision": 6, "threshold": 6},
    )


def lift_sql(source: str, key: str | None = None) -> str:
    part = f"PARTITION BY {key} " if key else ""
    col = f"{key}, " if key else ""
    return f"""
        SELECT {col}top_share, k, max(n) AS n, max(positives)::BIGINT AS positives,
               count(*) FILTER (WHERE is_excluded) AS hits,
               round(count(*) FILTER (WHERE is_excluded) / k, 6) AS "precision",
               round(count(*) FILTER (WHERE is_excluded) / greatest(max(positives), 1), 6) AS recall,
               round(count(*) FILTER (WHERE is_excluded) / k / nullif(max(positives) / max(n), 0), 6) AS lift
        FROM (SELECT *, greatest(1, floor(top_share * n))::BIGINT AS k
              FROM (SELECT {col}is_excluded,
                           row_number() OVER ({part}ORDER BY risk_score DESC, npi) AS r,
                           count(*) OVER ({part.strip()}) AS n,
                           sum(is_excluded::INT) OVER ({part.strip()}) AS positives FROM {source}),
                   (SELECT unnest([0.01, 0.05, 0.1, 0.2]::DOUBLE[]) AS top_share))
        WHERE r <= k GROUP BY {col}top_share, k
    """


LIFT_CHECK = {
    "top_share": None, "k": None, "n": None, "positives": None, "hits": None, "precision": 6,
    "recall": 6, "lift": 6,
}


@query("lift_at_pct", sql(lift_sql("risk"), "risk"))
def lift_at_pct(spark, d):
    return rounded(evaluation.lift_at_share(risk(spark, d)), LIFT_CHECK)


@query("document_lift_by_language", sql(lift_sql("docs", "provider_specialty"), "docs"))
def document_lift_by_language(spark, d):
    rows = evaluation.lift_at_share(testbed.labelled_documents(spark, d), ["provider_specialty"])
    return rounded(rows, {"provider_specialty": None, **LIFT_CHECK})


@query(
    "top5_analysis",
    sql(
        """
        SELECT round(t, 6) AS threshold, count(*) FILTER (WHERE risk_score >= t) AS flagged,
               count(*) FILTER (WHERE risk_score >= t AND is_excluded) AS true_positives,
               count(*) FILTER (WHERE risk_score >= t AND NOT is_excluded) AS false_positives,
               round(count(*) FILTER (WHERE risk_score >= t AND is_excluded)
                     / count(*) FILTER (WHERE risk_score >= t), 6) AS "precision"
        FROM risk, (SELECT quantile_cont(risk_score, 0.95) AS t FROM risk) GROUP BY t
        """,
        "risk",
    ),
)
def top5_analysis(spark, d):
    return rounded(
        evaluation.top5_analysis(risk(spark, d)),
        {"threshold": 6, "flagged": None, "true_positives": None, "false_positives": None, "precision": 6},
    )


@query(
    "per_specialty_eval",
    sql(
        f"""
        SELECT a.*, round(p.p10, 6) AS precision_at_10
        FROM (SELECT provider_specialty AS specialty, max(rows_)::BIGINT AS n_providers,
                     max(positives)::BIGINT AS n_excluded,
                     round(max(positives) / max(rows_), 6) AS exclusion_rate, round({AP}, 6) AS pr_auc
              FROM spec_curve GROUP BY provider_specialty
              HAVING max(rows_) >= 20 AND max(positives) > 0) a
        JOIN (SELECT provider_specialty AS specialty, avg(is_excluded::INT) AS p10
              FROM (SELECT *, row_number() OVER (PARTITION BY provider_specialty
                                                 ORDER BY risk_score DESC, npi) AS r FROM risk)
              WHERE r <= 10 GROUP BY provider_specialty) p USING (specialty)
        """,
        "spec_curve",
    ),
)
def per_specialty_eval(spark, d):
    rows = evaluation.scored(risk(spark, d), ["provider_specialty"])
    return rounded(
        evaluation.per_specialty(rows),
        {"specialty": None, "n_providers": None, "n_excluded": None, "exclusion_rate": 6, "pr_auc": 6,
         "precision_at_10": 6},
    )


def tier_labels(spark, d):
    """A match tier per excluded provider, dealt by nation."""
    who = testbed.providers(spark, d).where(F.col("c_acctbal") < 0)
    return who.select("npi", (F.col("c_nationkey") % 3 + 1).alias("match_tier"))


block(
    "cohorts",
    ["risk", "who"],
    """
    SELECT r.*, c.cohort
    FROM risk r JOIN who w USING (npi),
         (SELECT unnest(['all', 'tier_1', 'tier_2', 'tier_3', 'tier_1_2']) AS cohort) c
    WHERE c.cohort = 'all' OR NOT r.is_excluded
       OR c.cohort = 'tier_' || (w.c_nationkey % 3 + 1)
       OR (c.cohort = 'tier_1_2' AND w.c_nationkey % 3 < 2)
    """,
)
curve_block("cohort_curve", "cohorts", "cohort")


@query(
    "per_tier_eval",
    sql(
        f"""
        SELECT cohort, max(rows_)::BIGINT AS n, max(positives)::BIGINT AS positives,
               round({AUC}, 6) AS roc_auc, round({AP}, 6) AS pr_auc,
               round(max(positives) / max(rows_), 6) AS base_rate
        FROM cohort_curve GROUP BY cohort HAVING max(positives) > 0
        """,
        "cohort_curve",
    ),
)
def per_tier_eval(spark, d):
    return rounded(
        evaluation.per_tier(risk(spark, d), tier_labels(spark, d)),
        {"cohort": None, "n": None, "positives": None, "roc_auc": 6, "pr_auc": 6, "base_rate": 6},
    )


@query("per_tier_lift", sql(f"SELECT * FROM ({lift_sql('cohorts', 'cohort')}) WHERE positives > 0", "cohorts"))
def per_tier_lift(spark, d):
    rows = evaluation.per_tier_lift(risk(spark, d), tier_labels(spark, d))
    return rounded(rows, {"cohort": None, **LIFT_CHECK})


@query(
    "evaluation_bundle",
    sql(
        f"""
        SELECT metric, key, round(value, 6) AS value FROM (
            SELECT unnest(['n_test', 'n_positive', 'pr_auc']) AS metric, 'all' AS key,
                   unnest([max(rows_)::DOUBLE, max(positives)::DOUBLE, {AP}]) AS value FROM curve
            UNION ALL
            SELECT 'precision_at_k', k::VARCHAR, count(*) FILTER (WHERE is_excluded) / k
            FROM (SELECT is_excluded, row_number() OVER (ORDER BY risk_score DESC, npi) AS r,
                         count(*) OVER () AS n FROM risk),
                 (SELECT unnest([10, 25, 50, 100, 200, 500]) AS k) WHERE r <= k AND k <= n GROUP BY k
            UNION ALL
            SELECT unnest(['n_providers', 'n_excluded', 'exclusion_rate', 'pr_auc']), provider_specialty,
                   unnest([max(rows_)::DOUBLE, max(positives)::DOUBLE, max(positives) / max(rows_), {AP}])
            FROM spec_curve GROUP BY provider_specialty HAVING max(rows_) >= 20 AND max(positives) > 0
            UNION ALL
            SELECT 'precision_at_10', provider_specialty, avg(is_excluded::INT)
            FROM (SELECT *, row_number() OVER (PARTITION BY provider_specialty
                                               ORDER BY risk_score DESC, npi) AS r,
                         count(*) OVER (PARTITION BY provider_specialty) AS n,
                         sum(is_excluded::INT) OVER (PARTITION BY provider_specialty) AS p FROM risk)
            WHERE r <= 10 AND n >= 20 AND p > 0 GROUP BY provider_specialty
            UNION ALL
            SELECT unnest(['threshold', 'flagged', 'true_positives', 'false_positives', 'precision']), 'top_5pct',
                   unnest([max(t), count(*)::DOUBLE, count(*) FILTER (WHERE is_excluded)::DOUBLE,
                           count(*) FILTER (WHERE NOT is_excluded)::DOUBLE, avg(is_excluded::INT)])
            FROM risk, (SELECT quantile_cont(risk_score, 0.95) AS t FROM risk) WHERE risk_score >= t
        )
        """,
        "curve",
        "spec_curve",
    ),
)
def evaluation_bundle(spark, d):
    return rounded(evaluation.evaluate(risk(spark, d)), {"metric": None, "key": None, "value": 6})


# --- reports ---------------------------------------------------------------


@query(
    "top_risk",
    sql(
        """
        SELECT npi, trim(provider_first_name || ' ' || provider_last_name) AS provider_name,
               provider_specialty AS specialty, provider_state AS state,
               round(risk_score, 1) AS risk_score, risk_tier, is_excluded
        FROM risk WHERE provider_specialty ILIKE '%uil%' AND risk_score >= 40
        ORDER BY risk.risk_score DESC, npi LIMIT 50
        """,
        "risk",
    ),
)
def top_risk(spark, d):
    return reports.top_risk(risk(spark, d), limit=50, specialty="UIL", min_score=40)


@query(
    "provider_lookup",
    sql(
        f"""
        SELECT npi, trim(provider_first_name || ' ' || provider_last_name) AS provider_name,
               provider_specialty AS specialty, provider_state AS state,
               round(risk_score, 1) AS risk_score, risk_tier,
               round(if_anomaly_score, 4) AS isolation_forest, round(xgb_fraud_prob, 4) AS xgboost,
               round(graph_anomaly_score, 4) AS graph, '{reports.DISCLAIMER}' AS disclaimer
        FROM risk WHERE npi = '0000000042'
        """,
        "risk",
    ),
)
def provider_lookup(spark, d):
    return reports.provider_lookup(risk(spark, d), "0000000042")


@query(
    "filter_risk",
    sql(
        "SELECT npi, provider_specialty, risk_tier FROM risk WHERE risk_tier = 'Elevated'"
        " AND provider_specialty = 'BUILDING' AND risk_score BETWEEN 30 AND 90",
        "risk",
    ),
)
def filter_risk(spark, d):
    rows = reports.filter_risk(
        risk(spark, d), tier="Elevated", specialty="BUILDING", min_score=30, max_score=90
    )
    return rows.select("npi", "provider_specialty", "risk_tier")


@query(
    "excluded_only",
    sql("SELECT npi, provider_state FROM risk WHERE is_excluded AND provider_state = '07'", "risk"),
)
def excluded_only(spark, d):
    return reports.filter_risk(risk(spark, d), state="07", excluded_only=True).select("npi", "provider_state")


@query("filter_values", sql("SELECT DISTINCT provider_state FROM risk WHERE provider_state IS NOT NULL", "risk"))
def filter_values(spark, d):
    return reports.filter_values(risk(spark, d), "provider_state")


@query(
    "dataset_stats",
    sql(
        "SELECT count(*) AS total_providers, count(*) FILTER (WHERE is_excluded) AS total_excluded,"
        " round(avg(is_excluded::INT), 6) AS exclusion_rate FROM risk",
        "risk",
    ),
)
def dataset_stats(spark, d):
    return rounded(
        reports.dataset_stats(risk(spark, d)),
        {"total_providers": None, "total_excluded": None, "exclusion_rate": 6},
    )


@query("tier_counts", sql("SELECT risk_tier, count(*) AS providers FROM risk GROUP BY risk_tier", "risk"))
def tier_counts(spark, d):
    return reports.tier_counts(risk(spark, d))


@query(
    "top_specialties",
    sql(
        """
        SELECT provider_specialty, count(*) AS count, round(avg(risk_score), 6) AS avg_risk,
               count(*) FILTER (WHERE is_excluded) AS n_excluded
        FROM risk GROUP BY provider_specialty ORDER BY avg(risk_score) DESC LIMIT 10
        """,
        "risk",
    ),
)
def top_specialties(spark, d):
    return rounded(
        reports.top_specialties(risk(spark, d)),
        {"provider_specialty": None, "count": None, "avg_risk": 6, "n_excluded": None},
    )


@query(
    "specialty_risk",
    sql(
        """
        SELECT provider_specialty, count(*) AS providers, round(avg(risk_score), 1) AS avg_risk,
               round(max(risk_score), 1) AS max_risk,
               count(*) FILTER (WHERE risk_score >= p[1]) AS top_5pct,
               count(*) FILTER (WHERE risk_score >= p[2]) AS top_1pct,
               round(100.0 * count(*) FILTER (WHERE risk_score >= p[1]) / count(*), 1) AS pct_in_top_5,
               count(*) FILTER (WHERE is_excluded) AS excluded
        FROM risk, (SELECT quantile_cont(risk_score, [0.95, 0.99]) AS p FROM risk)
        GROUP BY provider_specialty HAVING count(*) >= 20 ORDER BY avg(risk_score) DESC LIMIT 15
        """,
        "risk",
    ),
)
def specialty_risk(spark, d):
    return reports.specialty_risk(risk(spark, d))


@query(
    "kpis",
    sql(
        "SELECT count(*) AS total_providers, count(*) FILTER (WHERE is_excluded) AS excluded,"
        " count(*) FILTER (WHERE risk_score >= 60) AS high_risk,"
        " round(100.0 * count(*) FILTER (WHERE risk_score >= 60) / count(*), 6) AS high_risk_pct FROM risk",
        "risk",
    ),
)
def kpis(spark, d):
    return rounded(
        reports.kpis(risk(spark, d)),
        {"total_providers": None, "excluded": None, "high_risk": None, "high_risk_pct": 6},
    )


@query(
    "score_histogram",
    sql(
        """
        SELECT b AS bin, (b * 5)::VARCHAR || '-' || (b * 5 + 5)::VARCHAR AS label, count(npi) AS providers
        FROM (SELECT unnest(range(20)) AS b)
        LEFT JOIN risk ON least(floor(risk_score / 5), 19) = b GROUP BY b
        """,
        "risk",
    ),
)
def score_histogram(spark, d):
    return reports.score_histogram(risk(spark, d))


@query(
    "layer_contribution",
    sql(
        """
        SELECT layer, round(m, 3) AS avg_score, weight, round(m * weight, 3) AS contribution
        FROM (SELECT unnest(['isolation_forest', 'xgboost', 'graph']) AS layer,
                     unnest([avg(if_anomaly_score), avg(xgb_fraud_prob), avg(graph_anomaly_score)]) AS m,
                     unnest([0.25, 0.5, 0.25]::DOUBLE[]) AS weight
              FROM (SELECT * FROM risk ORDER BY risk_score DESC, npi LIMIT 100))
        """,
        "risk",
    ),
)
def layer_contribution(spark, d):
    return reports.layer_contribution(risk(spark, d))


@query(
    "review_roi",
    """
    SELECT count(*) AS total_reviewed, count(*) FILTER (WHERE event_type = 'purchase') AS referred,
           count(*) FILTER (WHERE event_type IN ('click', 'view')) AS no_action,
           round(100.0 * count(*) FILTER (WHERE event_type = 'purchase') / count(*), 6) AS referral_rate,
           75000 * count(*) FILTER (WHERE event_type = 'purchase') AS estimated_value
    FROM events
    """,
)
def review_roi(spark, d):
    return rounded(
        reports.review_roi(testbed.reviews(spark, d)),
        {"total_reviewed": None, "referred": None, "no_action": None, "referral_rate": 6,
         "estimated_value": None},
    )


PROFILE = ["total_medicare_payments", "zscore_total_services", "services_per_beneficiary", "high_complexity_ratio"]


def mart_risk(spark, d):
    """The stand-in risk table with the mart's features attached."""
    from . import pipeline
    from .queries_features import inputs

    return reports.with_features(risk(spark, d), pipeline.build_mart(inputs(spark, d)).mart.drop("is_excluded"))


block(
    "mart_risk",
    ["risk", "mart"],
    """
    SELECT m.* EXCLUDE (is_excluded), r.is_excluded, r.risk_score FROM risk r LEFT JOIN mart m USING (npi)
    """,
)


@query(
    "feature_by_label",
    sql(
        " UNION ALL ".join(
            f"SELECT is_excluded, '{c}' AS feature, round(avg({c}), 5) AS mean, round(median({c}), 6) AS median,"
            f" round(quantile_cont({c}, 0.95), 6) AS p95 FROM mart_risk GROUP BY is_excluded"
            for c in PROFILE
        ),
        "mart_risk",
    ),
)
def feature_by_label(spark, d):
    return rounded(
        reports.feature_by_label(mart_risk(spark, d), PROFILE),
        {"is_excluded": None, "feature": None, "mean": 5, "median": 6, "p95": 6},
    )


@query(
    "positive_specialties",
    sql(
        "SELECT provider_specialty, count(*) AS providers FROM risk WHERE is_excluded"
        " GROUP BY provider_specialty ORDER BY providers DESC, provider_specialty LIMIT 10",
        "risk",
    ),
)
def positive_specialties(spark, d):
    return reports.positive_specialties(risk(spark, d))


@query(
    "top_profile",
    sql(
        " UNION ALL ".join(
            f"SELECT '{g}' AS cohort, "
            + ", ".join(f"round(median({c}), 6) AS {c}" for c in reports.PROFILE_METRICS)
            + f" FROM ({src})"
            for g, src in (
                ("top", "SELECT * FROM mart_risk ORDER BY risk_score DESC, npi LIMIT 25"),
                ("population", "SELECT * FROM mart_risk"),
            )
        ),
        "mart_risk",
    ),
)
def top_profile(spark, d):
    return rounded(
        reports.top_profile(mart_risk(spark, d)),
        {"cohort": None, **{c: 6 for c in reports.PROFILE_METRICS}},
    )


@query(
    "top_profile_specialties",
    sql(
        """
        SELECT provider_specialty, count(*) AS providers, count(*) FILTER (WHERE is_excluded) AS excluded
        FROM (SELECT * FROM risk ORDER BY risk_score DESC, npi LIMIT 25)
        GROUP BY provider_specialty ORDER BY providers DESC, provider_specialty LIMIT 5
        """,
        "risk",
    ),
)
def top_profile_specialties(spark, d):
    return reports.top_profile_specialties(risk(spark, d))


@query(
    "middle_sample",
    sql(
        "SELECT npi, risk_score, is_excluded FROM risk WHERE risk_score BETWEEN"
        " (SELECT quantile_cont(risk_score, 0.4) FROM risk) AND (SELECT quantile_cont(risk_score, 0.6) FROM risk)"
        f" ORDER BY {seeded(7, 'npi')}, npi LIMIT 10",
        "risk",
    ),
)
def middle_sample(spark, d):
    return reports.middle_sample(risk(spark, d)).select("npi", "risk_score", "is_excluded")


@query(
    "score_summary",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS score, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.95), 6) AS p95,"
            f" round(max({c}), 6) AS max FROM layers"
            for c in ("if_anomaly_score", "graph_anomaly_score")
        ),
        "layers",
    ),
)
def score_summary(spark, d):
    return rounded(
        reports.score_summary(layers(spark, d), ["if_anomaly_score", "graph_anomaly_score"]),
        {"score": None, "mean": 6, "p95": 6, "max": 6},
    )


@query(
    "null_rates",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg(({c} IS NULL)::INT), 6) AS null_rate,"
            f" avg(({c} IS NULL)::INT) > 0.1 AS above_threshold FROM mart"
            for c in ("zscore_total_services", "upcoding_ratio_vs_peers", "exclusion_type", "primary_taxonomy_code")
        ),
        "mart",
    ),
)
def null_rates(spark, d):
    from . import pipeline
    from .queries_features import inputs

    mart = pipeline.build_mart(inputs(spark, d)).mart
    rows = features.null_rates(
        mart, ["zscore_total_services", "upcoding_ratio_vs_peers", "exclusion_type", "primary_taxonomy_code"]
    )
    return rounded(rows, {"feature": None, "null_rate": 6, "above_threshold": None})
