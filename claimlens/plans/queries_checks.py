"""Queries that hold model results against what SQL can state about them."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..functions.columns import seeded
from ..operators import artifacts, audit, boosting, explain, prepare, scoring
from ..schemas import AUDIT_GENDER_PAIRS, COMMON_LAST_NAMES, ENSEMBLE_WEIGHTS, SQL_FEATURES, TIERS, UNSUPERVISED_WEIGHTS
from ..sources import writers
from . import pipeline, testbed
from .catalog import query
from .oracles import block, sql
from .oracles import seeded as seeded_sql
from .queries_features import inputs
from .queries_models import full_model, trained_risk_table
from .queries_sources import scratch


@query("attribution_sums", sql("SELECT npi, TRUE AS adds_up FROM mart", "mart"))
def attribution_sums(spark, d):
    """Whether a provider's attributions and the base add up to the log-odds of its score."""
    rows, fitted = full_model(spark, d)
    total = boosting.attributions(rows, fitted).groupBy("npi").agg((F.sum("attribution") + F.max("base")).alias("margin"))
    p = F.col("xgb_fraud_prob")
    both = total.join(boosting.boosted_scores(rows, fitted).select("npi", p), "npi")
    return both.select("npi", (F.abs(F.col("margin") - F.log(p / (1 - p))) < 1e-6).alias("adds_up"))


@query("contributor_order", sql("SELECT npi, [1, 2, 3, 4, 5] AS positions, TRUE AS falling FROM mart", "mart"))
def contributor_order(spark, d):
    """The five strongest contributors of every provider stand in falling order of impact."""
    top = explain.contributors(boosting.strongest(*full_model(spark, d)))
    packed = top.groupBy("npi").agg(F.array_sort(F.collect_list(F.struct("position", "impact"))).alias("t"))
    falling = F.forall(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.get("t", i)["impact"] <= F.get("t", i - 1)["impact"])
    return packed.select("npi", F.transform("t", lambda x: x["position"]).alias("positions"), falling.alias("falling"))


@query(
    "trained_risk_parts",
    sql(
        """
        SELECT (round(p * 0.2::DOUBLE) + round((n - p) * 0.2::DOUBLE))::BIGINT AS n_test, TRUE AS weighted, TRUE AS in_range, TRUE AS tiers_rise
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_excluded AND total_medicare_payments >= 5000
                     AND exclusion_type IN ('1128a1', '1128a3', '1128Aa', '1128b6', '1128b7')) AS p FROM mart)
        """,
        "mart",
    ),
)
def trained_risk_parts(spark, d):
    """The trained risk table: test rows, scores as weighted layers, tiers that rise with the score."""
    rows = materialize(trained_risk_table(spark, d))
    def weighted_by(weights):
        return sum(F.lit(w) * F.col(scoring.LAYERS[k]) for k, w in weights.items()) * 100.0

    # without a trained supervised layer its weight goes to the others
    trained = rows.select(F.max(scoring.LAYERS["xgboost"]) > 0).scalar()
    weighted = F.when(trained, weighted_by(ENSEMBLE_WEIGHTS)).otherwise(weighted_by(UNSUPERVISED_WEIGHTS))
    tier = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("risk_tier"))
    ends = rows.groupBy(tier.alias("tier")).agg(F.min("risk_score").alias("lo"), F.max("risk_score").alias("hi"))
    ends = ends.agg(F.array_sort(F.collect_list(F.struct("tier", "lo", "hi"))).alias("e"))
    rise = F.forall(F.slice("e", 2, 9), lambda x: F.forall("e", lambda y: (y["tier"] >= x["tier"]) | (y["hi"] <= x["lo"])))
    apart = F.abs(F.col("risk_score") - F.least(F.greatest(weighted, F.lit(0.0)), F.lit(100.0)))
    return rows.withColumn("apart", apart).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.bool_and(F.col("apart") < 1e-6).alias("weighted"),
        F.bool_and(F.col("risk_score").between(0, 100)).alias("in_range"),
    ).withColumn("tiers_rise", ends.select(rise).scalar())


@query(
    "reloaded_scores",
    sql(
        f"SELECT npi, TRUE AS same FROM mart WHERE {seeded_sql(11, 'npi')} % 10 = 0",
        "mart",
    ),
)
def reloaded_scores(spark, d):
    """Providers that no stage has seen, scored by a training run and by the same run saved and loaded."""
    mart = pipeline.build_mart(inputs(spark, d)).mart.select("npi", *SQL_FEATURES)
    debt = testbed.providers(spark, d).select("npi", (F.col("c_acctbal") < 0).alias("is_excluded"))
    rows = materialize(mart.join(debt, "npi"))
    unseen = F.pmod(seeded(11, "npi"), F.lit(10)) == 0
    known = materialize(prepare.stratified_split(rows.where(~unseen)))
    stages = [
        artifacts.MedianImputer(features=SQL_FEATURES),
        artifacts.IsolationForest(features=SQL_FEATURES, trees=100),
        artifacts.Calibrator(),
        artifacts.BoostedTrees(features=SQL_FEATURES, trees=30),
        artifacts.Ensemble(),
    ]
    fitted = Pipeline(stages=stages).fit(known)
    path = scratch(spark)
    writers.save_model(fitted, path, "run")
    loaded = writers.load_model(path, "run")
    fresh = rows.where(unseen)
    one = fitted.transform(fresh).select("npi", F.col("risk_score").alias("a"))
    two = loaded.transform(fresh).select("npi", F.col("risk_score").alias("b"))
    return one.join(two, "npi").select("npi", ((F.col("a") == F.col("b")) & F.col("a").between(0, 100)).alias("same"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ONE, TWO = [a for a, _ in AUDIT_GENDER_PAIRS], [b for _, b in AUDIT_GENDER_PAIRS]

block(
    "dealt_names",
    ["who"],
    f"""
    SELECT npi, (1 + k % 4)::INTEGER AS match_tier,
           CASE k % 3 WHEN 0 THEN {_list(COMMON_LAST_NAMES)}[(k % {len(COMMON_LAST_NAMES)} + 1)::INTEGER] WHEN 1 THEN last_name
                ELSE left(last_name, 3) END AS leie_last_norm,
           {_list(ONE)}[(k % {len(ONE)} + 1)::INTEGER] AS leie_first_norm,
           CASE WHEN k % 5 < 3 THEN {_list(TWO)}[(k % {len(TWO)} + 1)::INTEGER] ELSE {_list(ONE)}[(k // 5 % {len(ONE)} + 1)::INTEGER] END AS mart_first_norm,
           (80 + k % 21)::DOUBLE AS last_score, (80 + k * 7 % 21)::DOUBLE AS first_score
    FROM (SELECT *, c_custkey::BIGINT AS k FROM who)
    """,
)


def dealt_names(spark, d):
    """Providers with names from the audited lists, dealt by key."""
    k = F.col("c_custkey").cast("long")

    def dealt(values, at):
        return F.get(F.array(*[F.lit(v) for v in values]), (at % len(values)).cast("int"))

    short = F.when(k % 3 == 0, dealt(COMMON_LAST_NAMES, k)).when(k % 3 == 1, F.col("last_name")).otherwise(F.substring("last_name", 1, 3))
    return testbed.providers(spark, d).select(
        "npi",
        (1 + k % 4).cast("int").alias("match_tier"),
        short.alias("leie_last_norm"),
        dealt(ONE, k).alias("leie_first_norm"),
        F.when(k % 5 < 3, dealt(TWO, k)).otherwise(dealt(ONE, F.floor(k / 5))).alias("mart_first_norm"),
        (80 + k % 21).cast("double").alias("last_score"),
        (80 + k * 7 % 21).cast("double").alias("first_score"),
    )


GENDER_SQL = _list("|".join(sorted(p)) for p in AUDIT_GENDER_PAIRS)


@query(
    "audit_name_rules",
    sql(
        f"""
        SELECT *, cross_gender OR both_low OR common_last OR last_too_short AS any_flag FROM (
            SELECT npi, match_tier,
                   match_tier = 3 AND least(leie_first_norm, mart_first_norm) || '|' || greatest(leie_first_norm, mart_first_norm)
                       IN {GENDER_SQL} AS cross_gender,
                   match_tier IN (3, 4) AND last_score < 90 AND first_score < 90 AS both_low,
                   match_tier IN (3, 4) AND leie_last_norm IN {_list(COMMON_LAST_NAMES)} AND leie_first_norm <> mart_first_norm AS common_last,
                   match_tier = 3 AND len(leie_last_norm) <= 3 AS last_too_short
            FROM dealt_names)
        """,
        "dealt_names",
    ),
)
def audit_name_rules(spark, d):
    return audit.flag_candidates(dealt_names(spark, d)).select("npi", "match_tier", *audit.FLAGS, "any_flag")
