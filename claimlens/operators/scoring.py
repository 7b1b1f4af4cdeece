"""Ensemble score, risk tiers and the risk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..functions.columns import clip, min_max
from ..functions.ranking import Quantile, exact_quantiles
from ..schemas import ENSEMBLE_WEIGHTS, TIER_QUANTILES, TIERS, UNSUPERVISED_WEIGHTS

LAYERS = {
    "isolation_forest": "if_anomaly_score",
    "xgboost": "xgb_fraud_prob",
    "graph": "graph_anomaly_score",
}


def calibrate(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Invert and scale a raw score (low = anomalous) to [0, 1] over all rows."""
    ends = df.select(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi"))).scalar()
    scaled = (F.col("__ends.hi") - F.col(raw)) / (
        F.col("__ends.hi") - F.col("__ends.lo") + F.lit(1e-10)
    )
    return df.withColumn("__ends", ends).withColumn(out, clip(scaled, 0.0, 1.0)).drop("__ends")


def min_max_columns(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Add each named expression scaled to [0, 1] over the whole table."""
    exprs = {n: (F.col(c) if isinstance(c, str) else c).cast("double") for n, c in columns.items()}
    ends = df.select(
        F.struct(
            *[F.min(e).alias(f"lo_{n}") for n, e in exprs.items()],
            *[F.max(e).alias(f"hi_{n}") for n, e in exprs.items()],
        )
    ).scalar()
    scaled = {
        n: min_max(e, F.col(f"__ends.lo_{n}"), F.col(f"__ends.hi_{n}")) for n, e in exprs.items()
    }
    return df.withColumn("__ends", ends).withColumns(scaled).drop("__ends")


def normalized_weights(weights: dict[str, float] | None) -> dict[str, float]:
    weights = dict(weights or ENSEMBLE_WEIGHTS)
    total = sum(weights.values())
    if abs(total - 1.0) > 0.01:
        weights = {k: w / total for k, w in weights.items()}
    return weights


def ensemble_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``risk_score`` in [0, 100] from the three layer scores.

    If the supervised layer is zero on every row its weight moves to the others.
    """
    p = F.col(LAYERS["xgboost"])
    untrained = df.select((F.max(p) == 0) & (F.min(p) == 0)).scalar()
    layers = {c: F.col(c) for c in LAYERS.values()}
    return df.withColumn("risk_score", weighted_score(normalized_weights(weights), untrained, layers))


def weighted_score(weights: dict[str, float], untrained: Column, layers: dict[str, Column]) -> Column:
    """Score in [0, 100] of the layers' weighted sum; ``untrained`` moves the supervised weight to the others."""

    def weighted(w: dict[str, float]) -> Column:
        return sum(F.lit(float(w[k])) * layers[c] for k, c in LAYERS.items())

    combined = F.when(untrained, weighted(UNSUPERVISED_WEIGHTS)).otherwise(weighted(weights))
    return clip(combined * 100.0, 0.0, 100.0)


def tier_edges(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """One row, one array: score quantiles, each nudged above the one before."""
    specs = {f"e{i}": Quantile(score, q) for i, q in enumerate(TIER_QUANTILES)}
    row = exact_quantiles(df, [], specs)
    edges = [F.col("e0")]
    for i in range(1, len(TIER_QUANTILES)):
        here, before = F.col(f"e{i}"), edges[-1]
        edges.append(F.when(here <= before, before + F.lit(1e-9)).otherwise(here))
    return row.select(F.array(*edges).alias("edges"))


def risk_tiers(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """Add ``risk_tier``: right-closed quantile bands, lowest edge included."""
    edges = tier_edges(df, score).scalar()
    tier = F.lit(TIERS[-1])
    for i in range(len(TIERS) - 2, -1, -1):
        edge = F.get("__edges", F.lit(i + 1))
        tier = F.when(F.col(score) <= edge, F.lit(TIERS[i])).otherwise(tier)
    return (
        df.withColumn("__edges", edges)
        .withColumn("risk_tier", F.when(F.col(score).isNotNull(), tier))
        .drop("__edges")
    )


def fixed_tiers(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """Add ``risk_tier`` from the fixed bands (-1, 20, 40, 60, 80, 101]."""
    s = F.col(score)
    tier = F.when((s <= -1) | (s > 101), None)
    for top, name in zip((20, 40, 60, 80, 101), TIERS):
        tier = tier.when(s <= top, name)
    return df.withColumn("risk_tier", tier)


def risk_table(providers: DataFrame) -> DataFrame:
    """Scored providers with tier, highest risk first (ties by provider id).

    The scores are stored before the tier edges are looked up, so the layers
    behind them run once.
    """
    columns = [
        "npi",
        "provider_last_name",
        "provider_first_name",
        "provider_specialty",
        "provider_state",
        "is_excluded",
        "risk_score",
        *LAYERS.values(),
    ]
    rows = materialize(providers.select(*columns))
    return risk_tiers(rows).orderBy(F.desc("risk_score"), "npi")


def attach_graph_score(df: DataFrame, graph: DataFrame) -> DataFrame:
    """Graph score by provider; providers outside the graph score 0."""
    return df.join(graph.select("npi", "graph_anomaly_score"), "npi", "left").withColumn(
        "graph_anomaly_score", F.coalesce("graph_anomaly_score", F.lit(0.0))
    )
