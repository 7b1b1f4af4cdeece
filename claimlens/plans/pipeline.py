"""End-to-end flows that chain the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.checkpoints import materialize, store_by
from ..operators import features, summary
from ..schemas import HIGH_COMPLEXITY_CODES


@dataclass
class FeatureInputs:
    """Staged tables the feature flow starts from."""

    claims: DataFrame
    registry: DataFrame
    labels: DataFrame
    high_complexity: list[str] = field(default_factory=lambda: list(HIGH_COMPLEXITY_CODES))


@dataclass
class MartTables:
    cells: DataFrame
    mix: DataFrame
    providers: DataFrame
    benchmarks: DataFrame
    mart: DataFrame


def build_mart(inputs: FeatureInputs) -> MartTables:
    """Claims to the SQL feature mart.

    The claim lines are read once: they are combined into billing cells, laid
    out by provider and stored. Summary, mix and the later features then group
    by provider without another shuffle.
    """
    cells = store_by(summary.billing_cells(inputs.claims), "npi", arranged=True)
    mix = store_by(summary.hcpcs_mix(cells, inputs.high_complexity), "npi", arranged=True)
    providers = store_by(summary.claims_summary(cells), "npi", arranged=True)
    benchmarks = materialize(summary.specialty_benchmarks(providers))
    mart = summary.feature_mart(
        summary.enrich_providers(providers, inputs.registry, inputs.labels),
        benchmarks,
        mix,
    )
    return MartTables(cells, mix, providers, benchmarks, mart)


def build_features(inputs: FeatureInputs, tables: MartTables | None = None) -> DataFrame:
    """Claims to the full feature table, one row per provider."""
    tables = tables or build_mart(inputs)
    mart = materialize(tables.mart)
    return features.combine_features(
        mart,
        features.jsd_vs_specialty(tables.mix),
        features.zip_entropy(tables.cells),
        features.billing_velocity(tables.cells),
        features.mahalanobis_distance(mart),
    )
