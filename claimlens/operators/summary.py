"""Provider aggregates, peer benchmarks and the SQL feature mart."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checkpoints import lookup_side
from ..functions.columns import ratio_vs_benchmark, safe_zscore
from ..functions.ranking import Quantile, exact_quantiles
from ..schemas import HIGH_COMPLEXITY_CODES

CELL_KEYS = ["npi", "hcpcs_code", "provider_type", "provider_zip5"]
CELL_ATTRIBUTES = [
    "provider_last_name",
    "provider_first_name",
    "entity_type",
    "provider_state",
    "provider_gender",
]
# lines that a task combines at a time
FOLD_ROWS = 65_536


def _folded(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with equal keys added up; what still folds stays in the task, a bounded number of rows."""
    held: list[pa.RecordBatch] = []

    def fold() -> pa.Table:
        table = pa.Table.from_batches(held)
        found = table.group_by(keys, use_threads=False).aggregate([(n, "sum") for n in names])
        return found.select([*keys, *[f"{n}_sum" for n in names]]).rename_columns([*keys, *names]).cast(table.schema)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= FOLD_ROWS:
            table = fold()
            held = table.to_batches()
            if table.num_rows > FOLD_ROWS // 2:
                yield from held
                held = []
    if held:
        yield from fold().to_batches()


def billing_cells(claims: DataFrame) -> DataFrame:
    """Claim lines folded to provider x code x type x zip, dealt by provider.

    Every provider-level operator reads sums over these keys, so the lines are
    scanned once and combined map-side before anything is shuffled by provider;
    a provider that holds a third of all lines shrinks to its distinct cells.
    The combining is done before the exchange by provider, which is the only one:
    a grouping by all keys would exchange the cells, and they again by provider.
    Names and other attributes are grouping keys: a minimum over text would turn
    the hash aggregate over all lines into a sort.
    """
    services = F.col("total_services")

    def only(flag: Column) -> Column:
        return F.when(flag, services).otherwise(0.0)

    keys = [*CELL_KEYS, *CELL_ATTRIBUTES]
    values = {
        "total_services": services,
        "total_beneficiaries": F.col("total_beneficiaries"),
        "total_beneficiary_day_services": F.col("total_beneficiary_day_services"),
        "submitted_charges": services * F.col("avg_submitted_charge"),
        "medicare_payments": services * F.col("avg_medicare_payment_amt"),
        "medicare_allowed": services * F.col("avg_medicare_allowed_amt"),
        "standardized_payments": services * F.col("avg_medicare_standardized_amt"),
        "facility_services": only(F.col("place_of_service") == "F"),
        "office_services": only(F.col("place_of_service") == "O"),
        "drug_services": only(F.col("hcpcs_drug_indicator") == "Y"),
    }
    names = list(values)
    lines = claims.select(*keys, *[v.alias(n) for n, v in values.items()])
    sums = [F.sum(n).alias(n) for n in names]
    wide = lines.groupBy(*keys).agg(*sums).schema
    lines = lines.select(*keys, *[F.col(n).cast(wide[n].dataType).alias(n) for n in names])
    folded = lines.mapInArrow(lambda batches: _folded(batches, keys, names), wide)
    return folded.repartition("npi").groupBy(*keys).agg(*sums)


def claims_summary(cells: DataFrame) -> DataFrame:
    """One row per provider: attributes, volumes, money and service mix."""
    s = F.sum
    services, benes = s("total_services"), s("total_beneficiaries")
    return cells.groupBy("npi").agg(
        F.min("provider_last_name").alias("provider_last_name"),
        F.min("provider_first_name").alias("provider_first_name"),
        F.min("provider_type").alias("provider_type"),
        F.min("entity_type").alias("entity_type"),
        F.min("provider_state").alias("provider_state"),
        F.min("provider_zip5").alias("provider_zip5"),
        F.min("provider_gender").alias("provider_gender"),
        # a set holds at most all codes; a distinct count would fold every column by provider and code first
        F.size(F.collect_set("hcpcs_code")).cast("long").alias("unique_hcpcs_codes"),
        services.alias("total_services"),
        benes.alias("total_beneficiaries"),
        s("total_beneficiary_day_services").alias("total_beneficiary_day_services"),
        s("submitted_charges").alias("total_submitted_charges"),
        s("medicare_payments").alias("total_medicare_payments"),
        s("medicare_allowed").alias("total_medicare_allowed"),
        s("standardized_payments").alias("total_standardized_payments"),
        F.try_divide(s("submitted_charges"), services).alias("wavg_submitted_charge"),
        F.try_divide(s("medicare_payments"), services).alias("wavg_medicare_payment"),
        F.try_divide(services, benes).alias("services_per_beneficiary"),
        F.try_divide(s("facility_services"), services).alias("facility_service_ratio"),
        F.try_divide(s("drug_services"), services).alias("drug_service_ratio"),
    )


def hcpcs_mix(cells: DataFrame, high_complexity=HIGH_COMPLEXITY_CODES) -> DataFrame:
    """Services and share of the provider's total per provider x code x type."""
    per_code = cells.groupBy("npi", "hcpcs_code", "provider_type").agg(
        F.sum("total_services").alias("hcpcs_services")
    )
    total = F.sum("hcpcs_services").over(W.partitionBy("npi"))
    return per_code.select(
        "npi",
        "hcpcs_code",
        "provider_type",
        "hcpcs_services",
        F.try_divide("hcpcs_services", total).alias("hcpcs_fraction"),
        F.coalesce(F.col("hcpcs_code").isin(list(high_complexity)), F.lit(False)).alias(
            "is_high_complexity"
        ),
    )


def specialty_benchmarks(summary: DataFrame, min_peers: int = 10) -> DataFrame:
    """Peer statistics per specialty with at least ``min_peers`` providers."""
    providers = summary.where(F.col("provider_type").isNotNull()).withColumnRenamed(
        "provider_type", "specialty"
    )
    moments = {
        "total_services": "total_services",
        "total_payments": "total_medicare_payments",
        "total_beneficiaries": "total_beneficiaries",
        "services_per_bene": "services_per_beneficiary",
        "unique_hcpcs": "unique_hcpcs_codes",
        "wavg_charge": "wavg_submitted_charge",
    }
    stats = providers.groupBy("specialty").agg(
        F.count(F.lit(1)).alias("peer_count"),
        *[F.avg(c).alias(f"avg_{n}") for n, c in moments.items()],
        *[F.stddev_pop(c).alias(f"std_{n}") for n, c in moments.items()],
    )
    order = exact_quantiles(
        providers,
        ["specialty"],
        {
            "median_total_services": Quantile("total_services", 0.5),
            "median_total_payments": Quantile("total_medicare_payments", 0.5),
            "median_services_per_bene": Quantile("services_per_beneficiary", 0.5),
            "p25_total_services": Quantile("total_services", 0.25),
            "p75_total_services": Quantile("total_services", 0.75),
            "p95_total_services": Quantile("total_services", 0.95),
            "p99_total_services": Quantile("total_services", 0.99),
        },
    )
    return stats.where(F.col("peer_count") >= min_peers).join(order, "specialty", "left")


def enrich_providers(summary: DataFrame, registry: DataFrame, labels: DataFrame) -> DataFrame:
    """Provider rows with registry attributes and exclusion labels."""
    reg = registry.select(
        "npi",
        "primary_taxonomy_code",
        "enumeration_date",
        F.col("practice_state").alias("nppes_practice_state"),
        F.col("practice_zip5").alias("nppes_practice_zip5"),
    )
    lab = labels.select(
        "npi",
        F.col("is_excluded").alias("__excluded"),
        F.col("match_tier").alias("exclusion_match_tier"),
        F.col("similarity_score").alias("exclusion_match_score"),
        "exclusion_type",
        "exclusion_date",
        F.col("is_currently_excluded").alias("__current"),
    )
    return (
        summary.join(reg, "npi", "left")
        .join(lab, "npi", "left")
        .withColumns(
            {
                "is_excluded": F.coalesce("__excluded", F.lit(False)),
                "is_currently_excluded": F.coalesce("__current", F.lit(False)),
                "provider_specialty": F.coalesce("provider_type", F.lit("Unknown")),
            }
        )
        .drop("__excluded", "__current")
    )


def high_complexity_share(mix: DataFrame, key: str, name: str) -> DataFrame:
    """Share of services billed under high-complexity codes, per ``key``."""
    high = F.sum(F.when(F.col("is_high_complexity"), F.col("hcpcs_services")).otherwise(0.0))
    return mix.groupBy(key).agg(F.try_divide(high, F.sum("hcpcs_services")).alias(name))


def provider_upcoding(mix: DataFrame) -> DataFrame:
    return high_complexity_share(mix, "npi", "high_complexity_ratio")


def specialty_upcoding(mix: DataFrame) -> DataFrame:
    return high_complexity_share(
        mix.where(F.col("provider_type").isNotNull()), "provider_type", "peer_high_complexity_ratio"
    ).withColumnRenamed("provider_type", "specialty")


def feature_mart(enriched: DataFrame, benchmarks: DataFrame, mix: DataFrame) -> DataFrame:
    """One feature row per provider against its specialty peers.

    The peer tables have one row per specialty; their size is measured at run
    time, so they are broadcast when small and shuffled otherwise.
    """
    peers = lookup_side(
        benchmarks.join(specialty_upcoding(mix), "specialty", "full").withColumnRenamed(
            "specialty", "provider_specialty"
        )
    )
    joined = enriched.join(provider_upcoding(mix), "npi", "left").join(
        peers, "provider_specialty", "left"
    )

    def z(value: str, peer: str, name: str) -> Column:
        return safe_zscore(value, f"avg_{peer}", f"std_{peer}").alias(f"zscore_{name}")

    def above(pct: str) -> Column:
        over = F.col("total_services") > F.col(f"{pct}_total_services")
        return F.coalesce(over, F.lit(False)).alias(f"is_above_{pct}_volume")

    return joined.select(
        "npi",
        "provider_last_name",
        "provider_first_name",
        "provider_specialty",
        "entity_type",
        "provider_state",
        "provider_zip5",
        "primary_taxonomy_code",
        "total_services",
        "total_beneficiaries",
        "total_medicare_payments",
        "total_submitted_charges",
        "unique_hcpcs_codes",
        "services_per_beneficiary",
        "facility_service_ratio",
        "drug_service_ratio",
        "wavg_submitted_charge",
        "wavg_medicare_payment",
        z("total_services", "total_services", "total_services"),
        z("total_medicare_payments", "total_payments", "total_payments"),
        z("total_beneficiaries", "total_beneficiaries", "total_beneficiaries"),
        z("services_per_beneficiary", "services_per_bene", "services_per_bene"),
        z("unique_hcpcs_codes", "unique_hcpcs", "unique_hcpcs"),
        z("wavg_submitted_charge", "wavg_charge", "avg_charge"),
        ratio_vs_benchmark("total_services", "median_total_services").alias(
            "ratio_services_vs_median"
        ),
        ratio_vs_benchmark("total_medicare_payments", "median_total_payments").alias(
            "ratio_payments_vs_median"
        ),
        ratio_vs_benchmark("services_per_beneficiary", "median_services_per_bene").alias(
            "ratio_svc_per_bene_vs_median"
        ),
        ratio_vs_benchmark("total_beneficiary_day_services", "total_beneficiaries").alias(
            "beneficiary_day_intensity"
        ),
        "high_complexity_ratio",
        ratio_vs_benchmark("high_complexity_ratio", "peer_high_complexity_ratio").alias(
            "upcoding_ratio_vs_peers"
        ),
        F.col("peer_count").alias("specialty_peer_count"),
        F.col("avg_total_services").alias("specialty_avg_services"),
        F.col("p95_total_services").alias("specialty_p95_services"),
        F.col("p99_total_services").alias("specialty_p99_services"),
        above("p95"),
        above("p99"),
        "is_excluded",
        "exclusion_type",
        "exclusion_date",
        "is_currently_excluded",
        "exclusion_match_tier",
        "exclusion_match_score",
    )


def volume_flags(mart: DataFrame) -> DataFrame:
    return mart.select("npi", "is_above_p95_volume", "is_above_p99_volume")
