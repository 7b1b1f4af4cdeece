"""Queries: staging, provider aggregates, benchmarks and the feature mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..operators import staging, summary
from . import testbed
from .catalog import query, rounded
from .oracles import rounded as sql_round
from .oracles import sql


def cells(spark, d):
    """Billing cells, dealt by provider once for all that is then grouped by provider."""
    return summary.billing_cells(testbed.claims(spark, d))


def mix(spark, d):
    return summary.hcpcs_mix(cells(spark, d), testbed.HIGH_CODES)


def providers(spark, d):
    return summary.claims_summary(cells(spark, d))


def stored_providers(spark, d):
    """The provider summary, stored because its readers scan it several times."""
    return materialize(providers(spark, d))


def stored_mix(spark, d):
    return materialize(mix(spark, d))


CLAIM_CHECK = {
    "npi": None, "provider_last_name": None, "provider_zip5": None, "provider_type": None,
    "hcpcs_code": None, "hcpcs_drug_indicator": None, "place_of_service": None,
    "total_beneficiaries": None, "total_services": 6, "total_beneficiary_day_services": 6,
    "avg_submitted_charge": 9, "avg_medicare_payment_amt": 9,
}


@query("stage_claims", sql(f"SELECT {sql_round(CLAIM_CHECK)} FROM claims", "claims"))
def stage_claims(spark, d):
    return rounded(staging.stage_claims(testbed.raw_claims(spark, d)), CLAIM_CHECK)


@query(
    "stage_exclusions",
    sql(
        """
        SELECT npi, trim(lastname) AS last_name, trim(firstname) AS first_name, state,
               trim(specialty) AS specialty, excltype AS exclusion_type,
               try_cast(excldate AS DATE) AS exclusion_date, TRUE AS is_currently_excluded
        FROM raw_exclusions WHERE length(trim(npi)) = 10
        """,
        "raw_exclusions",
    ),
)
def stage_exclusions(spark, d):
    return staging.stage_exclusions(testbed.raw_exclusions(spark, d)).select(
        "npi", "last_name", "first_name", "state", "specialty", "exclusion_type",
        "exclusion_date", "is_currently_excluded",
    )


@query(
    "exclusions_active",
    sql(
        """
        SELECT npi, strptime(excldate, '%Y%m%d')::DATE AS exclusion_date,
               CASE WHEN reindate = '00000000' THEN NULL ELSE strptime(reindate, '%Y%m%d')::DATE END
                   AS reinstatement_date,
               reindate = '00000000' AS is_currently_excluded
        FROM raw_exclusions WHERE length(trim(npi)) = 10
        """,
        "raw_exclusions",
    ),
)
def exclusions_active(spark, d):
    return staging.stage_exclusions(testbed.raw_exclusions(spark, d), parse_dates=True).select(
        "npi", "exclusion_date", "reinstatement_date", "is_currently_excluded"
    )


@query("stage_registry", sql("SELECT * FROM registry", "registry"))
def stage_registry(spark, d):
    return staging.stage_registry(testbed.raw_registry(spark, d))


SUMMARY_CHECK = {
    "npi": None, "provider_last_name": None, "provider_first_name": None, "provider_type": None,
    "entity_type": None, "provider_state": None, "provider_zip5": None, "provider_gender": None,
    "unique_hcpcs_codes": None, "total_services": 6, "total_beneficiaries": None,
    "total_beneficiary_day_services": 6, "total_submitted_charges": 6,
    "total_medicare_payments": 6, "total_medicare_allowed": 6, "total_standardized_payments": 6,
    "wavg_submitted_charge": 6, "wavg_medicare_payment": 6, "services_per_beneficiary": 6,
    "facility_service_ratio": 6, "drug_service_ratio": 6,
}


@query("claims_summary", sql(f"SELECT {sql_round(SUMMARY_CHECK)} FROM summary", "summary"))
def claims_summary(spark, d):
    return rounded(providers(spark, d), SUMMARY_CHECK)


MIX_CHECK = {
    "npi": None, "hcpcs_code": None, "provider_type": None, "hcpcs_services": 6,
    "hcpcs_fraction": 6, "is_high_complexity": None,
}


@query("hcpcs_mix", sql(f"SELECT {sql_round(MIX_CHECK)} FROM mix", "mix"))
def hcpcs_mix(spark, d):
    return rounded(mix(spark, d), MIX_CHECK)


BENCH_CHECK = {
    "specialty": None, "peer_count": None,
    "avg_total_services": 6, "std_total_services": 6, "median_total_services": 6,
    "avg_total_payments": 4, "std_total_payments": 4, "median_total_payments": 6,
    "avg_total_beneficiaries": 6, "std_total_beneficiaries": 6,
    "avg_services_per_bene": 6, "std_services_per_bene": 6, "median_services_per_bene": 6,
    "avg_unique_hcpcs": 6, "std_unique_hcpcs": 6, "avg_wavg_charge": 6, "std_wavg_charge": 6,
    "p25_total_services": 6, "p75_total_services": 6, "p95_total_services": 6,
    "p99_total_services": 6,
}


@query("specialty_benchmarks", sql(f"SELECT {sql_round(BENCH_CHECK)} FROM benchmarks", "benchmarks"))
def specialty_benchmarks(spark, d):
    return rounded(summary.specialty_benchmarks(stored_providers(spark, d)), BENCH_CHECK)


@query(
    "provider_upcoding",
    sql("SELECT npi, round(high_complexity_ratio, 6) AS high_complexity_ratio FROM provider_upcoding",
        "provider_upcoding"),
)
def provider_upcoding(spark, d):
    return rounded(
        summary.provider_upcoding(mix(spark, d)), {"npi": None, "high_complexity_ratio": 6}
    )


@query(
    "specialty_upcoding",
    sql(
        "SELECT specialty, round(peer_high_complexity_ratio, 6) AS peer_high_complexity_ratio "
        "FROM specialty_upcoding",
        "specialty_upcoding",
    ),
)
def specialty_upcoding(spark, d):
    return rounded(
        summary.specialty_upcoding(mix(spark, d)),
        {"specialty": None, "peer_high_complexity_ratio": 6},
    )
