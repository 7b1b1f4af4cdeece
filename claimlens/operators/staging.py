"""Typed, trimmed views over the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import compact_date

# fixed values: raw claim column -> staged name, text columns then numbers
CLAIM_TEXT = {
    "Rndrng_Prvdr_Last_Org_Name": "provider_last_name",
    "Rndrng_Prvdr_First_Name": "provider_first_name",
    "Rndrng_Prvdr_Crdntls": "provider_credentials",
    "Rndrng_Prvdr_Gndr": "provider_gender",
    "Rndrng_Prvdr_Ent_Cd": "entity_type",
    "Rndrng_Prvdr_St1": "provider_street",
    "Rndrng_Prvdr_City": "provider_city",
    "Rndrng_Prvdr_State_Abrvtn": "provider_state",
    "Rndrng_Prvdr_State_FIPS": "provider_state_fips",
    "Rndrng_Prvdr_Zip5": "provider_zip5",
    "Rndrng_Prvdr_RUCA": "provider_ruca",
    "Rndrng_Prvdr_Type": "provider_type",
    "Rndrng_Prvdr_Mdcr_Prtcptg_Ind": "medicare_participating",
    "HCPCS_Cd": "hcpcs_code",
    "HCPCS_Desc": "hcpcs_description",
    "HCPCS_Drug_Ind": "hcpcs_drug_indicator",
    "Place_Of_Srvc": "place_of_service",
}
CLAIM_NUMBERS = {
    "Tot_Benes": ("total_beneficiaries", "int"),
    "Tot_Srvcs": ("total_services", "double"),
    "Tot_Bene_Day_Srvcs": ("total_beneficiary_day_services", "double"),
    "Avg_Sbmtd_Chrg": ("avg_submitted_charge", "double"),
    "Avg_Mdcr_Alowd_Amt": ("avg_medicare_allowed_amt", "double"),
    "Avg_Mdcr_Pymt_Amt": ("avg_medicare_payment_amt", "double"),
    "Avg_Mdcr_Stdzd_Amt": ("avg_medicare_standardized_amt", "double"),
}
EXCLUSION_TEXT = {
    "LASTNAME": "last_name",
    "FIRSTNAME": "first_name",
    "MIDNAME": "middle_name",
    "ADDRESS": "address",
    "CITY": "city",
    "STATE": "state",
    "ZIP": "zip_code",
    "SPECIALTY": "specialty",
    "EXCLTYPE": "exclusion_type",
    "WVRSTATE": "waiver_state",
}


def present(c: str) -> Column:
    """The column is neither NULL nor blank."""
    return F.col(c).isNotNull() & (F.trim(c) != "")


def stage_claims(raw: DataFrame) -> DataFrame:
    """Rename, trim and cast claim lines; lines without a provider id go."""
    return raw.where(present("Rndrng_NPI")).select(
        F.col("Rndrng_NPI").cast("string").alias("npi"),
        *[F.trim(src).alias(dst) for src, dst in CLAIM_TEXT.items()],
        *[F.col(src).cast(typ).alias(dst) for src, (dst, typ) in CLAIM_NUMBERS.items()],
    )


def stage_exclusions(raw: DataFrame, parse_dates: bool = False) -> DataFrame:
    """Exclusion entries with a ten-character provider id.

    Dates are read by plain cast, under which the list's yyyyMMdd text becomes
    NULL; ``parse_dates=True`` understands that format.
    """

    def date(c: str) -> Column:
        return compact_date(c) if parse_dates else F.col(c).try_cast("date")

    return raw.where(F.length(F.trim("NPI")) == 10).select(
        F.col("NPI").cast("string").alias("npi"),
        *[F.trim(src).alias(dst) for src, dst in EXCLUSION_TEXT.items()],
        date("EXCLDATE").alias("exclusion_date"),
        date("REINDATE").alias("reinstatement_date"),
        date("WAIVERDATE").alias("waiver_date"),
        date("REINDATE").isNull().alias("is_currently_excluded"),
    )


def entity_kind(code: str) -> Column:
    return (
        F.when(F.col(code) == "1", "individual")
        .when(F.col(code) == "2", "organization")
        .otherwise("unknown")
    )


def stage_registry(raw: DataFrame) -> DataFrame:
    return raw.where(present("npi")).select(
        F.col("npi").cast("string").alias("npi"),
        entity_kind("entity_type_code").alias("entity_type"),
        F.trim("last_name").alias("last_name"),
        F.trim("first_name").alias("first_name"),
        F.trim("organization_name").alias("organization_name"),
        F.trim("practice_state").alias("practice_state"),
        F.substring(F.trim("practice_zip"), 1, 5).alias("practice_zip5"),
        F.trim("taxonomy_code").alias("primary_taxonomy_code"),
        F.col("enumeration_date").try_cast("date").alias("enumeration_date"),
        F.trim("gender_code").alias("gender_code"),
    )


def stage_labels(labels: DataFrame) -> DataFrame:
    """Matched labels; every stored label counts as a current exclusion."""
    return labels.select(
        F.col("npi").cast("string").alias("npi"),
        F.col("is_excluded").cast("boolean").alias("is_excluded"),
        F.col("match_tier").cast("int").alias("match_tier"),
        F.col("similarity_score").cast("double").alias("similarity_score"),
        "exclusion_type",
        F.col("exclusion_date_parsed").cast("date").alias("exclusion_date"),
        F.lit(True).alias("is_currently_excluded"),
        "leie_specialty",
        F.col("leie_row_n_candidates").cast("long").alias("leie_row_n_candidates"),
        F.col("provider_n_leie_rows").cast("long").alias("provider_n_leie_rows"),
    )
