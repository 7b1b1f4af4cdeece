"""Derives claims, registry and exclusion list from the supplied star schema.

Providers are customers, specialties market segments, procedure codes part
names, patient zips supplier nations and states customer nations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checkpoints import widen

# fixed values: the first nine part names stand in for high-complexity codes
HIGH_CODES = [
    "blue anvil", "blue bolt", "blue gear", "blue gizmo", "blue plate",
    "blue ring", "blue rod", "blue widget", "cold anvil",
]
# fixed values: exclusion types dealt out over the derived exclusion list
EXCLUSION_TYPES = ["1128a1", "1128a2", "1128a3", "1128b4"]
STATES = tuple(f"{i:02d}" for i in range(25))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def npi_of(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 10, "0")


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as providers: id, name taken from a part name, state."""
    words = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("name_key"),
        F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("last_name"),
        F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("first_name"),
    )
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_acctbal",
        "c_nationkey",
        "c_mktsegment",
        (F.col("c_custkey") % words.select(F.count(F.lit(1))).scalar() + 1).alias("name_key"),
    )
    return cust.join(words, "name_key", "left").select(
        "c_custkey",
        "c_acctbal",
        "c_nationkey",
        npi_of("c_custkey").alias("npi"),
        "last_name",
        "first_name",
        F.col("c_mktsegment").alias("segment"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state"),
        F.when(F.col("c_nationkey") >= 20, "O").otherwise("I").alias("entity"),
        F.when(F.col("c_acctbal") < 4500, "F").otherwise("M").alias("gender"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as staged claim lines.

    Lines move once per table too large to broadcast, and narrow; orders, a fourth as
    many, meet their providers before the lines. A task hashes its providers and orders,
    at most one row a key and bounded by the number of partitions, and sorts no lines.
    """
    line = widen(table(spark, sf_dir, "lineitem"))
    orders = widen(table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    codes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("hcpcs_code")
    )
    zips = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("provider_zip5"),
    )
    who = providers(spark, sf_dir).hint("shuffle_hash")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    kept = 1 - F.col("l_discount")
    return (
        line.join(codes, "l_partkey")
        .join(zips, "l_suppkey")
        .join(orders.join(who, "c_custkey").hint("shuffle_hash"), "l_orderkey")
        .select(
            "npi",
            F.col("last_name").alias("provider_last_name"),
            F.col("first_name").alias("provider_first_name"),
            F.col("gender").alias("provider_gender"),
            F.col("entity").alias("entity_type"),
            F.col("state").alias("provider_state"),
            "provider_zip5",
            F.col("segment").alias("provider_type"),
            "hcpcs_code",
            F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("hcpcs_drug_indicator"),
            F.col("l_linestatus").alias("place_of_service"),
            F.col("l_linenumber").cast("int").alias("total_beneficiaries"),
            F.col("l_quantity").alias("total_services"),
            (F.col("l_quantity") * (1 + F.col("l_tax"))).alias("total_beneficiary_day_services"),
            unit.alias("avg_submitted_charge"),
            (unit * kept).alias("avg_medicare_allowed_amt"),
            (unit * kept * 0.8).alias("avg_medicare_payment_amt"),
            (unit * (1 + F.col("l_tax"))).alias("avg_medicare_standardized_amt"),
        )
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as an unstaged file would hold them: text, padded."""
    c = claims(spark, sf_dir)
    pad = {
        "Rndrng_NPI": "npi",
        "Rndrng_Prvdr_Last_Org_Name": "provider_last_name",
        "Rndrng_Prvdr_First_Name": "provider_first_name",
        "Rndrng_Prvdr_Gndr": "provider_gender",
        "Rndrng_Prvdr_Ent_Cd": "entity_type",
        "Rndrng_Prvdr_State_Abrvtn": "provider_state",
        "Rndrng_Prvdr_Zip5": "provider_zip5",
        "Rndrng_Prvdr_Type": "provider_type",
        "HCPCS_Cd": "hcpcs_code",
        "HCPCS_Drug_Ind": "hcpcs_drug_indicator",
        "Place_Of_Srvc": "place_of_service",
    }
    blank = ["Rndrng_Prvdr_MI", "Rndrng_Prvdr_Crdntls", "Rndrng_Prvdr_St1", "Rndrng_Prvdr_City",
             "Rndrng_Prvdr_State_FIPS", "Rndrng_Prvdr_RUCA", "Rndrng_Prvdr_Mdcr_Prtcptg_Ind",
             "HCPCS_Desc"]
    return c.select(
        *[
            (F.col(src) if dst == "Rndrng_NPI" else F.concat(F.lit(" "), F.col(src), F.lit(" "))).alias(dst)
            for dst, src in pad.items()
        ],
        *[F.lit(None).cast("string").alias(b) for b in blank],
        F.col("total_beneficiaries").cast("string").alias("Tot_Benes"),
        F.col("total_services").cast("string").alias("Tot_Srvcs"),
        F.col("total_beneficiary_day_services").cast("string").alias("Tot_Bene_Day_Srvcs"),
        F.col("avg_submitted_charge").cast("string").alias("Avg_Sbmtd_Chrg"),
        F.col("avg_medicare_allowed_amt").cast("string").alias("Avg_Mdcr_Alowd_Amt"),
        F.col("avg_medicare_payment_amt").cast("string").alias("Avg_Mdcr_Pymt_Amt"),
        F.col("avg_medicare_standardized_amt").cast("string").alias("Avg_Mdcr_Stdzd_Amt"),
    )


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows; customers with a balance of 9000 or more have none."""
    p = providers(spark, sf_dir).where(F.col("c_acctbal") < 9000)
    org = F.col("entity") == "O"
    return p.select(
        "npi",
        F.when(org, "2").when(F.col("c_acctbal") < 8800, "1").otherwise("9").alias("entity_type_code"),
        F.concat(F.lit(" "), "last_name").alias("last_name"),
        "first_name",
        F.when(org, F.concat_ws(" ", "first_name", "last_name")).alias("organization_name"),
        F.col("state").alias("practice_state"),
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "9"), F.lit("-1234")).alias(
            "practice_zip"
        ),
        F.concat(F.lit("TX"), F.col("segment")).alias("taxonomy_code"),
        F.concat(F.lit("2010-01-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")).alias(
            "enumeration_date"
        ),
        F.col("gender").alias("gender_code"),
    )


def raw_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt form the exclusion list. By nation, an entry carries
    the provider's id, the exact name only, or a name with one letter doubled."""
    p = providers(spark, sf_dir).where(F.col("c_acctbal") < 0)
    kind = F.col("c_nationkey") % 3
    last = F.col("last_name")
    return p.select(
        F.when(kind == 2, F.concat(F.substring(last, 1, 1), last)).otherwise(last).alias("LASTNAME"),
        F.concat(F.initcap("first_name"), F.lit(" ")).alias("FIRSTNAME"),
        F.lit("").alias("MIDNAME"),
        F.when(F.col("entity") == "O", F.concat_ws(" ", "first_name", "last_name")).alias("BUSNAME"),
        F.lit("IND").alias("GENERAL"),
        F.when(F.col("segment") == "FURNITURE", "PHARMACY ").otherwise(F.col("segment")).alias(
            "SPECIALTY"
        ),
        F.when(kind == 0, F.col("npi")).otherwise(F.lit("0000000000")).alias("NPI"),
        F.lit("").alias("ADDRESS"),
        F.lit("").alias("CITY"),
        F.col("state").alias("STATE"),
        F.lit("").alias("ZIP"),
        F.element_at(
            F.array(*[F.lit(t) for t in EXCLUSION_TYPES]), (F.col("c_custkey") % 4 + 1).cast("int")
        ).alias("EXCLTYPE"),
        F.concat(
            F.lit("20"),
            F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0"),
            F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0"),
            F.lit("15"),
        ).alias("EXCLDATE"),
        F.when(F.col("c_acctbal") < -900, "20220101").otherwise("00000000").alias("REINDATE"),
        F.lit("00000000").alias("WAIVERDATE"),
        F.lit("").alias("WVRSTATE"),
        "c_custkey",
    )


def scored_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers with stand-in layer scores computed from the customer key."""
    key = F.col("c_custkey")
    return providers(spark, sf_dir).select(
        "npi",
        F.col("last_name").alias("provider_last_name"),
        F.col("first_name").alias("provider_first_name"),
        F.col("segment").alias("provider_specialty"),
        F.col("state").alias("provider_state"),
        (F.col("c_acctbal") < 0).alias("is_excluded"),
        (F.pmod(key * 7919, F.lit(1000)) / 999.0).alias("if_anomaly_score"),
        (F.pmod(key * 104729, F.lit(997)) / 996.0).alias("xgb_fraud_prob"),
        (F.pmod(key * 31, F.lit(101)) / 100.0).alias("graph_anomaly_score"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as ranked rows: length is the score, quality the label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        npi_of("doc_id").alias("npi"),
        F.col("lang").alias("provider_specialty"),
        F.col("n_chars").cast("double").alias("risk_score"),
        (F.col("quality") == 1).alias("is_excluded"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as review decisions."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        npi_of("user_id").alias("npi"),
        F.when(kind == "purchase", "Referred for Investigation")
        .when(kind == "click", "No Action — Legitimate Pattern")
        .when(kind == "view", "No Action — Insufficient Evidence")
        .otherwise("Needs More Data")
        .alias("decision"),
        F.lit("").alias("notes"),
    )
