"""Queries: work list, registry flattening and round trips through files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..schemas import EXCLUSION_COLUMNS
from ..sources import readers, writers
from . import testbed
from .catalog import query
from .oracles import sql


def scratch(spark) -> str:
    """A new path in the shared checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        materialize(spark.range(1))
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


@query("npi_work_list", sql("SELECT DISTINCT npi FROM claims WHERE npi IS NOT NULL", "claims"))
def npi_work_list(spark, d):
    return readers.npi_work_list(testbed.claims(spark, d))


@query(
    "flatten_registry",
    sql(
        """
        SELECT npi, CASE WHEN entity = 'O' THEN '2' ELSE '1' END AS entity_type_code, last_name, first_name,
               '' AS organization_name, state AS practice_state,
               CASE WHEN c_acctbal < 0 THEN 'MAIL' ELSE 'SITE' END || state AS practice_zip,
               CASE WHEN gender = 'F' THEN segment ELSE '' END AS taxonomy_code, '2010-01-01' AS enumeration_date,
               gender AS gender_code
        FROM who
        """,
        "who",
    ),
)
def flatten_registry(spark, d):
    """Nested JSON records; debtors list no practice address, men no taxonomy."""
    p = testbed.providers(spark, d)

    def address(kind):
        return F.struct(
            F.lit("LOCATION" if kind == "SITE" else "MAILING").alias("address_purpose"),
            F.col("state"),
            F.concat(F.lit(kind), "state").alias("postal_code"),
        )

    record = F.to_json(
        F.struct(
            F.col("npi").alias("number"),
            F.when(F.col("entity") == "O", "NPI-2").otherwise("NPI-1").alias("enumeration_type"),
            F.struct(
                "last_name", "first_name", F.lit("2010-01-01").alias("enumeration_date"), "gender"
            ).alias("basic"),
            F.when(F.col("c_acctbal") < 0, F.array(address("MAIL")))
            .otherwise(F.array(address("MAIL"), address("SITE")))
            .alias("addresses"),
            F.when(F.col("gender") == "F", F.array(F.struct(F.col("segment").alias("code")))).alias("taxonomies"),
        )
    )
    return readers.parse_registry_records(p.select(record.alias("j")), "j")


@query(
    "claims_file_counts",
    sql("SELECT provider_state, count(*) AS rows FROM claims GROUP BY provider_state", "claims"),
)
def claims_file_counts(spark, d):
    """Claims written as one JSON folder per state, read back and counted per file."""
    path = scratch(spark)
    raw = testbed.raw_claims(spark, d)
    writers.save_json(raw.withColumn("st", F.trim("Rndrng_Prvdr_State_Abrvtn")), path, by=("st",), compression="gzip")
    counts = readers.file_row_counts(spark, f"{path}/*/*.json*")
    state = F.regexp_extract("file", "st=([^/]*)/", 1)
    return counts.groupBy(state.alias("provider_state")).agg(F.sum("rows").alias("rows"))


@query(
    "exclusions_round_trip",
    sql(
        "SELECT trim(lastname) AS \"LASTNAME\", npi AS \"NPI\", excltype AS \"EXCLTYPE\", excldate AS \"EXCLDATE\""
        " FROM raw_exclusions",
        "raw_exclusions",
    ),
)
def exclusions_round_trip(spark, d):
    path = scratch(spark)
    writers.save_csv(
        testbed.raw_exclusions(spark, d).select([c for c in EXCLUSION_COLUMNS if c != "DOB"]), path
    )
    return readers.read_exclusions(spark, path).select(
        F.trim("LASTNAME").alias("LASTNAME"), "NPI", "EXCLTYPE", "EXCLDATE"
    )


@query(
    "partition_load",
    sql(
        "SELECT provider_state AS state, count(*) AS rows, round(sum(total_services), 6) AS services"
        " FROM claims GROUP BY provider_state",
        "claims",
    ),
)
def partition_load(spark, d):
    """Load everything, then load one half again: no row is doubled or lost."""
    path = scratch(spark)
    rows = materialize(
        testbed.claims(spark, d).select(F.col("provider_state").alias("state"), F.lit(2022).alias("year"), "total_services")
    )
    writers.load_partitions(rows, path)
    writers.load_partitions(rows.where(F.col("state") < "12"), path)
    back = spark.read.schema("total_services double, state string, year int").parquet(path)
    return back.groupBy("state").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("total_services"), 6).alias("services")
    )
