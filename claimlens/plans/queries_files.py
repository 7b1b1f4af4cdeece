"""Queries: raw files and stored tables, written from the supplied tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..operators import audit, linkage
from ..schemas import EXCLUSION_COLUMNS, REGISTRY_COLUMNS
from ..sources import readers, writers
from . import pipeline, testbed
from .catalog import query, rounded
from .oracles import sql
from .queries_features import inputs
from .queries_linkage import CONFIG, kept, listed, names
from .queries_sources import scratch


def save_files(df: DataFrame, path: str) -> list[str]:
    """CSV folders in two orders of columns, and files of broken rows (too few, too many cells) for both."""
    folders = []
    for k, columns in enumerate((df.columns, df.columns[::-1])):
        part = df.where(F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) == k).select(*columns)
        part.write.option("header", True).csv(f"{path}/rows_{k}")
        lines = [",".join(columns), '"cut"', ",".join(["more"] * (len(columns) + 2))]
        broken = df.sparkSession.createDataFrame([(line,) for line in lines], "value string")
        broken.coalesce(1).write.text(f"{path}/broken_{k}")
        folders += [f"{path}/rows_{k}", f"{path}/broken_{k}"]
    return folders


@query(
    "exclusions_files",
    sql(
        "SELECT trim(lastname) AS \"LASTNAME\", npi AS \"NPI\", excltype AS \"EXCLTYPE\", excldate AS \"EXCLDATE\""
        " FROM raw_exclusions",
        "raw_exclusions",
    ),
)
def exclusions_files(spark, d):
    """The exclusion list from files that order their columns differently and hold broken rows."""
    path = scratch(spark)
    raw = testbed.raw_exclusions(spark, d).select([c for c in EXCLUSION_COLUMNS if c != "DOB"])
    found = readers.read_exclusions(spark, *save_files(raw, path))
    return found.select(F.trim("LASTNAME").alias("LASTNAME"), "NPI", "EXCLTYPE", "EXCLDATE")


@query(
    "registry_files",
    sql(
        "SELECT npi, entity_type_code, trim(last_name) AS last_name, practice_state, practice_zip, taxonomy_code,"
        " enumeration_date, gender_code FROM raw_registry",
        "raw_registry",
    ),
)
def registry_files(spark, d):
    """Ten of the registry's columns from files of two layouts."""
    path = scratch(spark)
    raw = testbed.raw_registry(spark, d).withColumnsRenamed({new: old for old, new in REGISTRY_COLUMNS.items()})
    raw = raw.select(*[F.col(f"`{c}`") for c in REGISTRY_COLUMNS], F.lit("z").alias("Unused"))
    writers.save_csv(raw.limit(0), f"{path}/other")
    for k, part in enumerate((raw, raw.select(*[F.col(f"`{c}`") for c in raw.columns[::-1]]))):
        part.where(F.pmod(F.xxhash64("NPI"), F.lit(2)) == k).write.option("header", True).csv(f"{path}/npidata_pfile_{k}")
    found = None
    for k in range(2):
        part = readers.read_registry(spark, f"{path}/npidata_pfile_{k}", "part-")
        found = part if found is None else found.unionByName(part)
    return found.select(
        "npi", "entity_type_code", F.trim("last_name").alias("last_name"), "practice_state", "practice_zip",
        "taxonomy_code", "enumeration_date", "gender_code",
    )


@query(
    "claims_append",
    sql(
        "SELECT provider_state AS state, count(*) AS rows, round(sum(total_services), 6) AS services,"
        " count(*) AS without_description FROM claims GROUP BY provider_state",
        "claims",
    ),
)
def claims_append(spark, d):
    """Newline-delimited JSON of some states replaces a table, that of the others is appended; absent keys are NULL."""
    path, database = scratch(spark), f"raw_{uuid.uuid4().hex}"
    raw = testbed.raw_claims(spark, d).drop("HCPCS_Desc")
    first = F.trim("Rndrng_Prvdr_State_Abrvtn") < "12"
    # the lines are joined once for both halves
    halves = raw.where(first.isNotNull()).withColumn("half", F.when(first, "a").otherwise("b"))
    writers.save_json(halves, path, by=("half",), compression="gzip")
    writers.create_layers(spark, [database])
    writers.save_table(readers.read_claims(spark, f"{path}/half=a"), f"{database}.claims")
    writers.save_table(readers.read_claims(spark, f"{path}/half=b"), f"{database}.claims", append=True)
    rows = readers.read_table(spark, f"{database}.claims")
    return rows.groupBy(F.trim("Rndrng_Prvdr_State_Abrvtn").alias("state")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum(F.col("Tot_Srvcs").cast("double")), 6).alias("services"),
        F.count_if(F.col("HCPCS_Desc").isNull()).alias("without_description"),
    )


@query(
    "feature_layers",
    sql(
        "SELECT 'mart' AS layer, npi, round(total_services, 6) AS total_services FROM mart"
        " UNION ALL SELECT 'full', npi, round(total_services, 6) FROM mart",
        "mart",
    ),
)
def feature_layers(spark, d):
    """The mart is read while no full feature table exists, the full table afterwards."""
    database = f"marts_{uuid.uuid4().hex}"
    mart = materialize(pipeline.build_mart(inputs(spark, d)).mart.select("npi", "total_services"))
    full, small = f"{database}.features_full", f"{database}.mart"
    writers.create_layers(spark, [database])
    writers.save_table(mart, small)
    before = readers.read_features(spark, full, small).withColumn("layer", F.lit("mart"))
    writers.save_table(mart.withColumn("extra", F.lit(1)), full)
    after = readers.read_features(spark, full, small).withColumn("layer", F.lit("full")).drop("extra")
    return rounded(before.unionByName(after), {"layer": None, "npi": None, "total_services": 6})


@query(
    "linkage_outputs",
    sql(
        "SELECT 'candidates' AS output, count(*) AS rows FROM candidates UNION ALL SELECT 'labels', count(*) FROM final_labels"
        " UNION ALL SELECT 'flagged', count(*) FILTER (WHERE coalesce(both_low, FALSE) OR last_too_short) FROM audited"
        " UNION ALL SELECT 'report', count(DISTINCT match_tier) + 1 FROM audited",
        "candidates",
        "final_labels",
        "audited",
    ),
)
def linkage_outputs(spark, d):
    """Candidates and labels as Parquet, flagged rows as CSV and the report as JSON, read back and counted."""
    path = scratch(spark)
    candidates = linkage.resolve_conflicts(linkage.run_match(listed(spark, d), names(spark, d), CONFIG))
    candidates = writers.save_match_outputs(candidates, linkage.final_labels, path)
    rows = audit.flag_candidates(candidates.where("keep_for_training"))
    writers.save_audit(audit.audit_sample(rows), audit.flagged_rows(rows), audit.audit_report(rows), path)
    found = {
        "candidates": readers.read_artifact(spark, path, "match_candidates"),
        "labels": readers.read_artifact(spark, path, "final_labels"),
        "flagged": spark.read.schema("match_tier int").option("header", True).csv(f"{path}/audit_flagged"),
        "report": spark.read.schema("match_tier int, n long").json(f"{path}/audit_report"),
    }
    out = None
    for name, table in found.items():
        part = table.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "review_log",
    "SELECT CASE event_type WHEN 'purchase' THEN 'Referred for Investigation' WHEN 'click' THEN 'No Action — Legitimate Pattern'"
    " WHEN 'view' THEN 'No Action — Insufficient Evidence' ELSE 'Needs More Data' END AS decision, count(*) AS rows"
    " FROM events GROUP BY 1 UNION ALL SELECT 'Under Review', 1",
)
def review_log(spark, d):
    """A stored log of decisions and one more appended to it."""
    path = scratch(spark)
    log = testbed.reviews(spark, d)
    log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in readers.REVIEW_SCHEMA]).write.parquet(path)
    writers.log_review(spark, path, "0000000001", "Under Review", "later")
    return readers.read_reviews(spark, path).groupBy("decision").agg(F.count(F.lit(1)).alias("rows"))
