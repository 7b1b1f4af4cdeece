"""Readers for raw files and stored layers; every schema is explicit."""

from __future__ import annotations

import csv
from collections import Counter
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import missing_columns
from ..schemas import (
    CLAIM_SCHEMA,
    EXCLUSION_SCHEMA,
    REGISTRY_COLUMNS,
    REGISTRY_RECORD_SCHEMA,
    REVIEW_SCHEMA,
)


def read_claims(spark: SparkSession, *paths: str) -> DataFrame:
    """Newline-delimited JSON claim files, one or many states at once.

    Only the schema's columns are kept; keys a record lacks come back NULL.
    """
    return spark.read.schema(CLAIM_SCHEMA).json(list(paths))


def file_row_counts(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows per claim file."""
    rows = spark.read.schema(CLAIM_SCHEMA).json(list(paths))
    return rows.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))


def csv_files(spark: SparkSession, paths: list[str], name_glob: str = "*") -> list[str]:
    """The files under ``paths`` (files or folders), through Spark's own file systems."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(paths)
    return [r.path for r in listing.select("path").orderBy("path").collect()]


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of every file from its first line that is not blank, in one distributed read.

    Names are settled as Spark settles them: blank ones become ``_c`` and their place,
    repeated ones get their place appended. Files without a line are left out.
    """
    if not files:
        return {}
    lines = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    # a header stands in the first block of its file
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    # the path comes back as a URI
    return {unquote(r.file): settled_names(r.header) for r in first.collect()}


def settled_names(header: str) -> tuple[str, ...]:
    names = next(csv.reader([header.removeprefix("\ufeff")], escapechar="\\"))
    seen = Counter(n.lower() for n in names)
    return tuple(f"_c{i}" if not n else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names))


def read_csv_by_header(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """One DataFrame of text columns per distinct header line of ``files``.

    Spark takes the first file's header for all; files that order their columns
    differently would be read by position. Broken rows (too few or too many cells)
    are dropped whichever columns are asked for later: the parser always sees the
    whole row. The number of jobs does not depend on the number of files.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in sorted(csv_headers(spark, files).items()):
        groups.setdefault(names, []).append(file)
    tables = []
    for names, members in groups.items():
        broken = "__broken"
        schema = ", ".join([*[f"`{n}` string" for n in names], f"{broken} string"])
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", broken)
            .csv(members)
        )
        # a column test that needs every cell keeps the parser from skipping any
        seen = F.concat(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names]) if names else F.lit("")
        tables.append(raw.where(F.col(broken).isNull() & (F.length(seen) >= 0)).drop(broken))
    return tables


def read_exclusions(spark: SparkSession, *paths: str) -> DataFrame:
    """Exclusion CSV as text; columns are found by each file's header, broken rows skipped.

    A file may order its columns freely or lack some of the known ones.
    """
    wanted = EXCLUSION_SCHEMA.fieldNames()
    out = None
    for raw in read_csv_by_header(spark, csv_files(spark, list(paths))):
        have = {c.lower() for c in raw.columns}
        part = raw.select(*[(F.col(f"`{c}`") if c.lower() in have else F.lit(None).cast("string")).alias(c) for c in wanted])
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], EXCLUSION_SCHEMA) if out is None else out


def read_registry(spark: SparkSession, path: str, name_part: str = "npidata_pfile") -> DataFrame:
    """Registry CSV files whose name contains ``name_part``: ten of several
    hundred columns, renamed; each file's own header counts."""
    out = None
    for raw in read_csv_by_header(spark, csv_files(spark, [path], f"*{name_part}*.csv")):
        absent = missing_columns(raw, list(REGISTRY_COLUMNS))
        if absent:
            raise ValueError(f"registry file lacks columns {absent}")
        part = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in REGISTRY_COLUMNS.items()])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"no registry file with {name_part} in its name under {path}")
    return out


def flatten_registry(records: DataFrame) -> DataFrame:
    """Nested registry records to the flat columns: the practice address, else
    the first; the first taxonomy; gaps become empty strings."""
    practice = F.coalesce(
        F.get(F.filter("addresses", lambda a: a["address_purpose"] == "LOCATION"), F.lit(0)),
        F.get("addresses", F.lit(0)),
    )
    fields = {
        "npi": F.col("number"),
        "entity_type_code": F.regexp_replace("enumeration_type", "^NPI-", ""),
        "last_name": F.col("basic.last_name"),
        "first_name": F.col("basic.first_name"),
        "organization_name": F.col("basic.organization_name"),
        "practice_state": practice["state"],
        "practice_zip": practice["postal_code"],
        "taxonomy_code": F.get("taxonomies", F.lit(0))["code"],
        "enumeration_date": F.col("basic.enumeration_date"),
        "gender_code": F.col("basic.gender"),
    }
    return records.select(*[F.coalesce(c, F.lit("")).alias(n) for n, c in fields.items()])


def read_registry_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Newline-delimited nested registry records, flattened."""
    return flatten_registry(spark.read.schema(REGISTRY_RECORD_SCHEMA).json(list(paths)))


def parse_registry_records(df: DataFrame, column: str) -> DataFrame:
    """The same from a column of JSON text."""
    return flatten_registry(df.select(F.from_json(column, REGISTRY_RECORD_SCHEMA).alias("r")).select("r.*"))


def npi_work_list(claims: DataFrame, first: int | None = None) -> DataFrame:
    """All distinct provider ids, or the ``first`` ones in id order."""
    ids = claims.select("npi").where(F.col("npi").isNotNull()).distinct()
    return ids if first is None else ids.orderBy("npi").limit(first)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_features(spark: SparkSession, full: str, mart: str) -> DataFrame:
    """The full feature table when it exists, else the SQL mart."""
    return spark.table(full if spark.catalog.tableExists(full) else mart)


def read_risk_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("metric string, key string, value double").json(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW_SCHEMA).parquet(path)


def read_artifact(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}")
