"""Writers for layers, labels, audit files, artifacts and the review log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import REVIEW_SCHEMA

# fixed values: layer databases
LAYERS = ["raw", "staging", "intermediate", "marts"]


def create_layers(spark: SparkSession, layers=LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def save_table(df: DataFrame, name: str, append: bool = False) -> None:
    """Replace a table, or append to it by column name."""
    if append and df.sparkSession.catalog.tableExists(name):
        df.select(*df.sparkSession.table(name).columns).write.mode("append").saveAsTable(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)


def load_partitions(df: DataFrame, path: str, keys=("state", "year"), rows_per_file: int = 1_000_000) -> None:
    """Idempotent load: the partitions present in ``df`` are replaced, others stay.

    The rows of every partition value are counted first; a value is then written by one
    task per ``rows_per_file`` rows, each task writing one value only. So a small value
    makes one file and a large one is spread by a hash of its rows. There is one count
    per folder, which is what the folders' listing holds as well.
    """
    spark, keys = df.sparkSession, list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).collect()
    if not counts:
        return
    plan, offset = [], 0
    for row in counts:
        files = max(1, -(-row["__n"] // rows_per_file))
        plan.append((*[row[k] for k in keys], offset, files))
        offset += files
    kinds = ", ".join(f"`__{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    places = spark.createDataFrame(plan, f"{kinds}, __offset int, __files int")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    task = F.col("__offset") + F.pmod(F.xxhash64(*df.columns), F.col("__files")).cast("int")
    (
        df.join(F.broadcast(places), same)
        .repartitionById(offset, task)
        .select(*df.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_json(df: DataFrame, path: str, by: tuple[str, ...] = (), compression: str = "none") -> None:
    """JSON lines, in folders per value of ``by``; a large table is worth compressing, as every line repeats all names."""
    df.write.mode("overwrite").option("compression", compression).partitionBy(*by).json(path)


def save_match_outputs(
    candidates: DataFrame, labels: DataFrame | Callable[[DataFrame], DataFrame], directory: str
) -> DataFrame:
    """Candidates and labels as Parquet; returns the stored candidates.

    ``labels`` may be a function of the candidates: they grow with the square of a name's
    rows, so they are then written once and read back by the columns that labels need.
    """
    save_parquet(candidates, f"{directory}/match_candidates")
    stored = candidates.sparkSession.read.parquet(f"{directory}/match_candidates")
    save_parquet(labels(stored) if callable(labels) else labels, f"{directory}/final_labels")
    return stored


def save_audit(sample: DataFrame, flagged: DataFrame, report: DataFrame, directory: str) -> None:
    """Sample and flagged rows as CSV, the report as JSON."""
    save_csv(sample, f"{directory}/audit_sample")
    save_csv(flagged, f"{directory}/audit_flagged")
    save_json(report, f"{directory}/audit_report")


def save_artifact(df: DataFrame, directory: str, name: str) -> None:
    save_parquet(df, f"{directory}/{name}")


def save_model(model: PipelineModel, directory: str, name: str) -> None:
    """Store the fitted stages of a training run."""
    model.write().overwrite().save(f"{directory}/{name}")


def load_model(directory: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{directory}/{name}")


def log_review(spark: SparkSession, path: str, npi: str, decision: str, notes: str = "") -> None:
    """Append one decision to the review log."""
    row = spark.createDataFrame([(npi, decision, notes)], "npi string, decision string, notes string")
    row.withColumn("timestamp", F.current_timestamp()).select(*REVIEW_SCHEMA.fieldNames()).write.mode(
        "append"
    ).parquet(path)
