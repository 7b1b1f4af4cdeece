"""Model input: label filters, imputation, scaling and the stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checkpoints import lookup_side, materialize
from ..functions.columns import finite, seeded
from ..functions.ranking import Quantile, exact_quantiles
from ..schemas import FRAUD_EXCLUSION_TYPES, LABEL, MIN_PAYMENTS_FOR_LABEL, ML_FEATURES



def filter_labels(
    df: DataFrame,
    labels: DataFrame,
    fraud_only: bool = True,
    min_payments: float = MIN_PAYMENTS_FOR_LABEL,
) -> DataFrame:
    """Demote positives of other exclusion types or with little billing."""
    if not fraud_only and min_payments <= 0:
        return df
    types = labels.select("npi", F.col("exclusion_type").alias("__type"))
    out = df.join(types, "npi", "left")
    keep = F.col(LABEL)
    if fraud_only:
        keep = keep & F.coalesce(F.col("__type").isin(FRAUD_EXCLUSION_TYPES), F.lit(False))
    if min_payments > 0:
        keep = keep & (F.coalesce("total_medicare_payments", F.lit(0.0)) >= min_payments)
    return out.withColumn(LABEL, keep).drop("__type")


def label_filter_report(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.agg(F.count_if(LABEL).alias("positives_before")).withColumn(
        "positives_after", after.select(F.count_if(LABEL)).scalar()
    )


def class_balance(df: DataFrame) -> DataFrame:
    pos = F.count_if(LABEL)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_total"),
        pos.alias("n_positive"),
        F.try_divide(100.0 * pos, n.cast("double")).alias("positive_pct"),
        F.try_divide(n - pos, pos).alias("imbalance_ratio"),
    )


def medians(df: DataFrame, features: list[str]) -> DataFrame:
    """One row of exact medians, NaN counting as missing."""
    clean = df.select(*[F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f) for f in features])
    return exact_quantiles(clean, [], {f: Quantile(f, 0.5) for f in features})


def impute(df: DataFrame, features: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Missing values become the column median, infinities 0."""
    row = medians(df if fit_on is None else fit_on, features).select(F.struct("*")).scalar()
    filled = {
        f: finite(F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.col(f"__m.{f}")))
        for f in features
    }
    return df.withColumn("__m", row).withColumns(filled).drop("__m")


def stratified_split(
    df: DataFrame, label: str = LABEL, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` (train/test): within each class the ``round(n * test_size)``
    rows with the lowest seeded hash are test.

    The cut-off hash per class is an exact order statistic, so no class is
    sorted in one task and the share is not merely expected.
    """
    hashed = df.withColumn("__h", seeded(seed, "npi").cast("double"))
    # three passes find the cut-offs: they read label and hash from a narrow stored table, not the plan of ``df``
    drawn = materialize(hashed.select(label, "__h"))
    wanted = lambda n: F.round(n * F.lit(test_size))
    cut = exact_quantiles(
        drawn, [label], {"__cut": Quantile("__h", test_size, lambda n: F.greatest(wanted(n) - 1, F.lit(0)))}
    )
    counts = drawn.groupBy(label).agg(wanted(F.count(F.lit(1))).alias("__k"))
    edges = lookup_side(cut.join(counts, label))
    test = (F.col("__k") > 0) & (F.col("__h") <= F.col("__cut"))
    return (
        hashed.join(edges, label)
        .withColumn("split", F.when(test, "test").otherwise("train"))
        .drop("__h", "__cut", "__k")
    )


def standard_scale(df: DataFrame, features: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and scale by the population deviation; constant columns become 0."""
    source = df if fit_on is None else fit_on
    row = source.select(
        F.struct(
            *[F.avg(f).alias(f"m_{f}") for f in features],
            *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
        )
    ).scalar()
    scaled = {
        f: F.coalesce(
            F.try_divide(F.col(f) - F.col(f"__s.m_{f}"), F.col(f"__s.s_{f}")), F.lit(0.0)
        )
        for f in features
    }
    return df.withColumn("__s", row).withColumns(scaled).drop("__s")


def split_dataset(
    features_table: DataFrame,
    labels: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    fraud_only: bool = True,
    min_payments: float = MIN_PAYMENTS_FOR_LABEL,
) -> DataFrame:
    """Filtered labels and a stored split; gaps in the features stay."""
    filtered = filter_labels(features_table, labels, fraud_only, min_payments)
    return materialize(stratified_split(filtered, LABEL, test_size, seed))


def prepare_dataset(
    features_table: DataFrame,
    labels: DataFrame,
    features: list[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    fraud_only: bool = True,
    min_payments: float = MIN_PAYMENTS_FOR_LABEL,
    parity: bool = False,
) -> DataFrame:
    """Filtered labels, split and imputed features in one table.

    Medians come from the training rows; ``parity=True`` takes them over all rows.
    """
    features = [f for f in (features or ML_FEATURES) if f in features_table.columns]
    split = split_dataset(features_table, labels, test_size, seed, fraud_only, min_payments)
    fit_on = None if parity else split.where(F.col("split") == "train")
    return impute(split, features, fit_on)
