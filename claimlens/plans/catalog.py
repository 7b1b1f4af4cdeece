"""Named queries over the supplied tables, each with an oracle where SQL allows.

A query is a function (spark, sf_dir) -> DataFrame; ``@query(name, sql)``
registers both halves side by side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# quotients of whole cents can end exactly half-way between two rounded values, where the
# last bit of a double would decide: these columns are rounded in decimals, from nine digits
DECIMAL = {"wavg_submitted_charge", "wavg_medicare_payment", "graph_weighted_degree"}


def half_up(value: Column, digits: int) -> Column:
    return F.round(value.cast("decimal(28,9)"), digits).cast("double")


def half_up_sql(value: str, digits: int) -> str:
    return f"round(({value})::DECIMAL(28,9), {digits})::DOUBLE"


def rounded(df: DataFrame, columns: dict[str, int | None]) -> DataFrame:
    """Select ``columns``, rounding those with a digit count."""

    def show(c: str, digits: int | None):
        if digits is None:
            return F.col(c)
        value = F.col(c).cast("double")
        return (half_up(value, digits) if c in DECIMAL else F.round(value, digits)).alias(c)

    return df.select(*[show(c, d) for c, d in columns.items()])


def load_all() -> None:
    """Import the query modules so that they register themselves."""
    from . import (  # noqa: F401
        queries_checks,
        queries_features,
        queries_files,
        queries_graph,
        queries_linkage,
        queries_models,
        queries_scoring,
        queries_sources,
        queries_summary,
    )
