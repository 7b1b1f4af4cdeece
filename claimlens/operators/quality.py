"""Load checks and the constraint suite; every result row is one check."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: load expectations
CLAIMS_REQUIRED = ["Rndrng_NPI", "HCPCS_Cd", "Tot_Srvcs", "Tot_Benes", "Avg_Mdcr_Pymt_Amt"]
CLAIMS_NULL_CHECKED = ["Rndrng_NPI", "HCPCS_Cd", "Tot_Srvcs", "Tot_Benes"]
MAX_NULL_PCT = 5.0
MAX_BAD_NPI_PCT = 1.0
MIN_EXCLUSION_ROWS = 50_000
MIN_EXCLUSION_NPIS = 1_000
MIN_TAXONOMY_PCT = 80.0


def table_stats(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table"),
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def find(df: DataFrame, column: str) -> Column:
    """The column under any letter case; NULL when the table lacks it."""
    hit = next((c for c in df.columns if c.lower() == column.lower()), None)
    return F.col(hit) if hit else F.lit(None).cast("string")


def share(test: Column) -> Column:
    """Percentage of rows passing ``test``, NULL on an empty table."""
    return F.round(F.try_divide(100.0 * F.count_if(test), F.count(F.lit(1)).cast("double")), 2)


def check_rows(df: DataFrame, name: str, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregate over the table, one row per check.

    A check is (measured value, test over ``value``); a NULL test fails.
    """
    labels = list(checks)
    measured = df.agg(*[checks[k][0].cast("double").alias(f"m{i}") for i, k in enumerate(labels)])
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("check"), F.col(f"m{i}").alias("value"), F.lit(i).alias("i"))
            for i, k in enumerate(labels)
        ]
    )
    verdict = F.lit(False)
    for i, k in enumerate(labels):
        verdict = F.when(F.col("i") == i, checks[k][1]).otherwise(verdict)
    return (
        measured.select(F.explode(rows).alias("r"))
        .select("r.*")
        .select(
            F.lit(name).alias("table"),
            "check",
            "value",
            F.coalesce(verdict, F.lit(False)).alias("passed"),
        )
    )


VALUE = F.col


def check_claims(raw: DataFrame, name: str = "claims") -> DataFrame:
    present = {c.lower() for c in raw.columns}
    missing = sum(c.lower() not in present for c in CLAIMS_REQUIRED)
    npi = find(raw, "Rndrng_NPI").cast("string")
    checks = {
        "has_rows": (F.count(F.lit(1)), VALUE("value") > 0),
        "required_columns_missing": (F.max(F.lit(missing)), F.lit(missing == 0)),
    }
    for c in CLAIMS_NULL_CHECKED:
        checks[f"null_pct_{c}"] = (share(find(raw, c).isNull()), VALUE("value") <= MAX_NULL_PCT)
    checks["bad_npi_pct"] = (share(~npi.rlike("^[0-9]{10}$")), VALUE("value") <= MAX_BAD_NPI_PCT)
    return check_rows(raw, name, checks)


def check_exclusions(raw: DataFrame, name: str = "exclusions") -> DataFrame:
    npi = find(raw, "NPI")
    return check_rows(
        raw,
        name,
        {
            "has_rows": (F.count(F.lit(1)), VALUE("value") > 0),
            "min_rows": (F.count(F.lit(1)), VALUE("value") >= MIN_EXCLUSION_ROWS),
            "null_pct_EXCLDATE": (share(find(raw, "EXCLDATE").isNull()), VALUE("value") <= MAX_NULL_PCT),
            "npis_present": (
                F.count_if(npi.isNotNull() & (F.trim(npi) != "")),
                VALUE("value") >= MIN_EXCLUSION_NPIS,
            ),
        },
    )


def check_registry(raw: DataFrame, name: str = "registry") -> DataFrame:
    taxonomy = find(raw, "taxonomy_code")
    return check_rows(
        raw,
        name,
        {
            "has_rows": (F.count(F.lit(1)), VALUE("value") > 0),
            "null_npis": (F.count_if(find(raw, "npi").isNull()), VALUE("value") == 0),
            "taxonomy_fill_pct": (
                share(taxonomy.isNotNull() & (F.trim(taxonomy) != "")),
                VALUE("value") >= MIN_TAXONOMY_PCT,
            ),
        },
    )


def validation_results(checks: DataFrame) -> DataFrame:
    """Per table: expectations, passed, failed and overall success."""
    return checks.groupBy("table").agg(
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if("passed").alias("successful_expectations"),
        F.count_if(~F.col("passed")).alias("failed_expectations"),
        F.bool_and("passed").alias("success"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))).alias("failures"),
    )


def validate_all(claims: DataFrame, exclusions: DataFrame, registry: DataFrame) -> DataFrame:
    rows = check_claims(claims).unionByName(check_exclusions(exclusions)).unionByName(check_registry(registry))
    return validation_results(rows)


def summary_line() -> Column:
    """[PASS] or [FAIL] line for a validation result row."""
    return F.concat(
        F.when(F.col("success"), "[PASS] ").otherwise("[FAIL] "),
        F.col("table"),
        F.lit(": "),
        F.col("successful_expectations").cast("string"),
        F.lit("/"),
        F.col("total_expectations").cast("string"),
        F.lit(" checks passed"),
    )


@dataclass(frozen=True)
class Constraints:
    """Column constraints of one table."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


# fixed values: the 34 constraints over the eight tables
CONSTRAINTS = {
    "claims": Constraints(
        ["npi", "hcpcs_code", "total_services", "total_beneficiaries", "provider_state"],
        [],
        {"entity_type": ["I", "O"], "place_of_service": ["F", "O"]},
    ),
    "exclusions": Constraints(["npi", "exclusion_type", "is_currently_excluded"], ["npi"]),
    "registry": Constraints(["npi"], ["npi"], {"entity_type": ["individual", "organization", "unknown"]}),
    "claims_summary": Constraints(["npi", "total_services", "total_beneficiaries"], ["npi"]),
    "provider_enriched": Constraints(["npi", "is_excluded", "provider_specialty"], ["npi"]),
    "hcpcs_mix": Constraints(["npi", "hcpcs_code", "is_high_complexity"]),
    "specialty_benchmarks": Constraints(["specialty", "peer_count"], ["specialty"]),
    "feature_mart": Constraints(
        ["npi", "provider_specialty", "total_services", "is_excluded"],
        ["npi"],
        {"is_excluded": [True, False]},
    ),
}


def check_constraints(df: DataFrame, name: str, spec: Constraints) -> DataFrame:
    """Failing rows per constraint: NULLs, values outside the list (NULL passes)
    and, for uniqueness, values that occur more than once.

    One aggregate over the table: rows fold to a few counts per value of the unique
    column, map-side first, and the counts of the values add up. A second unique
    column takes a further pass.
    """
    tests = {(c, "not_null"): F.col(c).isNull() for c in spec.not_null}
    for c, values in spec.accepted.items():
        tests[(c, "accepted_values")] = ~F.col(c).isin(list(values))
    failing = {f"t{i}": F.count_if(t) for i, t in enumerate(tests.values())}
    labels = [(c, kind, n) for (c, kind), n in zip(tests, failing)]

    def shown(one: DataFrame, rows: list[tuple[str, str, str]]) -> DataFrame:
        found = [F.struct(F.lit(c).alias("column"), F.lit(kind).alias("test"), F.col(n).alias("failures")) for c, kind, n in rows]
        return one.select(F.explode(F.array(*found)).alias("r")).select("r.*")

    def repeats(by: str, more: dict[str, Column]) -> DataFrame:
        groups = df.groupBy(F.col(by).alias("value")).agg(F.count(F.lit(1)).alias("n"), *[t.alias(n) for n, t in more.items()])
        again = F.count_if(F.col("value").isNotNull() & (F.col("n") > 1))
        return groups.agg(again.alias("u"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in more])

    if spec.unique:
        out = shown(repeats(spec.unique[0], failing), [*labels, (spec.unique[0], "unique", "u")])
        for c in spec.unique[1:]:
            out = out.unionByName(shown(repeats(c, {}), [(c, "unique", "u")]))
    else:
        out = shown(df.agg(*[t.alias(n) for n, t in failing.items()]), labels)
    return out.select(F.lit(name).alias("table"), "*", (F.col("failures") == 0).alias("passed"))


def constraint_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """All constraints of the given tables."""
    parts = [check_constraints(df, name, CONSTRAINTS[name]) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """Wanted columns the table lacks, in the wanted order."""
    have = {c.lower() for c in df.columns}
    return [c for c in wanted if c.lower() not in have]
