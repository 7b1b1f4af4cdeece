"""DuckDB SQL with the same meaning as the registered queries.

``CTES`` holds named building blocks; ``sql(query, *blocks)`` prefixes a query
with the blocks it needs, dependencies first.
"""

from __future__ import annotations

from .catalog import DECIMAL, half_up_sql
from .testbed import EXCLUSION_TYPES, HIGH_CODES

_HIGH = ", ".join(f"'{c}'" for c in HIGH_CODES)
_TYPES = ", ".join(f"'{t}'" for t in EXCLUSION_TYPES)

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {}


# blocks that are read more than once and evaluated once
KEPT: set[str] = set()


def block(name: str, deps: list[str], body: str, kept: bool = False) -> None:
    CTES[name] = (deps, body)
    if kept:
        KEPT.add(name)


def sql(query: str, *blocks: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTES[name][0]:
            visit(dep)
        ordered.append(name)

    for b in blocks:
        visit(b)
    with_clause = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in KEPT else ''}({CTES[n][1]})" for n in ordered)
    return f"WITH {with_clause}\n{query}" if ordered else query


block(
    "who",
    [],
    f"""
    SELECT c_custkey, c_acctbal, c_nationkey,
           lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS npi,
           upper(split_part(p_name, ' ', 2)) AS last_name,
           upper(split_part(p_name, ' ', 1)) AS first_name,
           c_mktsegment AS segment,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state,
           CASE WHEN c_nationkey >= 20 THEN 'O' ELSE 'I' END AS entity,
           CASE WHEN c_acctbal < 4500 THEN 'F' ELSE 'M' END AS gender
    FROM customer LEFT JOIN part ON p_partkey = c_custkey % (SELECT count(*) FROM part) + 1
    """,
)
block(
    "claims",
    ["who"],
    """
    SELECT npi, last_name AS provider_last_name, first_name AS provider_first_name,
           gender AS provider_gender, entity AS entity_type, state AS provider_state,
           lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS provider_zip5,
           segment AS provider_type, p_name AS hcpcs_code,
           CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS hcpcs_drug_indicator,
           l_linestatus AS place_of_service, l_linenumber AS total_beneficiaries,
           l_quantity AS total_services,
           l_quantity * (1 + l_tax) AS total_beneficiary_day_services,
           l_extendedprice / l_quantity AS avg_submitted_charge,
           l_extendedprice / l_quantity * (1 - l_discount) AS avg_medicare_allowed_amt,
           l_extendedprice / l_quantity * (1 - l_discount) * 0.8 AS avg_medicare_payment_amt,
           l_extendedprice / l_quantity * (1 + l_tax) AS avg_medicare_standardized_amt
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN who ON c_custkey = o_custkey
    """,
)
block(
    "raw_registry",
    ["who"],
    """
    SELECT npi, CASE WHEN entity = 'O' THEN '2' WHEN c_acctbal < 8800 THEN '1' ELSE '9' END
               AS entity_type_code,
           ' ' || last_name AS last_name, first_name,
           CASE WHEN entity = 'O' THEN first_name || ' ' || last_name END AS organization_name,
           state AS practice_state, lpad(CAST(c_nationkey AS VARCHAR), 5, '9') || '-1234' AS practice_zip,
           'TX' || segment AS taxonomy_code,
           '2010-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS enumeration_date,
           gender AS gender_code
    FROM who WHERE c_acctbal < 9000
    """,
)
block(
    "registry",
    ["raw_registry"],
    """
    SELECT npi,
           CASE entity_type_code WHEN '1' THEN 'individual' WHEN '2' THEN 'organization'
                ELSE 'unknown' END AS entity_type,
           trim(last_name) AS last_name, trim(first_name) AS first_name,
           trim(organization_name) AS organization_name, trim(practice_state) AS practice_state,
           left(trim(practice_zip), 5) AS practice_zip5,
           trim(taxonomy_code) AS primary_taxonomy_code,
           try_cast(enumeration_date AS DATE) AS enumeration_date,
           trim(gender_code) AS gender_code
    FROM raw_registry WHERE npi IS NOT NULL AND trim(npi) <> ''
    """,
)
block(
    "raw_exclusions",
    ["who"],
    f"""
    SELECT CASE WHEN c_nationkey % 3 = 2 THEN left(last_name, 1) || last_name ELSE last_name END AS lastname,
           left(first_name, 1) || lower(substr(first_name, 2)) || ' ' AS firstname,
           CASE WHEN entity = 'O' THEN first_name || ' ' || last_name END AS busname,
           CASE WHEN segment = 'FURNITURE' THEN 'PHARMACY ' ELSE segment END AS specialty,
           CASE WHEN c_nationkey % 3 = 0 THEN npi ELSE '0000000000' END AS npi,
           state,
           [{_TYPES}][CAST(c_custkey % 4 + 1 AS INTEGER)] AS excltype,
           '20' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0')
                || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '15' AS excldate,
           CASE WHEN c_acctbal < -900 THEN '20220101' ELSE '00000000' END AS reindate,
           c_custkey
    FROM who WHERE c_acctbal < 0
    """,
)
block(
    "summary",
    ["claims"],
    """
    SELECT npi, min(provider_last_name) AS provider_last_name,
           min(provider_first_name) AS provider_first_name, min(provider_type) AS provider_type,
           min(entity_type) AS entity_type, min(provider_state) AS provider_state,
           min(provider_zip5) AS provider_zip5, min(provider_gender) AS provider_gender,
           count(DISTINCT hcpcs_code) AS unique_hcpcs_codes,
           sum(total_services) AS total_services,
           CAST(sum(total_beneficiaries) AS BIGINT) AS total_beneficiaries,
           sum(total_beneficiary_day_services) AS total_beneficiary_day_services,
           sum(total_services * avg_submitted_charge) AS total_submitted_charges,
           sum(total_services * avg_medicare_payment_amt) AS total_medicare_payments,
           sum(total_services * avg_medicare_allowed_amt) AS total_medicare_allowed,
           sum(total_services * avg_medicare_standardized_amt) AS total_standardized_payments,
           sum(total_services * avg_submitted_charge) / nullif(sum(total_services), 0)
               AS wavg_submitted_charge,
           sum(total_services * avg_medicare_payment_amt) / nullif(sum(total_services), 0)
               AS wavg_medicare_payment,
           sum(total_services) / nullif(sum(total_beneficiaries), 0) AS services_per_beneficiary,
           sum(CASE WHEN place_of_service = 'F' THEN total_services ELSE 0 END)
               / nullif(sum(total_services), 0) AS facility_service_ratio,
           sum(CASE WHEN hcpcs_drug_indicator = 'Y' THEN total_services ELSE 0 END)
               / nullif(sum(total_services), 0) AS drug_service_ratio
    FROM claims GROUP BY npi
    """,
)
block(
    "mix",
    ["claims"],
    f"""
    SELECT npi, hcpcs_code, provider_type, sum(total_services) AS hcpcs_services,
           sum(total_services) / nullif(sum(sum(total_services)) OVER (PARTITION BY npi), 0)
               AS hcpcs_fraction,
           hcpcs_code IN ({_HIGH}) AS is_high_complexity
    FROM claims GROUP BY npi, hcpcs_code, provider_type
    """,
)
block(
    "benchmarks",
    ["summary"],
    """
    SELECT provider_type AS specialty, count(*) AS peer_count,
           avg(total_services) AS avg_total_services,
           stddev_pop(total_services) AS std_total_services,
           median(total_services) AS median_total_services,
           avg(total_medicare_payments) AS avg_total_payments,
           stddev_pop(total_medicare_payments) AS std_total_payments,
           median(total_medicare_payments) AS median_total_payments,
           avg(total_beneficiaries) AS avg_total_beneficiaries,
           stddev_pop(total_beneficiaries) AS std_total_beneficiaries,
           avg(services_per_beneficiary) AS avg_services_per_bene,
           stddev_pop(services_per_beneficiary) AS std_services_per_bene,
           median(services_per_beneficiary) AS median_services_per_bene,
           avg(unique_hcpcs_codes) AS avg_unique_hcpcs,
           stddev_pop(unique_hcpcs_codes) AS std_unique_hcpcs,
           avg(wavg_submitted_charge) AS avg_wavg_charge,
           stddev_pop(wavg_submitted_charge) AS std_wavg_charge,
           quantile_cont(total_services, 0.25) AS p25_total_services,
           quantile_cont(total_services, 0.75) AS p75_total_services,
           quantile_cont(total_services, 0.95) AS p95_total_services,
           quantile_cont(total_services, 0.99) AS p99_total_services
    FROM summary WHERE provider_type IS NOT NULL
    GROUP BY provider_type HAVING count(*) >= 10
    """,
)
block(
    "provider_upcoding",
    ["mix"],
    """
    SELECT npi, sum(CASE WHEN is_high_complexity THEN hcpcs_services ELSE 0 END)
           / nullif(sum(hcpcs_services), 0) AS high_complexity_ratio
    FROM mix GROUP BY npi
    """,
)
block(
    "specialty_upcoding",
    ["mix"],
    """
    SELECT provider_type AS specialty, sum(CASE WHEN is_high_complexity THEN hcpcs_services ELSE 0 END)
           / nullif(sum(hcpcs_services), 0) AS peer_high_complexity_ratio
    FROM mix GROUP BY provider_type
    """,
)


def rounded(columns: dict[str, int | None]) -> str:
    """Select list: columns with a digit count are rounded, others pass."""

    def show(c: str, digits: int | None) -> str:
        if digits is None:
            return c
        return f"{half_up_sql(c, digits) if c in DECIMAL else f'round({c}, {digits})'} AS {c}"

    return ", ".join(show(c, d) for c, d in columns.items())


def seeded(seed: int, *columns: str) -> str:
    """The draw of ``functions.columns.seeded`` in SQL."""
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(columns)})), 1, 13))::BIGINT"
