"""Queries: enriched providers, feature mart and derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, staging, summary
from ..schemas import MAHALANOBIS_FEATURES
from . import pipeline, testbed
from .catalog import query, rounded
from .oracles import block
from .oracles import rounded as sql_round
from .oracles import sql
from .queries_summary import providers, stored_mix, stored_providers

block(
    "labels0",
    ["raw_exclusions"],
    """
    SELECT npi, min(excltype) AS exclusion_type,
           min(strptime(excldate, '%Y%m%d'))::DATE AS exclusion_date
    FROM raw_exclusions WHERE npi <> '0000000000' GROUP BY npi
    """,
)
block(
    "enriched",
    ["summary", "registry", "labels0"],
    """
    SELECT s.*, r.primary_taxonomy_code, r.enumeration_date,
           r.practice_state AS nppes_practice_state, r.practice_zip5 AS nppes_practice_zip5,
           l.npi IS NOT NULL AS is_excluded, CASE WHEN l.npi IS NOT NULL THEN 1 END AS exclusion_match_tier,
           CASE WHEN l.npi IS NOT NULL THEN 100.0::DOUBLE END AS exclusion_match_score,
           l.exclusion_type, l.exclusion_date, l.npi IS NOT NULL AS is_currently_excluded,
           coalesce(s.provider_type, 'Unknown') AS provider_specialty
    FROM summary s LEFT JOIN registry r USING (npi) LEFT JOIN labels0 l USING (npi)
    """,
)
Z = {
    "total_services": ("total_services", "total_services"),
    "total_payments": ("total_medicare_payments", "total_payments"),
    "total_beneficiaries": ("total_beneficiaries", "total_beneficiaries"),
    "services_per_bene": ("services_per_beneficiary", "services_per_bene"),
    "unique_hcpcs": ("unique_hcpcs_codes", "unique_hcpcs"),
    "avg_charge": ("wavg_submitted_charge", "wavg_charge"),
}
block(
    "mart",
    ["enriched", "benchmarks", "provider_upcoding", "specialty_upcoding"],
    "SELECT p.npi, p.provider_last_name, p.provider_first_name, p.provider_specialty, p.entity_type,"
    " p.provider_state, p.provider_zip5, p.primary_taxonomy_code, p.total_services,"
    " p.total_beneficiaries, p.total_medicare_payments, p.total_submitted_charges,"
    " p.unique_hcpcs_codes, p.services_per_beneficiary, p.facility_service_ratio,"
    " p.drug_service_ratio, p.wavg_submitted_charge, p.wavg_medicare_payment, "
    + ", ".join(
        f"(p.{v} - b.avg_{b}) / nullif(b.std_{b}, 0) AS zscore_{n}" for n, (v, b) in Z.items()
    )
    + """,
    p.total_services / nullif(b.median_total_services, 0) AS ratio_services_vs_median,
    p.total_medicare_payments / nullif(b.median_total_payments, 0) AS ratio_payments_vs_median,
    p.services_per_beneficiary / nullif(b.median_services_per_bene, 0) AS ratio_svc_per_bene_vs_median,
    p.total_beneficiary_day_services / nullif(p.total_beneficiaries, 0) AS beneficiary_day_intensity,
    u.high_complexity_ratio,
    u.high_complexity_ratio / nullif(su.peer_high_complexity_ratio, 0) AS upcoding_ratio_vs_peers,
    b.peer_count AS specialty_peer_count, b.avg_total_services AS specialty_avg_services,
    b.p95_total_services AS specialty_p95_services, b.p99_total_services AS specialty_p99_services,
    coalesce(p.total_services > b.p95_total_services, FALSE) AS is_above_p95_volume,
    coalesce(p.total_services > b.p99_total_services, FALSE) AS is_above_p99_volume,
    p.is_excluded, p.exclusion_type, p.exclusion_date, p.is_currently_excluded,
    p.exclusion_match_tier, p.exclusion_match_score
    FROM enriched p LEFT JOIN benchmarks b ON p.provider_specialty = b.specialty
    LEFT JOIN provider_upcoding u ON p.npi = u.npi
    LEFT JOIN specialty_upcoding su ON p.provider_specialty = su.specialty
    """,
)
block(
    "median_mix",
    ["mix"],
    """
    SELECT specialty, hcpcs_code,
           CASE WHEN sum(med) OVER (PARTITION BY specialty) > 0
                THEN med / sum(med) OVER (PARTITION BY specialty) ELSE med END AS q
    FROM (
        SELECT g.specialty, hcpcs_code,
               (coalesce(f[(n - 1) // 2 - (n - k) + 1], 0) * CAST((n - 1) // 2 >= n - k AS INTEGER)
                + coalesce(f[n // 2 - (n - k) + 1], 0) * CAST(n // 2 >= n - k AS INTEGER)) / 2 AS med
        FROM (SELECT provider_type AS specialty, hcpcs_code, count(*) AS k,
                     list_sort(list(hcpcs_fraction)) AS f
              FROM mix GROUP BY provider_type, hcpcs_code) g
        JOIN (SELECT provider_type AS specialty, count(DISTINCT npi) AS n
              FROM mix GROUP BY provider_type) t ON t.specialty = g.specialty
    )
    """,
)
block(
    "jsd",
    ["mix", "median_mix"],
    """
    SELECT npi, specialty,
           0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
         + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) AS jsd_vs_specialty
    FROM (
        SELECT w.npi, w.specialty, coalesce(m.hcpcs_fraction, 0) / w.total AS p, d.q
        FROM (SELECT npi, provider_type AS specialty, sum(hcpcs_fraction) AS total
              FROM mix GROUP BY npi, provider_type) w
        JOIN median_mix d ON d.specialty = w.specialty
        LEFT JOIN mix m ON m.npi = w.npi AND m.provider_type = w.specialty
                       AND m.hcpcs_code = d.hcpcs_code
    ) GROUP BY npi, specialty
    """,
)
block(
    "zips",
    ["claims"],
    """
    SELECT npi, CASE WHEN total > 0 THEN -sum(c / total * log2(c / total)) ELSE 0 END AS zip_entropy,
           CASE WHEN total > 0 AND count(*) > 1
                THEN -sum(c / total * log2(c / total)) / log2(count(*)) ELSE 0 END
               AS zip_entropy_normalized,
           count(*) AS unique_zip_count
    FROM (SELECT npi, provider_zip5, CAST(sum(total_beneficiaries) AS DOUBLE) AS c,
                 CAST(sum(sum(total_beneficiaries)) OVER (PARTITION BY npi) AS DOUBLE) AS total
          FROM claims GROUP BY npi, provider_zip5)
    GROUP BY npi, total
    """,
)
block(
    "velocity",
    ["claims"],
    """
    SELECT npi, s / 250 AS daily_services, b / 250 AS daily_beneficiaries,
           d / nullif(b, 0) AS services_per_bene_per_day,
           s / 250 / greatest(coalesce(f / nullif(s, 0), 0) * 25 + coalesce(o / nullif(s, 0), 0) * 40, 1)
               AS throughput_utilization,
           s / 250 / greatest(coalesce(f / nullif(s, 0), 0) * 25 + coalesce(o / nullif(s, 0), 0) * 40, 1) > 1
               AS exceeds_throughput_limit
    FROM (SELECT npi, sum(total_services) AS s, sum(total_beneficiaries) AS b,
                 sum(total_beneficiary_day_services) AS d,
                 sum(CASE WHEN place_of_service = 'F' THEN total_services ELSE 0 END) AS f,
                 sum(CASE WHEN place_of_service = 'O' THEN total_services ELSE 0 END) AS o
          FROM claims GROUP BY npi)
    """,
)


def _cholesky_blocks() -> None:
    """Distance by an unrolled Cholesky factorisation and forward substitution.

    The tail series is summed over 400 terms, enough up to d2 = 300, beyond which
    the probability is below 1e-50.
    """
    f = MAHALANOBIS_FEATURES
    n = len(f)
    block(
        "moments",
        ["summary"],
        "SELECT provider_type AS specialty, count(*) AS peers, "
        + ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(f))
        + ", "
        + ", ".join(
            f"covar_samp({f[i]}, {f[j]})" + (" + 1e-6" if i == j else "") + f" AS c{i}_{j}"
            for i in range(n)
            for j in range(i + 1)
        )
        + " FROM summary GROUP BY provider_type HAVING count(*) >= 20",
    )
    prev = "moments"
    for j in range(n):
        diag = f"sqrt(c{j}_{j}" + "".join(f" - l{j}_{k} * l{j}_{k}" for k in range(j)) + ")"
        below = [
            f"(c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j)) + f") / {diag} AS l{i}_{j}"
            for i in range(j + 1, n)
        ]
        block(f"chol{j}", [prev], f"SELECT *, {', '.join([f'{diag} AS l{j}_{j}', *below])} FROM {prev}")
        prev = f"chol{j}"
    block(
        "sub",
        ["summary", prev],
        f"SELECT s.npi, k.*, {', '.join(f's.{c} AS x{i}' for i, c in enumerate(f))} "
        f"FROM summary s LEFT JOIN {prev} k ON k.specialty = s.provider_type",
    )
    prev = "sub"
    for i in range(n):
        y = f"(x{i} - m{i}" + "".join(f" - l{i}_{k} * y{k}" for k in range(i)) + f") / l{i}_{i}"
        block(f"sub{i}", [prev], f"SELECT *, {y} AS y{i} FROM {prev}")
        prev = f"sub{i}"
    d2 = " + ".join(f"y{i} * y{i}" for i in range(n))
    block(
        "distance",
        [prev],
        f"""
        SELECT npi, sqrt(d2) AS mahalanobis_distance,
               CASE WHEN d2 > 300 THEN 0 WHEN d2 IS NOT NULL THEN greatest(0, 1 - list_sum([exp(-d2 / 2 + (4.5 + k) * ln(d2 / 2) - lgamma(5.5 + k))
                             for k in range(0, 400)])) END AS mahalanobis_pvalue
        FROM (SELECT npi, {d2} AS d2 FROM {prev})
        """,
    )


_cholesky_blocks()
block(
    "full_features",
    ["mart", "jsd", "zips", "velocity", "distance"],
    """
    SELECT m.*, j.jsd_vs_specialty, z.* EXCLUDE (npi), v.* EXCLUDE (npi), d.* EXCLUDE (npi)
    FROM mart m LEFT JOIN jsd j ON j.npi = m.npi AND j.specialty = m.provider_specialty
    LEFT JOIN zips z ON z.npi = m.npi LEFT JOIN velocity v ON v.npi = m.npi
    LEFT JOIN distance d ON d.npi = m.npi
    """,
)


def labels(spark, d):
    """Labels by provider id alone: one row per listed provider."""
    listed = testbed.raw_exclusions(spark, d).where(F.col("NPI") != "0000000000")
    return listed.groupBy(F.col("NPI").alias("npi")).agg(
        F.lit(True).alias("is_excluded"),
        F.lit(1).alias("match_tier"),
        F.lit(100.0).alias("similarity_score"),
        F.min("EXCLTYPE").alias("exclusion_type"),
        F.min(F.to_date("EXCLDATE", "yyyyMMdd")).alias("exclusion_date"),
        F.lit(True).alias("is_currently_excluded"),
    )


def enriched(spark, d):
    return summary.enrich_providers(
        providers(spark, d), staging.stage_registry(testbed.raw_registry(spark, d)), labels(spark, d)
    )


def inputs(spark, d) -> pipeline.FeatureInputs:
    return pipeline.FeatureInputs(
        claims=testbed.claims(spark, d),
        registry=staging.stage_registry(testbed.raw_registry(spark, d)),
        labels=labels(spark, d),
        high_complexity=testbed.HIGH_CODES,
    )


ENRICHED_CHECK = {
    "npi": None, "provider_specialty": None, "primary_taxonomy_code": None, "enumeration_date": None,
    "nppes_practice_state": None, "nppes_practice_zip5": None, "is_excluded": None,
    "exclusion_match_tier": None, "exclusion_match_score": None, "exclusion_type": None,
    "exclusion_date": None, "is_currently_excluded": None, "total_services": 6,
}


@query("provider_enriched", sql(f"SELECT {sql_round(ENRICHED_CHECK)} FROM enriched", "enriched"))
def provider_enriched(spark, d):
    return rounded(enriched(spark, d), ENRICHED_CHECK)


MART_CHECK = {
    "npi": None, "provider_last_name": None, "provider_first_name": None,
    "provider_specialty": None, "entity_type": None, "provider_state": None, "provider_zip5": None,
    "primary_taxonomy_code": None, "total_services": 6, "total_beneficiaries": None,
    "total_medicare_payments": 6, "total_submitted_charges": 6, "unique_hcpcs_codes": None,
    "services_per_beneficiary": 6, "facility_service_ratio": 6, "drug_service_ratio": 6,
    "wavg_submitted_charge": 6, "wavg_medicare_payment": 6, "zscore_total_services": 6,
    "zscore_total_payments": 6, "zscore_total_beneficiaries": 6, "zscore_services_per_bene": 6,
    "zscore_unique_hcpcs": 6, "zscore_avg_charge": 6, "ratio_services_vs_median": 6,
    "ratio_payments_vs_median": 6, "ratio_svc_per_bene_vs_median": 6,
    "beneficiary_day_intensity": 10, "high_complexity_ratio": 6, "upcoding_ratio_vs_peers": 6,
    "specialty_peer_count": None, "specialty_avg_services": 6, "specialty_p95_services": 6,
    "specialty_p99_services": 6, "is_above_p95_volume": None, "is_above_p99_volume": None,
    "is_excluded": None, "exclusion_type": None, "exclusion_date": None,
    "is_currently_excluded": None, "exclusion_match_tier": None, "exclusion_match_score": None,
}


@query("feature_mart", sql(f"SELECT {sql_round(MART_CHECK)} FROM mart", "mart"))
def feature_mart(spark, d):
    return rounded(pipeline.build_mart(inputs(spark, d)).mart, MART_CHECK)


@query(
    "volume_flags",
    sql("SELECT npi, is_above_p95_volume, is_above_p99_volume FROM mart", "mart"),
)
def volume_flags(spark, d):
    return summary.volume_flags(pipeline.build_mart(inputs(spark, d)).mart)


@query(
    "specialty_median_mix",
    sql("SELECT specialty, hcpcs_code, round(q, 6) AS q FROM median_mix WHERE q > 0", "median_mix"),
)
def specialty_median_mix(spark, d):
    rows = features.specialty_median_mix(stored_mix(spark, d)).where(F.col("q") > 0)
    return rounded(rows, {"specialty": None, "hcpcs_code": None, "q": 6})


@query(
    "jsd_vs_specialty",
    sql("SELECT npi, specialty, round(jsd_vs_specialty, 6) AS jsd_vs_specialty FROM jsd", "jsd"),
)
def jsd_vs_specialty(spark, d):
    rows = features.jsd_vs_specialty(stored_mix(spark, d))
    return rounded(rows, {"npi": None, "specialty": None, "jsd_vs_specialty": 6})


ZIP_CHECK = {"npi": None, "zip_entropy": 6, "zip_entropy_normalized": 6, "unique_zip_count": None}


@query("zip_entropy", sql(f"SELECT {sql_round(ZIP_CHECK)} FROM zips", "zips"))
def zip_entropy(spark, d):
    return rounded(features.zip_entropy(testbed.claims(spark, d)), ZIP_CHECK)


VELOCITY_CHECK = {
    "npi": None, "daily_services": 6, "daily_beneficiaries": 6, "services_per_bene_per_day": 10,
    "throughput_utilization": 6, "exceeds_throughput_limit": None,
}


@query("billing_velocity", sql(f"SELECT {sql_round(VELOCITY_CHECK)} FROM velocity", "velocity"))
def billing_velocity(spark, d):
    return rounded(features.billing_velocity(testbed.claims(spark, d)), VELOCITY_CHECK)


def with_specialty(spark, d):
    return stored_providers(spark, d).withColumn(
        "provider_specialty", F.coalesce("provider_type", F.lit("Unknown"))
    )


@query(
    "mahalanobis_distance",
    sql(
        "SELECT npi, round(mahalanobis_distance, 5) AS mahalanobis_distance, "
        "abs(round(mahalanobis_pvalue, 5)) AS mahalanobis_pvalue FROM distance",
        "distance",
    ),
)
def mahalanobis_distance(spark, d):
    rows = features.mahalanobis_distance(with_specialty(spark, d))
    return rounded(rows, {"npi": None, "mahalanobis_distance": 5, "mahalanobis_pvalue": 5})


@query(
    "mahalanobis_moments",
    sql(
        " UNION ALL ".join(
            f"SELECT specialty, '{a}' AS feature_a, '{b}' AS feature_b, "
            f"round(covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})), 6) AS correlation "
            f"FROM (SELECT *, provider_type AS specialty FROM summary) GROUP BY specialty"
            for i, a in enumerate(MAHALANOBIS_FEATURES)
            for b in MAHALANOBIS_FEATURES[i + 1 :]
        ),
        "summary",
    ),
)
def mahalanobis_moments(spark, d):
    f = MAHALANOBIS_FEATURES
    n = len(f)
    m = features.mahalanobis_moments(features.filled_features(with_specialty(spark, d), f), f)

    def corr(i, j):
        at = lambda r, c: F.get("cov", F.lit(r * n + c))
        return F.struct(
            F.lit(f[i]).alias("feature_a"),
            F.lit(f[j]).alias("feature_b"),
            F.round(at(i, j) / F.sqrt(at(i, i) * at(j, j)), 6).alias("correlation"),
        )

    pairs = F.array(*[corr(i, j) for i in range(n) for j in range(i + 1, n)])
    return m.select(F.col("provider_specialty").alias("specialty"), F.explode(pairs).alias("p")).select(
        "specialty", "p.*"
    )


FULL_CHECK = {
    **{k: v for k, v in MART_CHECK.items() if k.startswith(("npi", "zscore", "ratio", "is_"))},
    "jsd_vs_specialty": 6, "zip_entropy": 6, "zip_entropy_normalized": 6, "unique_zip_count": None,
    "daily_services": 6, "throughput_utilization": 6, "exceeds_throughput_limit": None,
    "mahalanobis_distance": 5,
}


@query("feature_table", sql(f"SELECT {sql_round(FULL_CHECK)} FROM full_features", "full_features"))
def feature_table(spark, d):
    return rounded(pipeline.build_features(inputs(spark, d)), FULL_CHECK)
