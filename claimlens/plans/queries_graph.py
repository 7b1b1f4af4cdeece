"""Queries: graph features, data quality and model preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checkpoints import materialize, store_by
from ..operators import graph, prepare, quality, staging, summary
from . import pipeline, testbed
from .catalog import DECIMAL, half_up_sql, query, rounded
from .oracles import block, seeded, sql
from .queries_features import inputs, labels
from .queries_summary import mix

# as many steps as the operator may take; the smaller the graph, the later the change falls below N * TOL
STEPS, TOL = 100, 1e-6

block(
    "edges",
    ["mix"],
    "SELECT npi, hcpcs_code, max(hcpcs_fraction) AS weight FROM mix WHERE hcpcs_fraction > 0.01"
    " GROUP BY npi, hcpcs_code",
)
block(
    "degrees",
    ["edges"],
    """
    SELECT npi, count(*) AS graph_degree, sum(weight::DECIMAL(28,9))::DOUBLE AS graph_weighted_degree,
           count(*) / ((SELECT count(DISTINCT npi) + count(DISTINCT hcpcs_code) FROM edges) - 1)
               AS graph_degree_centrality
    FROM edges GROUP BY npi
    """,
)
block(
    "links",
    ["edges"],
    """
    SELECT 'P' || npi AS a, 'H' || hcpcs_code AS b, weight AS w FROM edges
    UNION ALL SELECT 'H' || hcpcs_code, 'P' || npi, weight FROM edges
    """,
)
block("moves", ["links"], "SELECT a, b, w / sum(w) OVER (PARTITION BY a) AS t FROM links", kept=True)
block(
    "rank0",
    ["moves"],
    "SELECT a AS node, 1.0::DOUBLE / (SELECT count(DISTINCT a) FROM moves) AS x FROM moves GROUP BY a",
    kept=True,
)
for i in range(1, STEPS + 1):
    block(
        f"rank{i}",
        [f"rank{i - 1}", "moves"],
        f"SELECT b AS node, 0.15 / (SELECT count(*) FROM rank0) + 0.85 * sum(t * x) AS x"
        f" FROM moves JOIN rank{i - 1} ON node = a GROUP BY b",
        kept=True,
    )
# the first step whose total change is below the tolerance
block(
    "stop",
    [f"rank{STEPS}"],
    f"SELECT coalesce(min(i), {STEPS}) AS i FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS i, sum(abs(p.x - q.x)) AS c FROM rank{i} p JOIN rank{i - 1} q USING (node)" for i in range(1, STEPS + 1)
    )
    + f") WHERE c < {TOL} * (SELECT count(*) FROM rank0)",
)
block(
    "pagerank",
    ["stop"],
    "SELECT substr(node, 2) AS npi, x AS graph_pagerank FROM ("
    + " UNION ALL ".join(f"SELECT {i} AS i, * FROM rank{i}" for i in range(1, STEPS + 1))
    + ") WHERE i = (SELECT i FROM stop) AND node LIKE 'P%'",
)
block(
    "clustering",
    ["edges"],
    """
    SELECT npi, coalesce(avg(shared / (d1 + d2 - shared)), 0) AS graph_clustering
    FROM (SELECT DISTINCT npi FROM edges) LEFT JOIN (
        SELECT x.npi, y.npi AS other, count(*) AS shared
        FROM edges x JOIN edges y ON x.hcpcs_code = y.hcpcs_code AND x.npi <> y.npi
        GROUP BY x.npi, y.npi
    ) USING (npi)
    LEFT JOIN (SELECT npi, count(*) AS d1 FROM edges GROUP BY npi) USING (npi)
    LEFT JOIN (SELECT npi AS other, count(*) AS d2 FROM edges GROUP BY npi) USING (other)
    GROUP BY npi
    """,
)
block(
    "community",
    ["edges"],
    """
    SELECT npi, code AS graph_community_id, count(*) OVER (PARTITION BY code) AS graph_community_size
    FROM (SELECT npi, hcpcs_code AS code, row_number() OVER (PARTITION BY npi
                 ORDER BY weight DESC, hcpcs_code DESC) AS r FROM edges) WHERE r = 1
    """,
)
block(
    "graph_scores",
    ["pagerank", "clustering", "community"],
    """
    SELECT npi, 0.4 * coalesce((p - min(p) OVER ()) / nullif(max(p) OVER () - min(p) OVER (), 0), 0)
              + 0.3 * coalesce((c - min(c) OVER ()) / nullif(max(c) OVER () - min(c) OVER (), 0), 0)
              + 0.3 * (1 - coalesce((s - min(s) OVER ()) / nullif(max(s) OVER () - min(s) OVER (), 0), 0))
              AS graph_anomaly_score
    FROM (SELECT npi, graph_pagerank AS p, graph_clustering AS c, least(graph_community_size, 100) AS s
          FROM pagerank JOIN clustering USING (npi) JOIN community USING (npi))
    """,
)


def edges(spark, d):
    """The edges, stored by provider and compressed: most of their readers group by provider."""
    return store_by(graph.graph_edges(mix(spark, d)), "npi", arranged=True)


@query("graph_edges", sql("SELECT npi, hcpcs_code, round(weight, 6) AS weight FROM edges", "edges"))
def graph_edges(spark, d):
    return rounded(graph.graph_edges(mix(spark, d)), {"npi": None, "hcpcs_code": None, "weight": 6})


@query(
    "graph_degrees",
    sql(
        f"SELECT npi, graph_degree, {half_up_sql('graph_weighted_degree', 6)} AS graph_weighted_degree,"
        " round(graph_degree_centrality, 6) AS graph_degree_centrality FROM degrees",
        "degrees",
    ),
)
def graph_degrees(spark, d):
    return rounded(
        graph.graph_degrees(edges(spark, d)),
        {"npi": None, "graph_degree": None, "graph_weighted_degree": 6, "graph_degree_centrality": 6},
    )


@query("graph_pagerank", sql("SELECT npi, round(graph_pagerank, 10) AS graph_pagerank FROM pagerank", "pagerank"))
def graph_pagerank(spark, d):
    rows = graph.graph_pagerank(edges(spark, d), max_iter=STEPS, tol=TOL)
    return rounded(rows, {"npi": None, "graph_pagerank": 10})


@query(
    "graph_clustering",
    sql("SELECT npi, round(graph_clustering, 6) AS graph_clustering FROM clustering", "clustering"),
)
def graph_clustering(spark, d):
    return rounded(graph.graph_clustering(edges(spark, d)), {"npi": None, "graph_clustering": 6})


@query("graph_community", sql("SELECT * FROM community", "community"))
def graph_community(spark, d):
    return graph.graph_community(edges(spark, d))


@query(
    "graph_score",
    sql("SELECT npi, round(graph_anomaly_score, 6) AS graph_anomaly_score FROM graph_scores", "graph_scores"),
)
def graph_score(spark, d):
    features = graph.graph_features(edges(spark, d), tol=TOL)
    return rounded(graph.graph_score(features), {"npi": None, "graph_anomaly_score": 6})


# --- data quality ----------------------------------------------------------


@query(
    "check_claims",
    sql(
        """
        SELECT 'claims' AS "table", unnest(['has_rows', 'required_columns_missing', 'null_pct_Rndrng_NPI',
                 'null_pct_HCPCS_Cd', 'null_pct_Tot_Srvcs', 'null_pct_Tot_Benes', 'bad_npi_pct']) AS "check",
               unnest([count(*)::DOUBLE, 0, round(100.0 * count(*) FILTER (WHERE npi IS NULL) / count(*), 2),
                 round(100.0 * count(*) FILTER (WHERE hcpcs_code IS NULL) / count(*), 2),
                 round(100.0 * count(*) FILTER (WHERE total_services IS NULL) / count(*), 2),
                 round(100.0 * count(*) FILTER (WHERE total_beneficiaries IS NULL) / count(*), 2),
                 round(100.0 * count(*) FILTER (WHERE NOT regexp_full_match(npi, '[0-9]{10}')) / count(*), 2)])
                 AS value, TRUE AS passed
        FROM claims
        """,
        "claims",
    ),
)
def check_claims(spark, d):
    return quality.check_claims(testbed.raw_claims(spark, d))


@query(
    "check_exclusions",
    sql(
        """
        SELECT 'exclusions' AS "table", c AS "check", v AS value,
               CASE c WHEN 'has_rows' THEN v > 0 WHEN 'min_rows' THEN v >= 50000
                      WHEN 'null_pct_EXCLDATE' THEN v <= 5 ELSE v >= 1000 END AS passed
        FROM (SELECT unnest(['has_rows', 'min_rows', 'null_pct_EXCLDATE', 'npis_present']) AS c,
                     unnest([count(*)::DOUBLE, count(*)::DOUBLE,
                             round(100.0 * count(*) FILTER (WHERE excldate IS NULL) / count(*), 2),
                             count(*) FILTER (WHERE trim(npi) <> '')]) AS v
              FROM raw_exclusions)
        """,
        "raw_exclusions",
    ),
)
def check_exclusions(spark, d):
    return quality.check_exclusions(testbed.raw_exclusions(spark, d))


@query(
    "check_registry",
    sql(
        """
        SELECT 'registry' AS "table", unnest(['has_rows', 'null_npis', 'taxonomy_fill_pct']) AS "check",
               unnest([count(*)::DOUBLE, count(*) FILTER (WHERE npi IS NULL),
                       round(100.0 * count(*) FILTER (WHERE trim(taxonomy_code) <> '') / count(*), 2)]) AS value,
               TRUE AS passed
        FROM raw_registry
        """,
        "raw_registry",
    ),
)
def check_registry(spark, d):
    return quality.check_registry(testbed.raw_registry(spark, d))


@query(
    "validate_all",
    sql(
        """
        SELECT * FROM (VALUES ('claims', 7::BIGINT, 7::BIGINT), ('registry', 3, 3)) t("table",
               total_expectations, successful_expectations)
        UNION ALL
        SELECT 'exclusions', 4, 2 + (count(*) >= 50000)::BIGINT + (count(*) FILTER (WHERE trim(npi) <> '') >= 1000)::BIGINT
        FROM raw_exclusions
        """,
        "raw_exclusions",
    ),
)
def validate_all(spark, d):
    return quality.validate_all(
        testbed.raw_claims(spark, d), testbed.raw_exclusions(spark, d), testbed.raw_registry(spark, d)
    ).select("table", "total_expectations", "successful_expectations")


@query(
    "table_stats",
    "SELECT 'lineitem' AS \"table\", count(*) AS row_count, 11::BIGINT AS column_count FROM lineitem",
)
def table_stats(spark, d):
    return quality.table_stats(testbed.table(spark, d, "lineitem"), "lineitem")


def suite_tables(spark, d):
    built = pipeline.build_mart(inputs(spark, d))
    return {
        "claims": testbed.claims(spark, d),
        "exclusions": staging.stage_exclusions(testbed.raw_exclusions(spark, d)),
        "registry": staging.stage_registry(testbed.raw_registry(spark, d)),
        "claims_summary": built.providers,
        "provider_enriched": summary.enrich_providers(
            built.providers, staging.stage_registry(testbed.raw_registry(spark, d)), labels(spark, d)
        ),
        "hcpcs_mix": built.mix,
        "specialty_benchmarks": built.benchmarks,
        "feature_mart": built.mart,
    }


def _suite_sql() -> str:
    source = {
        "claims": "claims", "exclusions": "staged_exclusions", "registry": "registry",
        "claims_summary": "summary", "provider_enriched": "enriched", "hcpcs_mix": "mix",
        "specialty_benchmarks": "benchmarks", "feature_mart": "mart",
    }
    parts = []
    for name, spec in quality.CONSTRAINTS.items():
        tests = [(c, "not_null", f"count(*) FILTER (WHERE {c} IS NULL)") for c in spec.not_null]
        for c, values in spec.accepted.items():
            quoted = ", ".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" for v in values)
            tests.append((c, "accepted_values", f"count(*) FILTER (WHERE {c} NOT IN ({quoted}))"))
        for c in spec.unique:
            tests.append(
                (c, "unique", f"(SELECT count(*) FROM (SELECT {c} FROM {source[name]} WHERE {c} IS NOT NULL"
                              f" GROUP BY {c} HAVING count(*) > 1))")
            )
        for c, kind, expr in tests:
            parts.append(
                f"SELECT '{name}' AS \"table\", '{c}' AS \"column\", '{kind}' AS test, {expr} AS failures"
                + (f" FROM {source[name]}" if kind != "unique" else "")
            )
    return sql(
        f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})",
        "claims", "staged_exclusions", "registry", "summary", "enriched", "mix", "benchmarks", "mart",
    )


block(
    "staged_exclusions",
    ["raw_exclusions"],
    "SELECT npi, excltype AS exclusion_type, TRUE AS is_currently_excluded FROM raw_exclusions"
    " WHERE length(trim(npi)) = 10",
)


@query("constraint_suite", _suite_sql())
def constraint_suite(spark, d):
    return quality.constraint_suite(suite_tables(spark, d))


# --- model preparation -----------------------------------------------------

PREP_FEATURES = ["total_services", "zscore_total_payments", "upcoding_ratio_vs_peers", "wavg_submitted_charge"]


def mart(spark, d):
    return materialize(pipeline.build_mart(inputs(spark, d)).mart)


@query(
    "label_filter",
    sql(
        "SELECT npi, is_excluded AND coalesce(exclusion_type IN ('1128a1', '1128a3', '1128Aa', '1128b6', '1128b7'), FALSE)"
        " AND coalesce(total_medicare_payments, 0) >= 5000 AS is_excluded FROM mart",
        "mart",
    ),
)
def label_filter(spark, d):
    return prepare.filter_labels(mart(spark, d), labels(spark, d)).select("npi", "is_excluded")


@query(
    "label_filter_report",
    sql(
        "SELECT count(*) FILTER (WHERE is_excluded) AS positives_before, count(*) FILTER (WHERE is_excluded"
        " AND exclusion_type IN ('1128a1', '1128a3') AND total_medicare_payments >= 5000) AS positives_after FROM mart",
        "mart",
    ),
)
def label_filter_report(spark, d):
    table = mart(spark, d)
    return prepare.label_filter_report(table, prepare.filter_labels(table, labels(spark, d)))


@query(
    "class_balance",
    sql(
        "SELECT count(*) AS n_total, count(*) FILTER (WHERE is_excluded) AS n_positive,"
        " round(100.0 * count(*) FILTER (WHERE is_excluded) / count(*), 6) AS positive_pct,"
        " round(count(*) FILTER (WHERE NOT is_excluded) / nullif(count(*) FILTER (WHERE is_excluded), 0), 6)"
        " AS imbalance_ratio FROM mart",
        "mart",
    ),
)
def class_balance(spark, d):
    return rounded(
        prepare.class_balance(mart(spark, d)),
        {"n_total": None, "n_positive": None, "positive_pct": 6, "imbalance_ratio": 6},
    )


def holed(table):
    """Mart features with high volumes blanked out, to have something to impute."""
    return table.withColumn("wavg_submitted_charge", F.when(~F.col("is_above_p95_volume"), F.col("wavg_submitted_charge")))


block(
    "h",
    ["mart"],
    "SELECT npi, total_services, zscore_total_payments, upcoding_ratio_vs_peers,"
    " CASE WHEN NOT is_above_p95_volume THEN wavg_submitted_charge END AS wavg_submitted_charge FROM mart",
)


@query(
    "impute",
    sql(
        "SELECT npi, "
        + ", ".join(
            f"{half_up_sql(v, 6) if c in DECIMAL else f'round({v}, 6)'} AS {c}"
            for c, v in ((c, f"coalesce({c}, (SELECT median({c}) FROM h))") for c in PREP_FEATURES)
        )
        + " FROM h",
        "h",
    ),
)
def impute(spark, d):
    return rounded(prepare.impute(holed(mart(spark, d)), PREP_FEATURES), {"npi": None, **{c: 6 for c in PREP_FEATURES}})


@query(
    "standard_scale",
    sql(
        "SELECT npi, " + ", ".join(
            f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 4) AS {c}"
            for c in PREP_FEATURES
        ) + " FROM mart",
        "mart",
    ),
)
def standard_scale(spark, d):
    return rounded(
        prepare.standard_scale(mart(spark, d), PREP_FEATURES), {"npi": None, **{c: 4 for c in PREP_FEATURES}}
    )


@query(
    "stratified_split",
    sql(
        "SELECT npi, is_excluded, CASE WHEN row_number() OVER (PARTITION BY is_excluded ORDER BY h, npi)"
        " <= round(count(*) OVER (PARTITION BY is_excluded) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split"
        f" FROM (SELECT npi, is_excluded, {seeded(42, 'npi')} AS h FROM mart)",
        "mart",
    ),
)
def stratified_split(spark, d):
    return prepare.stratified_split(mart(spark, d)).select("npi", "is_excluded", "split")


@query(
    "stratified_split_counts",
    sql(
        "SELECT * FROM (SELECT is_excluded, unnest(['test', 'train']) AS split,"
        " unnest([round(count(*) * 0.2::DOUBLE)::BIGINT, (count(*) - round(count(*) * 0.2::DOUBLE))::BIGINT]) AS n"
        " FROM mart GROUP BY is_excluded) WHERE n > 0",
        "mart",
    ),
)
def stratified_split_counts(spark, d):
    return prepare.stratified_split(mart(spark, d)).groupBy("is_excluded", "split").agg(
        F.count(F.lit(1)).alias("n")
    )
