"""Queries: record linkage, conflict resolution and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..functions.similarity import ratio_score, token_set_score
from ..operators import audit, linkage, staging
from . import testbed
from .catalog import query, rounded
from .oracles import block, seeded, sql
from .queries_summary import providers

CONFIG = linkage.MatchConfig(states=testbed.STATES)


def listed(spark, d):
    return linkage.load_exclusions(testbed.raw_exclusions(spark, d), testbed.STATES)


def names(spark, d):
    return linkage.load_providers(providers(spark, d))


def cascade(spark, d):
    """Stored inputs and what each tier leaves over: (list, people, after 1, after 2)."""
    rows, provs = materialize(listed(spark, d)), materialize(names(spark, d))
    people = linkage.individuals(rows)
    after1 = linkage.unmatched_by_npi(rows, provs)
    return rows, people, after1, linkage.unmatched_by_name(people, after1)


block(
    "listed",
    ["raw_exclusions"],
    """
    SELECT npi AS leie_npi, specialty AS leie_specialty, excltype AS leie_excltype,
           excldate AS leie_excldate, upper(trim(lastname)) AS leie_last_norm,
           upper(trim(firstname)) AS leie_first_norm, coalesce(upper(trim(busname)), '') AS leie_busname_norm,
           state AS leie_state_norm,
           upper(trim(lastname)) || '|' || upper(trim(firstname)) || '|'
               || coalesce(upper(trim(busname)), '') || '|' || state || '|' || excldate AS leie_row_key
    FROM raw_exclusions
    """,
)
block(
    "prov",
    ["summary"],
    """
    SELECT npi, provider_type AS mart_specialty, entity_type AS mart_entity_type,
           provider_last_name AS mart_last_norm, provider_first_name AS mart_first_norm,
           provider_state AS mart_state_norm
    FROM summary
    """,
)
block("people", ["listed"], "SELECT * FROM listed WHERE trim(leie_specialty) <> 'PHARMACY'")
block(
    "tier1",
    ["listed", "prov"],
    """
    SELECT l.*, p.*, 1 AS match_tier, 100.0::DOUBLE AS similarity_score
    FROM listed l JOIN prov p ON p.npi = l.leie_npi WHERE l.leie_npi <> '0000000000'
    """,
)
block("after1", ["prov", "tier1"], "SELECT * FROM prov WHERE npi NOT IN (SELECT npi FROM tier1)")
block(
    "tier2",
    ["people", "after1"],
    """
    SELECT l.*, p.*, 2 AS match_tier, 100.0::DOUBLE AS similarity_score
    FROM people l JOIN after1 p ON p.mart_last_norm = l.leie_last_norm
     AND p.mart_first_norm = l.leie_first_norm AND p.mart_state_norm = l.leie_state_norm
    """,
)
block("after2", ["after1", "tier2"], "SELECT * FROM after1 WHERE npi NOT IN (SELECT npi FROM tier2)")


def indel_sql(a: str, b: str) -> str:
    """200 * LCS / (m + n), the LCS row folded over the characters of b."""
    row = (
        f"list_reduce(list_prepend([0 for i in range(len({a}) + 1)], "
        f"[[ord({b}[j]) for i in range(len({a}) + 1)] for j in range(1, len({b}) + 1)]), "
        "lambda acc, ch: list_reduce(list_prepend([0], [[i] for i in range(1, len(acc))]), "
        f"lambda r, i: list_append(r, CASE WHEN ord({a}[i[1]]) = ch[1] THEN acc[i[1]] + 1 "
        "ELSE greatest(acc[i[1] + 1], r[i[1]]) END)))"
    )
    return f"(200.0::DOUBLE * {row}[len({a}) + 1] / (len({a}) + len({b})))"


# two-token names: the set score by its definition for shared and unshared tokens
block(
    "fuzzy_names",
    ["people", "after2"],
    f"""
    SELECT state, l_last, l_first, p_last, p_first, similarity_score,
           {indel_sql('l_last', 'p_last')} AS last_score, {indel_sql('l_first', 'p_first')} AS first_score
    FROM (
        SELECT *, CASE
            WHEN list_sort([l_last, l_first]) = list_sort([p_last, p_first]) THEN 100.0
            WHEN l_last IN (p_last, p_first) OR l_first IN (p_last, p_first) THEN greatest(
                100 * (1 - (la + lb - la_lb_sim * (la + lb) / 100) / (2 * s + 2 + la + lb)),
                100 * (1 - (1 + la) / (2 * s + 1 + la)), 100 * (1 - (1 + lb) / (2 * s + 1 + lb)))
            ELSE whole END AS similarity_score
        FROM (
            SELECT *, len(shared) AS s, len(rest_l) AS la, len(rest_p) AS lb,
                   {indel_sql('rest_l', 'rest_p')} AS la_lb_sim, {indel_sql('sorted_l', 'sorted_p')} AS whole
            FROM (
                SELECT *, CASE WHEN l_last IN (p_last, p_first) THEN l_last ELSE l_first END AS shared,
                       CASE WHEN l_last IN (p_last, p_first) THEN l_first ELSE l_last END AS rest_l,
                       CASE WHEN p_last IN (l_last, l_first) THEN p_first ELSE p_last END AS rest_p,
                       least(l_last, l_first) || ' ' || greatest(l_last, l_first) AS sorted_l,
                       least(p_last, p_first) || ' ' || greatest(p_last, p_first) AS sorted_p
                FROM (SELECT DISTINCT leie_state_norm AS state, leie_last_norm AS l_last,
                             leie_first_norm AS l_first FROM people)
                JOIN (SELECT DISTINCT mart_state_norm AS state, mart_last_norm AS p_last,
                             mart_first_norm AS p_first FROM after2) USING (state)
                WHERE NOT EXISTS (SELECT 1 FROM after2 a WHERE a.mart_state_norm = state
                                  AND a.mart_last_norm || ' ' || a.mart_first_norm = l_last || ' ' || l_first)
            )
        )
    ) WHERE similarity_score >= 92
    """,
)
block(
    "tier3",
    ["fuzzy_names", "people", "after2"],
    """
    SELECT l.*, p.*, 3 AS match_tier, f.similarity_score, f.last_score, f.first_score
    FROM (
        SELECT n.*, a.npi, row_number() OVER (PARTITION BY state, l_last || ' ' || l_first
                                              ORDER BY similarity_score DESC, a.npi) AS r
        FROM fuzzy_names n JOIN after2 a ON a.mart_state_norm = n.state
         AND a.mart_last_norm = p_last AND a.mart_first_norm = p_first
    ) f
    JOIN people l ON l.leie_state_norm = f.state AND l.leie_last_norm = l_last AND l.leie_first_norm = l_first
    JOIN after2 p ON p.npi = f.npi
    WHERE r <= 5 AND last_score >= 88 AND first_score >= 85 AND left(l_first, 1) = left(p_first, 1)
    """,
)
block(
    "matches",
    ["tier1", "tier2", "tier3"],
    """
    SELECT *, count(*) OVER (PARTITION BY leie_row_key) AS leie_row_n_candidates
    FROM (SELECT *, NULL::DOUBLE AS last_score, NULL::DOUBLE AS first_score FROM tier1
          UNION ALL BY NAME SELECT *, NULL::DOUBLE AS last_score, NULL::DOUBLE AS first_score FROM tier2
          UNION ALL BY NAME SELECT * FROM tier3)
    """,
)
block(
    "candidates",
    ["matches"],
    """
    SELECT m.*, c.provider_n_leie_rows,
           NOT (match_tier = 3 AND leie_row_n_candidates > 3) AS keep_for_training
    FROM matches m JOIN (SELECT npi, count(DISTINCT leie_row_key) AS provider_n_leie_rows
                         FROM matches GROUP BY npi) c USING (npi)
    """,
)
block(
    "final_labels",
    ["candidates"],
    """
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY npi ORDER BY leie_excldate, match_tier, leie_row_key,
                                     leie_excltype, leie_specialty) AS r
        FROM candidates WHERE keep_for_training
    ) WHERE r = 1
    """,
)
PAIR = ["npi", "leie_row_key", "leie_excltype", "leie_specialty", "similarity_score", "match_tier"]


def pair_rows(df):
    if "leie_row_key" not in df.columns:
        df = df.withColumn("leie_row_key", linkage.row_key())
    return rounded(df, {c: 6 if c == "similarity_score" else None for c in PAIR})


def pair_sql(source):
    cols = ", ".join(f"round({c}, 6) AS {c}" if c == "similarity_score" else c for c in PAIR)
    return sql(f"SELECT {cols} FROM {source}", source)


@query("match_npi", pair_sql("tier1"))
def match_npi(spark, d):
    return pair_rows(linkage.match_npi(listed(spark, d), names(spark, d)))


@query("match_exact_name", pair_sql("tier2"))
def match_exact_name(spark, d):
    _, people, after1, _ = cascade(spark, d)
    return pair_rows(linkage.match_exact_name(people, after1))


@query("unmatched_providers", sql("SELECT npi FROM after2", "after2"))
def unmatched_providers(spark, d):
    return cascade(spark, d)[3].select("npi")


@query(
    "match_fuzzy_name",
    sql(
        f"SELECT {', '.join(c for c in PAIR if c != 'similarity_score')},"
        " round(similarity_score, 6) AS similarity_score, round(last_score, 6) AS last_score,"
        " round(first_score, 6) AS first_score FROM tier3",
        "tier3",
    ),
)
def match_fuzzy_name(spark, d):
    _, people, _, after2 = cascade(spark, d)
    rows = linkage.match_fuzzy_name(people, after2, CONFIG).withColumn("leie_row_key", linkage.row_key())
    return rounded(
        rows, {**{c: None for c in PAIR}, "similarity_score": 6, "last_score": 6, "first_score": 6}
    )


# a listed two-word business meets one-word organisations of its state: the set
# score is 100 when the word is one of the two, and stays under 90 otherwise
@query(
    "match_business",
    sql(
        """
        SELECT npi, leie_row_key, leie_excltype, leie_specialty, 100.0::DOUBLE AS similarity_score, 4 AS match_tier
        FROM (SELECT n.leie_busname_norm, n.leie_state_norm, a.npi,
                     row_number() OVER (PARTITION BY n.leie_state_norm, n.leie_busname_norm ORDER BY a.npi) AS r
              FROM (SELECT DISTINCT leie_busname_norm, leie_state_norm FROM people WHERE leie_busname_norm <> '') n
              JOIN after1 a ON a.mart_entity_type = 'O' AND a.mart_state_norm = n.leie_state_norm
               AND a.mart_last_norm IN (split_part(leie_busname_norm, ' ', 1), split_part(leie_busname_norm, ' ', 2)))
        JOIN people USING (leie_busname_norm, leie_state_norm)
        WHERE r <= 3
        """,
        "people",
        "after1",
    ),
)
def match_business(spark, d):
    rows, _, after1, _ = cascade(spark, d)
    return pair_rows(linkage.match_business(linkage.businesses(rows), after1, CONFIG))


@query(
    "name_similarity",
    sql(
        f"SELECT npi, round({indel_sql('last_name', 'first_name')}, 6) AS ratio FROM who",
        "who",
    ),
)
def name_similarity(spark, d):
    """Insert/delete similarity of the two names of every provider."""
    who = testbed.providers(spark, d)
    return who.select("npi", F.round(ratio_score("last_name", "first_name"), 6).alias("ratio"))


# the definition for names of any number of tokens: shared tokens first, remainders after
SHARED = "split_part(p_name, ' ', 1 + p_size % 2) || ' ' || lower(p_type)"


def token_set_sql(other: str) -> str:
    return f"""
SELECT p_name, p_type, round(CASE
    WHEN len(s) > 0 AND (len(a) = 0 OR len(b) = 0) THEN 100.0
    ELSE greatest(100 * (1 - (la + lb - 2 * lcs) / (2 * (ls + gap) + la + lb)),
        CASE WHEN gap = 1 THEN 100 * (1 - (1 + la) / (2 * ls + 1 + la)) ELSE 0 END,
        CASE WHEN gap = 1 THEN 100 * (1 - (1 + lb) / (2 * ls + 1 + lb)) ELSE 0 END) END, 6) AS score
FROM (
    SELECT *, len(s) AS ls, len(a)::DOUBLE AS la, len(b)::DOUBLE AS lb, CASE WHEN s <> '' THEN 1 ELSE 0 END AS gap,
           CASE WHEN a = '' OR b = '' THEN 0 ELSE {indel_sql('a', 'b')} * (len(a) + len(b)) / 200 END AS lcs
    FROM (
        SELECT p_name, p_type,
               array_to_string(list_sort(list_filter(x, lambda t: list_contains(y, t))), ' ') AS s,
               array_to_string(list_sort(list_filter(x, lambda t: NOT list_contains(y, t))), ' ') AS a,
               array_to_string(list_sort(list_filter(y, lambda t: NOT list_contains(x, t))), ' ') AS b
        FROM (SELECT p_name, p_type, list_distinct(string_split(p_name, ' ')) AS x, list_distinct(string_split(other, ' ')) AS y
              FROM (SELECT DISTINCT p_name, p_type, {other} AS other FROM part))))
"""


@query("token_set_similarity", token_set_sql("lower(p_type)"))
def token_set_similarity(spark, d):
    parts = testbed.table(spark, d, "part").select("p_name", "p_type").distinct()
    return parts.select("p_name", "p_type", F.round(token_set_score("p_name", F.lower("p_type")), 6).alias("score"))


@query("token_set_shared", token_set_sql(SHARED))
def token_set_shared(spark, d):
    """Names of two tokens against names that share one of them."""
    part = testbed.table(spark, d, "part")
    shared = F.split_part("p_name", F.lit(" "), 1 + F.col("p_size") % 2)
    parts = part.select("p_name", "p_type", F.concat_ws(" ", shared, F.lower("p_type")).alias("other")).distinct()
    return parts.select("p_name", "p_type", F.round(token_set_score("p_name", "other"), 6).alias("score"))


CANDIDATE_SQL = (
    "SELECT npi, leie_row_key, match_tier, leie_row_n_candidates, provider_n_leie_rows, keep_for_training"
    " FROM candidates"
)


@query("candidate_ambiguity", sql(CANDIDATE_SQL, "candidates"))
def candidate_ambiguity(spark, d):
    rows = linkage.resolve_conflicts(linkage.run_match(listed(spark, d), names(spark, d), CONFIG))
    return rows.select(
        "npi", "leie_row_key", "match_tier", "leie_row_n_candidates", "provider_n_leie_rows",
        "keep_for_training",
    )


LABEL_SQL = """
    SELECT npi, TRUE AS is_excluded, match_tier, round(similarity_score, 6) AS similarity_score,
           leie_excldate AS exclusion_date, strptime(leie_excldate, '%Y%m%d')::DATE AS exclusion_date_parsed,
           leie_excltype AS exclusion_type, leie_last_norm, leie_first_norm, leie_state_norm AS leie_state,
           leie_specialty, mart_specialty, leie_row_n_candidates, provider_n_leie_rows
    FROM final_labels
"""


def rounded_labels(df):
    return df.withColumn("similarity_score", F.round("similarity_score", 6))


@query("final_labels", sql(LABEL_SQL, "final_labels"))
def final_labels(spark, d):
    return rounded_labels(linkage.link_labels(listed(spark, d), names(spark, d), CONFIG))


@query("final_labels_from_candidates", sql(LABEL_SQL, "final_labels"))
def final_labels_from_candidates(spark, d):
    return rounded_labels(
        linkage.final_labels(linkage.run_match(listed(spark, d), names(spark, d), CONFIG))
    )


@query(
    "match_summary",
    sql(
        "SELECT match_tier, count(*) AS candidates, count(*) FILTER (WHERE keep_for_training) AS kept,"
        " count(*) FILTER (WHERE NOT keep_for_training) AS dropped FROM candidates GROUP BY match_tier",
        "candidates",
    ),
)
def match_summary(spark, d):
    return linkage.summarize_counts(linkage.count_candidates(listed(spark, d), names(spark, d), CONFIG))


@query(
    "row_ambiguity",
    sql("SELECT leie_row_key, count(*) AS leie_row_n_candidates FROM matches GROUP BY leie_row_key", "matches"),
)
def row_ambiguity(spark, d):
    return linkage.row_ambiguity(linkage.count_candidates(listed(spark, d), names(spark, d), CONFIG))


@query(
    "provider_ambiguity",
    sql("SELECT npi, count(DISTINCT leie_row_key) AS provider_n_leie_rows FROM matches GROUP BY npi", "matches"),
)
def provider_ambiguity(spark, d):
    return linkage.provider_ambiguity(linkage.count_candidates(listed(spark, d), names(spark, d), CONFIG))


@query(
    "label_summary",
    sql(
        "SELECT match_tier, count(*) AS labels, count(*) FILTER (WHERE provider_n_leie_rows > 1)"
        " AS multi_exclusion FROM final_labels GROUP BY match_tier",
        "final_labels",
    ),
)
def label_summary(spark, d):
    return linkage.label_summary(linkage.link_labels(listed(spark, d), names(spark, d), CONFIG))


block(
    "audited",
    ["candidates"],
    """
    SELECT *, match_tier = 3 AND last_score < 90 AND first_score < 90 AS both_low,
           match_tier = 3 AND len(leie_last_norm) <= 3 AS last_too_short
    FROM candidates WHERE keep_for_training
    """,
)


def kept(spark, d):
    matches = linkage.resolve_conflicts(linkage.run_match(listed(spark, d), names(spark, d), CONFIG))
    return audit.flag_candidates(matches.where("keep_for_training"))


@query(
    "audit_flags",
    sql(
        "SELECT npi, leie_row_key, FALSE AS cross_gender, coalesce(both_low, FALSE) AS both_low,"
        " FALSE AS common_last, last_too_short,"
        " coalesce(both_low, FALSE) OR last_too_short AS any_flag FROM audited",
        "audited",
    ),
)
def audit_flags(spark, d):
    return kept(spark, d).select("npi", "leie_row_key", *audit.FLAGS, "any_flag")


DECISION = (
    f"CASE WHEN match_tier IN (3, 4) AND rate > {audit.TOLERANCE} THEN"
    f" printf('{audit.DOUBTFUL.replace('%2$.1f', '%s').replace('%1$d', '%d')}', printf('%.1f', rate * 100), match_tier) END"
)


@query(
    "audit_report",
    sql(
        f"""
        SELECT match_tier, n, n_flagged, rate AS estimated_fp_rate,
               {DECISION} AS decision
        FROM (SELECT match_tier, count(*) AS n,
                     count(*) FILTER (WHERE coalesce(both_low, FALSE) OR last_too_short) AS n_flagged,
                     round(count(*) FILTER (WHERE coalesce(both_low, FALSE) OR last_too_short) / count(*), 4) AS rate
              FROM audited GROUP BY ROLLUP (match_tier))
        """,
        "audited",
    ),
)
def audit_report(spark, d):
    return audit.audit_report_by_counts(linkage.count_candidates(listed(spark, d), names(spark, d), CONFIG))


@query(
    "audit_decisions",
    sql(
        f"""
        SELECT unnest(CASE WHEN len(d) > 0 THEN d ELSE ['{audit.ALL_CLEAR}'] END) AS decision
        FROM (SELECT coalesce(list(decision) FILTER (WHERE decision IS NOT NULL), []) AS d FROM (
            SELECT {DECISION} AS decision
            FROM (SELECT match_tier, round(count(*) FILTER (WHERE coalesce(both_low, FALSE) OR last_too_short) / count(*), 4) AS rate
                  FROM audited GROUP BY match_tier)))
        """,
        "audited",
    ),
)
def audit_decisions(spark, d):
    return audit.audit_decisions(audit_report(spark, d))


_SIZE = "CASE match_tier " + " ".join(f"WHEN {t} THEN {n}" for t, n in audit.SAMPLE_SIZES.items()) + " ELSE 0 END"
_SAMPLE = [c if not c.endswith("_score") else f"round({c}, 6) AS {c}" for c in audit.AUDIT_COLUMNS]

block(
    "flagged",
    ["audited"],
    """
    SELECT * EXCLUDE (both_low), coalesce(both_low, FALSE) AS both_low, FALSE AS cross_gender, FALSE AS common_last,
           coalesce(both_low, FALSE) OR last_too_short AS any_flag
    FROM audited
    """,
)


@query(
    "audit_sample",
    sql(
        f"""
        SELECT {', '.join(_SAMPLE)} FROM (
            SELECT *, row_number() OVER (PARTITION BY match_tier, any_flag ORDER BY {seeded(7, 'npi', 'leie_row_key')}, npi,
                          leie_row_key, leie_excltype, leie_specialty) AS r, {_SIZE} AS size,
                   least(count(*) FILTER (WHERE any_flag) OVER (PARTITION BY match_tier), {_SIZE} // 2) AS taken
            FROM flagged)
        WHERE r <= CASE WHEN any_flag THEN taken ELSE size - taken END
        """,
        "flagged",
    ),
)
def audit_sample(spark, d):
    rows = audit.audit_sample(kept(spark, d))
    return rows.select(*[F.round(c, 6).alias(c) if c.endswith("_score") else c for c in rows.columns])


@query(
    "stage_labels",
    sql(
        "SELECT npi, TRUE AS is_excluded, match_tier, round(similarity_score, 6) AS similarity_score,"
        " leie_excltype AS exclusion_type, strptime(leie_excldate, '%Y%m%d')::DATE AS exclusion_date,"
        " TRUE AS is_currently_excluded, leie_specialty, leie_row_n_candidates, provider_n_leie_rows"
        " FROM final_labels",
        "final_labels",
    ),
)
def stage_labels(spark, d):
    linked = linkage.link_labels(listed(spark, d), names(spark, d), CONFIG)
    return rounded_labels(staging.stage_labels(linked))
