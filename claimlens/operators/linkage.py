"""Links exclusion-list rows to providers in tiers and settles one label each.

Tier 1 matches the provider id, tier 2 the exact name and state, tier 3 similar
names within a state, tier 4 (off by default) business names. A provider matched
by one tier takes no part in the later ones.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checkpoints import materialize
from ..functions.columns import normalize_name, normalize_state, unordered_pair_in
from ..functions.similarity import may_reach, part_order, ratio_score, similarity_keys, token_set_score
from ..schemas import CROSS_GENDER_PAIRS, MATCH_STATES, NON_BILLING_SPECIALTIES, SENTINEL_NPI

NAME = ["leie_state_norm", "leie_last_norm", "leie_first_norm"]
PROVIDER_NAME = ["mart_state_norm", "mart_last_norm", "mart_first_norm"]


@dataclass(frozen=True)
class MatchConfig:
    fuzzy_threshold_t3: float = 92
    fuzzy_threshold_t3_last: float = 88
    fuzzy_threshold_t3_first: float = 85
    fuzzy_threshold_t4: float = 90
    states: tuple[str, ...] = MATCH_STATES
    business_tier: bool = False


def load_exclusions(raw: DataFrame, states=MATCH_STATES) -> DataFrame:
    """List rows of the given states with normalised names."""
    return raw.where(F.col("STATE").isin(list(states))).select(
        F.col("LASTNAME").alias("leie_last"),
        F.col("FIRSTNAME").alias("leie_first"),
        F.col("MIDNAME").alias("leie_mid"),
        F.col("BUSNAME").alias("leie_busname"),
        F.col("SPECIALTY").alias("leie_specialty"),
        F.col("GENERAL").alias("leie_general"),
        F.col("NPI").alias("leie_npi"),
        F.col("STATE").alias("leie_state"),
        F.col("EXCLTYPE").alias("leie_excltype"),
        F.col("EXCLDATE").alias("leie_excldate"),
        normalize_name("LASTNAME").alias("leie_last_norm"),
        normalize_name("FIRSTNAME").alias("leie_first_norm"),
        normalize_name("BUSNAME").alias("leie_busname_norm"),
        normalize_state("STATE").alias("leie_state_norm"),
    )


def load_providers(summary: DataFrame) -> DataFrame:
    """Provider names from the claims summary, which precedes any label."""
    return summary.select(
        F.col("npi").cast("string").alias("npi"),
        F.col("provider_last_name").alias("mart_last"),
        F.col("provider_first_name").alias("mart_first"),
        F.coalesce("provider_type", F.lit("Unknown")).alias("mart_specialty"),
        F.col("provider_state").alias("mart_state"),
        F.col("entity_type").alias("mart_entity_type"),
        normalize_name("provider_last_name").alias("mart_last_norm"),
        normalize_name("provider_first_name").alias("mart_first_norm"),
        normalize_state("provider_state").alias("mart_state_norm"),
    )


def filled(*columns: str) -> Column:
    test = F.col(columns[0]) != ""
    for c in columns[1:]:
        test = test & (F.col(c) != "")
    return test


def row_key() -> Column:
    parts = ["leie_last_norm", "leie_first_norm", "leie_busname_norm", "leie_state_norm", "leie_excldate"]
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in parts])


def bills_individually() -> Column:
    specialty = F.upper(F.trim("leie_specialty"))
    return ~F.coalesce(specialty.isin(NON_BILLING_SPECIALTIES), F.lit(False))


def individuals(listed: DataFrame) -> DataFrame:
    return listed.where(filled("leie_last_norm", "leie_first_norm") & bills_individually())


def businesses(listed: DataFrame) -> DataFrame:
    return listed.where(filled("leie_busname_norm") & bills_individually())


def with_valid_npi(listed: DataFrame) -> DataFrame:
    ok = F.col("leie_npi").isNotNull() & (F.col("leie_npi") != SENTINEL_NPI) & (F.trim("leie_npi") != "")
    return listed.where(ok).withColumn("leie_npi", F.trim("leie_npi"))


def match_npi(listed: DataFrame, providers: DataFrame) -> DataFrame:
    """Tier 1 candidate rows."""
    return (
        with_valid_npi(listed)
        .join(providers, F.col("leie_npi") == F.col("npi"))
        .withColumns({"match_tier": F.lit(1), "similarity_score": F.lit(100.0)})
    )


def same_name() -> Column:
    test = F.lit(True)
    for a, b in zip(NAME, PROVIDER_NAME):
        test = test & (F.col(a) == F.col(b))
    return test


# candidate rows, of some 260 bytes in a sort, that one task should form
TASK_PAIRS = 500_000
# tasks over which the providers of one name are dealt at most; list rows are copied as often
MOST_SLICES = 16


def pair_counts(listed: DataFrame, providers: DataFrame) -> tuple[int, int]:
    """How many rows ``match_exact_name`` gives, and how many for its largest name."""
    rows = listed.where(filled(*NAME)).groupBy(*NAME).agg(F.count(F.lit(1)).alias("__rows"))
    people = providers.where(filled(*PROVIDER_NAME)).groupBy(*PROVIDER_NAME).agg(F.count(F.lit(1)).alias("__people"))
    n = F.col("__rows") * F.col("__people")
    found = rows.join(people, same_name()).agg(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(0))).first()
    return found[0], found[1]


def match_exact_name(listed: DataFrame, providers: DataFrame) -> DataFrame:
    """Tier 2 candidate rows: every list row with every provider of its name.

    Their number grows with the square of a name's rows, so it is counted first and decides
    the number of tasks; the providers of large names are dealt over several tasks, each
    with all list rows of the name.
    """
    rows, people = listed.where(filled(*NAME)), providers.where(filled(*PROVIDER_NAME))
    pairs, largest = pair_counts(listed, providers)
    same = same_name()
    if pairs > TASK_PAIRS:
        tasks = max(-(-pairs // TASK_PAIRS), int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        # four parts of names a task, so that hashing deals them evenly
        slices = max(1, min(MOST_SLICES, -(-4 * largest // TASK_PAIRS)))
        rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).repartition(tasks, *NAME, "__copy")
        people = people.withColumn("__slice", F.pmod(F.xxhash64("npi"), F.lit(slices)).cast("int"))
        people = people.repartition(tasks, *PROVIDER_NAME, "__slice")
        same = same & (F.col("__copy") == F.col("__slice"))
    return (
        rows.join(people, same)
        .drop("__copy", "__slice")
        .withColumns({"match_tier": F.lit(2), "similarity_score": F.lit(100.0)})
    )


def unmatched_by_npi(listed: DataFrame, providers: DataFrame) -> DataFrame:
    ids = with_valid_npi(listed).select(F.col("leie_npi").alias("npi"))
    return providers.join(ids, "npi", "left_anti")


def unmatched_by_name(listed: DataFrame, providers: DataFrame) -> DataFrame:
    """Anti-join on the name itself: no candidate pair is formed."""
    return providers.join(listed.where(filled(*NAME)).select(*NAME), same_name(), "left_anti")


def similar_names(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, threshold: float
) -> DataFrame:
    """Distinct (state, left name, right name, score) at or above the threshold.

    Both inputs hold distinct (state, name) rows. Names meet on similarity keys,
    which only similar names share, never on the whole state; a name sends a few
    dozen at most, its rarest parts first. Lengths and ranks of a shared gram drop
    most other meetings before the pairs are folded and scored.
    """
    left, right = materialize(left), materialize(right)
    order = part_order(F.col("name"), left.select(F.col(left_name).alias("name")), right.select(F.col(right_name).alias("name")))

    def keyed(df: DataFrame, name: str, listed: bool) -> DataFrame:
        key = F.explode(similarity_keys(F.col(name), threshold, listed, order))
        return df.select("state", name, key.alias("key")).select(
            "state", name, F.xxhash64("state", "key.k").alias("k"), F.struct("key.q", "key.length", "key.rank", "key.grams").alias("at")
        )

    one = keyed(left, left_name, True).withColumnRenamed("at", "one")
    two = keyed(right, right_name, False).withColumnRenamed("at", "two")
    pairs = one.join(two, ["state", "k"]).where(may_reach("one", "two", threshold)).select("state", left_name, right_name).distinct()
    return pairs.withColumn("similarity_score", token_set_score(left_name, right_name)).where(
        F.col("similarity_score") >= threshold
    )


def best_providers(
    matched: DataFrame, providers: DataFrame, name_keys: list[str], left_name: str, k: int
) -> DataFrame:
    """The k best providers per left name by (score, provider id).

    A name shared by many providers contributes its k lowest ids, which is all
    that can reach the top k; the rank limit is applied before the shuffle.
    """
    lowest = W.partitionBy("state", *name_keys).orderBy("npi")
    members = (
        providers.withColumn("r", F.row_number().over(lowest)).where(F.col("r") <= k).drop("r")
    )
    rank = W.partitionBy("state", left_name).orderBy(F.desc("similarity_score"), "npi")
    return (
        matched.join(members, ["state", *name_keys])
        .withColumn("r", F.row_number().over(rank))
        .where(F.col("r") <= k)
        .drop("r")
    )


def fuzzy_name_pairs(
    listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Tier 3 at the grain (list name, provider) with the provider's first name and three scores.

    The five best providers per list name are taken on the whole-name score
    before the component floors, the gender pairs and the initial are tested.
    """
    prov = providers.where(
        filled(*PROVIDER_NAME) & (F.col("mart_last_norm") != F.col("mart_first_norm"))
    ).select(
        "npi",
        F.col("mart_state_norm").alias("state"),
        "mart_last_norm",
        "mart_first_norm",
        F.concat_ws(" ", "mart_last_norm", "mart_first_norm").alias("full"),
    )
    names = prov.select("state", "mart_last_norm", "mart_first_norm", "full").distinct()
    targets = (
        listed.where(filled(*NAME))
        .select(
            F.col("leie_state_norm").alias("state"),
            "leie_last_norm",
            "leie_first_norm",
            F.concat_ws(" ", "leie_last_norm", "leie_first_norm").alias("target"),
        )
        .distinct()
    )
    fulls = names.select("state", "full").distinct()
    open_targets = targets.join(
        fulls.withColumnRenamed("full", "target"), ["state", "target"], "left_anti"
    )
    matched = similar_names(
        open_targets.select("state", "target").distinct(), fulls, "target", "full",
        config.fuzzy_threshold_t3,
    )
    best = best_providers(
        matched.join(names, ["state", "full"]),
        prov.drop("full"),
        ["mart_last_norm", "mart_first_norm"],
        "target",
        5,
    )
    scored = (
        best.join(open_targets, ["state", "target"])
        .withColumn("last_score", ratio_score("leie_last_norm", "mart_last_norm"))
        .withColumn("first_score", ratio_score("leie_first_norm", "mart_first_norm"))
    )
    same_initial = F.substring("leie_first_norm", 1, 1) == F.substring("mart_first_norm", 1, 1)
    return scored.where(
        (F.col("last_score") >= config.fuzzy_threshold_t3_last)
        & (F.col("first_score") >= config.fuzzy_threshold_t3_first)
        & ~unordered_pair_in("leie_first_norm", "mart_first_norm", CROSS_GENDER_PAIRS)
        & same_initial
    ).select(
        F.col("state").alias("leie_state_norm"),
        "leie_last_norm",
        "leie_first_norm",
        "npi",
        "mart_first_norm",
        "similarity_score",
        "last_score",
        "first_score",
    )


def match_fuzzy_name(
    listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Tier 3 candidate rows."""
    return fuzzy_rows(listed, providers, fuzzy_name_pairs(listed, providers, config))


def fuzzy_rows(listed: DataFrame, providers: DataFrame, pairs: DataFrame) -> DataFrame:
    return (
        listed.join(pairs.drop("mart_first_norm"), NAME)
        .join(providers, "npi")
        .withColumn("match_tier", F.lit(3))
    )


BUSINESS = ["leie_state_norm", "leie_busname_norm"]


def business_pairs(listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Tier 4 at the grain (business name, provider): three best organisations each."""
    orgs = providers.where((F.col("mart_entity_type") == "O") & filled("mart_last_norm")).select(
        "npi", F.col("mart_state_norm").alias("state"), F.col("mart_last_norm").alias("org")
    )
    names = orgs.select("state", "org").distinct()
    targets = listed.select(
        F.col("leie_state_norm").alias("state"), F.col("leie_busname_norm").alias("target")
    ).distinct()
    matched = similar_names(targets, names, "target", "org", config.fuzzy_threshold_t4)
    return best_providers(matched, orgs, ["org"], "target", 3).select(
        F.col("state").alias("leie_state_norm"),
        F.col("target").alias("leie_busname_norm"),
        "npi",
        "similarity_score",
    )


def match_business(
    listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Tier 4 candidate rows."""
    return business_rows(listed, providers, business_pairs(listed, providers, config))


def business_rows(listed: DataFrame, providers: DataFrame, pairs: DataFrame) -> DataFrame:
    return (
        listed.join(pairs, BUSINESS)
        .join(providers, "npi")
        .withColumn("match_tier", F.lit(4))
    )


def run_match(listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """All candidate rows of the tier cascade with their ambiguity counts.

    The counts are known before a pair is formed and travel with the two sides, so the
    candidate rows, which grow with the square of a name's rows, are not exchanged. The
    two inputs are stored first because every tier reads them again.
    """
    listed, providers = materialize(listed), materialize(providers)
    counts = count_candidates(listed, providers, config)
    rows = materialize(listed.withColumn("leie_row_key", row_key()).join(row_ambiguity(counts), "leie_row_key"))
    known = materialize(providers.join(provider_ambiguity(counts), "npi"))
    parts = [
        match_npi(rows, known),
        match_exact_name(individuals(rows), unmatched_by_npi(listed, known)),
        fuzzy_rows(individuals(rows), known, counts.fuzzy),
    ]
    if counts.business is not None:
        parts.append(business_rows(businesses(rows), known, counts.business))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def keep_for_training(tier="match_tier", candidates="leie_row_n_candidates") -> Column:
    """Fuzzy rows that point at too many providers are not kept."""
    t, n = F.col(tier), F.col(candidates)
    return ~(((t == 3) & (n > 3)) | ((t == 4) & (n > 2)))


def resolve_conflicts(matches: DataFrame) -> DataFrame:
    return matches.withColumn("keep_for_training", keep_for_training())


LABEL_FIELDS = [
    "match_tier",
    "similarity_score",
    "leie_excldate",
    "leie_excltype",
    "leie_last_norm",
    "leie_first_norm",
    "leie_busname_norm",
    "leie_state_norm",
    "leie_specialty",
    "leie_row_n_candidates",
]


def earliest(*extra: str) -> Column:
    """Aggregate: the entry with the earliest readable date, NULL dates last;
    then the lower tier, then the row's own text so that ties are stable."""
    date = F.col("leie_excldate").try_cast("long")
    order = F.struct(
        date.isNull().alias("undated"),
        date.alias("date"),
        F.col("match_tier").alias("tier"),
        row_key().alias("key"),
        F.coalesce("leie_excltype", F.lit("")).alias("type"),
        F.coalesce("leie_specialty", F.lit("")).alias("specialty"),
    )
    return F.min_by(F.struct(*LABEL_FIELDS, *extra), order)


def label_columns(rows: DataFrame) -> DataFrame:
    """The stable label schema."""
    return rows.select(
        F.col("npi").cast("string").alias("npi"),
        F.lit(True).alias("is_excluded"),
        F.col("b.match_tier").cast("int").alias("match_tier"),
        F.col("b.similarity_score").cast("double").alias("similarity_score"),
        F.col("b.leie_excldate").alias("exclusion_date"),
        F.try_to_date("b.leie_excldate", "yyyyMMdd").alias("exclusion_date_parsed"),
        F.col("b.leie_excltype").alias("exclusion_type"),
        F.col("b.leie_last_norm").alias("leie_last_norm"),
        F.col("b.leie_first_norm").alias("leie_first_norm"),
        F.col("b.leie_state_norm").alias("leie_state"),
        F.col("b.leie_specialty").alias("leie_specialty"),
        "mart_specialty",
        F.col("b.leie_row_n_candidates").cast("long").alias("leie_row_n_candidates"),
        F.col("provider_n_leie_rows").cast("long").alias("provider_n_leie_rows"),
    )


def final_labels(matches: DataFrame) -> DataFrame:
    """One label per provider from candidate rows."""
    kept = resolve_conflicts(matches).where("keep_for_training")
    return label_columns(
        kept.groupBy("npi").agg(
            earliest().alias("b"),
            F.first("mart_specialty").alias("mart_specialty"),
            F.max("provider_n_leie_rows").alias("provider_n_leie_rows"),
        )
    )


@dataclass
class CandidateCounts:
    """Candidates of every tier by counts: rows are never paired with providers.

    ``entries`` are the list rows with their candidates per tier (n1 to n4) and per row
    key; ``fuzzy`` and ``business`` pair names with providers, a few per name; a
    provider in ``after1`` is open to tier 2 and the later ones.
    """

    entries: DataFrame
    fuzzy: DataFrame
    business: DataFrame | None
    providers: DataFrame
    after1: DataFrame


def provider_names(providers: DataFrame) -> DataFrame:
    renamed = {p: n for p, n in zip(PROVIDER_NAME, NAME)}
    return providers.where(filled(*PROVIDER_NAME)).withColumnsRenamed(renamed)


def count_candidates(
    listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()
) -> CandidateCounts:
    """The tier cascade on distinct ids and names.

    A name carried by many list rows and many providers is settled by counting:
    providers fold to a count per id and per name, and list rows look these up.
    """
    listed = materialize(listed.withColumn("leie_row_key", row_key()))
    providers = materialize(providers)
    person = filled(*NAME) & bills_individually()
    people = listed.where(person)
    after1 = unmatched_by_npi(listed, providers)
    after2 = unmatched_by_name(people, after1)
    fuzzy = materialize(fuzzy_name_pairs(people, after2, config))
    by_id = providers.groupBy(F.col("npi").alias("leie_npi")).agg(F.count(F.lit(1)).alias("n1"))
    by_name = provider_names(after1).groupBy(*NAME).agg(F.count(F.lit(1)).alias("n2"))
    by_fuzzy = fuzzy.groupBy(*NAME).agg(F.count(F.lit(1)).alias("n3"))
    valid = F.col("leie_npi") != SENTINEL_NPI
    counted = (
        listed.withColumn("leie_npi", F.trim("leie_npi"))
        .join(by_id, "leie_npi", "left")
        .join(by_name, NAME, "left")
        .join(by_fuzzy, NAME, "left")
    )
    business = None
    if config.business_tier:
        after3 = after2.join(fuzzy.select("npi"), "npi", "left_anti")
        business = materialize(business_pairs(businesses(listed), after3, config))
        by_business = business.groupBy(*BUSINESS).agg(F.count(F.lit(1)).alias("n4"))
        counted = counted.join(by_business, BUSINESS, "left")
    else:
        counted = counted.withColumn("n4", F.lit(None).cast("long"))
    tests = {"n1": valid, "n2": person, "n3": person, "n4": filled("leie_busname_norm") & bills_individually()}
    counted = counted.withColumns({n: F.coalesce(F.when(test, F.col(n)), F.lit(0)) for n, test in tests.items()})
    total = sum((F.col(n) for n in list(tests)[1:]), F.col("n1"))
    per_key = counted.groupBy("leie_row_key").agg(F.sum(total).alias("leie_row_n_candidates"))
    entries = materialize(counted.where(total > 0).join(per_key, "leie_row_key"))
    return CandidateCounts(entries, fuzzy, business, providers, after1)


def row_ambiguity(counts: CandidateCounts) -> DataFrame:
    """Candidates per list row key."""
    return counts.entries.groupBy("leie_row_key").agg(F.max("leie_row_n_candidates").alias("leie_row_n_candidates"))


def provider_ambiguity(counts: CandidateCounts) -> DataFrame:
    """Distinct list row keys per candidate provider.

    Keys are counted per id and per name and handed to the providers of that id or
    name. A provider of tier 3 or 4 may have several names and its keys are told apart
    by name, so the counts of its names add up.
    """
    rows, columns = counts.entries, ["npi", "provider_n_leie_rows"]

    def keys(n: str, by: list[str]) -> DataFrame:
        return rows.where(F.col(n) > 0).groupBy(*by).agg(F.count_distinct("leie_row_key").alias("provider_n_leie_rows"))

    out = keys("n1", ["leie_npi"]).withColumnRenamed("leie_npi", "npi").select(*columns)
    out = out.unionByName(provider_names(counts.after1).join(keys("n2", NAME), NAME).select(*columns))
    out = out.unionByName(counts.fuzzy.select("npi", *NAME).distinct().join(keys("n3", NAME), NAME).select(*columns))
    if counts.business is not None:
        out = out.unionByName(counts.business.select("npi", *BUSINESS).distinct().join(keys("n4", BUSINESS), BUSINESS).select(*columns))
    return out.groupBy("npi").agg(F.sum("provider_n_leie_rows").alias("provider_n_leie_rows"))


def summarize_counts(counts: CandidateCounts) -> DataFrame:
    """The same as ``match_summary(run_match(...))``, from counts."""
    return (
        counts.entries.select(F.explode(tier_entries()).alias("t"), "leie_row_n_candidates")
        .select(F.col("t.tier").alias("match_tier"), "t.n", "leie_row_n_candidates")
        .withColumn("kept", F.when(keep_for_training(), F.col("n")).otherwise(F.lit(0)))
        .groupBy("match_tier")
        .agg(F.sum("n").alias("candidates"), F.sum("kept").alias("kept"), F.sum(F.col("n") - F.col("kept")).alias("dropped"))
    )


def tier_entries() -> Column:
    """The tiers in which a list row has candidates, with their number."""
    tiers = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(f"n{t}").cast("long").alias("n")) for t in (1, 2, 3, 4)])
    return F.filter(tiers, lambda t: t.n > 0)


def link_labels(
    listed: DataFrame, providers: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Same result as ``final_labels(run_match(...))`` for tiers 1 to 3, without
    forming the candidate pairs of tier 2: list rows fold to their best entry per
    name, providers to a count per name.
    """
    counts = count_candidates(listed, providers, replace(config, business_tier=False))
    entries, fuzzy, providers, after1 = counts.entries, counts.fuzzy, counts.providers, counts.after1

    def best(df: DataFrame, keys: list[str]) -> DataFrame:
        distinct_keys = (
            df.select(*keys, "leie_row_key")
            .distinct()
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("provider_n_leie_rows"))
        )
        return df.groupBy(*keys).agg(earliest().alias("b")).join(distinct_keys, keys)

    def tier(df: DataFrame, n: int) -> DataFrame:
        return df.withColumns({"match_tier": F.lit(n), "similarity_score": F.lit(100.0)})

    t1 = best(tier(entries.where(F.col("n1") > 0), 1).withColumn("npi", F.col("leie_npi")), ["npi"])
    t1 = t1.join(providers.select("npi", "mart_specialty"), "npi")
    t2 = best(tier(entries.where(F.col("n2") > 0), 2), NAME).join(
        provider_names(after1).select("npi", "mart_specialty", *NAME), NAME
    )
    t3_rows = (
        entries.where(F.col("n3") > 0)
        .join(fuzzy.select(*NAME, "npi", "similarity_score"), NAME)
        .withColumn("match_tier", F.lit(3))
    )
    t3_keys = t3_rows.select("npi", "leie_row_key").distinct().groupBy("npi").agg(
        F.count(F.lit(1)).alias("provider_n_leie_rows")
    )
    t3 = (
        t3_rows.where(keep_for_training())
        .groupBy("npi")
        .agg(earliest().alias("b"))
        .join(t3_keys, "npi")
        .join(providers.select("npi", "mart_specialty"), "npi")
    )
    columns = ["npi", "b", "mart_specialty", "provider_n_leie_rows"]
    return label_columns(t1.select(columns).unionByName(t2.select(columns)).unionByName(t3.select(columns)))


def match_summary(matches: DataFrame) -> DataFrame:
    """Candidates, kept rows and providers per tier."""
    return resolve_conflicts(matches).groupBy("match_tier").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("keep_for_training").alias("kept"),
        F.count_if(~F.col("keep_for_training")).alias("dropped"),
    )


def label_summary(labels: DataFrame) -> DataFrame:
    """Final labels per tier and how many collapsed several list rows."""
    return labels.groupBy("match_tier").agg(
        F.count(F.lit(1)).alias("labels"),
        F.count_if(F.col("provider_n_leie_rows") > 1).alias("multi_exclusion"),
    )
