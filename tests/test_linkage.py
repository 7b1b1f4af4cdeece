import random

import pytest
from pyspark.sql import functions as F

from claimlens.functions.columns import normalize_name, normalize_state
from claimlens.functions.similarity import name_keys, ratio, token_set_ratio
from claimlens.operators import audit, linkage
from claimlens.schemas import EXCLUSION_SCHEMA


def exclusions(spark, rows):
    full = [{c: r.get(c) for c in EXCLUSION_SCHEMA.fieldNames()} for r in rows]
    raw = spark.createDataFrame([tuple(r.values()) for r in full], EXCLUSION_SCHEMA)
    return linkage.load_exclusions(raw)


def providers(spark, rows):
    df = spark.createDataFrame(
        rows, "npi string, provider_last_name string, provider_first_name string, provider_state string"
    )
    return linkage.load_providers(df.withColumns({"provider_type": F.lit("Cardiology"), "entity_type": F.lit("I")}))


@pytest.mark.parametrize(
    "name,expected",
    [
        ("  de  la   Cruz III ", "DE LA CRUZ"),
        ("o'brien-lee jr md", "O'BRIEN-LEE"),
        ("JR", ""),
        ("Muñoz, PhD", "MUÑOZ"),
        (None, ""),
        ("V", ""),
        ("SMITH.JONES", "SMITH JONES"),
    ],
)
def test_normalize_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(normalize_name("n")).first()[0] == expected


def test_normalize_state(spark):
    df = spark.createDataFrame([(" texas",), (None,)], "s string")
    assert [r[0] for r in df.select(normalize_state("s")).collect()] == ["TE", ""]


def test_ratio_counts_insertions_and_deletions():
    assert ratio("RICHARD", "RICARDO") == pytest.approx(85.714, abs=1e-3)
    assert ratio("ABC", "ABC") == 100 and ratio("A", "B") == 0


def test_token_set_ratio():
    assert token_set_ratio("SMITH JOHN", "JOHN SMITH") == 100
    assert token_set_ratio("SMITH JOHN", "SMITH JOHN A") == 100
    assert token_set_ratio("SMITH JOHN", "SMITH JON") == pytest.approx(100 * (1 - 1 / 19))


@pytest.mark.parametrize("threshold", [90, 92])
def test_similar_names_always_share_a_key(threshold):
    random.seed(threshold)
    words = ["SMITH", "SMYTH", "LEE", "CHRISTOPHER", "ANN", "DE", "LA", "CRUZ", "VAN", "BERG", "J", "RODRIGUEZ"]
    names = set()
    while len(names) < 220:
        s = list(" ".join(random.choices(words, k=random.choice([1, 2, 2, 2, 3, 7]))))
        for _ in range(random.choice([0, 1, 1, 2])):
            s.insert(random.randrange(len(s)), random.choice("ABZ "))
        names.add(" ".join("".join(s).split()))
    names = sorted(names)
    listed = {n: set(name_keys(n, threshold, True)) for n in names[::2]}
    other = {n: set(name_keys(n, threshold, False)) for n in names[1::2] + names[::2][:30]}
    hits = 0
    for a, ka in listed.items():
        for b, kb in other.items():
            if token_set_ratio(a, b) >= threshold:
                hits += 1
                assert ka & kb, (a, b)
    assert hits > 30


LONG_NAMES = [
    "SMITH JONATHAN",
    "DE LA CRUZ RODRIGUEZ MARIA FERNANDA",
    "A B C D E F G H",
    "UNIVERSITY HOSPITAL AND MEDICAL CENTER OF THE NORTHERN RIVER VALLEY ASSOCIATES INC",
    "INTERNATIONAL ASSOCIATION OF CARDIOVASCULAR SPECIALISTS",
    "X",
]


@pytest.mark.parametrize("threshold", [90, 92])
def test_a_name_sends_a_few_dozen_keys(threshold):
    for name in LONG_NAMES:
        for listed in (True, False):
            keys = name_keys(name, threshold, listed)
            assert 0 < len(keys) <= 100, (name, len(keys))
            assert len(name) > 40 or len(keys) <= 60
    with pytest.raises(ValueError, match="similarity"):
        name_keys("SMITH JOHN", 60, True)


def test_rarest_parts_and_ranks_lose_no_pair(spark):
    rng = random.Random(11)
    words = ["SMITH", "SMYTH", "LEE", "CHRISTOPHER", "ANN", "DE", "LA", "CRUZ", "VAN", "BERG", "J", "HOSPITAL", "CENTER", "OF"]
    names = set()
    while len(names) < 260:
        s = list(" ".join(rng.choices(words, weights=range(1, 15), k=rng.choice([1, 2, 2, 2, 3, 5, 9]))))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            s.insert(rng.randrange(len(s)), rng.choice("ABZ "))
        names.add(" ".join("".join(s).split()))
    names = sorted(names)
    left, right = names[::2], names[1::2] + names[:20]
    one = spark.createDataFrame([("TX", n) for n in left], "state string, a string")
    two = spark.createDataFrame([("TX", n) for n in right], "state string, b string")
    got = {(r.a, r.b) for r in linkage.similar_names(one, two, "a", "b", 90).collect()}
    assert got == {(a, b) for a in left for b in right if token_set_ratio(a, b) >= 90} and len(got) > 50


def test_counts_equal_the_candidate_rows(spark):
    """Summary, audit and ambiguity from counts against the same from all candidate rows, business tier included."""
    rng = random.Random(13)
    lasts, firsts = ["HERNANDEZ", "HERNANDES", "SMITH", "LEE", "LEA", "WILLIAMSON"], ["JAMES", "JAMIE", "JAMESS", "ANN", "MARIA"]
    raw = [
        {
            "LASTNAME": rng.choice(lasts), "FIRSTNAME": rng.choice(firsts), "STATE": rng.choice(["TX", "NY"]),
            "NPI": rng.choice(["0000000000", f"{rng.randrange(40):010d}"]), "EXCLDATE": rng.choice(["20200101", "20210101", None]),
            "BUSNAME": rng.choice([None, "SMITH CLINIC", "LEE"]), "SPECIALTY": rng.choice(["GENERAL", "PHARMACY"]),
        }
        for _ in range(120)
    ]
    listed = exclusions(spark, raw)
    prov = providers(spark, [(f"{i:010d}", rng.choice(lasts), rng.choice(firsts), rng.choice(["TX", "NY"])) for i in range(60)]
                     + [(f"{4 * i + 400:010d}", rng.choice(["LEE", "SMITH"]), "ZOE", rng.choice(["TX", "NY"])) for i in range(8)])
    prov = prov.withColumn("mart_entity_type", F.when(F.col("npi").cast("long") % 4 == 0, "O").otherwise("I"))
    config = linkage.MatchConfig(business_tier=True, fuzzy_threshold_t3_first=70, states=("TX", "NY"))
    pairs = linkage.resolve_conflicts(linkage.run_match(listed, prov, config)).cache()
    counts = linkage.count_candidates(listed, prov, config)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert {r["match_tier"] for r in pairs.select("match_tier").distinct().collect()} == {1, 2, 3, 4}
    assert rows(linkage.summarize_counts(counts)) == rows(linkage.match_summary(pairs))
    assert rows(linkage.row_ambiguity(counts)) == rows(pairs.select("leie_row_key", "leie_row_n_candidates").distinct())
    assert rows(linkage.provider_ambiguity(counts)) == rows(pairs.select("npi", "provider_n_leie_rows").distinct())
    kept = audit.flag_candidates(pairs.where("keep_for_training"))
    assert rows(audit.audit_report_by_counts(counts)) == rows(audit.audit_report(kept))


def test_sentinel_and_blank_ids_never_match(spark):
    listed = exclusions(
        spark,
        [{"LASTNAME": "A", "FIRSTNAME": "B", "NPI": n, "STATE": "TX"} for n in ("0000000000", " ", None)],
    )
    prov = providers(spark, [("0000000000", "X", "Y", "TX"), (" ", "X", "Y", "TX")])
    assert linkage.match_npi(listed, prov).count() == 0


def test_earlier_tier_wins(spark):
    listed = exclusions(
        spark,
        [
            {"LASTNAME": "Doe", "FIRSTNAME": "John", "NPI": "1234567890", "STATE": "TX", "EXCLDATE": "20200101"},
            {"LASTNAME": "Doe", "FIRSTNAME": "John", "NPI": "0000000000", "STATE": "TX", "EXCLDATE": "20190101"},
        ],
    )
    prov = providers(spark, [("1234567890", "DOE", "JOHN", "TX")])
    tiers = [r["match_tier"] for r in linkage.run_match(listed, prov).collect()]
    assert tiers == [1]


def fuzzy(spark, listed, prov):
    rows = [{"LASTNAME": l, "FIRSTNAME": f, "NPI": "0000000000", "STATE": "TX"} for l, f in listed]
    people = [(f"{i:010d}", l, f, "TX") for i, (l, f) in enumerate(prov)]
    out = linkage.match_fuzzy_name(exclusions(spark, rows), providers(spark, people))
    return {(r["leie_last_norm"], r["leie_first_norm"], r["mart_last_norm"], r["mart_first_norm"]) for r in out.collect()}


def test_fuzzy_tier_drops_known_false_friends(spark):
    listed = [("WINTERBOTTOM", "DANIEL"), ("WINTERBOTTOM", "SANDRA"), ("DAVIDS", "DAVID"), ("KOWALCZYK", "ANTONIO")]
    prov = [("WINTERBOTTOM", "DANIELLE"), ("WINTERBOTTOM", "CASANDRA"), ("DAVID", "DAVID"), ("KOWALCZYK", "ANTONIOS")]
    assert fuzzy(spark, listed, prov) == {("KOWALCZYK", "ANTONIO", "KOWALCZYK", "ANTONIOS")}


def test_fuzzy_tier_equals_brute_force(spark):
    random.seed(5)
    lasts = ["HERNANDEZ", "HERNANDES", "FERNANDEZ", "RODRIGUEZ", "RODRIGUES", "LEE", "LEA", "WILLIAMSON", "WILLIAMSEN"]
    firsts = ["MICHAEL", "MICHEAL", "MIGUEL", "MARIA", "MARIE", "JON", "JOHN", "CHRISTOPHER", "CHRISTOFER"]
    pairs = [(l, f) for l in lasts for f in firsts]
    listed, prov = random.sample(pairs, 25), random.choices(pairs, k=60)
    full = {f"{l} {f}" for l, f in prov}
    expected = set()
    for l, f in listed:
        target = f"{l} {f}"
        if target in full:
            continue
        scored = [(-token_set_ratio(target, f"{a} {b}"), i, a, b) for i, (a, b) in enumerate(prov)]
        for s, _, a, b in sorted(x for x in scored if -x[0] >= 92)[:5]:
            if ratio(l, a) >= 88 and ratio(f, b) >= 85 and f[0] == b[0]:
                expected.add((l, f, a, b))
    assert fuzzy(spark, listed, prov) == expected and expected


def test_labels_take_the_earliest_date_and_agree_with_candidates(spark):
    listed = exclusions(
        spark,
        [
            {"LASTNAME": "Doe", "FIRSTNAME": "J", "NPI": "1234567890", "STATE": "TX", "EXCLDATE": d, "EXCLTYPE": "1128a1"}
            for d in ("20200101", "20190101", None)
        ]
        + [
            {"LASTNAME": "Ray", "FIRSTNAME": "Ann", "NPI": "0000000000", "STATE": "TX", "EXCLDATE": d}
            for d in ("20210101", "20210101", "20200505")
        ],
    )
    prov = providers(
        spark, [("1234567890", "DOE", "J", "TX"), ("2222222222", "RAY", "ANN", "TX"), ("3333333333", "RAY", "ANN", "TX")]
    )
    compact = linkage.link_labels(listed, prov).orderBy("npi").collect()
    paired = linkage.final_labels(linkage.run_match(listed, prov)).orderBy("npi").collect()
    assert compact == paired
    assert [r["exclusion_date"] for r in compact] == ["20190101", "20200505", "20200505"]
    assert [r["provider_n_leie_rows"] for r in compact] == [3, 2, 2]


def test_ambiguous_fuzzy_rows_are_not_kept(spark):
    df = spark.createDataFrame([(3, 4), (3, 3), (4, 3), (1, 9)], "match_tier int, leie_row_n_candidates long")
    kept = [r["keep_for_training"] for r in linkage.resolve_conflicts(df).collect()]
    assert kept == [False, True, False, True]


def test_audit_flags_and_sample(spark):
    rows = [
        (3, "SMITH", "JOHN", "JON", 100.0, 85.7, "1"),
        (3, "LEE", "ANN", "ANN", 100.0, 100.0, "2"),
        (3, "KOWAL", "JAMES", "JAMIE", 88.9, 80.0, "3"),
        (1, "LEE", "JAMES", "JAMIE", 10.0, 10.0, "4"),
        (3, "NOVAKOVIC", "ANN", "ANN", 95.0, 100.0, "5"),
    ]
    cols = "match_tier int, leie_last_norm string, leie_first_norm string, mart_first_norm string, last_score double, first_score double, npi string"
    out = audit.flag_candidates(spark.createDataFrame(rows, cols).withColumn("leie_row_key", F.col("npi")))
    flags = {r["npi"]: [f for f in audit.FLAGS if r[f]] for r in out.collect()}
    assert flags == {"1": ["common_last"], "2": ["last_too_short"], "3": ["cross_gender", "both_low"], "4": [], "5": []}
    report = {r["match_tier"]: r for r in audit.audit_report(out).collect()}
    assert report[3]["n_flagged"] == 3 and "75.0%" in report[3]["decision"] and report[1]["decision"] is None
    assert audit.audit_sample(out, {1: 1, 3: 2}).count() == 3


def test_one_name_on_both_sides_stays_linear(spark):
    """20,000 list rows and 20,000 providers share a name: 4e8 pairs are never formed."""
    n = 20_000
    raw = spark.range(n).select(
        *[
            {
                "LASTNAME": F.lit("SMITH"),
                "FIRSTNAME": F.lit("JOHN"),
                "NPI": F.lit("0000000000"),
                "STATE": F.lit("TX"),
                "EXCLDATE": F.format_string("2020%04d", F.col("id") % 1000),
            }.get(c, F.lit("")).alias(c)
            for c in EXCLUSION_SCHEMA.fieldNames()
        ]
    )
    prov = spark.range(n).select(
        F.format_string("%010d", "id").alias("npi"),
        F.lit("SMITH").alias("provider_last_name"),
        F.lit("JOHN").alias("provider_first_name"),
        F.lit("TX").alias("provider_state"),
        F.lit("Cardiology").alias("provider_type"),
        F.lit("I").alias("entity_type"),
    )
    counts = linkage.count_candidates(linkage.load_exclusions(raw), linkage.load_providers(prov))
    assert [tuple(r) for r in linkage.summarize_counts(counts).collect()] == [(2, n * n, n * n, 0)]
    report = {r["match_tier"]: (r["n"], r["n_flagged"]) for r in audit.audit_report_by_counts(counts).collect()}
    assert report == {2: (n * n, 0), None: (n * n, 0)}
    assert linkage.provider_ambiguity(counts).agg(F.min("provider_n_leie_rows"), F.count("*")).first() == (1000, n)
    labels = linkage.link_labels(linkage.load_exclusions(raw), linkage.load_providers(prov))
    r = labels.agg(F.count("*"), F.min("exclusion_date"), F.max("leie_row_n_candidates"), F.max("provider_n_leie_rows")).first()
    assert tuple(r) == (n, "20200000", n * 20, 1000)


def test_candidate_rows_are_not_exchanged_for_their_counts(spark):
    raw = [{"LASTNAME": "SMITH", "FIRSTNAME": "JOHN", "STATE": "TX", "NPI": "0000000000", "EXCLDATE": f"2020010{i}"} for i in range(3)]
    prov = providers(spark, [(f"{i:010d}", "Smith", "John", "TX") for i in range(4)])
    pairs = linkage.run_match(exclusions(spark, raw), prov)
    # the tiers are laid side by side, and that is all that happens to a pair
    assert pairs._jdf.queryExecution().optimizedPlan().nodeName() == "Union"
    found = pairs.groupBy("match_tier", "leie_row_n_candidates", "provider_n_leie_rows").count().collect()
    assert [tuple(r) for r in found] == [(2, 4, 3, 12)]


def test_the_sample_is_the_first_rows_of_each_tier_and_flag(spark):
    from claimlens.functions.columns import seeded

    n = F.col("id")
    rows = spark.range(900).select(
        F.format_string("%05d", "id").alias("npi"), F.format_string("K%d", n % 7).alias("leie_row_key"),
        (n % 4 + 1).cast("int").alias("match_tier"), (n % 9 == 0).alias("any_flag"),
    )
    got = {tuple(r) for r in audit.audit_sample(rows, {1: 6, 2: 5, 3: 4}, 3).select("match_tier", "any_flag", "npi").collect()}
    every = rows.withColumn("h", seeded(3, "npi", "leie_row_key")).orderBy("h", "npi").collect()
    wanted = set()
    for tier, size in {1: 6, 2: 5, 3: 4}.items():
        for flag, take in ((True, size // 2), (False, size - size // 2)):
            wanted |= {(tier, flag, r.npi) for r in [r for r in every if r.match_tier == tier and r.any_flag == flag][:take]}
    assert got == wanted


def test_pairs_of_a_name_are_dealt_over_tasks(spark, monkeypatch):
    """No task forms much more than its share of the pairs, and none is lost."""
    listed = spark.range(60).select(
        F.concat(F.lit("l"), "id").alias("leie_row_key"), F.lit("DOE").alias("leie_last_norm"),
        F.lit("ANN").alias("leie_first_norm"), F.lit("TX").alias("leie_state_norm"),
    )
    providers = spark.range(1000).select(
        F.lpad(F.col("id").cast("string"), 10, "0").alias("npi"), F.lit("DOE").alias("mart_last_norm"),
        F.lit("ANN").alias("mart_first_norm"), F.lit("TX").alias("mart_state_norm"),
    )
    monkeypatch.setattr(linkage, "TASK_PAIRS", 10_000, raising=False)
    out = linkage.match_exact_name(listed, providers)
    assert set(out.columns) == {*listed.columns, *providers.columns, "match_tier", "similarity_score"}
    shares = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == out.select("leie_row_key", "npi").distinct().count() == 60_000
    assert max(shares) <= 30_000


def test_the_sample_is_whole_where_draws_are_equal(spark):
    """Rows of one draw, above the bound that a count suggests, are all ordered; scans of absent tiers and flags are left out."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).select(
        F.lit("0000000007").alias("npi"), F.lit("K").alias("leie_row_key"), F.format_string("%04d", "id").alias("leie_excltype"),
        F.lit(2).alias("match_tier"), (F.col("id") == 999).alias("any_flag"),
    )
    got = audit.audit_sample(rows.mapInArrow(count, rows.schema), {1: 3, 2: 4, 3: 5}, 3).collect()
    assert sorted((r["any_flag"], r["leie_excltype"]) for r in got) == [(False, "0000"), (False, "0001"), (False, "0002"), (True, "0999")]
    # counted once, read once a flag and once more for the equal draws
    assert seen.value <= 4000


def test_candidates_are_written_once_and_read_back(spark, tmp_path):
    """Labels are made from the stored candidates, whose pairs are formed a single time."""
    from claimlens.sources import writers

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = spark.range(50).select(F.format_string("%03d", F.col("id") % 10).alias("npi"))
    stored = writers.save_match_outputs(pairs.mapInArrow(count, pairs.schema), lambda c: c.distinct(), str(tmp_path))
    assert stored.count() == 50 and seen.value == 50
    assert spark.read.parquet(f"{tmp_path}/final_labels").count() == 10
