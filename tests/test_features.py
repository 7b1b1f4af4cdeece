import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlens.functions import checkpoints
from claimlens.operators import features, graph, scoring, summary

MIX = "npi string, hcpcs_code string, provider_type string, hcpcs_fraction double"


def jsd_of(spark, p, q):
    df = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
    return df.select(features.jsd("p", "q")).first()[0]


def test_jsd_identities(spark):
    assert jsd_of(spark, [0.5, 0.3, 0.2], [0.5, 0.3, 0.2]) == pytest.approx(0, abs=1e-12)
    assert jsd_of(spark, [1.0, 0.0], [0.0, 1.0]) == pytest.approx(1)
    a, b = [0.7, 0.2, 0.1], [0.3, 0.4, 0.3]
    assert jsd_of(spark, a, b) == pytest.approx(jsd_of(spark, b, a))


def test_jsd_is_bounded(spark):
    rng = np.random.default_rng(0)
    rows = [(rng.dirichlet(np.ones(5)).tolist(), rng.dirichlet(np.ones(5)).tolist()) for _ in range(100)]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>").select(features.jsd("p", "q").alias("d"))
    r = df.agg(F.min("d"), F.max("d")).first()
    assert -1e-12 <= r[0] and r[1] <= 1 + 1e-12


def test_jsd_ranks_the_skewed_provider(spark):
    shares = {"A": (0.6, 0.4), "B": (0.5, 0.5), "C": (0.9, 0.1)}
    rows = [(n, c, "Cardiology", f) for n, fs in shares.items() for c, f in zip(("99213", "99214"), fs)]
    out = {r["npi"]: r["jsd_vs_specialty"] for r in features.jsd_vs_specialty(spark.createDataFrame(rows, MIX)).collect()}
    assert len(out) == 3 and out["C"] > out["B"]


def test_sparse_median_equals_dense(spark):
    random.seed(2)
    rows, dense = [], {}
    for spec, n in (("S", 5), ("T", 6)):
        for code, k in (("c2", 2), ("c3", 3), ("c4", 4), ("all", n)):
            column = [0.0] * n
            for i in random.sample(range(n), k):
                column[i] = random.random()
                rows.append((f"{spec}{i}", code, spec, column[i]))
            dense[spec, code] = float(np.median(column))
    out = features.specialty_median_mix(spark.createDataFrame(rows, MIX)).where("q > 0").collect()
    got = {(r["specialty"], r["hcpcs_code"]): r["q"] for r in out}
    for key, value in dense.items():
        total = sum(v for (s, _), v in dense.items() if s == key[0])
        assert got.get(key, 0.0) == pytest.approx(value / total)


ZIPS = "npi string, provider_zip5 string, total_beneficiaries int"


def test_zip_entropy(spark):
    rows = [("A", "75001", 50), ("A", "75001", 30), ("Z", None, 5), ("N", "75001", 0)]
    rows += [("B", f"7500{i}", 25) for i in range(1, 5)]
    out = {r["npi"]: tuple(r)[1:] for r in features.zip_entropy(spark.createDataFrame(rows, ZIPS)).collect()}
    assert out["A"] == (0.0, 0.0, 1) and out["N"] == (0.0, 0.0, 0) and "Z" not in out
    assert out["B"] == (pytest.approx(2.0), pytest.approx(1.0), 4)


def test_velocity(spark):
    cols = "npi string, total_services double, total_beneficiaries int, total_beneficiary_day_services double, place_of_service string"
    rows = [("A", 5000.0, 200, 300.0, "O"), ("B", 15000.0, 200, 300.0, "O"), ("C", 2500.0, 10, 0.0, "F"), ("D", 0.0, 0, 0.0, "O")]
    out = {r["npi"]: r for r in features.billing_velocity(spark.createDataFrame(rows, cols)).collect()}
    assert out["A"]["throughput_utilization"] < 1 and not out["A"]["exceeds_throughput_limit"]
    assert out["B"]["throughput_utilization"] == pytest.approx(1.5) and out["B"]["exceeds_throughput_limit"]
    assert out["C"]["daily_services"] == 10.0 and out["D"]["services_per_bene_per_day"] is None


def test_mahalanobis(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(100, 20, size=(30, 9))
    x[-1] = 500
    names = features.MAHALANOBIS_FEATURES
    rows = [(f"{i}", "Big", *map(float, r)) for i, r in enumerate(x)] + [(f"s{i}", "Small", *map(float, x[i])) for i in range(5)]
    df = spark.createDataFrame(rows, "npi string, provider_specialty string, " + ", ".join(f"{n} double" for n in names))
    out = {r["npi"]: r for r in features.mahalanobis_distance(df, min_peer_count=20).collect()}
    assert all(out[f"s{i}"]["mahalanobis_distance"] is None for i in range(5))
    inv = np.linalg.inv(np.cov(x.T) + 1e-6 * np.eye(9))
    d = x - x.mean(axis=0)
    expected = np.sqrt(np.einsum("ij,jk,ik->i", d, inv, d))
    got = np.array([out[str(i)]["mahalanobis_distance"] for i in range(30)])
    assert np.allclose(got, expected) and got.argmax() == 29
    assert all(0 <= out[str(i)]["mahalanobis_pvalue"] <= 1 for i in range(30))


def test_mix_of_provider_without_services_has_no_share(spark):
    rows = [("A", "x", "T", 0.0), ("B", "x", "T", 2.0)]
    cells = spark.createDataFrame(rows, "npi string, hcpcs_code string, provider_type string, total_services double")
    out = {r["npi"]: r["hcpcs_fraction"] for r in summary.hcpcs_mix(cells).collect()}
    assert out == {"A": None, "B": 1.0}


def test_small_specialty_has_no_benchmark(spark):
    names = ["total_services", "total_medicare_payments", "total_beneficiaries", "services_per_beneficiary", "unique_hcpcs_codes", "wavg_submitted_charge"]
    rows = [("S", *[float(i)] * 6) for i in range(9)] + [("L", *[float(i)] * 6) for i in range(10)]
    df = spark.createDataFrame(rows, "provider_type string, " + ", ".join(f"{n} double" for n in names))
    out = summary.specialty_benchmarks(df).collect()
    assert [r["specialty"] for r in out] == ["L"] and out[0]["median_total_services"] == 4.5


EDGES = "npi string, hcpcs_code string, weight double"


def test_pagerank_sums_to_one(spark):
    edges = spark.createDataFrame([("A", "x", 0.7), ("A", "y", 0.3)], EDGES)
    x = graph.graph_pagerank(edges, max_iter=200, tol=1e-12).first()["graph_pagerank"]
    # provider and codes exchange all their rank: x = 0.05 + 0.85 (1 - x)
    assert x == pytest.approx(0.9 / 1.85, abs=1e-6)


def test_clustering_is_mean_overlap(spark):
    sets = {"A": "xy", "B": "yz", "C": "x", "D": "q"}
    edges = spark.createDataFrame([(n, c, 0.5) for n, cs in sets.items() for c in cs], EDGES)
    out = {r["npi"]: r["graph_clustering"] for r in graph.graph_clustering(edges).collect()}
    assert out == {"A": pytest.approx((1 / 3 + 1 / 2) / 2), "B": pytest.approx(1 / 3), "C": pytest.approx(0.5), "D": 0.0}
    blocked = graph.graph_clustering(edges, block_sets=1).collect()
    assert {r["npi"]: r["graph_clustering"] for r in blocked} == {k: pytest.approx(v) for k, v in out.items()}


def test_clustering_counts_providers_with_equal_sets(spark):
    sets = {"A": "xy", "B": "xy", "C": "xy", "D": "xz"}
    edges = spark.createDataFrame([(n, c, 0.5) for n, cs in sets.items() for c in cs], EDGES)
    out = {r["npi"]: r["graph_clustering"] for r in graph.graph_clustering(edges, block_sets=1).collect()}
    assert out == {n: pytest.approx((1 + 1 + 1 / 3) / 3 if n != "D" else 1 / 3) for n in sets}


def test_minmax_of_a_constant_is_zero(spark):
    df = scoring.min_max_columns(spark.createDataFrame([(2.0,), (2.0,)], "v double"), {"s": "v"})
    assert [r["s"] for r in df.collect()] == [0.0, 0.0]


def test_blocks_without_a_common_code_are_never_compared(spark):
    """Four clusters of providers with codes of their own: same result, few units."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(160):
        codes = rng.choice(8, int(rng.integers(1, 6)), replace=False)
        rows += [(f"{i:010d}", f"g{i % 4}c{c}", 0.1) for c in codes]
    edges = spark.createDataFrame(rows, "npi string, hcpcs_code string, weight double")
    sets = {}
    for npi, code, _ in rows:
        sets.setdefault(npi, set()).add(code)
    want = {}
    for a, x in sets.items():
        shared = [len(x & y) / len(x | y) for b, y in sets.items() if b != a and x & y]
        want[a] = sum(shared) / len(shared) if shared else 0.0
    got = {r["npi"]: r["graph_clustering"] for r in graph.graph_clustering(edges, block_sets=5).collect()}
    assert got == pytest.approx(want)
    folded = edges.groupBy("npi").agg(F.array_sort(F.collect_set("hcpcs_code")).alias("codes")).groupBy("codes").agg(F.count("*").alias("m"))
    placed = graph.set_blocks(folded.withColumn("s", F.md5(F.to_json("codes"))), 5).cache()
    blocks = placed.select("b").distinct().count()
    pairs = graph.block_pairs(placed)
    assert blocks > 8 and len(pairs) < 0.5 * blocks * (blocks + 1) / 2
    assert len(pairs) == len(set(pairs)) and all(i <= j for i, j in pairs)


def test_shuffles_widen_with_the_rows_of_a_table(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        checkpoints.widen(spark.range(100), task_rows=1000)
        assert spark.conf.get(key) == before
        checkpoints.widen(spark.range(10_001), task_rows=1000)
        assert spark.conf.get(key) == "11"
        checkpoints.widen(spark.range(100), task_rows=50)
        assert spark.conf.get(key) == "11"
    finally:
        spark.conf.set(key, before)


def test_adaptive_execution_does_not_merge_what_was_widened(spark):
    keys = "spark.sql.shuffle.partitions", checkpoints.MERGE_UP_TO
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.unset(checkpoints.MERGE_UP_TO)
        lines = checkpoints.widen(spark.range(8_000_000).select(*[F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(3)]))
        tasks = lines.repartition("c0").groupBy(F.spark_partition_id()).agg(F.count("c0").alias("n"), F.max("c1"), F.max("c2"))
        assert max(r["n"] for r in tasks.collect()) < 1.2 * checkpoints.TASK_ROWS
        spark.conf.set(checkpoints.MERGE_UP_TO, "32m")
        checkpoints.widen(lines)
        assert spark.conf.get(checkpoints.MERGE_UP_TO) == "32m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_codes_are_counted_in_the_fold_by_provider(spark):
    text = ["npi", "hcpcs_code", *summary.CELL_ATTRIBUTES, "provider_type", "provider_zip5"]
    rows = [("a", c, *"LFISG", "T", z) for c, z in [("x", "1"), ("x", "2"), ("y", "1"), (None, "1")]] + [("b", None, *"LFISG", None, "9")]
    lines = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in text)).withColumns(
        {c: F.lit("O") for c in ("place_of_service", "hcpcs_drug_indicator")}
        | {c: F.lit(1.0) for c in ("total_services", "total_beneficiaries", "total_beneficiary_day_services", "avg_submitted_charge",
                                   "avg_medicare_payment_amt", "avg_medicare_allowed_amt", "avg_medicare_standardized_amt")}
    )
    cells = checkpoints.materialize(summary.billing_cells(lines))
    found = summary.claims_summary(cells)
    assert {r["npi"]: r["unique_hcpcs_codes"] for r in found.collect()} == {"a": 2, "b": 0}
    assert dict(found.dtypes)["unique_hcpcs_codes"] == "bigint"
    plan = found._jdf.queryExecution().sparkPlan().toString()
    # one fold by provider, not one by provider and code before it
    assert plan.count("Aggregate(") == 2


def test_clustering_sends_blocks_packed(spark, monkeypatch):
    """A set travels as a byte per code, and tiles smaller than a block or the codes change nothing."""
    rng = np.random.default_rng(9)
    sets = {f"{i:010d}": sorted({f"code number {c}" for c in rng.choice(30, int(rng.integers(1, 12)))}) for i in range(90)}
    edges = spark.createDataFrame([(n, c, 0.1) for n, cs in sets.items() for c in cs], EDGES)
    rows = [(f"s{i}", c, 1) for i, c in enumerate(sets.values())]
    packed = graph.pack_blocks(graph.set_blocks(spark.createDataFrame(rows, "s string, codes array<string>, m long"), 40)).collect()
    assert len(packed) < 6 and sum(len(r["s"]) for r in packed) == 90
    assert sum(len(r["owner"]) for r in packed) == sum(map(len, sets.values()))
    want = {}
    for a, x in sets.items():
        shared = [len({*x} & {*y}) / len({*x} | {*y}) for b, y in sets.items() if b != a and {*x} & {*y}]
        want[a] = sum(shared) / len(shared) if shared else 0.0
    assert {r["npi"]: r["graph_clustering"] for r in graph.graph_clustering(edges, block_sets=40).collect()} == pytest.approx(want)
    packing = graph._packed(pd.DataFrame(rows, columns=["s", "codes", "m"]).assign(b=0)).iloc[0].to_dict()
    whole = graph._overlaps(packing, None)
    monkeypatch.setattr(graph, "TILE", (7, 16, 5))
    assert all(np.allclose(a, b) for a, b in zip(whole[0][1:], graph._overlaps(packing, None)[0][1:]))
    (_, left, _), (_, right, _) = graph._overlaps(packing, packing)
    twice = whole[0][1] + 1
    assert np.allclose(left, twice) and np.allclose(right, twice)


def test_pagerank_stops_at_the_same_step_on_codes_and_on_edges(spark):
    rng = np.random.default_rng(5)
    rows = {(f"{i:010d}", f"c{rng.integers(12)}"): float(rng.uniform(0.02, 1)) for i in range(40) for _ in range(3)}
    edges = spark.createDataFrame([(*k, w) for k, w in rows.items()], "npi string, hcpcs_code string, weight double").cache()
    codes = sorted({c for _, c in rows})
    for tol, steps in ((1e-3, 30), (None, 5)):
        one = {r[0]: r[1] for r in graph.pagerank_on_codes(edges, codes, 0.85, steps, tol).collect()}
        two = {r[0]: r[1] for r in graph.pagerank_by_steps(edges, 0.85, steps, tol).collect()}
        assert one == pytest.approx(two, abs=1e-13), tol


CELL_TEXT = [*summary.CELL_KEYS, *summary.CELL_ATTRIBUTES, "place_of_service", "hcpcs_drug_indicator"]
CELL_NUMBERS = ["total_services", "total_beneficiary_day_services", "avg_submitted_charge", "avg_medicare_payment_amt",
                "avg_medicare_allowed_amt", "avg_medicare_standardized_amt"]
CELL_SCHEMA = ", ".join([f"{c} string" for c in CELL_TEXT] + [f"{c} double" for c in CELL_NUMBERS] + ["total_beneficiaries int"])


def test_cells_are_exchanged_once_and_by_provider(spark, monkeypatch):
    """The lines are folded in their task, null keys and null amounts included, and dealt by provider only."""
    rng = random.Random(4)
    some = lambda *values: rng.choice([*values, None])
    rows = [
        (some("a", "b"), some("x", "y"), some("T"), some("1"), *"LFISG", some("F", "O"), some("Y", "N"), *[some(1.0, 2.5) for _ in CELL_NUMBERS], some(1, 2**31 - 1))
        for _ in range(400)
    ]
    lines = spark.createDataFrame(rows, CELL_SCHEMA).repartition(3)
    cells = summary.billing_cells(lines)
    keys = [*summary.CELL_KEYS, *summary.CELL_ATTRIBUTES]
    services = F.col("total_services")
    want = lines.groupBy(*keys).agg(
        F.sum(services).alias("total_services"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        F.sum(services * F.col("avg_medicare_payment_amt")).alias("medicare_payments"),
        F.sum(F.when(F.col("place_of_service") == "O", services).otherwise(0.0)).alias("office_services"),
    )
    order = lambda df: sorted((tuple(r) for r in df.select(want.columns).collect()), key=str)
    assert order(cells) == order(want)
    assert dict(cells.dtypes)["total_beneficiaries"] == "bigint"
    plan = summary.claims_summary(summary.billing_cells(spark.createDataFrame(rows, CELL_SCHEMA)))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RepartitionByExpression") + plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(npi" in plan
    monkeypatch.setattr(summary, "FOLD_ROWS", 7)
    assert order(summary.billing_cells(lines)) == order(want)


def test_stored_results_leave_no_shuffle_files(spark, tmp_path):
    """Shuffles behind a stored table are deleted with the job that wrote it; the session's setting stays."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    def settled(before):
        for _ in range(100):
            left = files() - before
            if not left:
                break
            time.sleep(0.1)
        return left

    before, rows = files(), spark.range(1000).groupBy((F.col("id") % 7).alias("npi")).count()
    stored = checkpoints.materialize(rows)
    assert not settled(before)
    table = checkpoints.store_by(rows, "npi")
    assert not settled(before)
    assert stored.count() == table.count() == 7 and rows.count() == 7
    assert spark.conf.get(checkpoints.DROP_SHUFFLES, None) in (None, "false")


def test_sets_are_words_of_bits():
    """A bit per common code, over several words; what two sets share is a count of bits."""
    rng = np.random.default_rng(2)
    sets = [sorted(int(c) for c in rng.choice(150, int(rng.integers(1, 90)), replace=False)) for _ in range(9)]
    names = [f"{c:03d}" for c in range(150)]
    row = graph._packed(pd.DataFrame({"b": 0, "s": range(9), "codes": [[names[c] for c in s] for s in sets], "m": 1})).iloc[0].to_dict()
    common = np.array(sorted({names[c] for s in sets for c in s}), dtype=object)
    for at_once in (2048, 70):
        words = graph._Sets(row, common).words(len(common), at_once)
        shared = np.bitwise_count(words[:, :, None] & words[:, None, :]).sum(axis=0)
        assert shared.tolist() == [[len({*a} & {*b}) for b in sets] for a in sets]
