import json

import pytest
from pyspark.sql import functions as F

from claimlens.operators import quality, staging
from claimlens.schemas import CLAIM_COLUMNS, EXCLUSION_COLUMNS, REGISTRY_COLUMNS, REGISTRY_RECORD_SCHEMA
from claimlens.sources import readers, writers

CLAIMS = [
    {"Rndrng_NPI": "1234567890", "HCPCS_Cd": "99213", "Tot_Srvcs": "100", "Tot_Benes": "50", "Avg_Mdcr_Pymt_Amt": "75.00", "Rndrng_Prvdr_State_Abrvtn": "TX", "Extra": "x"},
    {"Rndrng_NPI": "0987654321", "HCPCS_Cd": "99214", "Tot_Srvcs": "200", "Tot_Benes": "80", "Avg_Mdcr_Pymt_Amt": "95.00", "Rndrng_Prvdr_State_Abrvtn": "TX"},
]


def test_claims_json(spark, tmp_path):
    path = tmp_path / "tx.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in CLAIMS))
    df = readers.read_claims(spark, str(path))
    assert df.count() == 2 and df.columns == CLAIM_COLUMNS
    staged = staging.stage_claims(df).orderBy("npi").first()
    assert (staged["total_services"], staged["total_beneficiaries"], staged["provider_type"]) == (200.0, 80, None)
    assert readers.file_row_counts(spark, str(path)).first()["rows"] == 2


def test_exclusions_csv_skips_broken_rows(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text("LASTNAME,FIRSTNAME,NPI,EXCLTYPE,EXCLDATE\nDOE,JOHN,1234567890,1128a(1),20200115\nSMITH,JANE,0987654321,1128a(2),20210301\n")
    df = readers.read_exclusions(spark, str(path))
    assert df.count() == 2 and df.columns == EXCLUSION_COLUMNS
    r = staging.stage_exclusions(df, parse_dates=True).orderBy("npi").first()
    assert str(r["exclusion_date"]) == "2021-03-01" and r["is_currently_excluded"]
    assert staging.stage_exclusions(df).first()["exclusion_date"] is None


def test_exclusion_files_of_different_headers_and_broken_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("LASTNAME,FIRSTNAME,NPI\nDOE,JOHN,1\nBROKEN\nROE,JANE,2,too,many\n")
    (tmp_path / "b.csv").write_text("NPI,LASTNAME,FIRSTNAME,EXCLTYPE\n3,POE,ANN,1128a1\n4\n")
    df = readers.read_exclusions(spark, str(tmp_path))
    want = [("DOE", "JOHN", "1", None), ("POE", "ANN", "3", "1128a1")]
    assert sorted(tuple(r) for r in df.select("LASTNAME", "FIRSTNAME", "NPI", "EXCLTYPE").collect()) == sorted(want, key=lambda r: r[0])
    assert df.count() == 2 and df.select("LASTNAME").count() == 2 and len(df.select("LASTNAME").collect()) == 2


def test_registry_files_of_different_headers(spark, tmp_path):
    names = list(REGISTRY_COLUMNS)
    for k, order in enumerate((names, names[::-1])):
        (tmp_path / f"npidata_pfile_{k}.csv").write_text(",".join(f'"{c}"' for c in order) + "\n" + ",".join(f"{c[:3]}{k}" for c in order) + "\nx,y\n")
    rows = readers.read_registry(spark, str(tmp_path)).collect()
    assert len(rows) == 2
    for k, r in enumerate(sorted(rows, key=lambda r: r["npi"])):
        assert [r[new] for new in REGISTRY_COLUMNS.values()] == [f"{old[:3]}{k}" for old in names]


def test_registry_csv_picks_columns_and_files(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in [*REGISTRY_COLUMNS, "Unused"])
    (tmp_path / "npidata_pfile_1.csv").write_text(header + "\n1,2,L,F,O,TX,75001,207R,2010-01-01,M,z\n")
    (tmp_path / "other.csv").write_text("A\n1\n")
    df = readers.read_registry(spark, str(tmp_path))
    assert df.columns == list(REGISTRY_COLUMNS.values()) and df.count() == 1
    assert staging.stage_registry(df).first()["entity_type"] == "organization"


def test_registry_records(spark):
    rows = [
        ("1", "NPI-1", ("L", "F", None, None, "M"), [("MAILING", "NY", "1"), ("LOCATION", "TX", "2")], [("207R",)]),
        ("2", "NPI-2", None, [("MAILING", "NY", "1")], []),
        ("3", None, None, None, None),
    ]
    out = readers.flatten_registry(spark.createDataFrame(rows, REGISTRY_RECORD_SCHEMA)).orderBy("npi").collect()
    assert [r["practice_state"] for r in out] == ["TX", "NY", ""]
    assert [r["taxonomy_code"] for r in out] == ["207R", "", ""]
    assert [r["entity_type_code"] for r in out] == ["1", "2", ""]


def test_review_log_and_artifacts(spark, tmp_path):
    path = str(tmp_path / "log")
    writers.log_review(spark, path, "1234567890", "Referred for Investigation")
    writers.log_review(spark, path, "1234567890", "No Action — Legitimate Pattern", "ok")
    assert readers.read_reviews(spark, path).count() == 2
    writers.save_artifact(spark.range(3), str(tmp_path), "scores")
    assert readers.read_artifact(spark, str(tmp_path), "scores").count() == 3


def test_audit_outputs(spark, tmp_path):
    rows = spark.createDataFrame([(3, "A", True)], "match_tier int, npi string, any_flag boolean")
    report = spark.createDataFrame([("a", "b", 1.0)], "metric string, key string, value double")
    writers.save_audit(rows, rows, report, str(tmp_path))
    assert readers.read_metrics(spark, f"{tmp_path}/audit_report").first()["value"] == 1.0
    assert spark.read.option("header", True).csv(f"{tmp_path}/audit_sample").columns == rows.columns


def test_quality_lines_and_empty_table(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in CLAIMS))
    claims = readers.read_claims(spark, str(path))
    good = quality.validation_results(quality.check_claims(claims)).select(quality.summary_line()).first()[0]
    assert good == "[PASS] claims: 7/7 checks passed"
    empty = quality.validation_results(quality.check_claims(claims.limit(0)))
    assert empty.select(quality.summary_line()).first()[0] == "[FAIL] claims: 1/7 checks passed"
    lacking = quality.check_claims(claims.drop("Tot_Benes")).where("not passed")
    assert {r["check"] for r in lacking.collect()} == {"required_columns_missing", "null_pct_Tot_Benes"}


def test_constraints(spark):
    df = spark.createDataFrame([("1", "I"), ("1", "X"), (None, None)], "npi string, entity_type string")
    spec = quality.Constraints(["npi"], ["npi"], {"entity_type": ["I", "O"]})
    out = {r["test"]: r["failures"] for r in quality.check_constraints(df, "t", spec).collect()}
    assert out == {"not_null": 1, "unique": 1, "accepted_values": 1}
    n = sum(len(c.not_null) + len(c.unique) + len(c.accepted) for c in quality.CONSTRAINTS.values())
    assert n == 34


def test_tables_append_by_name_and_feature_fallback(spark):
    writers.create_layers(spark, ["claimlens_test"])
    try:
        rows = spark.createDataFrame([("TX", 1)], "state string, n int")
        writers.save_table(rows, "claimlens_test.mart")
        writers.save_table(rows.select("n", "state"), "claimlens_test.mart", append=True)
        both = readers.read_features(spark, "claimlens_test.full", "claimlens_test.mart")
        assert [tuple(r) for r in both.collect()] == [("TX", 1)] * 2
        writers.save_table(rows.limit(0), "claimlens_test.full")
        assert readers.read_features(spark, "claimlens_test.full", "claimlens_test.mart").count() == 0
    finally:
        spark.sql("DROP DATABASE claimlens_test CASCADE")


def test_a_large_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "load")
    rows = spark.range(6010).select(
        F.when(F.col("id") < 5000, "TX").when(F.col("id") < 6000, "NY").when(F.col("id") < 6007, "RI").alias("state"),
        F.lit(2022).alias("year"),
        "id",
    )
    writers.load_partitions(rows, path, rows_per_file=1000)
    files = {s: len(list((tmp_path / "load" / f"state={s}" / "year=2022").glob("*.parquet"))) for s in ("TX", "NY", "RI", "__HIVE_DEFAULT_PARTITION__")}
    assert files == {"TX": 5, "NY": 1, "RI": 1, "__HIVE_DEFAULT_PARTITION__": 1}
    writers.load_partitions(rows.where("state = 'NY'").limit(3), path, rows_per_file=1000)
    back = {r["state"]: r["count"] for r in spark.read.parquet(path).groupBy("state").count().collect()}
    assert back == {"TX": 5000, "NY": 3, "RI": 7, None: 3}
    writers.load_partitions(rows.limit(0), path)
    assert spark.read.parquet(path).count() == 5013


def test_headers_are_read_in_one_job_whatever_the_number_of_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"n{n} x%y"
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.csv").write_text(f"\n  \nNPI,LASTNAME{',X' * (i % 2)}\n{i},DOE{',z' * (i % 2)}\n")
        (folder / "empty.csv").write_text("")
        files = readers.csv_files(spark, [str(folder)])
        spark.sparkContext.setJobGroup(f"headers{n}", "")
        found = readers.csv_headers(spark, files)
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers{n}")
        assert sorted(set(found.values())) == [("NPI", "LASTNAME"), ("NPI", "LASTNAME", "X")] and len(found) == n
        assert {r["NPI"] for r in readers.read_exclusions(spark, str(folder)).select("NPI").collect()} == {str(i) for i in range(n)}
        return len(ids)

    assert jobs(3) == jobs(17)


def test_header_names_are_settled():
    assert readers.settled_names('\ufeff"A b",c,,C,"x, y"') == ("A b", "c1", "_c2", "C3", "x, y")


def test_json_of_a_large_table_is_compressed_and_split_by_folder(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("Rndrng_NPI"), (F.col("id") % 2).alias("half"))
    writers.save_json(rows, f"{tmp_path}/small", by=("half",))
    writers.save_json(rows, f"{tmp_path}/packed", by=("half",), compression="gzip")
    size = {k: sum(f.stat().st_size for f in tmp_path.glob(f"{k}/half=*/*.json*")) for k in ("small", "packed")}
    assert size["packed"] < 0.5 * size["small"]
    assert readers.read_claims(spark, f"{tmp_path}/packed/half=1").count() == 1000
    assert readers.file_row_counts(spark, f"{tmp_path}/packed/*/*.json*").agg(F.sum("rows")).first()[0] == 2000
