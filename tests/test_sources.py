import bz2
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe import session as SE
from riskframe.catalog import sources
from riskframe.operators import profile as P
from riskframe.sources import manifest as M
from riskframe.sources import tables as S
from tests.conftest import DATA

SCHEMA = T.StructType().add("id", "long").add("v", "double").add("s", "string")
TEXT = 'id,v,s,extra\n1,1.5,a,x\n2,NA,XNA,\n3,,"q ""w"", z",NULL\n4,NaN,n/a,y\n'
WANT = [(1, 1.5, "a", "x"), (2, None, "XNA", None), (3, None, 'q "w", z', None), (4, None, None, "y")]


@pytest.mark.parametrize("suffix, opener", [("csv", open), ("csv.gz", gzip.open), ("csv.bz2", bz2.open)])
def test_csv(spark, tmp_path, suffix, opener):
    path = tmp_path / f"t.{suffix}"
    with opener(path, "wt") as f:
        f.write(TEXT)
    df = S.read_csv_table(spark, str(path), SCHEMA)
    assert [tuple(r) for r in df.orderBy("id").collect()] == WANT
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "s": "string", "extra": "string"}


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("s,id\na,1\n")
    with pytest.raises(ValueError, match="lacks columns: v"):
        S.read_csv_table(spark, str(tmp_path / "t.csv"), SCHEMA)
    df = S.read_csv_table(spark, str(tmp_path / "t.csv"), T.StructType().add("id", "long"))
    assert df.first()["id"] == 1


def test_bad_number_raises_unless_lenient(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,v,s\n1,oops,a\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.read_csv_table(spark, str(tmp_path / "t.csv"), SCHEMA).collect()
    assert S.read_csv_table(spark, str(tmp_path / "t.csv"), SCHEMA, lenient=True).first()["v"] is None


def test_missing_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_csv_table(spark, str(tmp_path / "no.csv"), SCHEMA)
    with pytest.raises(FileNotFoundError):
        S.read_parquet_table(spark, str(tmp_path / "no"))
    with pytest.raises(ValueError, match="bureau is required"):
        S.read_tables(spark, {"bureau": S.TableSpec(None)})
    assert S.read_tables(spark, {"extra": S.TableSpec(None, required=False)}) == {"extra": None}


def test_parquet_and_predictions(spark, tmp_path):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    assert S.write_parquet_table(df, str(tmp_path / "t"), ["p"]) == 10
    assert (tmp_path / "t" / "p=0").exists()
    read = S.read_tables(spark, {"t": S.TableSpec(str(tmp_path / "t"), sample_rows=4, sample_key="id")})["t"]
    assert read.count() == 4
    assert S.write_predictions(df, str(tmp_path / "c"), "csv") == 10
    with pytest.raises(ValueError):
        S.write_predictions(df, str(tmp_path / "x"), "xml")


def test_history_grows(spark, tmp_path):
    row = spark.createDataFrame([("a", 1)], "name string, n int")
    for day in ("2024-01-01", "2024-01-02"):
        S.append_report(row, str(tmp_path / "h"), day)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 2


def test_a_report_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [("a", 1), ("b", None)]
    report = lambda r: spark.createDataFrame(r, "`x.y` string, n int").repartition(2)
    first = S.append_report(report(rows), path, "2024-01-01")
    assert S.append_report(report(rows[::-1]), path, "2024-01-01") == first  # the order of rows is no content
    assert S.append_report(report([("a", 2)]), path, "2024-01-01") != first
    S.append_report(report(rows), path, "2024-01-02", run_id="night")
    S.append_report(report([("c", 3)]), path, "2024-01-02", run_id="night")
    read = spark.read.parquet(path)
    got = sorted((str(r["run_date"]), r["x.y"], r["n"] or 0) for r in read.collect())
    assert got == [("2024-01-01", "a", 1), ("2024-01-01", "a", 2), ("2024-01-01", "b", 0), ("2024-01-02", "c", 3)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, s string")
    assert [tuple(r) for r in S.nan_to_null(df).collect()] == [(None, "x"), (1.0, None)]


def test_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,CREDIT_ACTIVE\n1,Active\n")
    md5 = hashlib.md5((tmp_path / "a.csv").read_bytes()).hexdigest()
    there = M.Source("there", str(tmp_path / "a.csv"), checksum=md5.upper())
    copy = M.Source("copy", str(tmp_path / "landed"), kind="copy", uri=str(tmp_path / "a.csv"))
    gone = M.Source("gone", str(tmp_path / "no.csv"))
    broken = M.Source("broken", str(tmp_path / "out"), kind="copy", uri=str(tmp_path / "no.csv"))
    wrong = M.Source("wrong", str(tmp_path / "a.csv"), checksum="0" * 32)
    rows = {r["name"]: r for r in M.land_sources(spark, [there, copy, gone, broken, wrong], fail_on_missing=False).collect()}
    assert {n: r["status"] for n, r in rows.items()} == {
        "there": "validated", "copy": "fetched", "gone": "missing", "broken": "failed", "wrong": "failed",
    }
    assert rows["there"]["checksum"] == md5 and rows["there"]["size_bytes"] == (tmp_path / "a.csv").stat().st_size
    assert spark.read.parquet(str(tmp_path / "landed")).first()["CREDIT_ACTIVE"] == "Active"
    assert M.land_sources(spark, [copy]).first()["status"] == "cached"
    for bad, error in ((gone, FileNotFoundError), (broken, FileNotFoundError), (wrong, M.ChecksumError)):
        with pytest.raises(error):
            M.land_sources(spark, [bad])
    with pytest.raises(ValueError, match="unsupported"):
        M.land_sources(spark, [M.Source("x", str(tmp_path / "zz"), kind="teleport")])


def test_checksums(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    md5 = hashlib.md5(b"abc").hexdigest()
    assert M.verify_checksums(spark, {str(tmp_path / "a.bin"): md5.upper()}).first()["matches"]
    with pytest.raises(M.ChecksumError):
        M.verify_checksums(spark, {str(tmp_path / "a.bin"): "f" * 32})


@pytest.mark.parametrize(
    "statuses, hour, stale",
    [(["validated", "cached"], 10, False), (["validated"], 30, True), (["validated", "missing"], 10, True), ([], None, True)],
)
def test_freshness(spark, statuses, hour, stale):
    rows = [(f"s{i}", s, f"2024-01-01 00:{i:02d}:00") for i, s in enumerate(statuses)]
    manifest = spark.createDataFrame(rows, "name string, status string, t string").withColumn("ingested_at", F.col("t").cast("timestamp"))
    row = M.freshness(manifest, F.timestamp_add("HOUR", F.lit(hour or 0), F.to_timestamp(F.lit("2024-01-01 00:00:00")))).first()
    assert row["stale"] == stale and row["freshness"] == ("stale" if stale else "fresh")
    assert row["failing_sources"] == ("s1" if "missing" in statuses else "")
    assert row["n_validated"] == statuses.count("validated")


def test_profile_and_lineage(spark, tmp_path):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "x", 1.0), (3, None, 2.0)], "a int, b string, c double")
    assert {r["column"]: r["missing_fraction"] for r in P.profile_table(df).collect()} == {
        "a": 0.0, "b": pytest.approx(2 / 3), "c": pytest.approx(1 / 3),
    }
    assert [(r["column"], r["missing_fraction"]) for r in P.top_missing(df, 1).collect()] == [("b", 0.6667)]
    rows = {r["table"]: r for r in P.lineage({"t": df}, df.drop("c")).collect()}
    assert (rows["t"]["n_rows"], rows["t"]["column_names"], rows["t"]["most_missing"]) == (3, "a,b,c", "b,c")
    assert rows["feature_store"]["source_tables"] == "t" and rows["feature_store"]["n_columns"] == 2
    df.write.parquet(str(tmp_path / "t"))
    facts = P.file_facts(spark.read.parquet(str(tmp_path / "t")), "t").first()
    assert facts["n_files"] >= 1 and facts["file_size_bytes"] > 0


def test_lineage_is_the_same_for_a_file_and_a_folder_of_files(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    whole, parts = (sorted(map(tuple, sources.lineage(spark, d).collect()), key=str) for d in (DATA, str(tmp_path)))
    assert whole == parts
    facts = P.file_facts(spark.read.parquet(str(tmp_path / "documents.parquet")), "t").first()
    assert (facts["n_files"], facts["n_folders"]) == (3, 1)


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(500).withColumn("v", F.col("id") / 7)
    one = P.table_fingerprint(df, ["id", "v"]).first()
    assert P.table_fingerprint(df.orderBy(F.desc("id")).repartition(3), ["id", "v"]).first() == one
    assert P.table_fingerprint(df.withColumn("v", F.when(F.col("id") == 7, None).otherwise(F.col("v"))), ["id", "v"]).first() != one


def test_shared_folder_comes_from_the_session(spark):
    assert SE.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert SE.scratch_path(spark, "x") != SE.scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_an_error():
    class Conf(dict):
        set = dict.__setitem__

    class Fake:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SE.shared_folder(Fake())


def test_files_of_any_size_are_hashed_in_pieces(spark, tmp_path):
    content = {"small": b"x" * 10, "large": bytes(range(256)) * 5000, "edge": b"y" * 1000, "_hidden": b"z"}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    for limit, piece in ((1000, 64 << 10), (0, 7), (1 << 31, 1)):
        rows = M.file_checksums(spark, str(tmp_path), whole_up_to=limit, piece_bytes=piece).collect()
        got = {r["path"].rsplit("/", 1)[-1]: (r["length"], r["md5"]) for r in rows}
        assert got == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in content.items() if n != "_hidden"}
    assert M.table_checksum(spark, str(tmp_path / "large")) == hashlib.md5(content["large"]).hexdigest()
