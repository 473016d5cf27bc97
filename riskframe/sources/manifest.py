"""Landing of sources, their manifest, checksums and freshness."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
FAILING_STATUSES = ("missing", "failed")
MAX_AGE_HOURS = 24.0

#: Files that Spark reads as one value (it can up to 2 GB); a task holds one of them at a time.
WHOLE_UP_TO = 256 << 20
PIECE_BYTES = 8 << 20

MANIFEST_SCHEMA = (
    "name string, path string, source_type string, status string, n_files bigint, size_bytes bigint, "
    "checksum string, expected_checksum string, message string, ingested_at timestamp"
)


class ChecksumError(ValueError):
    """File content differs from what was promised."""


@dataclass(frozen=True)
class Source:
    """A table to have in place at ``path``.

    ``existing`` only checks that it is there. ``copy`` reads ``uri`` in format
    ``fmt`` and lands it at ``path`` as Parquet, unless it is there already.
    """

    name: str
    path: str
    kind: str = "existing"
    uri: str | None = None
    fmt: str = "csv"
    options: Mapping[str, str] = field(default_factory=lambda: {"header": "true"})
    checksum: str | None = None
    skip_if_exists: bool = True


def file_checksums(
    spark: SparkSession, path: str | list[str], whole_up_to: int = WHOLE_UP_TO, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """path, length and MD5 per file, of any size.

    Files up to ``whole_up_to`` bytes are read by Spark as one value each. Larger ones are read piece by piece, each by one
    task (an MD5 has to be), through the file system that their path names (pyarrow: local, S3, GCS, HDFS).
    """
    files = _binary(spark, path)
    whole = files.filter(F.col("length") <= whole_up_to).select("path", "length", F.md5("content").alias("md5"))
    large = files.filter(F.col("length") > whole_up_to).select("path", "length")
    sizes = large.agg(F.count(F.lit(1))).first()[0]
    if not sizes:
        return whole

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_streamed_md5(p, piece_bytes) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["path", "length", "md5"])

    spread = large.repartition(min(sizes, 10_000), "path")  # about one file a task
    return whole.unionByName(spread.mapInArrow(digest, "path string, length long, md5 string"))


def _streamed_md5(path: str, piece_bytes: int) -> str:
    scheme, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        system, name = pafs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    else:
        system, name = pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    total = hashlib.md5()
    with system.open_input_stream(name) as stream:
        while piece := stream.read(piece_bytes):
            total.update(piece)
    return total.hexdigest()


def table_checksum(spark: SparkSession, path: str) -> str | None:
    """One checksum of a table: its file's MD5, or of several files the MD5 over their
    sorted (path below the table, MD5) pairs. Only names and MD5s reach the driver."""
    root = path.rstrip("/").rsplit("/", 1)[-1]
    below = F.regexp_extract("path", f"/{re.escape(root)}/(.*)$", 1)
    pairs = file_checksums(spark, path).select(below.alias("name"), "md5")
    listed = pairs.agg(F.array_sort(F.collect_list(F.struct("name", "md5"))).alias("files")).select(
        F.size("files").alias("n"),
        F.get("files", F.lit(0))["md5"].alias("only"),
        F.md5(F.concat_ws("\n", F.transform("files", lambda f: F.concat_ws(":", f["name"], f["md5"])))).alias("all"),
    )
    row = listed.first()
    return None if not row["n"] else row["only"] if row["n"] == 1 else row["all"]


def _binary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Data files below the path; names that begin with a dot or an underscore are not data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter(~F.regexp_extract("path", "([^/]+)$", 1).rlike("^[._]"))


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return _binary(spark, path).select("path", "length", "modificationTime")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition()):
            return None
        raise


def _facts(spark: SparkSession, path: str, with_checksum: bool) -> dict:
    files = _files(spark, path)
    if files is None:
        return {}
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), F.max("modificationTime").alias("t")).first()
    facts = {"n_files": row["n"], "size_bytes": row["b"], "ingested_at": row["t"]}
    if with_checksum:
        facts["checksum"] = table_checksum(spark, path)
    return facts


def _land(spark: SparkSession, source: Source, fail_on_missing: bool) -> tuple[str, str | None]:
    present = _files(spark, source.path) is not None
    if source.kind == "existing":
        if present:
            return "validated", None
        message = f"expected table {source.path} does not exist"
        if fail_on_missing:
            raise FileNotFoundError(message)
        return "missing", message
    if source.kind != "copy":
        raise ValueError(f"unsupported source kind {source.kind!r}")
    if present and source.skip_if_exists:
        return "cached", None
    if not source.uri or _files(spark, source.uri) is None:
        raise FileNotFoundError(f"source {source.uri} of '{source.name}' does not exist")
    spark.read.format(source.fmt).options(**source.options).load(source.uri).write.mode("overwrite").parquet(source.path)
    return "fetched", None


def land_sources(spark: SparkSession, sources: Sequence[Source], fail_on_missing: bool = True) -> DataFrame:
    """Lands every source and returns the manifest, one row per source.

    With ``fail_on_missing`` the first problem raises; without it the problem
    is recorded as ``missing`` or ``failed`` and the next source is tried.
    """
    rows = []
    for source in sources:
        facts: dict = {}
        try:
            status, message = _land(spark, source, fail_on_missing)
            facts = _facts(spark, source.path, source.checksum is not None)
            got = facts.get("checksum")
            if source.checksum and status not in FAILING_STATUSES and (got or "").lower() != source.checksum.lower():
                raise ChecksumError(f"checksum of '{source.name}' is {got}, expected {source.checksum}")
        except Exception as exc:
            if fail_on_missing:
                raise
            status, message = "failed", str(exc)
        rows.append(
            (
                source.name, source.path, source.kind, status, facts.get("n_files"), facts.get("size_bytes"),
                facts.get("checksum"), source.checksum, message, facts.get("ingested_at"),
            )
        )
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def verify_checksums(spark: SparkSession, expected: Mapping[str, str]) -> DataFrame:
    """Path, MD5 and match per expected file (case does not matter). A mismatch raises."""
    if not expected:
        raise ValueError("no checksums given")
    plain = lambda path: F.regexp_replace(path, "^[A-Za-z0-9]+:/*", "/")
    wanted = spark.createDataFrame([(p, m.lower()) for p, m in expected.items()], "file string, expected string")
    found = file_checksums(spark, list(expected))
    rows = found.join(wanted, plain(F.col("path")) == plain(F.col("file"))).drop("file")
    rows = rows.withColumn("matches", F.lower("md5") == F.col("expected"))
    wrong = [r["path"] for r in rows.filter("not matches").limit(5).collect()]
    if wrong:
        raise ChecksumError(f"checksum mismatch: {', '.join(wrong)}")
    return rows


def freshness(manifest: DataFrame, now: Column, max_age_hours: float = MAX_AGE_HOURS) -> DataFrame:
    """One row: sources per status, failing names, hours since the last ingestion, and the verdict.

    Stale when nothing was ingested, the last ingestion is too old, or any
    source is missing or failed.
    """
    status = F.coalesce(F.col("status"), F.lit("unknown"))
    failing = F.col("status").isin(*FAILING_STATUSES)
    summary = manifest.agg(
        *[
            F.count_if(status == s).alias(f"n_{s}")
            for s in ("validated", "cached", "fetched", "missing", "failed", "unknown")
        ],
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(failing, F.col("name"))))).alias("failing_sources"),
        F.max("ingested_at").alias("ingested_at"),
    )
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ingested_at").cast("timestamp"))) / F.lit(3.6e9)
    hours = F.round(age, 2)
    stale = F.col("ingested_at").isNull() | (hours > max_age_hours) | (F.col("failing_sources") != "")
    return summary.withColumns(
        {
            "hours_since_ingestion": hours,
            "stale": stale,
            "freshness": F.when(stale, "stale").otherwise("fresh"),
        }
    )
