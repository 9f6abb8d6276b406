"""Readers of every stage's files, with declared schemas."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import schemas

MARKER = ".crawl_start_time"
JSONL = "*.{jsonl,json,jsonl.gz,json.gz}"  # given files, and those Spark writes


def _jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema + ", _corrupt_record string")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", JSONL).json(path)
    )


def read_marker(spark: SparkSession, raw_dir: str):
    """Start time of the current run in epoch seconds, kept beside the raw folder; None if unreadable."""
    jvm = spark._jvm
    # Spark's readers skip names that begin with a dot
    path = jvm.org.apache.hadoop.fs.Path(raw_dir.rstrip("/").rsplit("/", 1)[0] + "/" + MARKER)
    try:
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
        try:
            return float(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip())
        finally:
            stream.close()
    except (Py4JJavaError, PySparkException, ValueError):
        return None


def scan_raw(spark: SparkSession, path: str, since: float | None = None, slack_s: int = 10):
    """(good, rejects) of all JSON-lines files of a folder, not of its subfolders; blank lines are skipped.

    Rejects hold lines that are not JSON objects of the raw layout or lack a required field.
    `since` keeps the files modified no earlier than slack_s seconds before it.
    """
    rows = _jsonl(spark, path, schemas.RAW).withColumn("_file", F.col("_metadata.file_path"))
    if since is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(
            F.lit(int((since - slack_s) * 1_000_000))))
    complete = F.col("_corrupt_record").isNull()
    for name in schemas.RAW_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    good = rows.where(complete).drop("_corrupt_record").withColumns({
        "content": F.coalesce("content", F.lit("")), "title": F.coalesce("title", F.lit("No Title"))})
    return good, rows.where(~complete)


def raw_counts(spark: SparkSession, path: str) -> DataFrame:
    """Parsed lines per file; lines that are not JSON do not count."""
    # the JSON source must be asked for a column of its own beside the corrupt one
    rows = _jsonl(spark, path, schemas.RAW).where("_corrupt_record IS NULL AND length(coalesce(id, '')) >= 0")
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("total_docs"))


def scan_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """All cleaned files of all runs, with defaults for absent fields."""
    rows = _jsonl(spark, path, schemas.CLEANED).where("_corrupt_record IS NULL AND id IS NOT NULL").drop("_corrupt_record")
    return rows.withColumns({
        "language": F.coalesce("language", F.lit("unknown")),
        "quality_score": F.coalesce("quality_score", F.lit(0.5)),
        "content_length": F.coalesce("content_length", F.lit(0)),
    })


def cleaned_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason, line) of what scan_cleaned leaves out: lines that are no JSON objects, and those without an id."""
    rows = _jsonl(spark, path, schemas.CLEANED).withColumn("file", F.col("_metadata.file_path"))
    fields = F.to_json(F.struct(*[f for f in rows.columns if f not in ("_corrupt_record", "file")]))
    return rows.where("_corrupt_record IS NOT NULL OR id IS NULL").select(
        "file", F.when(F.col("_corrupt_record").isNotNull(), "corrupt").otherwise("no_id").alias("reason"),
        F.coalesce("_corrupt_record", fields).alias("line"))


def silent_shards(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the Parquet files under a shard folder that give scan_shards no row, unreadable or empty."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select(F.col("_metadata.file_path").alias("file"), "length")
    read = scan_shards(spark, path).select(F.col("_metadata.file_path").alias("file")).distinct()
    return files.join(read, "file", "left_anti")


def _any_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a Parquet file; looks no further than the first, so that files are listed once, by the read."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    files = fs.listFiles(root, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def scan_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with split and shard_id; unreadable shard files are skipped, a folder without any is an error."""
    if not _any_parquet(spark, path):
        raise FileNotFoundError(f"no Parquet files under {path}")
    return (
        spark.read.schema(schemas.SHARD + ", split string, shard_id string")
        .option("ignoreCorruptFiles", "true").parquet(path)
    )


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard of a split manifest with the manifest's totals; absent totals are 0."""
    rows = spark.read.schema(schemas.SPLIT_MANIFEST).option("multiLine", True).json(path)
    return rows.select(
        "version",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_shards", "total_documents", "total_tokens")],
        F.explode_outer("shards").alias("shard"),
    ).select("version", "total_shards", "total_documents", "total_tokens", "shard.*")
