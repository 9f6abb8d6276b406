"""Writers of every stage. All are distributed; a file never passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline import schemas
from weftline.operators import shard, stats
from weftline.session import cut


def _columns(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in their declared types; absent ones NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in StructType.fromDDL(schema).fields
    ])


def write_raw(df: DataFrame, path: str, docs_per_file: int = 10, compression: str = "none") -> None:
    (df.write.mode("append").option("maxRecordsPerFile", docs_per_file).option("compression", compression)
     .option("ignoreNullFields", "false").format("json").save(path))


def write_cleaned(df: DataFrame, path: str) -> None:
    _columns(df, schemas.CLEANED).write.mode("append").option("ignoreNullFields", "false").json(path)


def manifest_projection(df: DataFrame) -> DataFrame:
    return df.select("id", "source", "language", "quality_score",
                     F.col("token_estimate").alias("tokens"), "license", "timestamp")


def write_manifest(df: DataFrame, path: str) -> None:
    manifest_projection(df).write.mode("overwrite").json(path)


def write_stats_csv(df: DataFrame, path: str) -> None:
    """Every document column, text included."""
    flat = _columns(df, schemas.CLEANED).withColumn("tags", F.to_json("tags"))
    (flat.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
     .csv(path))


def write_shards(df: DataFrame, path: str) -> None:
    """One Snappy Parquet file per shard, under split=…/shard_id=…, rows in shuffle order."""
    rows = shard.shard_rows(df).repartition("split", "shard_id")
    order = ["split", "shard_id"] + (["position"] if "position" in rows.columns else [])
    (rows.sortWithinPartitions(*order).drop("position").write.mode("overwrite")
     .partitionBy("split", "shard_id").option("compression", "snappy").parquet(path))


def shard_meta(df: DataFrame, path: str, created_at: str) -> DataFrame:
    """Per written shard: totals, languages, mean quality and file size."""
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select("path", "length")
    part = r"split=([^/]+)/shard_id=([^/]+)/"
    sizes = files.groupBy(
        F.regexp_extract("path", part, 1).alias("split"), F.regexp_extract("path", part, 2).alias("shard_id")
    ).agg((F.sum("length") / float(1024 * 1024)).alias("file_size_mb"))
    return stats.shard_stats(df).join(sizes, ["split", "shard_id"]).select(
        "split", "shard_id", F.col("documents").alias("total_documents"), F.col("tokens").alias("total_tokens"),
        F.col("languages").alias("language_distribution"), F.col("avg_quality").alias("avg_quality_score"),
        F.lit(created_at).alias("created_at"), "file_size_mb")


def write_shard_meta(df: DataFrame, path: str, out: str, created_at: str) -> None:
    shard_meta(df, path, created_at).write.mode("overwrite").partitionBy("split").json(out)


def write_split_manifest(df: DataFrame, path: str, created_at: str, version: str = "1.0") -> None:
    """One JSON object per split; its shard list grows with the shard count only."""
    shards = stats.shard_stats(df).withColumn("created_at", F.lit(created_at))
    entry = F.struct("shard_id", "documents", "tokens", "languages", "avg_quality", "created_at")

    def by_id(a, b):
        return F.signum(a["shard_id"].cast("long") - b["shard_id"].cast("long")).cast("int")

    manifest = shards.groupBy("split").agg(
        F.lit(version).alias("version"), F.lit(created_at).alias("created_at"),
        F.count("*").alias("total_shards"), F.sum("documents").alias("total_documents"),
        F.sum("tokens").alias("total_tokens"), F.array_sort(F.collect_list(entry), by_id).alias("shards"))
    manifest.write.mode("overwrite").partitionBy("split").json(path)


# -- tables ---------------------------------------------------------------------------------------

TABLES = {"documents": schemas.DOCUMENTS_TABLE, "jobs": schemas.JOBS_TABLE,
          "dataset_versions": schemas.VERSIONS_TABLE}
KEYS = {"documents": "id", "jobs": "id", "dataset_versions": "version"}
LAYOUT = {"documents": ["language"], "jobs": ["status"], "dataset_versions": []}


def table_rows(df: DataFrame, table: str) -> DataFrame:
    return _columns(df, TABLES[table])


def insert_absent(df: DataFrame, table: str, path: str) -> DataFrame:
    """Append the rows whose key the table does not hold yet; returns the whole table.

    Filtered columns become folders (language, status) or sort order (domain), in place of indexes.
    """
    spark = df.sparkSession
    key, layout = KEYS[table], LAYOUT[table]
    rows = table_rows(df, table)
    rows = rows.dropDuplicates([key])
    target = spark.read.schema(TABLES[table])
    if table_exists(spark, path):
        rows = cut(rows.join(target.parquet(path).select(key), key, "left_anti"))
    writer = rows.sortWithinPartitions("domain") if "domain" in rows.columns else rows
    writer.write.mode("append").partitionBy(*layout).parquet(path)
    return target.parquet(path)


def table_exists(spark, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_stream_output(spark, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """What a stream has written; no rows where it found nothing to write."""
    return spark.read.schema(schema).format(fmt).load(path) if table_exists(spark, path) else spark.createDataFrame([], schema)
