"""Structured Streaming forms of the cleaning steps."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import schemas
from weftline.config import Config
from weftline.functions import text as T
from weftline.operators import filters
from weftline.sources.readers import JSONL


def read_stream(spark: SparkSession, path: str, fmt: str = "json", schema: str = schemas.RAW,
                glob: str = JSONL, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def clean_rows(df: DataFrame, cfg: Config = Config(), profiles: dict | None = None) -> DataFrame:
    """Stateless part of cleaning: length tests and, with language profiles, all tests of one document; cleaned content, token estimate."""
    judged = filters.with_length_reason(df, cfg) if profiles is None else filters.annotate_reason(df, profiles, cfg)
    kept = judged.where("reason IS NULL").drop("reason")
    return kept.withColumns({"token_estimate": T.estimate_tokens("content"), "content": T.clean_content("content")})


PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


@contextmanager
def _plain_files(spark: SparkSession):
    """A query started inside writes no checksum file beside each file of a local folder; other file systems have none.

    Without Hadoop's native library each file and each checksum file costs a process that sets its mode.
    """
    before = {name: spark.conf.get(name, None) for name in PLAIN_FILES}
    for name, value in PLAIN_FILES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stream_ingest_clean(sdf: DataFrame, out: str, checkpoint: str, cfg: Config = Config(),
                        docs_per_file: int | None = None, trigger: dict | None = None, profiles: dict | None = None):
    """Clean each arriving file and append it, exactly once, as Parquet; returns the running query."""
    writer = clean_rows(sdf, cfg, profiles).writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint)
    if docs_per_file:
        writer = writer.option("maxRecordsPerFile", docs_per_file)
    return writer.trigger(**(trigger or {"availableNow": True})).start(out)


def periodic_flush(sdf: DataFrame, out: str, checkpoint: str, docs_per_file: int = 10, interval: str | None = None):
    """Arriving documents in files of a few rows, on an interval or until the input is used up."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with _plain_files(sdf.sparkSession):
        return (
            sdf.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", docs_per_file).trigger(**trigger).start(out)
        )


def stream_dedup(sdf: DataFrame, ts: str | None = None, watermark: str | None = None,
                 keys=("content_hash",)) -> DataFrame:
    """First arrival per key. With a watermark the state is bounded and later copies may pass again."""
    if watermark:
        return sdf.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))
    return sdf.dropDuplicates(list(keys))


def metrics_window(df: DataFrame, ts: str = "ts", reason: str = "reason", width: str = "10 seconds",
                   watermark: str | None = None) -> DataFrame:
    """Counts per reason and tumbling window, for streams and for batches alike.

    A watermark needs instants: times without a zone are taken in the session's, and given back without one.
    """
    kind = df.schema[ts].dataType
    if watermark:
        df = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return df.groupBy(F.window(ts, width), reason).agg(F.count("*").alias("docs")).select(
        F.col("window.start").cast(kind).alias("window_start"), reason, "docs")


def stream_metrics(sdf: DataFrame, out: str, checkpoint: str, watermark: str, ts: str = "ts", reason: str = "reason",
                   width: str = "10 seconds", trigger: dict | None = None):
    """Append each window once, as Parquet, when the watermark has passed its end; returns the running query.

    Rows that come after their window is out are dropped; `late_rows` tells how many.
    """
    windows = metrics_window(sdf, ts, reason, width, watermark)
    return windows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start(out)


def late_rows(query) -> int:
    """Rows that a query's stateful operators dropped behind the watermark, over the progress it still holds.

    Spark counts them after the partial aggregation: late rows of one task, window and reason are one.
    """
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
