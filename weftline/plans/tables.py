"""The given tables in the layouts the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = "2024-01-01T00:00:00"
RUN_UNIX = 1704067200


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a stream of its files, be it one file or a folder of parts."""
        # as a pattern: a plain path would have to be a folder
        return self.spark.readStream.schema(getattr(self, name).schema).parquet(f"{self.folder}/{{{name}}}.parquet")

    @property
    def texts(self) -> DataFrame:
        return self.documents

    @property
    def html(self) -> DataFrame:
        return self.pages

    @property
    def raw(self) -> DataFrame:
        """documents as raw records; ord is the unique reading order."""
        d = self.texts
        domain = F.concat("source", F.lit(".example.com"))
        return d.select(
            F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"),
            F.concat(F.lit("https://"), domain, F.lit("/"), F.col("doc_id")).alias("url"),
            domain.alias("domain"), F.lit("No Title").alias("title"), F.col("text").alias("content"),
            F.length("text").alias("content_length"), F.lit(0).alias("links_found"), F.lit(0).alias("depth"),
            F.lit(200).alias("status_code"), F.lit(RUN_TS).alias("timestamp"),
            F.sha2("text", 256).alias("content_hash"), F.array().cast("array<string>").alias("links"),
            "source", "lang")

    @property
    def job_events(self) -> DataFrame:
        """events as a job log: a user is a job, an event one status change."""
        return self.job_events_of(self.events)

    @staticmethod
    def job_events_of(events: DataFrame) -> DataFrame:
        kind = F.element_at(F.array(F.lit("crawl"), F.lit("process"), F.lit("tokenize")),
                            (F.col("user_id") % 3 + 1).cast("int"))
        status = (F.when(F.col("event_type") == "signup", "queued").when(F.col("event_type") == "purchase", "completed")
                  .when(F.col("event_type") == "error", "failed").otherwise("running"))
        return events.select(
            "event_id", F.concat(F.lit("job_"), F.col("user_id")).alias("job_id"), kind.alias("type"),
            status.alias("status"), F.least(F.col("value") / 100.0, F.lit(1.0)).alias("progress"),
            F.col("event_type").alias("message"), F.col("ts").alias("updated_at"), F.col("props").alias("params"))

    @property
    def jobs(self) -> DataFrame:
        """One row per job with its creation time and last status."""
        last = F.max_by(F.struct("status", "progress", "message"), F.struct("updated_at", "event_id"))
        return self.job_events.groupBy("job_id", "type").agg(
            F.min("updated_at").alias("created_at"), F.max("updated_at").alias("updated_at"), last.alias("last")
        ).select("job_id", "type", "last.*", "created_at", "updated_at")
