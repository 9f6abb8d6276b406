"""Job log kept as an append-only table of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter defaults of a job.
PARAM_DEFAULTS = {
    "raw_dir": "dataset/raw", "output_dir": "dataset", "cleaned_dir": "dataset/cleaned",
    "shards_dir": "dataset/shards", "max_length": 2048, "val_split": 0.05, "max_depth": 3,
}


def job_latest_status(events: DataFrame, jobs: DataFrame | None = None, tie: str = "event_id") -> DataFrame:
    """The last status, progress and message per job; events of unknown jobs are ignored."""
    if jobs is not None:
        events = events.join(jobs.select("job_id").distinct(), "job_id", "left_semi")
    order = F.struct("updated_at", *([tie] if tie in events.columns else []))
    last = events.groupBy("job_id").agg(
        F.max_by(F.struct("status", "progress", "message", "updated_at"), order).alias("last"))
    return last.select("job_id", "last.*")


def jobs_by_recency(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy(F.desc("created_at"), "job_id")


def recent_jobs_topk(jobs: DataFrame, k: int = 10) -> DataFrame:
    return jobs_by_recency(jobs).limit(k)


def job_status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("type", "status").agg(F.count("*").alias("jobs"))


def job_params(jobs: DataFrame, col: str = "params", defaults=PARAM_DEFAULTS) -> DataFrame:
    """One column per parameter, defaults where the JSON has none."""
    kinds = {str: "string", int: "int", float: "double"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in defaults.items())
    parsed = F.from_json(F.col(col), schema)
    return jobs.withColumn("_p", parsed).select(
        *jobs.columns, *[F.coalesce(F.col(f"_p.{n}"), F.lit(v)).alias(n) for n, v in defaults.items()])
