"""Corpus statistics, each one aggregation with map-side combine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weftline.operators.rank import shuffle_key, top_per_group


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One row out of several one-row tables, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def corpus_stats(df: DataFrame, by: str = "source") -> DataFrame:
    """Documents per file and in all (NULL), by outcome. df has a reason column."""
    def count(condition, name):
        return F.count_if(condition).alias(name)

    reason = F.col("reason")
    return df.rollup(by).agg(
        F.count("*").alias("total_docs"),
        count(reason.isNull(), "processed_docs"),
        count(reason.isNotNull(), "filtered_docs"),
        count(reason == "duplicate", "duplicate_docs"),
        count(reason.isin("unsupported_language", "low_language_confidence"), "language_filtered"),
        count(reason == "low_quality", "quality_filtered"),
    )


def filter_counts_by_reason(df: DataFrame) -> DataFrame:
    return df.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("docs"))


def quality_histogram(df: DataFrame, bins: int = 10, col: str = "quality_score") -> DataFrame:
    """Documents per equal slice of [0, 1]; a score of 1 counts in the last slice."""
    slot = F.least(F.floor(F.col(col) * bins), F.lit(bins - 1)).cast("int")
    return df.where(F.col(col).isNotNull()).groupBy(slot.alias("bin")).agg(F.count("*").alias("docs"))


def language_distribution(df: DataFrame, by=None) -> DataFrame:
    """One map language -> documents, for the table or per group."""
    by = [by] if isinstance(by, str) else list(by or ())
    counts = df.groupBy(*by, "language").agg(F.count("*").alias("n"))
    entries = F.array_sort(F.collect_list(F.struct("language", "n")))
    return counts.groupBy(*by).agg(F.map_from_entries(entries).alias("languages"))


def shard_stats(df: DataFrame) -> DataFrame:
    """Per shard: documents, tokens, languages and mean quality."""
    keys = ["split", "shard_id"]
    # one pass: counts per language first, then the few languages of each shard
    part = df.groupBy(*keys, "language").agg(
        F.count("*").alias("n"), F.sum("token_count").alias("t"), F.sum(F.col("quality_score").cast("double")).alias("q"))
    return part.groupBy(*keys).agg(
        F.sum("n").alias("documents"), F.sum("t").alias("tokens"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "n")))).alias("languages"),
        F.coalesce(F.sum("q") / F.sum("n"), F.lit(0.0)).alias("avg_quality"),
    )


def split_manifest(df: DataFrame) -> DataFrame:
    shards = df.groupBy("split", "shard_id").agg(F.count("*").alias("n"), F.sum("token_count").alias("t"))
    return shards.groupBy("split").agg(
        F.count("*").alias("total_shards"), F.sum("n").alias("total_documents"), F.sum("t").alias("total_tokens"))


def token_stats(df: DataFrame) -> DataFrame:
    """One row: documents, tokens, mean length, languages and shards of each split."""
    part = df.groupBy("split", "shard_id", "language").agg(F.count("*").alias("n"), F.sum("token_count").alias("t"))
    shards = part.select("split", "shard_id").distinct().agg(
        F.count_if(F.col("split") == "train").alias("train_shards"),
        F.count_if(F.col("split") == "val").alias("val_shards"))
    langs = part.groupBy("language").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    docs = langs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs"), F.coalesce(F.sum("t"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.try_divide(F.sum("t"), F.sum("n")), F.lit(0.0)).alias("avg_doc_length"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "n")))).alias("language_dist"))
    return side_by_side(docs, shards)


def dataset_summary(df: DataFrame, versions: DataFrame, backups: DataFrame) -> DataFrame:
    """One row: documents and tokens by split and in all, current version and version count.

    The current version is the last created one, else the greatest backup name, else N/A.
    """
    def both(split):
        on = F.col("split") == split
        return [F.count_if(on).alias(f"{split}_documents"),
                F.coalesce(F.sum(F.when(on, F.col("token_count"))), F.lit(0)).alias(f"{split}_tokens")]

    counts = df.agg(*both("train"), *both("val"))
    known = versions.agg(F.max_by("version", "created_at").alias("_v"), F.count("*").alias("_nv"))
    saved = backups.agg(F.max("name").alias("_b"), F.count("*").alias("_nb"))
    return side_by_side(counts, known, saved).select(
        F.coalesce("_v", "_b", F.lit("N/A")).alias("current_version"),
        F.greatest("_nv", "_nb").alias("total_versions"),
        (F.col("train_documents") + F.col("val_documents")).alias("total_documents"),
        (F.col("train_tokens") + F.col("val_tokens")).alias("total_tokens"),
        "train_documents", "train_tokens", "val_documents", "val_tokens",
    )


def filter_rate(raw, kept):
    """Share of documents removed, in percent with one decimal; NULL without documents."""
    raw, kept = (F.col(c) if isinstance(c, str) else c for c in (raw, kept))
    return F.round(F.try_divide((raw - kept) * F.lit(100.0), raw), 1)


def domain_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("domain").agg(F.count("*").alias("docs"), F.avg("quality_score").alias("avg_quality"))


def balance_cap(df: DataFrame, by="domain", k: int = 1000, seed=0, id_col: str = "id") -> DataFrame:
    """At most k documents per group, the first ones in a seeded order."""
    keyed = df.withColumn("_key", shuffle_key(seed, id_col))
    return top_per_group(keyed, by, ["_key", id_col], k, id_col).drop("_key")


def sample_documents(df: DataFrame, n: int, seed=0, id_col: str = "id") -> DataFrame:
    """The first n documents in a seeded order."""
    return df.orderBy(shuffle_key(seed, id_col), id_col).limit(n)


def throughput(df: DataFrame, name: str = "throughput", **counters):
    """(df, observation): counts taken while df runs, e.g. docs=F.count('*')."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counters.items()]), seen
