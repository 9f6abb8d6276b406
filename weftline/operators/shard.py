"""Shuffle order, train/validation split and shard numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.rank import BUCKET_DIGITS, ordered_totals, shuffle_key


def shuffle_docs(df: DataFrame, seed=0, id_col: str = "id", digits: int = BUCKET_DIGITS) -> DataFrame:
    """df + rank, the position in a seeded order, and total, the number of rows."""
    return ordered_totals(df, shuffle_key(seed, id_col), id_col, digits=digits).drop("before")


def val_count(val: float):
    # the epsilon keeps 0.05 * 40 at 2 in binary arithmetic
    return F.floor(F.col("total") * F.lit(val) + F.lit(1e-9))


def train_val_split(ranked: DataFrame, val: float = 0.05) -> DataFrame:
    """ranked + split and position: exactly floor(n * val) rows go to val, from the front of the order."""
    n_val = val_count(val)
    in_val = F.col("rank") <= n_val
    return ranked.withColumns({
        "split": F.when(in_val, "val").otherwise("train"),
        "position": F.col("rank") - F.when(in_val, F.lit(0)).otherwise(n_val) - 1,
    })


def shard_name(number):
    return F.format_string("%04d", number)


def docs_per_shard(shard_size_mb=512, bytes_per_doc=2048) -> int:
    return max(1, -(-int(shard_size_mb * 1024 * 1024) // bytes_per_doc))


def assign_shards(split: DataFrame, shard_size_mb: float = 512, bytes_per_doc: int = 2048) -> DataFrame:
    """split + shard_id: each document counts a constant number of bytes; the last shard may be short."""
    number = F.floor(F.col("position") / docs_per_shard(shard_size_mb, bytes_per_doc))
    return split.withColumn("shard_id", shard_name(number))


def assign_shards_by_bytes(df: DataFrame, shard_size_mb: float = 512, size="token_count",
                           bytes_per_unit: int = 8, seed=0, id_col: str = "id",
                           digits: int = BUCKET_DIGITS) -> DataFrame:
    """df + shard_id by the bytes of all documents before each one in the seeded order."""
    weight = (F.col(size) * bytes_per_unit).cast("long")
    ranked = ordered_totals(df, shuffle_key(seed, id_col), id_col, weight, digits)
    number = F.floor(F.col("before") / F.lit(int(shard_size_mb * 1024 * 1024)))
    return ranked.withColumn("shard_id", shard_name(number)).drop("before", "total")


def shard_rows(df: DataFrame) -> DataFrame:
    """The stored columns with their stored types."""
    return df.select(
        F.col("id").alias("doc_id"), F.col("tokens").cast("array<int>"),
        F.col("attention_mask").cast("array<int>"), "language", F.col("quality_score").cast("float"),
        F.col("token_count").cast("int"), "split", "shard_id",
        *([F.col("position")] if "position" in df.columns else []),
    )
