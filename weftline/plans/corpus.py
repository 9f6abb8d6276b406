"""End-to-end plans: raw documents to a cleaned corpus, cleaned corpus to training shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions import sketch, text as T
from weftline.operators import dedup, filters, shard, tokenize
from weftline.operators.language import load_profiles
from weftline.session import staged


@dataclass(frozen=True)
class Cleaned:
    documents: DataFrame  # the surviving documents in the cleaned layout
    verdicts: DataFrame   # every input document's id, scores and reason, without its text


def record_key():
    """Order and identity of a raw record: equal keys mean copies of one record.

    The id alone holds 32 bits of the URL's hash and repeats in a large corpus.
    """
    return F.concat_ws("\x1f", "timestamp", "url", "id", T.content_hash(F.coalesce("content", F.lit(""))))


def clean_corpus(raw: DataFrame, profiles, cfg: Config = Config(), order_by: str | None = None,
                 detector=None, scorer=None) -> Cleaned:
    """Filter, score, remove duplicates and clean.

    The texts are read map-only to judge each document; what is staged and shuffled afterwards is a
    narrow row per document. Only the survivors' texts are read again for the output. Of equal
    documents the first by `order_by` survives, a column that is unique; by default the record key.
    """
    if isinstance(profiles, DataFrame):
        profiles = load_profiles(profiles)
    if order_by is None:
        raw, order_by = raw.withColumn("record", record_key()), "record"
    judged = filters.annotate_reason(raw, profiles, cfg, detector, scorer)
    todo = F.when(F.col("reason").isNull(), F.col("content"))
    narrow = judged.select(
        order_by, *(c for c in ("id", "source") if c in judged.columns and c != order_by), "reason", "language",
        "language_confidence", "quality_score", "content_length",
        T.content_hash(todo).alias("text_hash"),
        F.when(F.col("reason").isNull(), sketch.fuzzy_hash(sketch.minhash_signature(
            todo, cfg.deduplication.num_perm))).alias("duplicate_hash"))
    verdicts = staged(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("copies")), "verdicts")
    kept = dedup.keep_first(verdicts.where("reason IS NULL"), F.col("text_hash"), order_by)
    if cfg.deduplication.mode == "signature":
        kept = dedup.keep_first(kept, F.col("duplicate_hash"), order_by)
    elif cfg.deduplication.mode == "lsh":
        texts = raw.select(order_by, T.strip("content").alias("content")).join(
            kept.select(order_by), order_by, "left_semi")
        kept = kept.join(dedup.near_dup_pairs(texts, cfg.deduplication.fuzzy_threshold, order_by=order_by)
                         .select(F.col("b").alias(order_by)), order_by, "left_anti")
    elif cfg.deduplication.mode != "exact":
        raise ValueError(f"unknown dedup mode: {cfg.deduplication.mode}")
    kept = staged(kept, "kept")
    fresh = F.col("_kept").isNotNull() & (F.col("_copy") == 1)
    final = (
        verdicts.join(kept.select(order_by, F.lit(True).alias("_kept")), order_by, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .withColumn("reason", F.when(F.col("reason").isNull() & ~fresh, "duplicate").otherwise(F.col("reason")))
        .drop("_kept", "_copy", "copies", "text_hash")
    )
    scores = kept.select(order_by, "language", "language_confidence", "quality_score", "duplicate_hash")
    body = T.strip("content")
    documents = raw.join(scores, order_by).select(
        *([order_by] if order_by != "id" else []),
        "id", F.col("url").alias("original_url"), "domain", "title",
        T.clean_content(body).alias("content"), "language", "language_confidence", "quality_score",
        F.length(body).alias("content_length"), T.estimate_tokens(body).alias("token_estimate"),
        "content_hash", "duplicate_hash", "timestamp", F.lit("web_crawl").alias("source"),
        F.lit("unknown").alias("license"), F.array().cast("array<string>").alias("tags"))
    if not kept.where("copies > 1").isEmpty():
        documents = documents.dropDuplicates([order_by])
    return Cleaned(documents, final)


def shard_corpus(cleaned: DataFrame, tokenizer, cfg: Config = Config(), by_bytes: bool = False) -> DataFrame:
    """Tokenized rows with split, position and shard_id, ready for write_shards.

    Tokens are computed once and staged; ranking then reads the ids alone.
    """
    s = cfg.shards
    coded = staged(
        tokenize.tokenize(cleaned, tokenizer, s.max_length, s.min_tokens)
        .select("id", "tokens", "attention_mask", "token_count", "language", "quality_score"), "tokens")
    split = shard.train_val_split(shard.shuffle_docs(coded, s.seed), s.val_split)
    return shard.assign_shards(split, s.shard_size_mb, s.bytes_per_doc)
