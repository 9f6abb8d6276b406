"""documents through the stages of a training corpus, each written as Parquet and read again by the next.

Texts are shuffled once where rows are joined to their verdicts, which are as many as the rows and never
broadcast; rows are told apart by a number given when a
stage reads them, as ids may repeat or be null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import mixing, packing, quality_rules, secrets_scan, shingle_dedup, simhash_dedup
from weftline.session import passing, scratch_path, settled, staged

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _numbered(docs: DataFrame) -> DataFrame:
    return staged(docs.withColumn("row_number", F.monotonically_increasing_id()), "numbered")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs, _table(spark, sf_dir, "labels"))


def _firsts(rows: DataFrame) -> DataFrame:
    """(row_number) of the row of smallest id (null last) of each group by op1's fingerprints."""
    groups = simhash_dedup.simhash_components(rows, id_col="row_number").select(F.col("doc_id").alias("row_number"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_number")
    first = groups.join(rows.select("row_number", "doc_id"), "row_number").groupBy("component_id").agg(F.min(order).alias("first"))
    return first.select("first.row_number")


def _chosen(rows: DataFrame, numbers: DataFrame, columns: list) -> DataFrame:
    return rows.join(numbers.hint("merge"), "row_number", "left_semi").select(columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By op1's fingerprints: the document of smallest id (null last) of each group; one row of those that repeat."""
    rows = _numbered(docs)
    return _chosen(rows, settled(spark, "firsts", lambda: _firsts(rows)), docs.columns)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash groups first, then what their three bits miss: of the documents left, those stay that no one kept of smaller
    id (null last) resembles, by Jaccard 0.8 or more over five-word shingles. Texts are numbered once; verdicts are numbers."""
    rows = _numbered(docs)
    firsts = settled(spark, "firsts", lambda: _firsts(rows))
    gone = settled(spark, "similar", lambda: shingle_dedup.near_duplicates(rows, among=firsts))
    return _chosen(rows, firsts.join(gone, "row_number", "left_anti"), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked and n_chars to match."""
    texts = docs.withColumn("text", secrets_scan.masked(F.col("text"), by_window=True))
    return texts.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = _numbered(docs)
    taken = settled(spark, "taken", lambda: mixing.mix(rows, carry=("row_number",)).where("copies > 0").select("row_number", "copies"))
    repeated = rows.join(taken.hint("merge"), "row_number").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # fingerprints and token ids have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with passing(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
