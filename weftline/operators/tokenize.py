"""Word vocabulary and token arrays."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.session import small_batches

# Special tokens, in id order.
SPECIALS = ("<pad>", "<unk>", "<bos>", "<eos>")
MAX_VOCAB = 1_000_000


def build_vocab(df: DataFrame, size: int = 32_000, specials=SPECIALS, col: str = "content") -> DataFrame:
    """(token, token_id, n): the specials, then the most frequent words; ties by code point.

    Words are counted with map-side combine; only the `size` leading words are ever brought
    together to be numbered.
    """
    if size > MAX_VOCAB:
        raise ValueError(f"a vocabulary holds at most {MAX_VOCAB} tokens")
    counts = df.select(F.explode(T.words(col)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    room = size - len(specials)
    top = counts.orderBy(F.desc("n"), "token").limit(room)
    packed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "token"))).alias("rows"))
    words = packed.select(F.posexplode("rows").alias("pos", "row")).select(
        F.col("row.token").alias("token"),
        (F.col("pos") + len(specials)).cast("int").alias("token_id"),
        (-F.col("row.neg")).alias("n"),
    )
    fixed = df.sparkSession.createDataFrame(
        [(s, i, 0) for i, s in enumerate(specials)], "token string, token_id int, n bigint")
    return fixed.unionByName(words)


def word_vocab(vocab: DataFrame, unk: str = "<unk>"):
    """Tokenizer over a vocabulary table: array<string> of words to array<int>, in Arrow batches."""
    table = vocab.select("token", "token_id").limit(MAX_VOCAB + 1).toPandas()
    if len(table) > MAX_VOCAB:
        raise ValueError(f"a vocabulary holds at most {MAX_VOCAB} tokens")
    known = pa.array(table["token"], pa.string())
    ids = pa.array(table["token_id"], pa.int32())
    other = int(dict(zip(table["token"], table["token_id"]))[unk])

    def encode(words: pa.Array) -> pa.Array:
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        flat = pc.take(ids, pc.index_in(words.flatten(), value_set=known))
        lengths = pc.fill_null(pc.list_value_length(words), 0)
        ends = pc.cumulative_sum(lengths)
        offsets = pa.concat_arrays([pa.array([0], ends.type), ends])
        return pa.ListArray.from_arrays(offsets.cast(pa.int32()), pc.fill_null(flat, other))

    udf = F.arrow_udf(encode, "array<int>").asNondeterministic()  # not repeated for a filter above it

    def tokenizer(content, max_length: int):
        return udf(F.slice(T.words(content), 1, max_length))

    return tokenizer


def tokenize(df: DataFrame, tokenizer, max_length: int = 2048, min_tokens: int = 10,
             col: str = "content") -> DataFrame:
    """df + tokens, attention_mask, token_count, without empty and very short documents. Map-only.

    `tokenizer(content, max_length)` is a Column function giving array<int>.
    """
    small_batches(df.sparkSession)
    ready = df.withColumn("_text", T.strip(F.coalesce(F.col(col), F.lit("")))).where("_text <> ''")
    coded = ready.withColumn("tokens", F.slice(tokenizer(F.col("_text"), max_length), 1, max_length)).drop("_text")
    return coded.where(F.size("tokens") >= min_tokens).withColumns({
        "attention_mask": attention_mask("tokens"), "token_count": F.size("tokens")})


def attention_mask(tokens, length: int | None = None):
    """1 per token; with a length, 0 for each missing position."""
    n = F.size(T.col(tokens))
    ones = F.array_repeat(F.lit(1), n if length is None else F.least(n, F.lit(length)))
    return ones if length is None else F.concat(
        ones, F.array_repeat(F.lit(0), F.greatest(F.lit(length) - n, F.lit(0))))


def pad_truncate(df: DataFrame, max_length: int = 2048, pad_id: int = 0) -> DataFrame:
    def fit(c, fill):
        gap = F.greatest(F.lit(max_length) - F.size(c), F.lit(0))
        return F.concat(F.slice(c, 1, max_length), F.array_repeat(F.lit(fill), gap))

    return df.withColumns({"tokens": fit("tokens", pad_id), "attention_mask": fit("attention_mask", 0)})


def training_view(df: DataFrame) -> DataFrame:
    return df.select(F.col("tokens").alias("input_ids"), "attention_mask", F.col("tokens").alias("labels"))
