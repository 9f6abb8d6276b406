"""Concatenate and cut: documents laid end to end and cut into windows of a fixed number of tokens.

Pass one encodes every document once, into a staged table that holds the tokens before it in its own
partition. Prefix sums over the partitions' totals give every document its global offset. Pass two
cuts: each document knows its windows by itself, so nothing but the totals is shuffled.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.bpe import piece_ids, vocabulary
from weftline.llm.common import id_field, map_rows, texts
from weftline.session import staged

LENGTH = 2048
END_ID = 1
AREA = 1024                    # partitions whose totals are summed by one task
BROADCAST_PARTS = 1_000_000    # partition offsets that travel to every task, 16 bytes each


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(part, doc_id, before, doc_tokens, ids): a document's ids and its place in its partition, staged."""
    src = texts(docs, id_col, text_col, binary=False)

    def run(rows):
        ids, part, before = piece_ids(tokenizer), TaskContext.get().partitionId(), 0
        width = ids.vocab.width
        end = end_id.to_bytes(width, "little")
        for doc_id, text in rows:
            data = ids.encode(text) + end
            n = len(data) // width
            yield part, doc_id, before, n, data
            before += n

    return staged(map_rows(src, run, T.StructType([
        T.StructField("part", T.IntegerType()), id_field(src), T.StructField("before", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])), "tokens")


def part_offsets(rows: DataFrame) -> DataFrame:
    """(part, offset): tokens in all earlier partitions, summed in two levels."""
    sums = rows.groupBy("part").agg(F.sum("doc_tokens").alias("n")).withColumn("area", F.floor(F.col("part") / AREA))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    areas = sums.groupBy("area").agg(F.sum("n").alias("n"))
    areas = areas.select("area", F.coalesce(F.sum("n").over(before.orderBy("area")), F.lit(0)).alias("base"))
    own = F.coalesce(F.sum("n").over(before.partitionBy("area").orderBy("part")), F.lit(0))
    return sums.select("part", "area", own.alias("own")).join(areas, "area").select(
        "part", (F.col("base") + F.col("own")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row a piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, continues).

    A document is its ids and `end_id`. `start` counts its ids before the piece, `offset` the ids before
    it in its sequence; `continues` marks a boundary record, whose document goes on in the next sequence.
    Every sequence but the last is full. Null and empty texts are the end id alone, repeated rows and null
    ids are documents like any other, other columns are ignored, an empty table gives an empty one.
    """
    rows = encoded(docs, tokenizer, end_id, id_col, text_col)
    offsets = staged(part_offsets(rows), "offsets")
    if offsets.count() <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    placed = rows.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("before")).alias("at"), "ids")
    width = vocabulary(tokenizer).width

    def run(batch):
        for doc_id, at, data in batch:
            ids = memoryview(np.frombuffer(data, f"<u{width}").astype("<u4")).cast("B")
            total, start = len(ids) // 4, 0
            while start < total:
                sequence, offset = divmod(at + start, length)
                n = min(length - offset, total - start)
                yield (doc_id, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), total, sequence, offset, start + n < total)
                start += n

    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    return map_rows(placed, run, T.StructType([id_field(placed), *longs, T.StructField("continues", T.BooleanType())]))
