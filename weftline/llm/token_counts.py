"""Exact token counts by prefix dynamic programming: totals, limits and cuts without a second encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.bpe import piece_counts
from weftline.llm.common import id_field, map_rows, texts

LIMIT = 1024


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, limit_bytes) for every row of docs.

    `tokenizer` is the path of a byte-level BPE .json file. Counts equal the library's for the whole
    text, without begin, end or added special tokens; a special token's string inside a text is one
    token. limit_bytes is what the first `limit` tokens cover. Null texts are empty (0 tokens), null ids
    and repeated rows stay, other columns are ignored and an empty table gives an empty one.
    """
    src = texts(docs, id_col, text_col, binary=False)

    def run(rows):
        counts = piece_counts(tokenizer)
        for doc_id, text in rows:
            n, size = counts.total(text), len(text.encode())
            yield doc_id, size, n, n > limit, counts.cut(text, limit) if n > limit else size

    return map_rows(src, run, T.StructType([
        id_field(src), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()), T.StructField("limit_bytes", T.LongType())]))
