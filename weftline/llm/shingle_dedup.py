"""Near-duplicates by the Jaccard similarity of word shingles: MinHash bands for candidates, exact sets for the verdict.

32 bands of 4 values miss a pair at 0.8 with probability 5e-8. A 64-bit SimHash would need a radius of
about 16 bits for such pairs, within which a share of 4e-5 of all unlike pairs falls too. Rows are walked
as in operators.dedup: a row goes if it is similar to an earlier one that stays.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.sketch import PRESETS, _signatures
from weftline.llm.common import id_field, map_rows
from weftline.operators import dedup
from weftline.session import staged

SHINGLE = 5       # words a shingle
SIMILAR = 0.8     # least Jaccard similarity of near-duplicates
SEED = 42
BANDS, VALUES = PRESETS["recall"]


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles; A-Z count as a-z, a text of fewer words, or none, is one shingle."""
    words = text.lower().split()
    total = max(1, len(words) - size + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((digest(join(words[i:i + size]), SEED) for i in range(total)), np.uint64, total)).view(np.int64)


def _keys(hashes: np.ndarray) -> list:
    values = _signatures([hashes], BANDS * VALUES)[0].reshape(BANDS, VALUES)
    return [xxhash.xxh64_intdigest(band.tobytes(), i) - (1 << 63) for i, band in enumerate(values)]


def near_duplicates(rows: DataFrame, number_col: str = "row_number", id_col: str = "doc_id", text_col: str = "text",
                    among: DataFrame | None = None) -> DataFrame:
    """(row_number) of the rows to drop: those similar to a row that stays, of a smaller id (null last) or number.

    Of the rows, only those of the numbers (row_number) of `among` take part, if it is given.
    `number_col` is unique. Equal shingle sets are folded by hash first. Null texts are empty; texts
    without words equal each other; an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    src = rows.select(F.col(number_col).alias("row_number"), F.col(id_col).alias("doc_id"), text.alias("text"))
    number = T.StructField("row_number", T.LongType())

    def keyed(batch):
        for row, doc_id, text in batch:
            found = shingles(text)
            yield row, doc_id, xxhash.xxh3_128_digest(found.tobytes()), _keys(found)

    none = F.lit("" if isinstance(src.schema["doc_id"].dataType, T.StringType) else 0).cast(src.schema["doc_id"].dataType)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", none).alias("id"), "row_number")
    keys = map_rows(src, keyed, T.StructType([
        number, id_field(src), T.StructField("set_hash", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]))
    if among is not None:
        keys = keys.join(among.hint("merge"), "row_number", "left_semi")
    keys = staged(keys, "shingle-keys").select(order.alias("ord"), "set_hash", "keys")
    members = dedup._members(keys)

    def sets(batch):
        for row, doc_id, text in batch:
            yield row, doc_id, shingles(text).tolist()

    wanted = src.join(members.select("ord.row_number").distinct().hint("merge"), "row_number", "left_semi")
    features = map_rows(wanted, sets, T.StructType([
        number, id_field(src), T.StructField("feature", T.ArrayType(T.LongType()))])).select(order.alias("ord"), "feature").repartition(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ord")
    gone = dedup.similar_sets_gone(members, features, SIMILAR)
    same = keys.groupBy("set_hash").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = keys.select("ord", "set_hash").join(same, "set_hash").where("ord <> first")
    return gone.select("ord.row_number").union(copies.select("ord.row_number"))
