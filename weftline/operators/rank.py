"""Exact ranks and running sums over a whole table without a one-partition window.

Rows are spread over buckets by the leading hex digits of a hash of their key. Bucket totals are
summed up in two levels, so no task sees more than a few thousand of them, and give each bucket its
offset. The rows are shuffled once, by bucket: the join with the offsets and the window inside a
bucket share that exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 5  # about a million buckets, several per shuffle partition at any size
COARSE_DIGITS = 3


def shuffle_key(seed, id_col: str = "id"):
    """Seeded order that every engine reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def ordered_totals(df: DataFrame, key, id_col: str = "id", weight=None,
                   digits: int = BUCKET_DIGITS) -> DataFrame:
    """df + rank (1-based), total rows and, with a weight, the weight of all rows before this one.

    `key` must be hex text that is evenly spread, such as a hash of a unique id. The input is read
    twice, the first time only for the id (and weight).
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    keyed = df.withColumns({"_key": key, "_weight": weight})
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, digits))
    return (
        keyed.join(_offsets(keyed, min(COARSE_DIGITS, digits)), "_bucket")
        .withColumns({
            "rank": F.col("_rows_before") + F.row_number().over(_inside(id_col)),
            "before": F.col("_sum_before") + _so_far("_weight", _inside(id_col)),
        })
        .drop("_key", "_weight", "_bucket", "_rows_before", "_sum_before")
    )


def _inside(id_col: str):
    return Window.partitionBy("_bucket").orderBy("_key", id_col)


def _so_far(col: str, window):
    """Sum over the rows before this one."""
    return F.coalesce(F.sum(col).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _offsets(keyed: DataFrame, coarse: int) -> DataFrame:
    """(_bucket, _rows_before, _sum_before, total): what lies before each bucket."""
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_rows"), F.sum("_weight").alias("_sum")).withColumn(
        "_area", F.substring("_bucket", 1, coarse))
    areas = sizes.groupBy("_area").agg(F.sum("_rows").alias("_rows"), F.sum("_sum").alias("_sum"))
    # at most 16 ** coarse rows pass through this window
    in_all = Window.orderBy("_area")
    areas = areas.select(
        "_area", _so_far("_rows", in_all).alias("_area_rows"), _so_far("_sum", in_all).alias("_area_sum"),
        F.sum("_rows").over(Window.partitionBy()).alias("total"))
    in_area = Window.partitionBy("_area").orderBy("_bucket")
    return sizes.join(areas, "_area").select(
        "_bucket",
        (F.col("_area_rows") + _so_far("_rows", in_area)).alias("_rows_before"),
        (F.col("_area_sum") + _so_far("_sum", in_area)).alias("_sum_before"),
        "total",
    )


def top_per_group(df: DataFrame, by, order, k: int, salt_on: str, salts: int = 1024) -> DataFrame:
    """The first k rows of each group in a given order.

    Every group is first cut to k rows within each of `salts` slices, on the map side already for
    k up to 1000, so a group holding a third of the table is never sorted by one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = order if isinstance(order, (list, tuple)) else [order]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)))
    near = Window.partitionBy(*by, "_salt").orderBy(*order)
    final = Window.partitionBy(*by).orderBy(*order)
    return (
        salted.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= k)
        .withColumn("_n", F.row_number().over(final)).where(F.col("_n") <= k)
        .drop("_n", "_salt")
    )
