"""Exact top-k by inner product as a Voronoi kNN join.

Integer vectors get one more coordinate that gives every row the same length, so the highest inner
products are the smallest distances. Rows and queries are grouped by pivots. The rows' distances to
their pivots, summed up by cell, bound each query's k-th distance; a query is copied only to the cells
that may hold a row within it, and blocks of a cell are solved locally. Bounds are floats with slack,
scores exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.rank import top_per_group
from weftline.session import staged

PIVOTS = 64
BLOCK = 4096
LONG = (-(1 << 63), (1 << 63) - 1)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) as whole doubles; rows without an id or with a bad component are left out."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: _floor(x * scale))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(F.col(id_col).alias("vec_id"), whole.alias("v"))


def _floor(x):
    """floor as a double, also beyond the range of long."""
    return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)


def _matrix(column, dims: int) -> np.ndarray:
    """List arrays as rows of equal length; shorter vectors end in zeros."""
    if isinstance(column, pa.Array):
        values, offsets = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
        if (offsets == dims).all():
            return values.reshape(-1, dims)
        column = column.to_pylist()
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 2**53 by whole numbers, kept within the range of long."""
    if queries.size == 0 or rows.size == 0:
        return np.zeros((len(queries), len(rows)), np.int64)
    if np.abs(queries).max() * np.abs(rows).max() * rows.shape[1] < 2.0 ** 53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(queries) @ exact(rows).T, *LONG).astype(np.int64)


def knn_join(rows: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query among all rows with another id.

    Queries are the rows whose id is divisible by `every`; ties go to the smaller id; fewer than k other
    rows give fewer results. Vectors that are null or hold null or non-finite components and rows without
    an id take no part; shorter vectors count as ending in zeros; a repeated row is a row of its own, and
    results of a repeated query id are those of its distinct vectors, ranked together. Other columns are
    ignored; an empty table gives an empty one. `pivots` rows, chosen by a hash of the id, shape the cells;
    results do not depend on them.
    """
    spark = rows.sparkSession
    own = staged(integer_vectors(rows, id_col, vector_col), "vectors")
    id_type = own.schema["vec_id"].dataType.simpleString()
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    reach, dims = own.agg(F.max(norm), F.max(F.size("v"))).first()
    if not dims:
        dims, reach = 1, reach or 0.0
    centre_rows = own.orderBy(F.xxhash64("vec_id"), "vec_id", F.hash("v")).limit(pivots).collect()
    if not centre_rows:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score long")
    centres = _matrix([r["v"] for r in centre_rows], dims)
    lift = np.sqrt(np.maximum(reach - (centres ** 2).sum(1), 0))

    def far(v, extra):
        """Distances to the pivots; rounding can only make them a little wrong, which the slack covers."""
        square = (v ** 2).sum(1)[:, None] + extra[:, None] ** 2 + reach - 2 * (v @ centres.T + np.outer(extra, lift))
        return np.sqrt(np.maximum(square, 0))

    def assign(batches):
        for batch in batches:
            v = _matrix(batch.column(1), dims)
            d = far(v, np.sqrt(np.maximum(reach - (v ** 2).sum(1), 0)))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(v)), cell]), *batch.columns],
                                             names=["cell", "dist", "vec_id", "v"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BLOCK)
    data = staged(own.mapInArrow(assign, f"cell int, dist double, vec_id {id_type}, v array<double>"), "cells")
    # summaries: at most `pivots` rows, and k + 1 near rows of different ids for each
    cells = data.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()
    ids = data.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    near = top_per_group(ids, "cell", ["dist", "vec_id"], k + 1, "vec_id").select("cell", "dist", "vec_id").collect()
    near_cell, near_dist, near_id = (np.array([r[n] for r in near]) for n in ("cell", "dist", "vec_id"))
    cell_ids = np.array([r["cell"] for r in cells])
    low, high = np.array([r["low"] for r in cells]), np.array([r["high"] for r in cells])
    slack = 1e-6 * (1 + np.sqrt(reach))

    def route(batches):
        """Each query to the cells that may hold one of its k nearest rows."""
        for batch in batches:
            v = _matrix(batch.column(1), dims)
            if not len(v):
                continue
            d = far(v, np.zeros(len(v)))
            bound = d[:, near_cell] + near_dist
            # rows of the query's own id are no results, whichever cells they are in
            bound[batch.column(0).to_numpy(zero_copy_only=False)[:, None] == near_id] = np.inf
            limit = np.partition(bound, k - 1, axis=1)[:, k - 1] if bound.shape[1] >= k else np.full(len(v), np.inf)
            gap = np.maximum(d[:, cell_ids] - high, low - d[:, cell_ids])
            q, c = np.nonzero(gap <= (limit * (1 + 1e-9) + slack)[:, None])
            yield pa.RecordBatch.from_arrays([pa.array(cell_ids[c].astype(np.int32)), batch.column(0).take(pa.array(q)), batch.column(1).take(pa.array(q))],
                                             names=["cell", "vec_id", "v"])

    # a repeated query row asks the same question
    asked = staged(own.where(F.col("vec_id") % every == 0).distinct().mapInArrow(route, f"cell int, vec_id {id_type}, v array<double>"), "queries")
    q_blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q_blocks"))
    d_blocks = data.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("d_blocks"))
    blocks = staged(q_blocks.join(d_blocks, "cell"), "blocks")

    def dealt(side, own_blocks, other_blocks, is_query):
        mine = F.pmod(F.xxhash64("vec_id", F.hash("v")), F.col(own_blocks)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
        spread = side.join(F.broadcast(blocks), "cell").select("cell", mine.alias("mine"), other.alias("other"), "vec_id", "v")
        names = ("mine", "other") if is_query else ("other", "mine")
        return spread.select("cell", F.col(names[0]).alias("q_block"), F.col(names[1]).alias("d_block"), F.lit(is_query).alias("is_query"), "vec_id", "v")

    together = dealt(asked, "q_blocks", "d_blocks", True).union(dealt(data.drop("dist"), "d_blocks", "q_blocks", False))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        ask, rest = group[group.is_query], group[~group.is_query].sort_values("vec_id", kind="stable")
        empty = pd.DataFrame({"query_id": ask.vec_id[:0], "vec_id": ask.vec_id[:0], "score": np.zeros(0, np.int64)})
        if not len(ask) or not len(rest):
            return empty
        score = scores(_matrix(list(ask.v), dims), _matrix(list(rest.v), dims))
        other, out = rest.vec_id.to_numpy(), []
        for query, row in zip(ask.vec_id.to_numpy(), score):
            pick = np.flatnonzero(other != query)
            if len(pick) > k:  # the k best and all that tie with the last of them
                pick = pick[row[pick] >= np.partition(row[pick], len(pick) - k)[len(pick) - k]]
            pick = pick[np.argsort(-row[pick], kind="stable")][:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": other[pick], "score": row[pick]}))
        return pd.concat(out, ignore_index=True)

    best = together.groupBy("cell", "q_block", "d_block").applyInPandas(solve, f"query_id {id_type}, vec_id {id_type}, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
