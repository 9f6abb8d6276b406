"""Importance resampling of documents towards a target corpus.

Every feature falls into one of a fixed number of hash buckets; the log ratio of target and raw counts is
an array with a gain a bucket, by which a document is scored where it is read. Perturbed scores then decide
who is drawn: a quantile sketch brackets the cutoff, exact counts outside the bracket confirm or widen it,
and only the bracket is sorted to find the cutoff.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import id_field, map_rows, texts
from weftline.llm.terms import features
from weftline.session import staged

BUCKETS = 10_000
SEED = 2024
LONGEST = 1         # terms a feature
LEAST_WORDS = 20    # of a document that may be drawn
PERCENT = 10        # of those are drawn
WIDTH = 0.005       # half the first bracket, as a share of the rows
SKETCH = 2_000      # accuracy of the sketch: ranks are off by a row in so many
KNOWN = 200_000     # features a task remembers the bucket of


def _bucketed(buckets: int, longest: int):
    """text -> {bucket: count}, with the buckets of frequent features remembered."""
    known: dict = {}

    def run(data: bytes) -> tuple[dict, int]:
        out: dict = {}
        words = 0
        for feature, n in features(data, longest).items():
            b = known.get(feature)
            if b is None:
                b = zlib.crc32(feature) % buckets
                if len(known) < KNOWN:
                    known[feature] = b
            out[b] = out.get(b, 0) + n
            if b" " not in feature:
                words += n
        return out, words

    return run


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features in each bucket over all texts; a task sends at most a row a bucket, as does the corpus to the driver."""
    def run(batch):
        bucketed = _bucketed(buckets, longest)
        sums = np.zeros(buckets, np.int64)
        for (data,) in batch:
            found = bucketed(data)[0]
            sums[list(found)] += np.fromiter(found.values(), np.int64, len(found))
        for b in np.flatnonzero(sums).tolist():
            yield b, int(sums[b])

    out = np.zeros(buckets, np.int64)
    counted = map_rows(rows.select("text"), run, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares, floored."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_raw + n) / ((s + 1) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def _noise(seed, doc_id) -> int:
    """A standard Gumbel number of the id, times 1000, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed=SEED, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every text."""
    def run(batch):
        bucketed = _bucketed(len(gain), longest)
        for doc_id, data in batch:
            found, words = bucketed(data)
            n = sum(found.values())
            total = sum(int(gain[b]) * c for b, c in found.items())
            weight = total // n if n else 0
            yield doc_id, words, n, weight, weight + _noise(seed, doc_id)

    return map_rows(rows, run, T.StructType([id_field(rows), *(T.StructField(c, T.LongType()) for c in (
        "n_words", "n_features", "weight", "score"))]))


def bracket(rows: DataFrame, wanted: int, total: int, width: float = WIDTH) -> tuple[int, int, int]:
    """(low, high, rows above high): scores between which the wanted-th highest of `total` rows lies.

    The sketch proposes; the exact number of rows above and inside decides, and a bracket that does not
    hold the cutoff is widened until it does.
    """
    middle = 1 - wanted / total
    while True:
        shares = [max(0.0, middle - width), min(1.0, middle + width)]
        low, high = rows.agg(F.percentile_approx("score", shares, SKETCH).alias("at")).first()["at"]
        if width >= 1:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, inside = rows.agg(F.count(F.when(F.col("score") > high, 1)), F.count(F.when(F.col("score").between(low, high), 1))).first()
        if above < wanted <= above + inside:
            return low, high, above
        width *= 4


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """rows + rank by falling score and rising id: dealt by range, numbered within, and moved by what lies before."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    laid = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), name)
    part = F.shiftright("place", 33)
    sizes = laid.groupBy(part.alias("part")).agg(F.count("*").alias("n"))   # a row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("before"))
    return laid.withColumn("part", part).join(starts, "part").withColumn(
        "rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "place", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             longest: int = LONGEST, seed=SEED, id_col: str = "doc_id", text_col: str = "text", width: float = WIDTH) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of docs; rank is null where a document is not drawn.

    Of the N documents with `least_words` words, floor(percent * N / 100) of highest score are drawn, ties to
    the smaller id, null ids last. Null texts have no features and weight 0; repeated rows are documents of
    their own; other columns are ignored; an empty table gives an empty one, and with an empty target every
    gain speaks for rare features.
    """
    rows = texts(docs, id_col, text_col)
    goal = target.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    gain = gains(bucket_counts(rows, buckets, longest), bucket_counts(goal, buckets, longest))
    all_rows = staged(scored(rows, gain, seed, longest), "scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    free = all_rows.where(F.col("n_words") >= least_words)
    total = free.count()
    wanted = total * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return all_rows.select(*columns, none)
    low, high, above = bracket(free.select("score"), wanted, total, width)
    sure = _ranked(free.where(F.col("score") > high).select(columns), "drawn")
    at_cut = _ranked(free.where(F.col("score").between(low, high)).select(columns), "bracket")
    cut = F.when(F.col("rank") <= wanted - above, F.col("rank") + above)
    rest = all_rows.where((F.col("n_words") < least_words) | (F.col("score") < low)).select(*columns, none)
    return rest.unionByName(sure).unionByName(at_cut.withColumn("rank", cut))
