"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A document of a source is wanted target / source_size times. The whole part is certain; the rest is an
inclusion probability. Documents are ordered by random odds divided by inclusion odds and taken, in
that order, until the words that the whole copies leave open are met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import WORD
from weftline.session import staged

WEIGHTS = (3, 1, 2)    # by the source's place in code point order, repeating
TOTAL = 1.5            # of all words
MOST = 2               # copies of a document
BUCKETS = 1 << 16      # of the order, per source; only the bucket that holds the cut is ranked row by row
PASSES = 2             # the second fills, in the same order, what a long document at the cut left open


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, odds_col: str | None, carry=()) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    odds = F.col(odds_col).cast("double") if odds_col else F.lit(1.0)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.alias("size"), odds.alias("odds"), *carry)


def source_targets(rows: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target): words a source should give.

    Sources are numbered in code point order, null last. The shared level c of target = weight * c rises
    while some sources stop at `most` times their size; every round is one aggregation of two numbers.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    laid = staged(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("place", 33)), "sources")
    parts = laid.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    ranked = staged(laid.join(parts.select("part", before.alias("before")), "part").select("source", "source_size", weight.alias("weight")), "ranked")
    cap = F.col("source_size") * most
    goal = total * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = cap <= F.col("weight") * level
        open_weight, filled = ranked.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap))).first()
        if not open_weight:
            break
        raised = (goal - (filled or 0)) / open_weight
        if raised <= level:
            break
        level = raised
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, seed: int = 0, weights=WEIGHTS, total: float = TOTAL, most: int = MOST, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", odds_col: str | None = None, carry: tuple = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for every row of docs; taken = copies * size.

    The order comes from a seeded hash of the id, so reruns agree; ties go by id and size, null ids first.
    `odds_col` multiplies a document's inclusion odds; `carry` names columns to hand through. A null source is a source of its own, the last one;
    null texts have size 0 and are taken 0 words; repeated rows are documents of their own; other columns
    are ignored and an empty table gives an empty one. A source misses its target by less than its longest
    document.
    """
    rows = staged(sized(docs, id_col, text_col, source_col, odds_col, carry), "sizes")
    targets = staged(source_targets(rows, weights, total, most).withColumnsRenamed({"source": "own"}).withColumn(
        "wanted", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn(
        "whole", F.floor("wanted")).withColumn("open", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    share = F.col("wanted") - F.col("whole")
    rank = F.when(share > 0, (u / (1 - u)) / (F.col("odds") * share / (1 - share)))
    spot = F.col("rank") / (1 + F.col("rank"))  # the same order within 0 and 1
    state = rows.join(targets, rows["source"].eqNullSafe(targets["own"])).select(
        "doc_id", "source", "size", "source_size", "target", F.col("whole").alias("copies"), "open", rank.alias("rank"), *carry).withColumn(
        "spot", spot).withColumn("bucket", F.floor(F.col("spot") * BUCKETS))
    state = staged(state.withColumn("free", F.col("spot").isNotNull() & (F.col("size") > 0)), "order")
    for _ in range(PASSES):
        state = staged(_fill(state, carry), "order")
    return state.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *carry)


def _fill(state: DataFrame, carry: tuple) -> DataFrame:
    """One more copy for free documents, in order, while the middle of a document lies within the open words."""
    key = ["source_key", "bucket"]
    state = state.withColumn("source_key", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    fits = F.col("free") & (F.col("size") <= 2 * F.col("open"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = state.where(fits).groupBy(*key).agg(F.sum("size").alias("words"))
    sums = sums.withColumn("base", F.coalesce(F.sum("words").over(before.partitionBy("source_key").orderBy("bucket")), F.lit(0)))
    placed = state.join(sums, key, "left").withColumn("fits", fits)
    at_cut = F.col("fits") & (F.col("base") < F.col("open")) & (F.col("base") + F.col("words") > F.col("open"))
    cut = placed.where(at_cut)
    inside = F.coalesce(F.sum("size").over(before.partitionBy(*key).orderBy("spot", "doc_id", "size")), F.lit(0))
    cut = cut.withColumn("take", F.col("base") + inside + F.col("size") / 2 <= F.col("open"))
    rest = placed.where(~F.coalesce(at_cut, F.lit(False))).withColumn("take", F.col("fits") & (F.col("base") + F.col("words") <= F.col("open")))
    done = rest.unionByName(cut).withColumn("take", F.coalesce("take", F.lit(False)))
    given = done.where("take").groupBy("source_key").agg(F.sum("size").alias("given"))
    return done.join(given, "source_key", "left").select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") + F.col("take").cast("long")).alias("copies"),
        (F.col("open") - F.coalesce("given", F.lit(0))).alias("open"), "rank", "spot", "bucket", *carry, (F.col("free") & ~F.col("take")).alias("free"))
