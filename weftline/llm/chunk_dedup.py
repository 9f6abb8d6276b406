"""Exact duplicates by content-defined chunks, in DataFrame operations only.

A normalised text is cut after words whose hash falls on a mark, so equal passages give equal chunks
wherever they stand. Chunks become identifiers of a few hash words; one shuffle of the distinct chunks
verifies that no two contents share one, and identifiers grow by a hash word until that holds. A document
is then the ordered list of its identifiers, and documents are compared by these lists alone: a long text
is not moved again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import staged

SPACES = r"[\x20\x09-\x0D]+"
UNIT = 256           # code points of a word that are looked at as one
MARK = 128           # units between two borders, on average
LONGEST = 4096       # units of a chunk at most
WORDS = 2            # 64-bit hash words of an identifier to begin with
HOT = 1000           # a group with over one row in so many is joined by broadcast: there are fewer than so many
HOT_LIST = 2048      # hash words of a list that is broadcast: 16 KB, so all of them stay under 16 MB


def normalised(text):
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _let(value, fn):
    """fn(value) with the value computed once, also where fn uses it within a lambda."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def chunks(text, mark: int = MARK, longest: int = LONGEST):
    """The chunks of a normalised text in order; joined, they give the text. An empty text has none."""
    units = F.regexp_extract_all(text, F.lit("[^ ]{1,%d} ?| " % UNIT), F.lit(0))

    def ends(u):
        here = F.transform(u, lambda w, i: F.when(
            (F.pmod(F.xxhash64(w), F.lit(mark)) == 0) | ((i + 1) % longest == 0) | (i + 1 == F.size(u)), i + 1))
        return F.filter(here, lambda i: i.isNotNull())

    def cut(u, e):
        def piece(end, j):
            start = F.when(j > 0, F.get(e, j - 1)).otherwise(0)
            return F.array_join(F.slice(u, start + 1, end - start), "")
        return F.transform(e, piece)

    return _let(units, lambda u: _let(ends(u), lambda e: cut(u, e)))


def identifier(chunk, words: int, bits: int = 64):
    """`words` independent hashes of a chunk, of which `bits` bits count."""
    return F.array(*(F.shiftrightunsigned(F.xxhash64(F.lit(k), chunk), 64 - bits) for k in range(words)))


def _clash(rows: DataFrame, words: int, bits: int) -> bool:
    """Do two different chunks share an identifier? Copies are folded where they are read, so a hot chunk is a row a task."""
    cut = rows.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
    distinct = cut.select(identifier(F.col("chunk"), words, bits).alias("id"), "chunk").distinct()
    return not distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.

    Texts are equal when they are after each run of white space became one space. Of equal ones the row of
    smallest id stays, null ids last; of repeated rows of that id one stays. Null texts are empty and equal
    each other; other columns are ignored; an empty table gives an empty one.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    while _clash(src, words, bits):
        words += 1
    recipe = F.flatten(F.transform(chunks(F.col("norm")), lambda c: identifier(c, words, bits)))
    rows = staged(src.select("doc_id", recipe.alias("recipe"), F.sha2("norm", 256).alias("text_sha256")).withColumn(
        "row", F.monotonically_increasing_id()), "recipes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = staged(rows.groupBy("recipe").agg(F.min(order).alias("first"), F.count("*").alias("group_size")).where("group_size > 1"), "groups")
    found = groups.select("recipe", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    hot = (F.col("group_size") * HOT > rows.count()) & (F.size("recipe") <= HOT_LIST)
    often = F.broadcast(found.where(hot))
    known = rows.join(often, "recipe")
    other = rows.join(often.select("recipe"), "recipe", "left_anti").join(found.where(~hot), "recipe", "left")
    lone = F.col("group_size").isNull()
    return known.unionByName(other).select(
        "doc_id", F.when(lone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (lone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")
