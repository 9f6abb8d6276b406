"""Ranked lexical search by pipelined term partitioning.

Documents are read in slices of bounded size; a slice's posting lists belong to the owner of their term.
Owners hold bands of term weight, rarest first. A bundle of items meets a slice as one row, which travels
from owner to owner: each stage cogroups it with the owner's lists of that slice, adds whole-number
contributions to its sparse accumulators and sends it on. An accumulator is left behind once what the later
owners can still add does not lift it to the slice's k-th score, which never changes the result. The last
owner hands out k documents an item and slice, from which the final k are selected.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import id_field, map_rows, texts
from weftline.llm.terms import features
from weftline.operators.rank import top_per_group
from weftline.session import staged

K = 10
SCALE = 1000                         # of a weight
GAIN = 1_000_000_000                 # a list's contribution is below GAIN / 1000 for each point of weight
LENGTH_SHARE = 75                    # per cent of the length norm that varies with the length
BANDS = (6000, 3500, 1500)           # least weight of the terms of each owner but the last
SLICE_DOCS = 8192
SLICE_POSTINGS = 2_000_000
BUNDLE = 64                          # items that travel together, on average
KNOWN_BYTES = 8 << 20                # a vocabulary up to this size goes to every task; a longer one is joined
SALTS = 32                           # parts of a term's lists where they are joined


def _packed(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, pickle.HIGHEST_PROTOCOL))


def _unpacked(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


# -- the index ------------------------------------------------------------------------------------------

def index(rows: DataFrame, known: frozenset | None) -> DataFrame:
    """(slice, term, n_docs, n_terms, blob): posting lists (documents, counts), and with a null term a row a slice.

    That row counts the slice's documents that hold terms, and their terms, and packs ids and lengths. `known`
    limits the lists to these terms.
    """
    def run(batch):
        part, number = TaskContext.get().partitionId(), 0
        ids, sizes, lists, held = [], [], {}, 0
        for doc_id, data in batch:
            found = features(data)
            if not found:
                continue
            at = len(ids)
            ids.append(doc_id)
            sizes.append(sum(found.values()))
            for term in found if known is None else found.keys() & known:
                docs, counts = lists.setdefault(term, ([], []))
                docs.append(at)
                counts.append(found[term])
                held += 1
            if len(ids) == SLICE_DOCS or held >= SLICE_POSTINGS:
                yield from slice_rows(part << 32 | number, ids, sizes, lists)
                number += 1
                ids, sizes, lists, held = [], [], {}, 0
        if ids:
            yield from slice_rows(part << 32 | number, ids, sizes, lists)

    def slice_rows(name, ids, sizes, lists):
        yield name, None, len(ids), sum(sizes), _packed(ids, np.array(sizes, np.int64))
        for term, (docs, counts) in lists.items():
            yield name, term, len(docs), None, _packed(np.array(docs, np.int32), np.array(counts, np.int32))

    return map_rows(rows, run, "slice long, term binary, n_docs long, n_terms long, blob binary")


# -- item bundles ---------------------------------------------------------------------------------------

def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term, times): the items numbered, with their distinct terms."""
    def run(batch):
        part = TaskContext.get().partitionId()
        for i, (item_id, data) in enumerate(batch):
            for term, n in features(data).items():
                yield part << 32 | i, item_id, term, n

    rows = texts(items, id_col, text_col)
    return map_rows(rows, run, T.StructType([
        T.StructField("item", T.LongType()), id_field(rows, "doc_id"), T.StructField("term", T.BinaryType()),
        T.StructField("times", T.LongType())])).withColumnRenamed("doc_id", "item_id")


def _vocabulary(wanted: DataFrame) -> frozenset | None:
    """The items' terms if their size is proven small."""
    distinct = wanted.select("term").distinct()
    size = distinct.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return frozenset(bytes(r["term"]) for r in distinct.toLocalIterator()) if size <= KNOWN_BYTES else None


# -- the stages -----------------------------------------------------------------------------------------

def _accumulated(mean: tuple, owner: int, k: int, last: bool):
    """The work of one owner on a bundle at a slice: the bundle's row and the owner's lists in, the row or the best out.

    The row's blob holds (items, ids, sizes, terms, item of each accumulator, its document, its score), with terms
    as (item, term, weight, owner).
    """
    n_docs, n_terms = mean

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["item", "item_id", "doc_id", "score"] if last else ["bundle", "slice", "blob"]
        if left.empty:
            return pd.DataFrame([], columns=columns)
        items, ids, sizes, terms, at_item, at_doc, score = _unpacked(left.blob.iloc[0])
        acc = np.zeros((len(items), len(ids)), np.int64)
        acc[at_item, at_doc] = score
        norm = 100 - LENGTH_SHARE + LENGTH_SHARE * sizes * n_docs // n_terms
        lists = {bytes(t): b for t, b in zip(right.term, right.blob)}
        own, later = [], []
        limit = np.zeros(len(items), np.int64)     # what this and later owners can add to any document
        rest = np.zeros(len(items), np.int64)      # and the later ones alone
        for item, term, weight, whose in terms:
            limit[item] += weight * (GAIN // 1000)
            if whose == owner:
                own.append((item, term, weight))
            else:
                later.append((item, term, weight, whose))
                rest[item] += weight * (GAIN // 1000)
        closed = limit < _kth(acc, k)              # no document without an accumulator can come in
        parts: dict = {}
        for item, term, weight in own:
            blob = lists.get(term)
            if blob is None:
                continue
            if term not in parts:
                docs, counts = _unpacked(blob)
                counts = counts.astype(np.int64)
                parts[term] = docs, GAIN * counts // (1000 * counts + 8 * norm[docs])
            docs, gain = parts[term]
            if closed[item]:
                held = acc[item, docs] > 0
                docs, gain = docs[held], gain[held]
            acc[item, docs] += weight * gain
        best = _kth(acc, k)
        if last:
            at_item, at_doc = np.nonzero((acc > 0) & (acc >= best[:, None]))
            found = pd.DataFrame({"at": at_item, "doc": at_doc, "score": acc[at_item, at_doc], "doc_id": pd.array([ids[d] for d in at_doc], dtype=object)})
            found = found.sort_values(["at", "score", "doc_id"], ascending=[True, False, True], na_position="last").groupby("at").head(k)
            return pd.DataFrame({"item": [items[a][0] for a in found["at"]], "item_id": [items[a][1] for a in found["at"]],
                                 "doc_id": found["doc_id"].tolist(), "score": found["score"].tolist()}, columns=columns)
        at_item, at_doc = np.nonzero((acc > 0) & (acc + rest[:, None] >= best[:, None]))
        blob = _packed(items, ids, sizes, later, at_item.astype(np.int32), at_doc.astype(np.int32), acc[at_item, at_doc])
        return pd.DataFrame({"bundle": left.bundle, "slice": left.slice, "blob": [blob]}, columns=columns)

    return run


def _kth(acc: np.ndarray, k: int) -> np.ndarray:
    """Each item's k-th highest score in the slice, 0 if it has fewer documents."""
    if acc.shape[1] <= k:
        return np.zeros(len(acc), np.int64)
    return np.partition(acc, -k, axis=1)[:, -k]


def _bundles(weighed: DataFrame) -> DataFrame:
    """(bundle, items): a bundle's items and their terms, packed; as long as its items' texts."""
    item = F.collect_list(F.struct("term", "w", "owner")).alias("terms")
    whole = weighed.groupBy("bundle", "item", "item_id").agg(item)
    return whole.groupBy("bundle").agg(F.collect_list(F.struct("item", "item_id", "terms")).alias("items"))


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", bands: tuple = BANDS, known_bytes: int | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 of each row of items.

    Equal scores go by id, null ids last. Null texts have no terms; an item without terms that any document
    holds has no rows; repeated rows are documents, or items, of their own; other columns are ignored; empty
    tables give an empty result.
    """
    spark = docs.sparkSession
    wanted = staged(item_terms(items, item_col, item_text_col), "items")
    rows = texts(docs, id_col, text_col)
    known = _vocabulary(wanted) if known_bytes is None or known_bytes > 0 else None
    built = index(rows, known)
    if known is None:
        vocabulary = wanted.select("term").distinct()
        built = staged(built, "all-postings")
        built = built.where("term IS NULL").unionByName(built.join(vocabulary, "term", "left_semi").select(built.columns))
    built = staged(built, "postings")
    heads = built.where("term IS NULL")
    n_docs, n_terms = heads.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = wanted.schema["item_id"].dataType.simpleString()
    if not n_docs:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    lists = built.where("term IS NOT NULL").select("slice", "term", "n_docs", "blob")
    weight = F.floor(SCALE * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)))
    owner = sum((F.when(F.col("weight") < b, 1).otherwise(0) for b in bands), F.lit(0))
    terms = staged(lists.groupBy("term").agg(F.sum("n_docs").alias("df")).withColumn("weight", weight).withColumn("owner", owner), "weights")
    # an item without a term in the index is in no bundle and has no result
    n_items = wanted.select("item").distinct().count()
    bundle = F.pmod(F.xxhash64("item"), F.lit(-(-n_items // BUNDLE) or 1)).alias("bundle")
    weighed = staged(wanted.join(terms, "term").where("weight > 0").select(
        "item", "item_id", bundle, "term", (F.col("weight") * F.col("times")).alias("w"), "owner"), "weighed")
    bundles = _bundles(weighed)
    meet = heads.select("slice", "blob").withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(-(-n_items // BUNDLE) or 1) - 1)))

    def start(batch):
        for name, number, blob, found in batch:
            ids, sizes = _unpacked(blob)
            names = [(r["item"], r["item_id"]) for r in found]
            flat = [(i, bytes(t["term"]), t["w"], t["owner"]) for i, r in enumerate(found) for t in r["terms"]]
            yield number, name, _packed(names, ids, sizes, flat, *(np.zeros(0, t) for t in (np.int32, np.int32, np.int64)))

    state = map_rows(meet.join(bundles, "bundle").select("slice", "bundle", "blob", "items"), start, "bundle long, slice long, blob binary")
    salt = F.pmod(F.xxhash64("slice"), F.lit(SALTS)).alias("salt")
    routes = weighed.select("term", "owner", "bundle").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    for stage in range(len(bands) + 1):
        last = stage == len(bands)
        sent = lists.withColumn("salt", salt).join(routes.where(F.col("owner") == stage), ["term", "salt"]).select("bundle", "slice", "term", "blob")
        schema = f"item long, item_id {item_kind}, doc_id {kind}, score long" if last else "bundle long, slice long, blob binary"
        state = state.groupBy("bundle", "slice").cogroup(sent.groupBy("bundle", "slice")).applyInPandas(
            _accumulated((n_docs, n_terms), stage, k, last), schema)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = top_per_group(state.withColumn("_spread", F.monotonically_increasing_id()), "item", order, k, "_spread", 64)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return best.select("item_id", rank.alias("rank"), "doc_id", "score")
