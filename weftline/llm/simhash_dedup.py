"""SimHash near-duplicates: pigeonring candidates, a full Hamming check and components.

A fingerprint is a ring of four 16-bit segments. Two fingerprints with at most 3 differing bits have a
segment from which the differences of 1, 2, 3 and 4 consecutive segments stay within 0, 1, 2 and 3
(the pigeonring bound l * 3 / 4). The first two bounds are the bucket key: the 32 bits of a chain of
two segments with one bit of the second masked. The third and fourth are checked inside a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import id_field, map_rows, texts
from weftline.llm.components import components
from weftline.session import small_batches, staged

BITS = 3        # fingerprints link at this many differing bits or fewer
SHINGLE = 3     # words a shingle
SEED = 42
BLOCK = 2048    # rows of a bucket that are compared in one task; larger buckets are cut into pairs of blocks
CHUNK = 1 << 16


def simhash(text: bytes, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint; A-Z count as a-z, a text without words gives 0, a tied bit is 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        words = [b" ".join(words)]
        size = 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, CHUNK):
        part = words[start:start + CHUNK + size - 1]
        hashes = np.array([digest(join(s), SEED) for s in zip(*(part[i:] for i in range(size)))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long. Null texts are empty; null ids stay."""
    src = texts(docs, id_col, text_col)

    def run(rows):
        for doc_id, text in rows:
            fp = simhash(text)
            yield doc_id, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(src, run, T.StructType([id_field(src), T.StructField("fp", T.LongType())]))


def _chains(fps: DataFrame) -> DataFrame:
    """(fp, ring, chain): the 32 bits from each of the four segments on, around the ring."""
    fp = F.col("fp")
    turned = [fp] + [F.shiftleft(fp, 16 * i).bitwiseOR(F.shiftrightunsigned(fp, 64 - 16 * i)) for i in (1, 2, 3)]
    return fps.select("fp", F.posexplode(F.array(*(F.shiftrightunsigned(t, 32) for t in turned))).alias("ring", "chain"))


def _flips(change) -> object:
    """An array of 16 values, one for each bit of a chain's second segment."""
    return F.array(*(change(j) for j in range(16)))


def links(fps: DataFrame) -> DataFrame:
    """(a, b): fingerprints within BITS bits, enough pairs to connect all that are linked.

    Each bucket gives the edges of a spanning forest, never all its pairs. A chain shared by more than
    BLOCK fingerprints is compared, with its neighbours one bit away, as a grid of block pairs.
    """
    chains = staged(_chains(fps.select("fp").distinct()), "chains")
    counts = chains.groupBy("ring", "chain").count()
    hot = staged(counts.where(F.col("count") > BLOCK).select("ring", "chain"), "hot-chains")
    masked = _flips(lambda j: F.struct(F.lit(j).alias("bit"), F.col("chain").bitwiseAND(F.lit(~(1 << j))).alias("key")))
    cool = chains.join(hot, ["ring", "chain"], "left_anti").select("fp", "ring", F.explode(masked).alias("m")).select(
        (F.shiftleft(F.col("ring").cast("long") * 16 + F.col("m.bit"), 32) + F.col("m.key")).alias("key"), F.lit(0).alias("cell"), "ring", "fp")
    found = _compare(cool)
    if hot.isEmpty():
        return found
    # fingerprints of a hot chain and of the chains one bit away
    reach = chains.select("fp", "ring", F.explode(F.concat(
        F.array("chain"), _flips(lambda j: F.col("chain").bitwiseXOR(F.lit(1 << j))))).alias("chain"))
    around = staged(reach.join(hot, ["ring", "chain"]), "hot-rows")
    blocks = around.groupBy("ring", "chain").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    grid = around.join(blocks, ["ring", "chain"]).withColumn("own", own).select(
        "fp", "ring", "chain", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = grid.select(
        (F.shiftleft(F.col("ring").cast("long"), 32) + F.col("chain")).alias("key"),
        (F.least("own", "other") * 65536 + F.greatest("own", "other")).alias("cell"), "ring", "fp")
    return found.union(_compare(cells))


def _compare(rows: DataFrame) -> DataFrame:
    """Spanning edges within each (key, cell); rows of a bucket follow each other in a sorted partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")

    def run(batches):
        kept = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            last = len(cols[0]) - 1
            open_from = int(np.argmax((cols[0] == cols[0][last]) & (cols[1] == cols[1][last])))
            yield from _edges([c[:open_from] for c in cols])
            kept = [c[open_from:] for c in cols]
        if kept is not None:
            yield from _edges(kept)

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100_000)
    return laid.mapInArrow(run, "a long, b long")


def _edges(cols):
    key, cell, ring, fp = cols
    n = len(key)
    if n < 2:
        return
    fps, shift = fp.view(np.uint64), (16 * ring).astype(np.uint64)
    root = np.arange(n)
    out_a, out_b = [], []
    left = np.flatnonzero((key[1:] == key[:-1]) & (cell[1:] == cell[:-1]))  # rows with a row of their bucket behind them
    lag = 1
    while len(left):
        x = fps[left] ^ fps[left + lag]
        s = shift[left]
        turned = (x << s) | (x >> (np.uint64(64) - s) % np.uint64(64)) * (s > 0)
        near = (np.bitwise_count(turned >> np.uint64(16)) <= 2) & (np.bitwise_count(x) <= BITS)
        a = left[near]
        b = a + lag
        while len(a):
            a, b = a[root[a] != root[b]], b[root[a] != root[b]]
            if not len(a):
                break
            # one edge for each tree that is hung below another, smaller ones first
            high, low = np.maximum(root[a], root[b]), np.minimum(root[a], root[b])
            top, first = np.unique(high, return_index=True)
            out_a.append(fp[a[first]])
            out_b.append(fp[b[first]])
            root[top] = low[first]
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
        lag += 1
        left = left[left + lag < n]
        left = left[(key[left] == key[left + lag]) & (cell[left] == cell[left + lag])]
    if out_a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    component_id is the smallest id that links of at most BITS bits reach, the row's own included. Rows
    without words have fingerprint 0 and link like any other. Repeated rows are kept; ids that are null
    stay null and do not count as smallest; an empty table gives an empty one; other columns are ignored.
    """
    own = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    near = staged(links(own), "links")
    small_batches(docs.sparkSession)  # those of fingerprints are larger than texts allow
    roots = components(near)
    low = own.groupBy("fp").agg(F.min("doc_id").alias("low")).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    low = low.withColumn("root", F.coalesce("root", "fp"))
    named = low.select("fp", "root").join(low.groupBy("root").agg(F.min("low").alias("component_id")), "root")
    return own.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
