"""Duplicate removal. The first document in a given order survives.

`order_by` names a column that is unique per row. Keys and order travel through the shuffles, not
the texts: each operator first finds which rows survive and then semi-joins the table once on that
unique column, so a hash shared by a third of all rows is combined on the map side and never meets
in one task.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import sketch, text as T
from weftline.operators.rank import top_per_group
from weftline.session import noted, remove, scratch_path, staged, staged_at, swept

LEADERS = 16  # rows per bucket that the others are compared with in the second round; twice as many in each later one
SET_LEADERS = 64  # the same where outlines settle most pairs before any set is read
MOST_LEADERS = 1000  # up to which the first rows of a bucket are found on the map side; rounds go on beyond it
MOST_UNSPLIT = 16_000  # rows of a band bucket up to which comparing outlines costs less than splitting by words
SLICE_ROWS = 4_000_000  # rows of buckets that are shuffled with their outlines at once
SLICE_PAIRS = 100_000  # pairs that are shuffled with their sets at once


def keep_first(df: DataFrame, key, order_by: str, scope=None) -> DataFrame:
    """The first row of each key by a unique column.

    Only the ids of repeats, the lesser part, are joined to the table; Spark broadcasts them where they
    are few by its own check. Null keys and scopes are a group like any other.
    """
    scope = list(scope or ())
    names = [f"_key{i}" for i in range(len(scope) + 1)]
    keyed = df.select(*(F.col(c).alias(n) for c, n in zip(scope, names)), key.alias(names[-1]), order_by)
    repeated = keyed.groupBy(*names).agg(F.min(order_by).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    repeated = repeated.select(*(F.col(n).alias(f"{n}r") for n in names), "_first")
    same = [F.col(n).eqNullSafe(F.col(f"{n}r")) for n in names]
    gone = keyed.join(repeated, same).where(F.col(order_by) > F.col("_first")).select(order_by)
    return df.join(gone, order_by, "left_anti")


def dedup_exact(df: DataFrame, col: str = "content", order_by: str = "id", scope=None,
                algo: str = "sha256") -> DataFrame:
    """One row per hash of the stripped text; `scope` columns limit the comparison, e.g. to one file."""
    return keep_first(df, T.content_hash(T.strip(col), algo), order_by, scope)


def dedup_signature(df: DataFrame, order_by: str = "id", scope=None, col: str = "content",
                    num_perm: int = 128, max_words: int | None = None) -> DataFrame:
    """One row per whole MinHash signature."""
    return keep_first(df, sketch.fuzzy_hash(sketch.minhash_signature(col, num_perm, max_words)),
                      order_by, scope)


def visited_dedup(urls: DataFrame, visited: DataFrame, col: str = "url") -> DataFrame:
    """Distinct URLs that were not visited before."""
    return urls.select(col).distinct().join(visited.select(col).distinct(), col, "left_anti")


# -- near duplicates ------------------------------------------------------------------------------

def _keyed(df: DataFrame, order_by: str, bands: int, rows: int, col: str, max_words) -> DataFrame:
    """(ord, set_hash, keys): a hash of each word set and its band keys, some 100 bytes a document."""
    words = df.select(F.col(order_by).alias("ord"), sketch.word_set(col, max_words).alias("words"))
    signed = words.select(
        "ord", F.sha2(F.to_json("words"), 256).alias("set_hash"), F.size("words").alias("size"),
        sketch.signature_of("words", bands * rows).alias("sig")).where("size > 0")
    return staged(signed.select("ord", "set_hash", sketch.band_keys("sig", bands, rows).alias("keys")),
                  "bandkeys")


def _members(keyed: DataFrame) -> DataFrame:
    """(ord, key) of the first document of every word set, in buckets of at least two."""
    firsts = keyed.groupBy("set_hash").agg(F.min("ord").alias("ord"))
    return staged(shared_only(
        keyed.join(firsts.select("ord"), "ord", "left_semi").select("ord", F.explode("keys").alias("key"))), "members")


def shared_only(members: DataFrame) -> DataFrame:
    """Without the buckets of one member."""
    counts = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return members.join(counts.select("key"), "key", "left_semi")


def divide(members: DataFrame, features: DataFrame, threshold: float, above: int = LEADERS) -> DataFrame:
    """Split each bucket of more than `above` rows without losing a pair at or above the threshold.

    Sets of size n that reach the threshold t with another set share at least one of their first
    n - ceil(t n) + 1 words in any common order. Ordering a bucket's words from rare to frequent
    puts shared boilerplate last, so members that only share boilerplate part ways. Buckets that overlap
    have one order between them: a row is in many that hold much the same rows, and its words are counted
    and ranked once for all of those.
    """
    counts = members.groupBy("key").agg(F.count("*").alias("n"))
    large = staged(counts.where(F.col("n") > above).select("key"), "large")
    if large.isEmpty():
        return members
    small = members.join(large, "key", "left_anti").select("ord", "key")
    crowded = staged(_overlapping(members.join(large, "key", "left_semi").select("ord", "key")), "crowded")
    worded = crowded.select("ord", "group").distinct().join(features, "ord").select(
        "group", "ord", F.size("feature").alias("size"), F.explode("feature").alias("word"))
    often = staged(worded.groupBy("group", "word").agg(F.count("*").alias("df")).where("df > 1"), "often")
    ranked = worded.join(often, ["group", "word"]).groupBy("group", "ord", "size").agg(
        F.array_sort(F.collect_list(F.struct("df", "word"))).alias("words"))
    # the words that no other member has come first and split nothing off
    prefix = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9).cast("int") + 1 - (F.col("size") - F.size("words"))
    first = ranked.select("group", "ord", F.slice("words", F.lit(1), F.greatest(prefix, F.lit(0))).alias("first"))
    split = crowded.join(first, ["group", "ord"]).select("ord", "key", F.explode("first").alias("w")).select(
        "ord", F.xxhash64("key", "w.word").alias("key"))
    return small.unionByName(split).distinct()


def _overlapping(members: DataFrame) -> DataFrame:
    """members + group: one for all rows of a bucket, and mostly one for buckets that share many of their rows.

    A row takes the earliest leader of its buckets, a bucket the earliest one that its rows have taken.
    """
    leaders = members.groupBy("key").agg(F.min("ord").alias("lead"))
    taken = members.join(leaders, "key").groupBy("ord").agg(F.min("lead").alias("lead"))
    groups = members.join(taken, "ord").groupBy("key").agg(F.min("lead").alias("group"))
    return members.join(groups, "key")


def _beside(pairs: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """pairs + _b and _a: the column of a table for the row and for its lead."""
    return pairs.join(table.select("ord", F.col(col).alias("_b")), "ord").join(
        table.select(F.col("ord").alias("lead"), F.col(col).alias("_a")), "lead")


def _verified(pairs: DataFrame, features: DataFrame, similar) -> DataFrame:
    """(lead, ord, score) of the pairs that are similar."""
    return _beside(pairs, features, "feature").select(
        "lead", "ord", similar(F.col("_a"), F.col("_b")).alias("score")).where("score IS NOT NULL")


@contextmanager
def by_ord(rows: DataFrame):
    """The rows as a table bucketed by `ord`, which joins on it do not shuffle; deleted at the end."""
    spark = rows.sparkSession
    path = scratch_path(spark, "features")
    name = f"weftline_{path.rsplit('/', 1)[1].replace('-', '_')}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        with swept(spark):
            rows.write.format("parquet").bucketBy(buckets, "ord").option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files of an external table stay
        remove(spark, path)


def similar_sets_gone(members: DataFrame, features: DataFrame, threshold: float, above: int = LEADERS) -> DataFrame:
    """keep_first_similar over sets by Jaccard similarity, buckets of more than `above` rows divided after the first round.

    The features should be dealt by `ord`: they are laid out in a table bucketed by it, so that no round shuffles
    them. Pairs whose outlines rule out the threshold are left before features are read, whatever their number.
    """
    with by_ord(features.select("ord", "feature")) as laid:
        return _laid_sets_gone(members, laid, threshold, above)


def _laid_sets_gone(members: DataFrame, laid: DataFrame, threshold: float, above: int) -> DataFrame:
    outlines, at = _laid(laid.select("ord", sketch.outline("feature").alias("outline")))
    possible = (outlines, lambda a, b: sketch.may_be_similar(a, b, threshold))
    try:
        return keep_first_similar(
            members, laid, _similar_sets(threshold), lambda open_: divide(open_, laid, threshold, above), SET_LEADERS, possible)
    finally:
        remove(laid.sparkSession, at)


def _laid(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a compressed table of a round, and its path for when the round is over."""
    path = staged_at(df, "round")
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _sliced(rows: DataFrame, by: list, most: int, build) -> tuple[DataFrame, str]:
    """build(part) over slices of about `most` rows, laid one after the other in one table, and its path.

    part(df) is a slice's share of a table with the columns `by`. What a slice shuffles is gone before the next one.
    """
    n = -(-rows.count() // most)
    if n <= 1:
        return _laid(build(lambda df: df))
    spark, path = rows.sparkSession, noted(scratch_path(rows.sparkSession, "round"))
    for i in range(n):
        # not the hash that rows are dealt by
        df = build(lambda df, i=i: df.where(F.pmod(F.xxhash64(*by, F.lit("slice")), F.lit(n)) == i))
        with swept(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _met(members: DataFrame, among) -> tuple[DataFrame, str]:
    """(lead, ord) once for each pair that among(part) finds in a slice of the buckets, and the table's path."""
    pairs, path = _sliced(members, ["key"], SLICE_ROWS, among)
    if members.count() <= SLICE_ROWS:
        return pairs, path
    once, at = _laid(pairs.distinct())
    remove(members.sparkSession, path)
    return once, at


def keep_first_similar(members: DataFrame, features: DataFrame, similar, refine=None,
                       leaders: int = LEADERS, possible=None) -> DataFrame:
    """(ord, kept_ord, score) for each row that an earlier surviving row makes redundant.

    Equal to walking the rows in order and dropping each one that shares a bucket with, and is
    similar to, an earlier row that was kept. In a round the first few open rows of every bucket
    lead it and the bucket's other rows are compared with them alone, so a bucket of n copies costs
    n comparisons and not n squared. A row that leads all its buckets has met every earlier open
    row, so its fate follows from the similar pairs found. Rounds go on until no bucket is open; the
    leaders grow from round to round, so that a bucket of n unlike rows takes about log n rounds.

    members (ord, key), features (ord, feature), similar(a, b) -> score or NULL; possible names outlines
    (ord, outline) and a test of two of them that is false only for pairs that cannot be similar: rows meet their
    leads with it, so that such pairs are never made. The first round,
    with one leader, settles the copies; then refine(members) may split the buckets of the rows
    left over as long as similar rows stay together. What a round leaves behind is deleted once the next
    one is written; only the rows found redundant stay.
    """
    spark = members.sparkSession
    (open_, held), dropped, lead_count = _laid(shared_only(members)), [], 1
    while not open_.isEmpty():
        first = top_per_group(open_, "key", "ord", lead_count, "ord")
        led = first.groupBy("ord").agg(F.count("*").alias("led"))
        buckets = open_.groupBy("ord").agg(F.count("*").alias("all"))
        covered, past = _laid(led.join(buckets, "ord").where("led = all").select("ord"))
        past = [past, held]

        def among(part):
            rest, meet = part(open_), F.col("lead") < F.col("ord")
            leads = part(first).select("key", F.col("ord").alias("lead"))
            if possible is not None:
                outlines, test = possible
                rest = rest.join(outlines.select("ord", F.col("outline").alias("_b")), "ord")
                leads = leads.join(outlines.select(F.col("ord").alias("lead"), F.col("outline").alias("_a")), "lead")
                meet = meet & test(F.col("_a"), F.col("_b"))
            return rest.join(leads, "key").where(meet).select("lead", "ord").distinct()

        pairs, path = _met(open_, among)
        past.append(path)
        edges, path = _sliced(pairs, ["lead", "ord"], SLICE_ROWS if possible is None else SLICE_PAIRS,
                              lambda part: _verified(part(pairs), features, similar))
        past.append(path)
        settled = covered
        while True:
            heads = edges.select(F.col("lead").alias("ord")).distinct().join(
                covered, "ord", "left_semi").join(edges.select("ord"), "ord", "left_anti")
            gone, path = _laid(
                edges.join(heads.withColumnRenamed("ord", "lead"), "lead", "left_semi")
                .groupBy("ord").agg(F.min(F.struct("lead", "score")).alias("by"))
                .select("ord", F.col("by.lead").alias("kept_ord"), F.col("by.score").alias("score")))
            if gone.isEmpty():
                past.append(path)
                break
            dropped.append(gone)
            settled = settled.unionByName(gone.select("ord"))
            edges, path = _laid(edges.join(gone, "ord", "left_anti").join(
                gone.select(F.col("ord").alias("lead")), "lead", "left_anti"))
            past.append(path)
        # covered rows still waiting for the fate of an uncovered one stay open
        settled = settled.join(edges.select("ord"), "ord", "left_anti")
        open_, held = _laid(shared_only(open_.join(settled, "ord", "left_anti")))
        lead_count = max(leaders, min(2 * lead_count, MOST_LEADERS) if possible is None else 4 * lead_count)
        if refine is not None and not open_.isEmpty():
            past.append(held)
            (open_, held), refine = _laid(shared_only(refine(open_))), None
        remove(spark, *past)
    remove(spark, held)
    if not dropped:
        kind = features.schema["ord"].dataType.simpleString()
        return features.sparkSession.createDataFrame([], f"ord {kind}, kept_ord {kind}, score double")
    return reduce(DataFrame.unionByName, dropped)


def jaccard(a, b):
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _similar_sets(threshold):
    def score(a, b):
        value = jaccard(a, b)
        return F.when(value >= threshold - 1e-12, value)
    return score


def lsh_candidates(df: DataFrame, order_by: str = "id", bands: int = 9, rows: int = 13,
                   col: str = "content", max_words: int | None = None) -> DataFrame:
    """(a, b): each document b with the first document a of every band bucket it falls into.

    Linear in the documents: a bucket names its first member to the others instead of emitting all
    of its pairs.
    """
    members = _keyed(df, order_by, bands, rows, col, max_words).select("ord", F.explode("keys").alias("key"))
    lead = members.groupBy("key").agg(F.min("ord").alias("a"), F.count("*").alias("n")).where("n > 1")
    return (
        members.join(lead.select("key", "a"), "key").where("ord <> a")
        .select("a", F.col("ord").alias("b")).distinct()
    )


def near_dup_pairs(df: DataFrame, threshold: float = 0.8, preset: str = "recall",
                   order_by: str = "id", col: str = "content", max_words: int | None = None) -> DataFrame:
    """(a, b, jaccard): each redundant document b with the surviving earlier document a.

    Documents are walked in order; b is redundant when its word set reaches the threshold with that
    of an earlier survivor in one of its band buckets. Equal sets are folded by hash beforehand.
    """
    bands, rows = sketch.PRESETS[preset]
    keyed = _keyed(df, order_by, bands, rows, col, max_words)
    members = _members(keyed)
    wanted = _dealt(df.select(F.col(order_by).alias("ord"), F.col(col)), members)
    features = wanted.select("ord", sketch.word_set(col, max_words).alias("feature"))
    return _walked(keyed, similar_sets_gone(members, features, threshold, MOST_UNSPLIT))


def _dealt(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows that are in a bucket, dealt by `ord` as the layout of the features needs them."""
    return rows.join(members.select("ord").distinct().hint("merge"), "ord", "left_semi")


def near_dup_sets(described: DataFrame, laid: DataFrame, threshold: float = 0.8) -> DataFrame:
    """near_dup_pairs over (ord, set_hash, keys) that are there already, with their features in a table `by_ord`; sets are not empty."""
    return _walked(described.select("ord", "set_hash", "keys"), _laid_sets_gone(
        _members(described), laid.select("ord", "feature"), threshold, MOST_UNSPLIT))


def _walked(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    near = gone.select(F.col("kept_ord").alias("a"), F.col("ord").alias("b"), F.col("score").alias("jaccard"))
    same = keyed.groupBy("set_hash").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = keyed.select("ord", "set_hash").join(same, "set_hash").where("ord <> first")
    copied = copies.join(near.select(F.col("b").alias("first"), "a", "jaccard"), "first", "left").select(
        F.coalesce("a", "first").alias("a"), F.col("ord").alias("b"),
        F.coalesce("jaccard", F.lit(1.0)).alias("jaccard"))
    return near.unionByName(copied)


def similar_to(rows: DataFrame, held: DataFrame, known: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(ord) of the rows (ord, keys, feature) but the `known` that are similar to a row of `held` sharing a key.

    Pairs meet with their outlines, as in a walk, and of the sets only those of a slice of the pairs are shuffled.
    """
    def keyed(df, ord_, outline):
        return _laid(df.select(F.col("ord").alias(ord_), "keys", sketch.outline("feature").alias(outline)))

    spread = lambda df: df.withColumn("key", F.explode("keys")).drop("keys")
    (here, at_here), (there, at_there) = keyed(rows, "ord", "_b"), keyed(held, "lead", "_a")
    here = here.join(known, "ord", "left_anti")
    members = spread(here.select("keys")).unionAll(spread(there.select("keys")))

    def among(part):
        meet = sketch.may_be_similar(F.col("_a"), F.col("_b"), threshold)
        return part(spread(here)).join(part(spread(there)), "key").where(meet).select("lead", "ord").distinct()

    pairs, at = _met(members, among)
    remove(rows.sparkSession, at_here, at_there)
    score = _similar_sets(threshold)(F.col("_a"), F.col("_b"))

    def verified(part):
        few = part(pairs)

        def sets(df, name, feature):
            return df.select(F.col("ord").alias(name), F.col("feature").alias(feature)).join(
                F.broadcast(few.select(name).distinct()), name, "left_semi")  # at most a slice of them
        return few.join(sets(rows, "ord", "_b"), "ord").join(sets(held, "lead", "_a"), "lead").where(score.isNotNull()).select("ord")

    found, _ = _sliced(pairs, ["lead", "ord"], SLICE_PAIRS, verified)
    remove(rows.sparkSession, at)
    return found.distinct()


def dedup_lsh(df: DataFrame, order_by: str = "id", threshold: float = 0.8, preset: str = "recall",
              col: str = "content", max_words: int | None = None) -> DataFrame:
    """Without the documents near_dup_pairs finds redundant."""
    pairs = near_dup_pairs(df, threshold, preset, order_by, col, max_words)
    return df.join(pairs.select(F.col("b").alias(order_by)), order_by, "left_anti")


def simhash_pairs(df: DataFrame, order_by: str = "id", max_distance: int = 3,
                  col: str = "content") -> DataFrame:
    """(a, b, distance): each redundant document b with the surviving earlier document a."""
    prints = staged(df.select(F.col(order_by).alias("ord"), sketch.simhash64(col).alias("feature")), "simhash")
    firsts = staged(prints.groupBy("feature").agg(F.min("ord").alias("ord"), F.count("*").alias("n")), "firsts")  # read in every round
    members = firsts.select("ord", F.explode(
        sketch.simhash_keys("feature", max_distance + 3, max_distance)).alias("key"))
    features = firsts.select("ord", "feature")

    def near(a, b):
        bits = F.bit_count(a.bitwiseXOR(b))
        return F.when(bits <= max_distance, bits.cast("double"))

    gone = keep_first_similar(members, features, near)
    close = gone.select(F.col("kept_ord").alias("a"), F.col("ord").alias("b"),
                        F.col("score").cast("int").alias("distance"))
    copies = prints.join(firsts.where("n > 1").select("feature", F.col("ord").alias("first")), "feature").where(
        "ord <> first")
    copied = copies.join(close.select(F.col("b").alias("first"), "a", "distance"), "first", "left").select(
        F.coalesce("a", "first").alias("a"), F.col("ord").alias("b"),
        F.coalesce("distance", F.lit(0)).alias("distance"))
    return close.unionByName(copied)


def dedup_simhash(df: DataFrame, order_by: str = "id", max_distance: int = 3, col: str = "content") -> DataFrame:
    """Keeps the first of documents whose fingerprints differ in at most max_distance bits."""
    pairs = simhash_pairs(df, order_by, max_distance, col)
    return df.join(pairs.select(F.col("b").alias(order_by)), order_by, "left_anti")
