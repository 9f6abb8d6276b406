import os
import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.functions import sketch
from weftline.operators import dedup


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string").repartition(5)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def greedy(items, similar):
    """Walk in order; drop an item similar to an earlier kept one."""
    kept = []
    for i, x in enumerate(items):
        if not any(similar(items[k], x) for k in kept):
            kept.append(i)
    return kept


def words(text):
    return frozenset(re.findall(r"\w+", text.lower()))


def near(t):
    def similar(a, b):
        a, b = words(a), words(b)
        return bool(a) and bool(b) and len(a & b) / len(a | b) >= t
    return similar


def corpus(seed, n=110):
    """Clusters of drifting copies, shared boilerplate and plain copies, in random order."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    boiler = [f"b{i}" for i in range(60)]
    texts, base = [], rng.sample(vocabulary, 50)
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35:                      # copies of one text
            texts.append(" ".join(base))
        elif kind < 0.7:                     # a drifting chain of near copies
            last = texts[-1].split() if texts else list(base)
            for _ in range(rng.randint(1, 5)):
                last[rng.randrange(len(last))] = rng.choice(vocabulary)
            texts.append(" ".join(last))
        else:                                # mostly boilerplate
            texts.append(" ".join(boiler + rng.sample(vocabulary, rng.randint(8, 30))))
    rng.shuffle(texts)
    return texts


def test_exact_strips_and_keeps_the_first(spark):
    df = docs(spark, ["x", " x ", "y"])
    assert ids(dedup.dedup_exact(df)) == [0, 2]
    assert ids(dedup.dedup_exact(dedup.dedup_exact(df))) == [0, 2]
    assert ids(dedup.dedup_exact(df, algo="md5")) == [0, 2]


def test_exact_within_a_scope(spark):
    df = docs(spark, ["x", "x", "x"]).withColumn("file", F.when(F.col("id") == 2, "b").otherwise("a"))
    assert ids(dedup.dedup_exact(df, scope=["file"])) == [0, 2]


def test_signature_ignores_order_and_repeats(spark):
    assert ids(dedup.dedup_signature(docs(spark, ["a b c", "c b a a", "a b d"]))) == [0, 2]


def test_signature_limit_reads_only_the_first_words(spark):
    df = docs(spark, ["a b c", "a b d"])
    assert ids(dedup.dedup_signature(df, max_words=2)) == [0]


def test_signature_estimates_jaccard(spark):
    a, b = " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(50, 250))
    rows = docs(spark, [a, b]).select(sketch.minhash_signature("content").alias("s")).collect()
    same = sum(x == y for x, y in zip(rows[0]["s"], rows[1]["s"])) / 128
    assert same == pytest.approx(150 / 250, abs=0.15)


@pytest.mark.parametrize("seed", [1])
def test_lsh_equals_the_sequential_walk(spark, seed):
    texts = corpus(seed)
    df = docs(spark, texts)
    kept = greedy(texts, near(0.8))
    pairs = dedup.near_dup_pairs(df, 0.8).collect()
    assert sorted(set(range(len(texts))) - {r["b"] for r in pairs}) == kept
    for r in pairs:
        a, b = words(texts[r["a"]]), words(texts[r["b"]])
        assert r["a"] in kept and r["a"] < r["b"]
        assert r["jaccard"] >= 0.8 - 1e-9 or a == b
    assert ids(dedup.dedup_lsh(df, threshold=0.8)) == kept


def test_dividing_buckets_loses_no_pair(spark):
    texts = corpus(3)
    members = spark.createDataFrame([(i, 7) for i in range(len(texts))], "ord int, key bigint")
    features = docs(spark, texts).select(F.col("id").alias("ord"), sketch.word_set("content").alias("feature"))
    split = dedup.divide(members, features, 0.8, above=4).collect()
    buckets = {}
    for r in split:
        buckets.setdefault(r["key"], set()).add(r["ord"])
    together = {(a, b) for m in buckets.values() for a in m for b in m if a < b}
    similar = near(0.8)
    wanted = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if similar(texts[a], texts[b])}
    assert wanted <= together


def test_overlapping_buckets_count_words_once(spark, monkeypatch):
    """Buckets of much the same rows: words are counted once for all, and pairs are those of one bucket alone."""
    texts = corpus(3)
    rng = random.Random(4)
    held = {(i, k) for k in range(12) for i in range(len(texts)) if rng.random() < 0.9} | {(i, 50 + i % 2) for i in range(len(texts))}
    members = spark.createDataFrame(sorted(held), "ord int, key bigint")
    features = docs(spark, texts).select(F.col("id").alias("ord"), sketch.word_set("content").alias("feature"))
    counted, plain = [], dedup.staged

    def staged(df, name):
        out = plain(df, name)
        if name == "often":
            counted.append(out.count())
        return out

    monkeypatch.setattr(dedup, "staged", staged)
    buckets, keys = {}, {}
    for r in dedup.divide(members, features, 0.8, above=4).collect():
        buckets.setdefault(r["key"], set()).add(r["ord"])
    for i, k in held:
        keys.setdefault(i, set()).add(k)
    together = {(a, b) for m in buckets.values() for a in m for b in m if a < b}
    shared = {(a, b) for a in keys for b in keys if a < b and keys[a] & keys[b]}
    similar = near(0.8)
    assert {(a, b) for a, b in shared if similar(texts[a], texts[b])} <= together <= shared
    vocabulary = {w for t in texts for w in words(t)}
    assert 0 < sum(counted) <= 2 * len(vocabulary)


def test_walk_settles_a_long_chain_and_a_hot_bucket(spark):
    # numbers within distance 1 are similar; all share one bucket, so 0, 2, 4, ... survive
    n = 40
    members = spark.createDataFrame([(i, 1) for i in range(n)], "ord int, key bigint")
    features = spark.createDataFrame([(i, i) for i in range(n)], "ord int, feature int")

    def similar(a, b):
        return F.when(F.abs(a - b) <= 1, F.lit(1.0))

    gone = dedup.keep_first_similar(members, features, similar).collect()
    assert sorted(r["ord"] for r in gone) == list(range(1, n, 2))
    assert all(r["kept_ord"] == r["ord"] - 1 for r in gone)


def test_rounds_grow_slowly_in_a_bucket_of_unlike_rows(spark, monkeypatch):
    # pairs (2i, 2i + 1) are similar, all else is not; leaders double: 1, 4, 8, 16, 32
    n, taken, top = 80, [], dedup.top_per_group
    monkeypatch.setattr(dedup, "top_per_group", lambda df, by, order, k, salt_on: taken.append(k) or top(df, by, order, k, salt_on))
    members = spark.createDataFrame([(i, 1) for i in range(n)], "ord int, key bigint")
    features = spark.createDataFrame([(i, i // 2) for i in range(n)], "ord int, feature int")
    gone = dedup.keep_first_similar(members, features, lambda a, b: F.when(a == b, F.lit(1.0)), leaders=4).collect()
    assert sorted(r["ord"] for r in gone) == list(range(1, n, 2))
    assert all(r["kept_ord"] == r["ord"] - 1 for r in gone)
    assert taken[:4] == [1, 4, 8, 16] and len(taken) <= 6


def test_simhash_walk_equals_brute_force(spark):
    texts = corpus(4)
    df = docs(spark, texts)
    prints = {r["id"]: r["f"] for r in df.select("id", sketch.simhash64("content").alias("f")).collect()}
    values = [prints[i] & (2**64 - 1) for i in range(len(texts))]
    kept = greedy(values, lambda a, b: bin(a ^ b).count("1") <= 3)
    assert ids(dedup.dedup_simhash(df)) == kept


def test_simhash_keys_cover_three_flips(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 3):
            y ^= 1 << bit
        rows += [(2 * i, x), (2 * i + 1, y)]
    signed = [(i, v - 2**64 if v >> 63 else v) for i, v in rows]
    keys = spark.createDataFrame(signed, "i int, f bigint").select("i", sketch.simhash_keys("f").alias("k")).collect()
    k = {r["i"]: set(r["k"]) for r in keys}
    assert all(k[2 * i] & k[2 * i + 1] for i in range(200))


def test_candidates_are_linear_in_a_bucket_of_near_copies(spark):
    texts = [" ".join(f"w{i}" for i in range(200)) + f" x{n}" for n in range(60)]
    pairs = dedup.lsh_candidates(docs(spark, texts)).collect()
    assert len(pairs) <= 9 * 60 and {r["b"] for r in pairs} >= set(range(1, 60)) - {0}


def test_visited(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("b",)], "url string")
    seen = spark.createDataFrame([("a",)], "url string")
    assert [r["url"] for r in dedup.visited_dedup(urls, seen).collect()] == ["b"]


def test_keep_first_with_null_keys_and_scopes(spark):
    rows = [(1, None, "s"), (2, None, "s"), (3, None, None), (4, "x", None), (5, "x", None), (6, "x", "s"), (7, " x", "s")]
    df = spark.createDataFrame(rows, "id int, content string, source string")
    assert {r["id"] for r in dedup.dedup_exact(df).collect()} == {1, 4}
    assert {r["id"] for r in dedup.dedup_exact(df, scope=["source"]).collect()} == {1, 3, 4, 6}


def test_outlines_rule_out_unlike_sets_only(spark):
    rng = random.Random(8)
    fresh = lambda n: [rng.randrange(-2**62, 2**62) for _ in range(n)]
    base = fresh(300)
    sets = [[], base] + [base[:300 - k] + fresh(k) for k in range(0, 300, 7)] + [base[:n] for n in (200, 239, 240, 241, 270)]
    rows = spark.createDataFrame(list(enumerate(sets)), "ord int, feature array<bigint>").select("ord", sketch.outline("feature").alias("o"))
    a, b = rows.toDF("a", "x"), rows.toDF("b", "y")
    may = {(r["a"], r["b"]): r["may"] for r in a.crossJoin(b).select("a", "b", sketch.may_be_similar(F.col("x"), F.col("y"), 0.8).alias("may")).collect()}
    out = 0
    for (i, j), held in may.items():
        x, y = set(sets[i]), set(sets[j])
        similar = len(x & y) >= 0.8 * len(x | y) - 1e-12
        assert held or not similar
        out += not held
    assert out > len(may) / 2


def test_features_are_read_for_possible_pairs_only_and_nothing_stays(spark, monkeypatch):
    seen, verified = [], dedup._verified
    monkeypatch.setattr(dedup, "_verified", lambda pairs, *more: seen.append(pairs.count()) or verified(pairs, *more))
    shared = " ".join(f"same{i}" for i in range(60))  # Jaccard 0.6: in common buckets, but not similar
    texts = [shared + " " + " ".join(f"own{k}x{i}" for i in range(20)) for k in range(40)]
    folder = spark.conf.get("spark.checkpoint.dir")
    held = set(os.listdir(folder))
    pairs = dedup.near_dup_pairs(docs(spark, texts + [texts[3] + " more"])).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(3, 40)]
    assert sum(seen) < 20
    assert not [name for name in set(os.listdir(folder)) - held if name.startswith(("features", "wordsets"))]


def test_pairs_that_outlines_rule_out_are_not_made(spark, monkeypatch):
    """The join of rows with their leads tests outlines itself; a bucket of unlike rows makes no pair."""
    plans, laid = [], dedup._laid
    monkeypatch.setattr(dedup, "_laid", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or laid(df))
    sets = [list(range(100 * i, 100 * i + 60)) for i in range(30)]
    sets += [s[:-1] for s in sets[:5]]
    features = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "ord long, feature array<long>").repartition(8, "ord")
    members = spark.createDataFrame([(i, 7) for i in range(len(sets))], "ord long, key long")
    gone = dedup.similar_sets_gone(members, features, 0.8).collect()
    assert sorted((r["ord"], r["kept_ord"]) for r in gone) == [(30 + i, i) for i in range(5)]
    met = [line for plan in plans for line in plan.splitlines() if "Join Inner" in line and "lead" in line and "<" in line]
    assert met and all("bit_count" in line for line in met)


def test_outlines_of_long_sets_rule_out_unlike_ones(spark):
    """512 bits are full of 1,500 hashes; longer bitmaps tell such sets apart, and lose no similar pair of other lengths."""
    rng = random.Random(9)
    fresh = lambda n: [rng.randrange(-2**62, 2**62) for _ in range(n)]
    common, base = fresh(150), fresh(1040)
    unlike = [common + fresh(1350) for _ in range(6)]
    like = [base[:n] for n in (500, 520, 840, 1000, 1020, 1024, 1030, 1040)] + [base + fresh(100)]
    sets = unlike + like
    rows = spark.createDataFrame(list(enumerate(sets)), "ord int, feature array<bigint>").select("ord", sketch.outline("feature").alias("o"))
    a, b = rows.toDF("a", "x"), rows.toDF("b", "y")
    may = {(r["a"], r["b"]): r["may"] for r in a.crossJoin(b).select("a", "b", sketch.may_be_similar(F.col("x"), F.col("y"), 0.8).alias("may")).collect()}
    for (i, j), held in may.items():
        x, y = set(sets[i]), set(sets[j])
        assert held or len(x & y) < 0.8 * len(x | y) - 1e-12
    assert not any(may[i, j] for i in range(6) for j in range(6) if i != j)


def test_slices_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(300)}" for _ in range(30)] for _ in range(5)]
    texts = [" ".join(w if rng.random() < 0.97 else f"x{rng.randrange(40)}" for w in rng.choice(base)) for _ in range(60)]
    whole = sorted(map(tuple, dedup.near_dup_pairs(docs(spark, texts)).collect()))
    monkeypatch.setattr(dedup, "SLICE_ROWS", 400)
    monkeypatch.setattr(dedup, "SLICE_PAIRS", 20)
    assert sorted(map(tuple, dedup.near_dup_pairs(docs(spark, texts)).collect())) == whole and whole


def test_small_band_buckets_are_not_split(spark, monkeypatch):
    """Splitting a row's buckets by its words makes many times as many rows; below MOST_UNSPLIT outlines are compared instead."""
    sizes, shared_only = [], dedup.shared_only
    monkeypatch.setattr(dedup, "shared_only", lambda m: sizes.append(m.count()) or shared_only(m))
    shared = " ".join(f"same{i}" for i in range(60))
    texts = [shared + " " + " ".join(f"own{rng}x{i}" for i in range(20)) for rng in range(40)]
    assert dedup.near_dup_pairs(docs(spark, texts)).collect() == []
    assert max(sizes) <= 40 * 32 and sizes == sorted(sizes, reverse=True)
