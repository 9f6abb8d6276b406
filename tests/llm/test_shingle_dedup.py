import os
import random

import corpus_pipeline as P
from weftline.llm import shingle_dedup as S


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(rows):
    """Places of the rows that stay."""
    kept = []
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        own = grams(rows[i][1])
        if all(len(own & g) / len(own | g) < 0.8 for _, g in kept):
            kept.append((i, own))
    return sorted(i for i, _ in kept)


def cases():
    rng = random.Random(3)
    texts = [None, "", " \n", "one two", "One TWO", "one two three four five", "é É"]
    for n in (40, 60, 90, 200, 600):
        for _ in range(4):
            base = [f"w{rng.randrange(5000)}" for _ in range(n)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, 5):
                words = list(base)
                for at in rng.sample(range(n), edits):
                    words[at] = f"x{rng.randrange(5000)}"
                texts.append(" ".join(words))
    rng.shuffle(texts)
    return [(None if i % 17 == 0 else 900 - i // 2, t) for i, t in enumerate(texts)]


def test_rows_to_drop_equal_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_number long, doc_id long, text string")
    gone = [r[0] for r in S.near_duplicates(df).collect()]
    assert len(gone) == len(set(gone))
    assert sorted(set(range(len(rows))) - set(gone)) == brute(rows)
    assert S.near_duplicates(df.limit(0)).collect() == []


def test_rows_left_out_drop_nothing(spark):
    rows = cases()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_number long, doc_id long, text string")
    part = [i for i in range(len(rows)) if i % 3]
    gone = {r[0] for r in S.near_duplicates(df, among=df.where("row_number % 3 > 0").select("row_number")).collect()}
    assert sorted(set(part) - gone) == [part[i] for i in brute([rows[i] for i in part])] and gone <= set(part)


def test_stage_holds_texts_once(spark):
    """One copy of the texts and the numbers of rows are all that the stage leaves on disk for its result."""
    folder = spark.conf.get("spark.checkpoint.dir")
    rows = [(i, " ".join(f"w{(i // 2) * 100 + k}" for k in range(80)) + " x" * (i % 2), "en", "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for step, most in (("simhash_near_dedup", {"numbered", "firsts", "similar"}), ("mix_sources", {"numbered", "taken"})):
        before = set(os.listdir(folder))
        kept = dict(P.STAGES)[step](spark, docs, "")
        left = [name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before]
        assert sorted(left) == sorted(most)
        assert kept.count() == (20 if "near" in step else kept.count()) > 0


def test_stage_drops_pairs_at_0_8(spark):
    """One word of sixty changed: far beyond three bits of a fingerprint, and a near-duplicate."""
    rng = random.Random(1)
    rows = []
    for i in range(20):
        words = [f"w{rng.randrange(9000)}" for _ in range(60)]
        rows.append((i, " ".join(words), "en", "a", 1))
        words[30] = "other"
        rows.append((100 + i, " ".join(words), "en", "a", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(P.STAGES)["simhash_near_dedup"](spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(20))
