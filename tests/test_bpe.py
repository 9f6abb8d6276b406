import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import bpe, tokenize
from weftline.session import shared_dir


def sequential(words, merges):
    """One merge after the other, all pairs counted anew each time."""
    split, out = {w: list(w) for w in words}, []
    for rank in range(merges):
        pairs = Counter()
        for w, parts in split.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += words[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        out.append((rank, *best, pairs[best]))
        split = {w: bpe.merged(parts, {best}) for w, parts in split.items()}
    return out, split


def texts(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeéß日", [9, 7, 5, 4, 3, 2, 1, 1], k=rng.randrange(1, 7))) for _ in range(150)]
    return [" ".join(rng.choice(stems) + rng.choice(["", "ab", "aaa", "ing", "a"]) for _ in range(rng.randrange(1, 80))) for _ in range(60)] + [None, "", "aaaa aaaaaaaa aaa", "!?"]


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, content string")


@pytest.mark.parametrize("seed,candidates", [(1, 1024), (2, 1024), (3, 5), (4, 1)])
def test_batches_equal_one_merge_after_the_other(spark, seed, candidates):
    rows = texts(seed)
    words = Counter(w for t in rows if t for w in re.findall(r"\w+", t.lower()))
    merges = 40 if candidates < 10 else 150
    wanted, split = sequential(words, merges)
    got = bpe.train_bpe(frame(spark, rows), merges, candidates=candidates)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == wanted
    ranks = {(a, b): r for r, a, b, _ in wanted}
    assert all(bpe.encode_word(list(w), ranks) == split[w] for w in words)


def test_no_pairs_and_no_leftover_tables(spark):
    folder = shared_dir(spark)
    listed = lambda: spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder))
    before = len(list(listed()))
    assert bpe.train_bpe(frame(spark, ["a b c", None]), 5).collect() == []
    assert bpe.train_bpe(frame(spark, texts(5)), 60).count() == 60
    assert len(list(listed())) == before


def test_ids_decode_to_the_words(spark):
    rows = texts(6)
    df = frame(spark, rows)
    merges = bpe.train_bpe(df, 50, mark=bpe.SPACE_MARK)
    vocab = bpe.bpe_vocab(df, merges, mark=bpe.SPACE_MARK)
    ids = [r["token_id"] for r in vocab.collect()]
    assert len(ids) == len(set(ids))
    coded = tokenize.tokenize(df, bpe.bpe_tokenizer(vocab, merges, bpe.SPACE_MARK), max_length=10_000, min_tokens=1)
    got = {r["id"]: r["t"] for r in coded.select("id", bpe.decoder(vocab, bpe.SPACE_MARK)("tokens").alias("t")).collect()}
    assert got == {i: " ".join(re.findall(r"\w+", t.lower())) for i, t in enumerate(rows) if t and re.search(r"\w", t)}
    short = tokenize.tokenize(df, bpe.bpe_tokenizer(vocab, merges, bpe.SPACE_MARK), max_length=12, min_tokens=1)
    assert max(r["token_count"] for r in short.collect()) == 12


def test_unknown_letters_and_a_very_long_word(spark):
    df = frame(spark, ["ab ab abc"])
    merges = bpe.train_bpe(df, 2)
    vocab = bpe.bpe_vocab(df, merges)
    tokenizer = bpe.bpe_tokenizer(vocab, merges)
    row = frame(spark, ["ab" * 200_000 + " xab"]).select(tokenizer(F.col("content"), 10).alias("t")).first()["t"]
    known = {r["token"]: r["token_id"] for r in vocab.collect()}
    assert len(row) == 200_002 and row[0] == known["ab"] and row[-2:] == [known["<unk>"], known["ab"]]
