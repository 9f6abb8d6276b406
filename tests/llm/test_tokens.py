import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weftline.llm import bpe, packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a \n b", "it's we'll 'tis ''s 'LL", "a_b __x _", "日本語のテキスト", "½ Ⅷ x²", "\x1c\x1d \x85  x", "naïve façade – «q»",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "!!<|endoftext|>", "<|endo", "🙂 é ﬁ", "a" * 3000, "x y " * 4000, " " * 500 + "q", "\t\t\n\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def noise():
    rng = random.Random(3)
    letters = "abcdeé ÖßĀ \t\n  '’sreLl0129_-.,&|½\x1c\x85日🙂"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]


def test_counts_and_ids_equal_the_library(library):
    counts, ids = bpe.piece_counts(PATH), bpe.piece_ids(PATH)
    for text in ODD + noise():
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.encode(text), "<u2").tolist() == want, text
        assert counts.total(text) == len(want), text


def test_least_id_first_is_least_rank_first():
    vocab = bpe.vocabulary(PATH)
    assert vocab.quick and all(vocab.merged(token) == [token] for token in vocab.ids)


def test_plain_texts_equal_the_library(library):
    vocab, rng = bpe.vocabulary(PATH), random.Random(5)
    runs = [c * n for c in ("a", " ", "\n", "#", "7", "'s", "ab ", "é", " \t") for n in (1, 2, 499, 500, 70_000)]
    mixed = ["".join(rng.choice(["<|endoftext|>", "<|", "don't", "  ", "\n\n", "x9", "ÀÿƟ", "--", "\x0b\x0c", "…"]) for _ in range(30)) for _ in range(300)]
    for text in runs + mixed:
        want = library.encode(text, add_special_tokens=False).ids
        assert vocab.plain_ids(text).tolist() == want, text[:80]


def test_every_prefix_and_budget(library):
    counts = bpe.piece_counts(PATH)
    for text in [t for t in ODD if len(t) < 100] + noise()[:40]:
        full = library.encode(text, add_special_tokens=False)
        for end in range(len(text) + 1):
            assert counts.prefix(text, end) == len(library.encode(text[:end], add_special_tokens=False).ids), (text, end)
        sizes = [len(bpe.vocabulary(PATH).special and t.encode() if i == 50256 else bytes(map(bpe.vocabulary(PATH).to_byte.__getitem__, t)))
                 for i, t in zip(full.ids, full.tokens)]
        for budget in range(len(full.ids) + 1):
            assert counts.cut(text, budget) == sum(sizes[:budget]), (text, budget)


def test_token_counts(spark, library):
    rows = [(i, t, 1) for i, t in enumerate([None, *ODD])] + [(0, "twice", 1), (0, "twice", 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts.token_counts(df, PATH).drop("limit_bytes").collect()), key=repr)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(df.limit(0), PATH).collect() == []


def test_packing_round_trip(spark, library):
    rows = [(i, t, 5) for i, t in enumerate([None, *ODD, *noise()])] + [(3, "again", 5), (3, "again", 5), (None, "no id", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(5)
    got = packing.pack(df, PATH, length=64).collect()
    docs = {}
    for i, t, _ in rows:
        docs.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    total = sum(len(x) for v in docs.values() for x in v)
    assert sum(r["length"] for r in got) == total
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert any(r["doc_tokens"] == len(x) and r["ids_crc32"] == zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
                   for x in docs[r["doc_id"]])
        assert r["continues"] == (r["start"] + r["length"] < r["doc_tokens"])
    assert sorted(windows) == list(range(-(-total // 64)))
    for k, parts in windows.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == (64 if k < total // 64 else total % 64)
    pieces = sorted((str(r["doc_id"]), r["start"]) for r in got)
    assert len(pieces) == len(got) and packing.pack(df.limit(0), PATH).collect() == []


def test_millions_of_white_space_characters(spark):
    vocab = bpe.vocabulary(PATH)
    texts = ["a" + " " * 1_500_000 + "b c", "\n" * 3_000_000, "x " + "\t " * 600_000 + "y"]
    for text in texts:
        ids = vocab.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bpe.PieceIds(vocab).encode(text), vocab.kind).tolist() == ids
    rows = packing.pack(spark.createDataFrame(enumerate(texts), "doc_id long, text string"), PATH).collect()
    assert sum(r["length"] for r in rows) == sum(len(vocab.library.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
