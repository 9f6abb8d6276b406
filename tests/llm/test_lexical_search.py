import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from weftline.llm import lexical_search as L

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in PATTERN.findall(text or "")]


def brute(docs, items, k=10):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for i, (d, c) in enumerate(found):
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, n in Counter(terms(text)).items() if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, i))
        out += [(item_id, r + 1, None if none else d, -s) for r, (s, none, d, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "c", b"x", 1) for d, t in docs], "doc_id long, text string, score string, term binary, item_id int"),
            spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, weight int"))


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(2)
    vocab = [f"t{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(0, 120)))) for i in range(700)]
    docs += [(i, "T1 t2 rare") for i in range(800, 1000)]        # ties, and a hot group
    docs += [(None, "rare t9"), (2000, None), (2001, ""), (2002, "-- ?"), (2003, "t3 " * 50_000), (2003, "t4 t5"), (2004, "É t6 日本")]
    items = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 40)))) for i in range(90)]
    items += [(200, "rare"), (201, None), (202, ""), (203, "unheard words"), (204, "t1 T1 t1 é É 日本"), (205, "t7"), (205, "t7"), (None, "t8 rare")]
    return docs, items


@pytest.mark.parametrize("known_bytes", [None, 0])
def test_equals_brute_force(spark, tables, known_bytes, monkeypatch):
    docs, items = tables
    a, b = frames(spark, docs, items)
    if known_bytes == 0:
        monkeypatch.setattr(L, "SLICE_DOCS", 25)     # more slices, more pruning
        monkeypatch.setattr(L, "BUNDLE", 7)
    assert got(L.search(a.repartition(3), b.repartition(2), known_bytes=known_bytes)) == brute(docs, items)


def test_other_bands_and_k(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(L, "SLICE_POSTINGS", 500)
    a, b = frames(spark, docs, items)
    assert got(L.search(a, b, k=3, bands=(2000,))) == brute(docs, items, 3)


def test_empty_tables(spark, tables):
    a, b = frames(spark, *tables)
    assert L.search(a.limit(0), b).collect() == []
    assert L.search(a, b.limit(0)).collect() == []


def test_accumulators_are_left_behind():
    ids, sizes = list(range(500)), np.full(500, 4)
    flat = [(0, b"rare", 8000, 0), (0, b"common", 100, 1)]
    start = L._packed([(1, 1)], ids, sizes, flat, *(np.zeros(0, np.int64) for _ in range(3)))
    lists = pd.DataFrame({"term": [b"rare"], "blob": [L._packed(np.arange(20, dtype=np.int32), np.ones(20, np.int32))]})
    left = pd.DataFrame({"bundle": [0], "slice": [0], "blob": [start]})
    sent = L._accumulated((500, 2000), 0, 10, False)(left, lists)
    assert len(L._unpacked(sent.blob[0])[4]) == 20                   # ties stay
    lists = pd.DataFrame({"term": [b"common"], "blob": [L._packed(np.arange(500, dtype=np.int32), np.ones(500, np.int32))]})
    best = L._accumulated((500, 2000), 1, 10, True)(sent, lists)
    assert best.doc_id.tolist() == list(range(10))
