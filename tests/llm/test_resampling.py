import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from weftline.llm import resampling as R
from weftline.llm.terms import features, term_lists

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, goal, percent=10, least=20, buckets=10_000, longest=1):
    def runs(text):
        words = PATTERN.findall(lowered(text))
        return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    def at(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(at, runs(text)[1]))
    for text in goal:
        t.update(map(at, runs(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        n_words, found = runs(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(at, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words))
    free = sorted((i for i, r in enumerate(out) if r[4] >= least), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, out[i][1:3]))
    rank = {i: n + 1 for n, i in enumerate(free[:len(free) * percent // 100])}
    return sorted(((*r[:4], rank.get(i)) for i, r in enumerate(out)), key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(300)] + ["Élan", "ÀB", "naïve", "日本", "A-b", "x_y"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 60)))) for i in range(1500)]
    rows += [(None, "one two " * 15), (None, None), (2000, ""), (2001, None), (2002, "Wide " * 200_000), (2003, "x" * 1_500_000)]
    rows += [(2004, "same words here " * 9)] * 3 + [(2004, "other words here " * 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1, "z") for d, t in rows], "doc_id long, text string, score string, rank int, bucket string")


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("percent,width,longest", [(10, 0.005, 1), (37, 0.0, 2), (100, 0.005, 1), (0, 0.005, 1)])
def test_equals_brute_force(spark, docs, percent, width, longest):
    goal = ["w1 w2 w3 Élan " * 20, None, "", "w7 w1"]
    target = spark.createDataFrame([(t, 1) for t in goal], "text string, doc_id int")
    found = R.resample(frame(spark, docs).repartition(5), target, percent=percent, width=max(width, 1e-9), longest=longest)
    assert got(found) == brute(docs, goal, percent, longest=longest)


def test_ties_and_empty(spark):
    rows = [(i % 50, "tie " * 25) for i in range(400)]      # every id eight times
    target = spark.createDataFrame([], "text string")
    assert got(R.resample(frame(spark, rows), target, percent=13)) == brute(rows, [], 13)
    assert R.resample(frame(spark, rows).limit(0), target).collect() == []


def test_wrong_sketch_is_widened(spark, monkeypatch):
    rows = spark.createDataFrame([(i, (i * 7919) % 100_000) for i in range(20_000)], "doc_id long, score long")
    scores = sorted((r["score"] for r in rows.collect()), reverse=True)
    monkeypatch.setattr(R, "SKETCH", 2)   # ranks off by half the rows
    for wanted in (1, 2_000, 19_999, 20_000):
        low, high, above = R.bracket(rows, wanted, 20_000, 1e-6)
        assert low <= scores[wanted - 1] <= high and above == sum(s > high for s in scores)


def test_long_texts_are_cut_between_terms():
    text = b"ab cd-EF " * 50 + b"g" * 100 + b" h\xc3\xa9"
    whole = next(term_lists(text))
    assert [w for part in term_lists(text, 16) for w in part] == whole
    assert features(text, 2)[b"ab cd"] == 50 and features(text, 2)[b"ef ab"] == 49
