"""op4's ratio and the whole of op8 against plain Python over the smallest tables."""

import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import quality_classifier as C, quality_rules as Q

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def buckets(text):
    data = (text or "").encode()
    for i in range(len(data) - 3):
        h = 0
        for byte in data[i:i + 4]:
            h = (h ^ byte) * 16777619 % 2**32
        yield h >> 16


def ratios(good, bad):
    """Log ratio of a bucket between two counters."""
    n, m = sum(good.values()), sum(bad.values())
    if not n or not m:
        return lambda b: 0.0
    low = min(n, m)
    return lambda b: math.log(good[b] * low / n + 5) - math.log(bad[b] * low / m + 5)


def mean_ratio(text, of):
    found = Counter(buckets(text))
    return sum(k * of(b) for b, k in found.items()) / max(1, sum(found.values()))


def repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


def tables(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, [r.asDict() for r in docs.collect()], {r["doc_id"]: r for r in labels.collect()}


def test_ratio_equals_plain_python(spark):
    docs, labels, rows, known = tables(spark)
    raw, target = Counter(), Counter()
    for r in rows:
        found = Counter(buckets(r["text"]))
        raw += found
        if r["doc_id"] in known and known[r["doc_id"]]["quality"] == 1 and not known[r["doc_id"]]["toxic"]:
            target += found
    of = ratios(target, raw)
    got = {r["doc_id"]: r for r in Q.quality_rules(docs, labels).collect()}
    for r in rows:
        want = mean_ratio(r["text"], of)
        assert got[r["doc_id"]]["ratio"] == pytest.approx(want, abs=1e-9)
        if abs(want + 0.2) > 1e-9:
            assert got[r["doc_id"]]["kept"] == (not got[r["doc_id"]]["base_failed"] and want >= -0.2)


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def fitted(x, y):
    """The operator's weights, which must be where the penalised likelihood is flat."""
    w = C.fit_logistic(np.array(x, float), np.array(y, float))
    if w.any():
        misses = [t - sigmoid(sum(a * b for a, b in zip(w, [*row, 1.0]))) for row, t in zip(x, y)]
        for k in range(len(w)):
            slope = sum(m * [*row, 1.0][k] for m, row in zip(misses, x)) - (1.0 if k < len(w) - 1 else 1e-6) * w[k]
            assert abs(slope) < 1e-4
    return [float(v) for v in w]


def site_priors(votes):
    """votes: (host, path, vote); the prior of each, its own vote left out."""
    hosts, paths = defaultdict(list), defaultdict(list)
    for host, path, v in votes:
        hosts[host].append(v)
        paths[host, path].append(v)
    mean = (sum(v for *_, v in votes) + 0.5) / (len(votes) + 1)

    def weight(sites):
        spreads = []
        for found in sites.values():
            n = len(found)
            if n > 1:
                rate = sum(found) / n
                noise = (sum(v * v for v in found) / n - rate * rate) / (n - 1)
                spreads.append((rate - mean) ** 2 - noise)
        spread = sum(spreads) / len(spreads) if spreads else 0
        return min(10_000.0, max(1.0, mean * (1 - mean) / max(spread, 1e-9) - 1))

    of_host, of_path = weight(hosts), weight(paths)
    for host, path, v in votes:
        at_host = (sum(hosts[host]) - v + of_host * mean) / (len(hosts[host]) - 1 + of_host)
        at_path = (sum(paths[host, path]) - v + of_path * at_host) / (len(paths[host, path]) - 1 + of_path)
        yield min(1 - 1e-6, max(1e-6, at_path))


def test_classifier_equals_plain_python(spark):
    docs, labels, rows, known = tables(spark)
    half = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("h")).collect()}
    rated = [(r, int(known[r["doc_id"]]["quality"] or 0), int(known[r["doc_id"]]["toxic"] or 0)) for r in rows if r["doc_id"] in known]
    first, second = ([x for x in rated if half[x[0]["doc_id"]] == h] for h in (0, 1))
    good, bad, clean, foul = Counter(), Counter(), Counter(), Counter()

    def word_buckets(text):
        return {xxhash.xxh32_intdigest(w) % 2**18 for w in re.findall(r"\w+", (text or "").lower())}

    for r, quality, toxic in first:
        (good if quality == 1 else bad).update(buckets(r["text"]))
        (foul if toxic else clean).update(word_buckets(r["text"]))
    n_foul = sum(t for *_, t in first)
    rate = n_foul / len(first)
    of = ratios(good, bad)

    def word(b):
        if n_foul in (0, len(first)):
            return 0.0
        return math.log((foul[b] + 50 * rate) / (foul[b] + clean[b] + 50)) - math.log(rate)

    def features(text):
        words = (text or "").encode().split()
        n = max(1, len(words))
        return [mean_ratio(text, of), repeats(words) / n, 1 / n], [max(map(word, word_buckets(text)), default=0.0)]

    seen = [(*features(r["text"]), q, t) for r, q, t in second]
    models = [fitted([s[k] for s in seen], [s[2 + k] for s in seen]) for k in (0, 1)]
    lean = [math.log((sum(s[2 + k] for s in seen) + 0.5) / (len(seen) - sum(s[2 + k] for s in seen) + 0.5)) for k in (0, 1)]
    measured = [features(r["text"]) for r in rows]
    want = []
    for k in (0, 1):
        z = [sum(a * b for a, b in zip(models[k], [*m[k], 1.0])) for m in measured]
        priors = site_priors([(r["source"], r["lang"], sigmoid(v)) for r, v in zip(rows, z)])
        p = [1 / (1 + math.exp(-(v - lean[k] + math.log(prior / (1 - prior))))) for v, prior in zip(z, priors)]
        want.append(p if any(models[k]) else [(0.5, 0.0)[k]] * len(rows))
    got = {r["doc_id"]: r for r in C.quality_classifier(docs, labels).collect()}
    assert len(got) == len(rows)
    for r, quality, toxic in zip(rows, *want):
        row = got[r["doc_id"]]
        assert (row["p_quality"], row["p_toxic"]) == (pytest.approx(quality, abs=1e-6), pytest.approx(toxic, abs=1e-6))
        assert row["toxic"] == (toxic >= 0.5) and row["kept"] == (quality >= 0.5 and toxic < 0.5)


def test_weights_come_from_all_rows_of_a_table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=500) > 0).astype(float)
    rows = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "x0 double, x1 double, x2 double, y long").repartition(7)
    assert np.allclose(C.fit_rows(rows, ["x0", "x1", "x2"], "y"), C.fit_logistic(x, y), atol=1e-9)
    assert not C.fit_rows(rows.where("y = 1"), ["x0"], "y").any() and not C.fit_rows(rows.limit(0), ["x0"], "y").any()
    assert not hasattr(C, "MAX_LABELLED")
