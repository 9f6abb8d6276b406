import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import grams, quality_classifier as C, quality_rules as Q

FOLDER = "/root/testdata/sf0.01"
needs = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures_equal_brute_force():
    for text in ["", " ", "a", "a b c", "a b c a b c", "a a a a", "x\nx\n\n \n y\ny \nx", "é # é # é # $", "a\x1cb\x85c a\x1cb\x85c", "w " * 200,
                 "日本 語 <|> 日本 語 <|>\n日本"]:
        assert Q.measures(text) == brute(text), text


def rows(spark):
    prose = "the quick brown fox jumps over a lazy dog while rain falls on quiet hills and rivers "
    data = [(i, prose * 5 + str(i), 7) for i in range(40)] + [(100 + i, "| a%%% | b&&& | " * 20 + str(i), 7) for i in range(10)]
    data += [(200, None, 7), (201, "", 7), (0, prose * 5 + "0", 7), (None, prose, 7), (300, "z" * 3_000_000, 7)]
    labels = [(i, 1, 0) for i in range(0, 40, 2)] + [(100 + i, 0, 0) for i in range(0, 10, 2)] + [(None, 1, 0), (0, 1, 0)]
    return (data, spark.createDataFrame(data, "doc_id long, text string, quality int").withColumn("source", F.lit("s")).withColumn("lang", F.lit(None).cast("string")),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_rules(spark):
    data, docs, labels = rows(spark)
    got = sorted(map(tuple, Q.quality_rules(docs, labels).collect()), key=repr)
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()} - {None}
    counts = np.zeros((2, grams.BUCKETS))
    for i, t, _ in data:
        for b in grams.bucket_chunks((t or "").encode()):
            for k in range(1 + (i in trusted)):
                np.add.at(counts[k], b, 1)
    ratio = grams.log_ratio(counts[1], counts[0])
    want = []
    for i, t, _ in data:
        m = brute(t)
        r = grams.mean_ratio((t or "").encode(), ratio)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want.append((i, *m, failed, r, not failed and r >= Q.THRESHOLD))
    assert got == sorted(want, key=repr)
    assert Q.quality_rules(docs.limit(0), labels).collect() == []
    assert {r["ratio"] for r in Q.quality_rules(docs, labels.limit(0)).collect()} == {0.0}


@needs
def test_rules_and_classifier_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    kept = Q.quality_rules(docs, labels).join(labels, "doc_id").where("n_words >= 50").toPandas()
    assert kept[kept.quality == 1].kept.mean() > 0.95 and kept[kept.quality == 0].kept.mean() < 0.1
    got = C.quality_classifier(docs, labels)
    assert got.count() == docs.count()
    held = got.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))).drop("toxic").join(labels, "doc_id").toPandas()
    clean = held[(held.quality == 1) & (held.toxic == 0)]
    assert clean.kept.mean() > 0.97 and held[held.quality == 0].kept.mean() < 0.1


def test_classifier_edges(spark):
    data, docs, labels = rows(spark)
    got = C.quality_classifier(docs, labels)
    assert got.count() == len(data)
    assert C.quality_classifier(docs.limit(0), labels).collect() == []
    assert {(r["p_quality"], r["p_toxic"], r["kept"]) for r in C.quality_classifier(docs, labels.limit(0)).collect()} == {(0.5, 0.0, True)}


def test_learning_holds_half_of_the_labelled_texts_and_leaves_none(spark, monkeypatch):
    data, docs, labels = rows(spark)
    held, staged = {}, C.staged

    def noted(df, name):
        out = staged(df, name)
        held[name] = (out.count(), out.inputFiles()[0].removeprefix("file:"))
        return out

    monkeypatch.setattr(C, "staged", noted)
    assert C.quality_classifier(docs, labels).count() == len(data)
    known = docs.join(labels.select("doc_id").distinct(), "doc_id")
    n, file = held["labelled"]
    assert n == known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).count() < known.count()
    assert not os.path.exists(file) and os.path.exists(held["evidence"][1])


def test_priors_shrink_sparse_sites(spark):
    votes = [("big", "a", 0.9)] * 200 + [("bad", "a", 0.1)] * 200 + [("new", "a", 0.9), ("new", "a", 0.9)]
    df = spark.createDataFrame(votes, "host string, path string, v double")
    prior = {r["host"]: r["v_prior"] for r in C.posterior(df, "v").collect()}
    assert prior["big"] > 0.85 and prior["bad"] < 0.15 and prior["big"] > prior["new"] > 0.5
