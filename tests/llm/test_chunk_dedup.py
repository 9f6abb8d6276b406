import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import chunk_dedup as C


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        kept = False
        for i in ids:
            stays = i == first and not kept
            kept |= stays
            out.append((i, first, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, recipe string, row int")


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [" ".join(rng.choices(["uno", "dos", "três", "四", "five"], k=rng.randrange(0, 900))) for _ in range(60)]
    out = [(i, rng.choice(base).replace(" ", rng.choice([" ", "\n", "\t \r", "  "]))) for i in range(400)]
    out += [(i, "hot text " * 40) for i in range(1000, 1300)]           # a third of all rows
    out += [(5, None), (6, ""), (None, ""), (7, " "), (8, "\n\t"), (9, " a"), (10, "a"), (11, "a "), (None, "null id"), (None, "null id")]
    out += [(12, "x" * 300_000), (13, "x" * 300_001), (14, "x" * 300_000), (15, "y " * 200_000), (16, "y  " * 200_000), (17, "y " * 200_001)]
    out += [(18, "same id"), (18, "same  id"), (18, "same id"), (19, "a b"), (20, "a b"), (21, "😀 " * 500), (22, "😀\t" * 500)]
    return out


def test_equals_brute_force(spark, rows):
    assert got(C.exact_dedup(frame(spark, rows).repartition(5))) == brute(rows)


def test_identifiers_grow_until_they_are_verified(spark, rows):
    short = [r for r in rows if len(r[1] or "") < 5000]
    assert C._clash(frame(spark, short).select(C.normalised(F.col("text")).alias("norm")), 1, 3)
    assert got(C.exact_dedup(frame(spark, short), words=1, bits=3)) == brute(short)


def test_hot_groups_and_long_lists(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "HOT_LIST", 4)
    assert got(C.exact_dedup(frame(spark, rows))) == brute(rows)


def test_chunks_follow_the_content(spark):
    rng = random.Random(5)
    text = " ".join(rng.choices([f"word{i}" for i in range(2000)], k=20_000))
    cut = lambda t: [r["c"] for r in spark.createDataFrame([(t,)], "t string").select(F.explode(C.chunks(F.col("t"))).alias("c")).collect()]
    first, second = cut(text), cut("some words in front " + text)
    assert "".join(first) == text and len(first) > 60
    assert len(set(first) - set(second)) <= 12 and len(set(second) - set(first)) <= 12
    assert max(len(c) for c in cut("z " * 30_000)) <= 2 * C.LONGEST
    assert cut("") == []


def test_empty_table_and_no_python(spark, rows):
    assert C.exact_dedup(frame(spark, rows).limit(0)).collect() == []
    plan = C.exact_dedup(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
