import itertools
import random

import pytest
import xxhash

from weftline.llm import simhash_dedup as S
from weftline.llm.components import components


def brute_print(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
            root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(len(ids))]


def test_documents_equal_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n", "one", "one two", "One TWO", "É É é", base, base + " tail", base.upper(), "a b c " * 3000,
             "x" * 50_000, base, "\x1c\x85 b"]
    rows = [(50 - i, t, "clash") for i, t in enumerate(texts)] + [(50, None, "clash"), (None, base, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(map(tuple, S.simhash_components(df).collect()), key=repr)
    prints = [brute_print(t) for _, t, _ in rows]
    want = brute_components([r[0] for r in rows], prints)
    assert got == sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, want)), key=repr)
    assert S.simhash_components(df.limit(0)).collect() == []


@pytest.mark.parametrize("block", [4, 2048])
def test_links_connect_what_is_near(spark, monkeypatch, block):
    """Clusters around centres, a chain of one-bit steps and a dense ball, in whole and in cut buckets."""
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(1)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:20]:
        for _ in range(5):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5]))))
    prints += [prints[0] ^ ((1 << k) - 1) for k in range(12)] + [prints[1] ^ rng.getrandbits(7) << 20 for _ in range(60)]
    ids = list(range(len(prints)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long")
    root = {r["node"]: r["root"] for r in components(S.links(df)).collect()}
    got = [root.get(s, s) for s in signed]
    want = brute_components(ids, prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
    assert S.links(df).count() < 64 * len(prints)


def test_components_of_a_long_path(spark):
    n = 300
    path = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(900, 901)], "a long, b long"))
    roots = {r["node"]: r["root"] for r in components(path).collect()}
    assert roots == {i: 0 for i in range(n)} | {900: 900, 901: 900}
