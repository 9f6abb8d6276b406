import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from weftline.llm import secrets_scan as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    extra = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        c = m[0]
        if not re.search("[0-9]", c) or not re.search("[A-Za-z]", c) or re.search(S.ALLOWED, c):
            continue
        bits = 3.0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", c) else 3.8 if re.search("[a-z]", c) and re.search("[A-Z]", c) else 3.5
        own = []
        for i in range(len(c) - 19):
            if entropy(c[i:i + 20]) >= bits - 1e-9:
                low, high = m.start() + i, m.start() + i + 20
                if own and own[-1][2] >= low:
                    own[-1] = (own[-1][0], 3, high)
                else:
                    own.append((low, 3, high))
        extra += own
    def line(x):
        return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(x))
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], hashlib.sha256(line(found).encode()).hexdigest(), line(found + extra), len(extra)


def cases():
    rng = random.Random(5)
    key = "".join(rng.choice("ABCDEFabcdefghijk0123456789+/") for _ in range(40))
    texts = [None, "", "plain words only", f"é password: '{key}' and more", "Secret=short", "secret: token:abcdefghijklmnop", "token = token=abcdefghijklm",
             "ſecret=abcdefghijklmnop", 'API_KEY":"A.b/c=d-e_f+1234"', "AKIA" + "A1" * 7, "AKIA" + "A1" * 6 + "A", "xAKIAAKIA" + "B2" * 8, "deadbeef" * 2,
             "deadbeef" * 2 + "G", "日本" + "0123456789abcdef" * 3, "123e4567-e89b-12d3-a456-426614174000", f"{key}EXAMPLE", "a1" * 30, key + "\n" + key,
             "passwd:\n x", "password=abcdefghijkl" * 3, "password: " * 50, "word " * 2000 + key, "A" * 5000, key * 60, "".join(rng.choice("ab1 =:") for _ in range(500))]
    pool = ["password", "=", ":", " ", "'", '"', "api_key", "tokeN", "AKIA", "Z9Z9Z9Z9Z9Z9Z9Z9", "0a1b2c3d4e5f6a7b8", "é", key[:25], "\n", "x"]
    return texts + ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(300)]


def test_scan_equals_brute_force(spark):
    rows = [(i, t, 0) for i, t in enumerate(cases())] + [(None, "deadbeefdeadbeef", 0), (3, "x", 0), (3, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_hex int")
    got = sorted((tuple(r) for r in S.scan(df).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=repr)
    assert S.scan(df.limit(0)).collect() == []


def test_masked_texts(spark):
    texts = cases()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("i", S.masked(F.col("text")).alias("m")).collect():
        text = texts[r["i"]]
        if text is None:
            assert r["m"] is None
            continue
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in brute(text)[4].split(",") if s)
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += text[at:a] + S.MASK
            at = max(at, b)
        assert r["m"] == out + text[at:]


def test_long_texts_stay_linear(spark):
    for text in ("ab " * 700_000, "x" * 2_000_000, "password: " * 100_000):
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert S.scan(df).count() == 1 and S.scan(df).collect()[0]["n_assign"] >= 0
