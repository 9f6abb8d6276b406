import os
import random
import re
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from test_secrets_scan import cases, entropy  # noqa: E402
from weftline.llm import queries, secrets_scan as S  # noqa: E402

PART = re.compile(r"(?i:example|sample|dummy|placeholder|changeme|abcdefgh|12345678|(.)\1{5,})")
UUID = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


def bits(w, whole):
    if re.search("[A-Za-z]", w):
        return 3.0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", w) else 3.8 if re.search("[a-z]", w) and re.search("[A-Z]", w) else 3.5
    return 3.0 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", whole) else 3.5


def brute(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        c = m[0]
        if not re.search("[0-9]", c) or not re.search("[A-Za-z]", c) or UUID.fullmatch(c):
            continue
        hidden = [a.span() for a in PART.finditer(c)]
        own = []
        for i in range(len(c) - 19):
            w = c[i:i + 20]
            if entropy(w) >= bits(w, c) - 1e-9 and not any(a < i + 20 and b > i for a, b in hidden):
                low = m.start() + i
                own = own[:-1] + [(own[-1][0], low + 20)] if own and own[-1][1] >= low else own + [(low, low + 20)]
        out += own
    return out


def labelled():
    rng = random.Random(7)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    heads = ["", "Key=", "SAMPLE_KEY=", "example/", "path/To/", "id=12345678", "AAAAAA", "a0_"]
    return [head + key + tail for head in heads for tail in ("", "AAAAAAAA", "/Example") for key in
            (pick("0123456789ABCDEF", 40), pick("0123456789abcdef", 32), pick(base64, 40), pick("abcdefghij0123456789", 30), pick("0123456789", 24))]


def test_windows_equal_brute_force(spark):
    texts = cases() + labelled() + [f"see {x} and {x}" for x in labelled()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in S.scan(df, by_window=True).collect():
        found = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("entropy")]
        assert found == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_query_finds_keys_behind_labels(spark, tmp_path):
    rng = random.Random(2)
    keys = ["".join(rng.choice("0123456789ABCDEF") for _ in range(40)) for _ in range(40)]
    keys += ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(40)]
    rows = [(i, head + key) for i, (head, key) in enumerate((h, k) for h in ("", "Key=", "SAMPLE_KEY=", "example/") for k in keys)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = [r["doc_id"] for r in queries.QUERIES["op7_secret_scan"](spark, str(tmp_path)).where("n_entropy > 0").collect()]
    assert all(sum(i // 80 == h for i in found) >= 76 for h in range(4))
    clean = df.select(S.masked(F.col("text"), by_window=True).alias("m")).collect()
    assert sum(S.MASK in r["m"] for r in clean) == len(found)
