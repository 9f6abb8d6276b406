import hashlib
import random

import numpy as np
import pytest

from weftline.llm import suffix_dedup as S
from weftline.llm.merge_tree import merge


def brute(rows):
    low = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - 49):
                low[b[p:p + 50]] = min(low.get(b[p:p + 50], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49) if i is not None else ():
            if low[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def sample():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(20), text(30), text(8)]
    rows = [(100 + i, text(rng.randrange(40)) + rng.choice(passage) + text(rng.randrange(10)) + rng.choice(["", passage[0], passage[1][7:70]])) for i in range(80)]
    rows += [(i, rows[i][1]) for i in range(5)] + [(300 + i, rows[30 + i][1]) for i in range(5)]
    rows += [(400, None), (401, ""), (402, "short"), (403, "x" * 49), (404, "x" * 50), (405, "x" * 120), (406, "ab" * 200), (407, "ba" * 90), (None, passage[0] * 2),
             (None, passage[0] * 2), (100, rows[0][1]), (101, "other text with " + passage[1]), (408, text(9000)), (409, "é" * 60)]
    rows += [(500, "start " + rows[-2][1][3000:3055].strip() + " end")]
    for n in (49, 50, 51):
        rows.append((600 + n, "<" + passage[0][:n] + ">"))
    return rows


@pytest.mark.parametrize("hot,run", [(4096, 100_000), (5, 40)])
def test_equals_brute_force(spark, monkeypatch, hot, run):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "RUN", run)
    rows = sample()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(4)
    assert sorted(map(tuple, S.suffix_dedup(df).collect()), key=repr) == brute(rows)
    assert S.suffix_dedup(df.limit(0)).collect() == []


def test_one_line_in_most_texts_makes_rows_by_text(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 20)
    line = "the same long line that nearly every text repeats, again and again, word for word, to its end. "
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abcdef ", k=rng.randrange(80))) + line * rng.randrange(1, 9) + str(i)) for i in range(300)]
    rows += [(50, "another text of one id " + line * 3 + "x" + line), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts, send = [], S._send

    def counted(*given):
        made = send(*given)
        counts.extend(made.where(f"{c} IS NOT NULL").count() for c in ("doc_id", "part"))
        return made

    monkeypatch.setattr(S, "_send", counted)
    assert sorted(map(tuple, S.suffix_dedup(df).collect()), key=repr) == brute(rows)
    assert 0 < counts[0] <= 2 * len(rows) and 0 < counts[1] <= 8 * S.LEAST_BUCKETS


def test_equal_strings_have_the_same_anchors(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 300)
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcab ") for _ in range(2000)) + b"z" * 200
    at, hashes = S.anchors(text)
    known = dict(zip(at.tolist(), hashes.tolist()))
    for p in range(0, len(text) - 49, 7):
        own = {a: h for a, h in known.items() if p <= a <= p + 32}
        alone, h = S.anchors(text[p:p + 50])
        assert len(alone) and all(own[p + a] == x for a, x in zip(alone.tolist(), h.tolist()))


def test_merge_is_sorted_with_common_prefixes():
    rng = random.Random(4)
    for runs in ([], [[]], [[b"a"]], [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(40))) for _ in range(13)]):
        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n
        prefixes = [[0] + [common(a, b) for a, b in zip(r, r[1:])] for r in runs]
        order, lcps = merge(runs, prefixes)
        at = [0] * len(runs)
        out = []
        for k in order:
            out.append(runs[k][at[k]])
            at[k] += 1
        assert out == sorted(x for r in runs for x in r)
        assert lcps == [common(a, b) for a, b in zip([b"", *out], out)]
