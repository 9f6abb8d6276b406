import os
import sys
from collections import Counter

import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as P  # noqa: E402
from test_secrets_scan import brute as brute_spans  # noqa: E402
from test_simhash_dedup import brute_components, brute_print  # noqa: E402
from weftline.llm import grams, quality_rules as Q, secrets_scan as S  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def mask(text):
    out, at = "", 0
    for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in brute_spans(text)[4].split(",") if s):
        if a >= at:
            out += text[at:a] + S.MASK
        at = max(at, b)
    return out + text[at:]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    counts = [Counter(), Counter()]
    for r in rows:
        for k in range(1 + (r["doc_id"] in trusted)):
            for b in grams.bucket_chunks(r["text"].encode()):
                counts[k].update(b.tolist())
    raw, target = ([c[i] for i in range(grams.BUCKETS)] for c in counts)
    import numpy as np
    ratio = grams.log_ratio(np.array(target, float), np.array(raw, float))
    kept = [r for r in rows if Q.judged(r["text"], ratio)[-1]]
    assert 0 < len(kept) < len(rows)

    stage = P.keep_quality(spark, docs, FOLDER)
    assert stage.columns == columns and sorted(map(tuple, stage.collect())) == sorted(map(tuple, kept))

    groups = brute_components([r["doc_id"] for r in kept], [brute_print(r["text"]) for r in kept])
    single = [r for r, g in zip(kept, groups) if r["doc_id"] == g]
    stage = P.drop_near_duplicates(spark, stage, FOLDER)
    assert stage.columns == columns and sorted(map(tuple, stage.collect())) == sorted(map(tuple, single))

    clean = sorted((r["doc_id"], mask(r["text"]), r["lang"], r["source"], len(mask(r["text"]))) for r in single)
    stage = P.mask_secrets(spark, stage, FOLDER)
    assert stage.columns == columns and sorted(map(tuple, stage.collect())) == clean

    stage = P.mix_sources(spark, stage, FOLDER)
    mixed = [tuple(r) for r in stage.collect()]
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) == 2
    words = sum(len(t.split()) for _, t, *_ in mixed) / sum(len(t.split()) for _, t, *_ in clean)
    assert stage.columns == columns and 1.4 < words < 1.6

    pieces = P.pack_sequences(spark, stage, FOLDER).collect()
    library = Tokenizer.from_file(P.TOKENIZER)
    tokens = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t, *_ in mixed)
    assert sum(p["length"] for p in pieces) == tokens
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == Counter(r[0] for r in mixed)


def test_run_and_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i} and" for i in range(60))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (2, None, "en", "a", 0), (3, "", "en", "b", 0),
            (4, text + " password=abcdefghijkl12", "en", "b", 3), (5, " ".join(f"x{i}" for i in range(80)), "en", None, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    pieces = P.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} <= {1, 4, 5} and pieces
    empty = tmp_path / "empty"
    frame.limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(empty / "labels.parquet"))
    assert P.run(spark, str(empty)).collect() == []


def test_near_duplicates_go_by_fingerprint_and_by_shingles(spark, monkeypatch):
    asked, components = [], P.simhash_dedup.simhash_components
    monkeypatch.setattr(P.simhash_dedup, "simhash_components", lambda *a, **k: asked.append(1) or components(*a, **k))
    words = [f"w{i}" for i in range(400)]
    near = words[:200] + ["other"] + words[201:]
    # the same three-word runs in another order: one fingerprint, few five-word runs in common
    runs = [f"{x} {y} {z}" for x, y, z in zip(words[::3], words[1::3], words[2::3])]
    one, two = " ".join(["a b c d a b c", *["a b c"] * 5]), " ".join(["a b c", *["a b c"] * 5, "d a b c"])
    rows = [(1, " ".join(words), "en", "a", 1), (2, " ".join(near), "en", "a", 1), (3, " ".join(reversed(words)), "en", "a", 1),
            (4, " ".join(runs[::-1]), "en", "a", 1), (5, one, "en", "a", 1), (6, two, "en", "a", 1), (7, None, None, None, None), (7, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(P.STAGES)["simhash_near_dedup"](spark, docs, FOLDER)
    groups = brute_components([r[0] for r in rows], [brute_print(r[1] or "") for r in rows])
    assert asked and kept.columns == docs.columns
    found = sorted(r["doc_id"] for r in kept.collect())
    assert set(found) <= {g for g in groups} and 1 in found and 2 not in found and found.count(7) <= 1
