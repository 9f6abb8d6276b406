import pytest
from pyspark.sql import functions as F

from weftline.config import Config, merge
from weftline.functions.registry import register_language_detector, register_quality_scorer, register_tokenizer
from weftline.operators import bpe, filters, language, quality, shard, stats, tokenize
from weftline.operators.rank import ordered_totals, shuffle_key, top_per_group
from weftline.plans.corpus import clean_corpus, shard_corpus

ENGLISH = "This is a test of English language detection. "
PROSE = "The people of the town are in the house and it was a good day for them. "


def raw(spark, texts):
    rows = [(str(i), f"http://h/{i}", "h", "t", x, "hash", "2024") for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "id string, url string, domain string, title string, content string, content_hash string, timestamp string")


@pytest.fixture(scope="module")
def profiles(spark):
    return language.load_profiles(language.default_profiles(spark))


def test_config_merges_deeply():
    cfg = merge(Config(), {"quality": {"min_quality_score": 0.1}, "language": {"supported_languages": ["en"]}})
    assert cfg.quality.min_content_length == 500 and cfg.quality.min_quality_score == 0.1
    assert cfg.language.supported_languages == ("en",)
    with pytest.raises(KeyError):
        merge(Config(), {"nothing": 1})


def test_language(spark, profiles):
    texts = [ENGLISH, "Это тест определения языка", "这是语言检测的测试", "これは言語検出のテストです", "이것은 언어 감지 테스트입니다",
             "123 !!", "", None]
    rows = language.detect_language(raw(spark, texts), profiles).orderBy(F.col("id").cast("int")).collect()
    assert [r["language"] for r in rows] == ["en", "ru", "zh", "ja", "ko", "unknown", "unknown", None]
    assert rows[0]["language_confidence"] > 0.7 and rows[5]["language_confidence"] == 0.0


def test_confidence_falls_for_what_no_profile_knows(spark, profiles):
    known = [ENGLISH, "El gobierno decidió ayer que las nuevas reglas de tráfico se aplicarán en toda la ciudad."]
    strange = ["Rząd zdecydował wczoraj, że nowe przepisy ruchu drogowego będą obowiązywać w całym mieście.",
               "xkcd qwrt zxvb nmpl krtw bcdf ghjk lmnp qrst vwxz kjhg fdsw zxcv bnmk"]
    rows = language.detect_language(raw(spark, known + strange + [strange[1] * 200]), profiles).orderBy(F.col("id").cast("int")).collect()
    assert [r["language_confidence"] > 0.7 for r in rows] == [True, True, False, False, False]


def test_oversized_profiles_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_PROFILE", 3)
    with pytest.raises(ValueError):
        language.load_profiles(language.default_profiles(spark))


def reasons(df):
    return [r["reason"] for r in df.orderBy(F.col("id").cast("int")).collect()]


def fixed(spark, lang="en", confidence=1.0, score=0.9):
    import pandas as pd

    detector = register_language_detector("fixed", lambda s: pd.DataFrame({"language": [lang] * len(s), "confidence": [confidence] * len(s)}))
    scorer = register_quality_scorer("fixed", lambda s: pd.Series([score] * len(s)))
    return {"detector": detector, "scorer": scorer}


def test_length_bounds_are_inclusive(spark):
    df = raw(spark, ["x" * 499, "x" * 500, "x" * 100_000, "x" * 100_001, "  ", None])
    got = reasons(filters.annotate_reason(df, {}, **fixed(spark)))
    assert got == ["too_short", None, None, "too_long", "empty", "empty"]


def test_thresholds_and_order(spark):
    df = raw(spark, ["x" * 500, "x"])
    assert reasons(filters.annotate_reason(df, {}, **fixed(spark, confidence=0.7, score=0.6))) == [None, "too_short"]
    assert reasons(filters.annotate_reason(df, {}, **fixed(spark, confidence=0.69)))[0] == "low_language_confidence"
    assert reasons(filters.annotate_reason(df, {}, **fixed(spark, lang="tr", confidence=0.1)))[0] == "unsupported_language"
    assert reasons(filters.annotate_reason(df, {}, **fixed(spark, score=0.59)))[0] == "low_quality"
    assert reasons(filters.annotate_reason(df, {}, **fixed(spark, lang="tr")))[1] == "too_short"


@pytest.mark.parametrize("mode", ["exact", "signature", "lsh"])
def test_clean_corpus_accounts_for_every_document(spark, profiles, mode):
    texts = [PROSE * 10, PROSE * 10, PROSE * 10 + " mail x@io", ENGLISH * 20, "short", ""]
    cfg = merge(Config(), {"deduplication": {"mode": mode}, "quality": {"min_quality_score": 0.0}})
    done = clean_corpus(raw(spark, texts), profiles, cfg)
    got = reasons(done.verdicts)
    assert got[0] is None and got[1] == "duplicate" and got[3] is None and got[4:] == ["too_short", "empty"]
    assert got[2] == ("duplicate" if mode == "lsh" else None)
    out = {r["id"]: r for r in done.documents.collect()}
    assert set(out) == {str(i) for i, r in enumerate(got) if r is None}
    assert out["0"]["content_length"] == len((PROSE * 10).strip()) and out["0"]["tags"] == []
    assert len(out["0"]["duplicate_hash"]) == 64
    totals = stats.corpus_stats(done.verdicts.withColumn("source", F.lit("f"))).where("source IS NULL").first()
    assert totals["processed_docs"] + totals["filtered_docs"] == totals["total_docs"] == 6


def test_repeated_ids_and_records(spark, profiles):
    one, two = PROSE * 10, ENGLISH * 20
    rows = [("same", "http://h/1", "h", "t", one, "x", "2024"), ("same", "http://h/2", "h", "t", two, "y", "2024"),
            ("same", "http://h/1", "h", "t", one, "x", "2024"), ("b", "http://h/3", "h", "t", one, "x", "2023")]
    df = spark.createDataFrame(rows, "id string, url string, domain string, title string, content string, content_hash string, timestamp string")
    done = clean_corpus(df, profiles, merge(Config(), {"quality": {"min_quality_score": 0.0}}))
    assert sorted(r["original_url"] for r in done.documents.collect()) == ["http://h/2", "http://h/3"]
    assert sorted(str(r["reason"]) for r in done.verdicts.collect()) == ["None", "None", "duplicate", "duplicate"]
    again = clean_corpus(spark.createDataFrame(rows[:1] * 3, df.schema), profiles, merge(Config(), {"quality": {"min_quality_score": 0.0}}))
    assert again.documents.count() == 1 and again.verdicts.where("reason IS NULL").count() == 1


def test_quality_model_separates(spark):
    good, bad = "clear useful words here", "spam spam buy now"
    rows = [(f"{good} {i}", 1) for i in range(20)] + [(f"{bad} {i}", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "content string, quality int")
    model = quality.fit_quality_model(df, features=1 << 10)
    got = {r["quality"]: r["s"] for r in quality.quality_model_score(df.drop("quality_score"), model)
           .groupBy("quality").agg(F.avg("quality_score").alias("s")).collect()}
    assert got[1] > 0.8 and got[0] < 0.2


# -- tokens and shards ----------------------------------------------------------------------------

def test_vocabulary_order_and_ids(spark):
    df = raw(spark, ["b b a a c", "a"])
    rows = [(r["token"], r["token_id"], r["n"]) for r in tokenize.build_vocab(df, 6).orderBy("token_id").collect()]
    assert rows[4:] == [("a", 4, 3), ("b", 5, 2)]
    assert [r[0] for r in rows[:4]] == ["<pad>", "<unk>", "<bos>", "<eos>"]


def test_tokenize_truncates_masks_and_drops_short(spark):
    df = raw(spark, ["a " * 30, "a " * 9, "a " * 10, "  ", None, "z a " * 6])
    vocab = tokenize.word_vocab(tokenize.build_vocab(raw(spark, ["a"]), 10))
    rows = {r["id"]: r for r in tokenize.tokenize(df, vocab, max_length=20).collect()}
    assert set(rows) == {"0", "2", "5"}
    assert rows["0"]["tokens"] == [4] * 20 and rows["0"]["attention_mask"] == [1] * 20 and rows["0"]["token_count"] == 20
    assert rows["5"]["tokens"] == [1, 4] * 6


def test_registered_tokenizer(spark):
    chars = register_tokenizer("chars", lambda texts, n: [[ord(c) for c in t[:n]] for t in texts])
    rows = tokenize.tokenize(raw(spark, ["abcdefghijkl", "ab"]), chars, max_length=11).collect()
    assert [r["tokens"][:2] for r in rows] == [[97, 98]] and rows[0]["token_count"] == 11


def test_pad_truncate_and_training_view(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5], [1] * 5), (list(range(12)), [1] * 12)], "tokens array<int>, attention_mask array<int>")
    a, b = tokenize.training_view(tokenize.pad_truncate(df, 10, 0)).collect()
    assert a["input_ids"] == [1, 2, 3, 4, 5, 0, 0, 0, 0, 0] == a["labels"]
    assert a["attention_mask"] == [1] * 5 + [0] * 5
    assert b["input_ids"] == list(range(10)) and len(b["attention_mask"]) == 10


def test_bpe_against_plain_python(spark):
    texts = ["low lower lowest", "newer newest low", "$a $a b.b"]
    merges = [(r["left"], r["right"]) for r in bpe.train_bpe(raw(spark, texts), 6).orderBy("rank").collect()]
    import collections
    import re

    words = collections.Counter(w for t in texts for w in re.findall(r"\w+", t.lower()))
    split, wanted = {w: list(w) for w in words}, []
    for _ in range(6):
        pairs = collections.Counter()
        for w, parts in split.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += words[w]
        best = min(pairs, key=lambda p: (-pairs[p], p))
        wanted.append(best)
        for w, parts in split.items():
            out = []
            while parts:
                if tuple(parts[:2]) == best:
                    out, parts = out + ["".join(best)], parts[2:]
                else:
                    out, parts = out + parts[:1], parts[1:]
            split[w] = out
    assert merges == wanted
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(merges)], "rank int, left string, right string")
    got = spark.createDataFrame([(["lowest", "newer"],)], "w array<string>").select(bpe.bpe_pieces("w", table).alias("p")).first()["p"]
    assert got == split["lowest"] + split["newer"]


@pytest.mark.parametrize("n,val", [(40, 2), (19, 0), (1, 0)])
def test_split_sizes_are_exact(spark, n, val):
    ranked = shard.shuffle_docs(spark.range(n).select(F.col("id").cast("string")))
    rows = shard.train_val_split(ranked).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, n + 1))
    assert sum(r["split"] == "val" for r in rows) == val
    assert sorted(r["position"] for r in rows if r["split"] == "train") == list(range(n - val))


def test_shard_sizes(spark):
    assert shard.docs_per_shard(512) == 262_144 and shard.docs_per_shard(1) == 512
    ranked = shard.train_val_split(shard.shuffle_docs(spark.range(1025).select(F.col("id").cast("string"))), 0.0)
    sizes = {r["shard_id"]: r["count"] for r in shard.assign_shards(ranked, 1).groupBy("shard_id").count().collect()}
    assert sizes == {"0000": 512, "0001": 512, "0002": 1}


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_running_totals_at_any_bucket_size(spark, digits):
    df = spark.range(300).select(F.col("id").cast("string"), (F.col("id") % 7).alias("w"))
    rows = ordered_totals(df, shuffle_key(9), "id", F.col("w"), digits).orderBy("rank").collect()
    total = 0
    for place, r in enumerate(rows, 1):
        assert (r["rank"], r["before"], r["total"]) == (place, total, 300)
        total += r["w"]


def test_top_per_group_is_exact_for_a_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"))
    got = top_per_group(df, "g", F.desc("id"), 5, "id").where("g = 'hot'")
    assert sorted(r["id"] for r in got.collect()) == [4986, 4989, 4992, 4995, 4998]


def test_shard_corpus(spark):
    vocab = tokenize.word_vocab(tokenize.build_vocab(raw(spark, ["a"]), 10))
    df = raw(spark, ["a " * 20] * 41).withColumns({"language": F.lit("en"), "quality_score": F.lit(0.5)})
    cfg = merge(Config(), {"shards": {"shard_size_mb": 0.02}})
    rows = shard_corpus(df, vocab, cfg)
    meta = {(r["split"], r["shard_id"]): r["documents"] for r in stats.shard_stats(rows).collect()}
    assert meta == {("train", "0000"): 11, ("train", "0001"): 11, ("train", "0002"): 11, ("train", "0003"): 6, ("val", "0000"): 2}


def test_filter_rate_has_a_zero_guard(spark):
    rows = spark.createDataFrame([(0, 0), (3, 2)], "raw int, kept int").select(stats.filter_rate("raw", "kept").alias("r")).collect()
    assert [r["r"] for r in rows] == [None, 33.3]


def test_texts_are_scored_once(spark):
    """The counts behind the score stand once in the plan, however often reason and score are used."""
    from weftline.functions import text as T
    from weftline.operators import filters
    from weftline.operators.language import default_profiles, load_profiles

    words = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were when".split()
    text = ". ".join(" ".join(words[i:] + words[:i]).capitalize() for i in range(8)) + "."
    raw = spark.createDataFrame([("a", text), ("b", "short"), ("c", None)], "id string, content string")
    judged = filters.annotate_reason(raw, load_profiles(default_profiles(spark)))
    todo = F.when(F.col("reason").isNull(), F.col("content"))
    used = judged.select("id", "reason", "quality_score", T.content_hash(todo).alias("hash"), F.length(todo).alias("n"))
    assert used._jdf.queryExecution().optimizedPlan().toString().count(T.VOWELS) == 1
    assert {r["id"]: (r["reason"], r["hash"] is None) for r in used.collect()} == {"a": (None, False), "b": ("too_short", True), "c": ("empty", True)}
