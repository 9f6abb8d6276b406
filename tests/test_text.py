import math
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from weftline.functions import scoring as S, text as T, url as U


def test_clean_content_keeps_fragment_and_double_space(column):
    raw = "Visit https://a.b/c?x=1#top or me@x.io now!!  ok"
    assert column(T.clean_content, raw) == ["Visit #top or  now. ok"]


def test_strip_is_unicode(column):
    assert column(T.strip, "  a b\x1c ", "   ", "x") == ["a b", "", "x"]


def test_estimate_tokens(column):
    assert column(T.estimate_tokens, "Hello, world! It's ok.") == [7]


def test_avg_sentence_len(column):
    assert column(T.avg_sentence_len, "One two three. Four five!  Six", "One two.") == [2.0, 1.0]


def test_readability_of_plain_sentence(column):
    text = "This is a well-written sentence with good structure and proper grammar."
    (score,) = column(T.flesch_reading_ease, text)
    assert 0 <= score <= 100
    assert column(T.avg_sentence_len, text)[0] > 0


def test_entropy(column):
    got = column(S.char_entropy, "aabb", "Aab", "", None)
    assert got[0] == 1.0
    assert got[1] == pytest.approx(0.9182958340544896)
    assert got[2] == 0.0 and got[3] is None


def test_quality_is_half_when_undefined_and_bounded(column):
    got = column(S.quality_score, None, "One two three four five six seven.", "")
    assert got[0] == 0.5
    assert all(0 <= g <= 1 for g in got)


def test_weighted_quality_needs_500_chars(column):
    short, long = "word " * 50, "Some words make a sentence here. " * 30
    got = column(S.quality_score_weighted, short, long)
    assert got[0] == 0.0 and 0 < got[1] <= 1


def test_normalize_unicode(column):
    assert column(S.normalize_unicode, "é") == ["é"]


def test_strip_html(column):
    assert column(T.strip_html, "<p>a<script>x<y</script>b</p><!-- c -->d")[0].split() == ["a", "b", "d"]


@pytest.mark.parametrize("host,root", [
    ("example.com", "example.com"), ("sub.example.com", "example.com"), ("docs.kubernetes.io", "kubernetes.io"),
    ("example.co.uk", "example.co.uk"), ("sub.example.co.uk", "example.co.uk"),
    ("docs.example.com.au", "example.com.au"), ("localhost", "localhost"), ("example.org", "example.org"),
])
def test_root_domain(column, host, root):
    assert column(U.root_domain, host) == [root]


def test_urls(column):
    assert column(U.canonical_url, "https://h/a?b=2&a=1#f", "http://h") == ["https://h/a?a=1&b=2", "http://h/"]
    assert column(U.url_domain, "https://u:p@h:81/a") == ["u:p@h:81"]
    assert column(U.url_host, "https://u:p@H:81/a") == ["h"]
    assert column(lambda c: U.on_domains(c, ["b.c"]), "http://a.b.c/", "http://ab.c/", "http://b.c/") == [True, False, True]
    assert column(U.has_denied_extension, "http://h/x.PDF?y", "http://h/x.html", "http://h.zip/") == [True, False, False]


# the same functions spelled with Python's own patterns
def py_clean(t):
    t = re.sub(r"\s+", " ", t)
    t = re.sub(r"https?://(?:[a-zA-Z0-9]|[$-_@.&+]|[!*(),])+", "", t)
    t = re.sub(r"\S+@\S+", "", t)
    return re.sub(r"[.!?]{2,}", ".", t).strip()


ALPHABET = "ab @.!?\n\t é_1'-#:/hH" + "中\x1c"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=60), st.text(alphabet=ALPHABET).map(lambda s: "see http://x/" + s)),
                min_size=20, max_size=40))
def test_text_functions_agree_with_python(column, texts):
    assert column(T.clean_content, *texts) == [py_clean(t) for t in texts]
    assert column(T.strip, *texts) == [t.strip() for t in texts]
    assert column(T.words, *texts) == [re.findall(r"\b\w+\b", t.lower()) for t in texts]
    pieces = [re.split(r"[.!?]+", t) for t in texts]
    assert column(T.sentence_count, *texts) == [len(p) for p in pieces]
    assert column(T.avg_sentence_len, *texts) == [sum(len(s.split()) for s in p) / len(p) for p in pieces]


def test_long_texts_stay_linear(column):
    # one token of 200 000 characters, and as many sentences
    assert len(column(T.remove_emails, "x" * 200_000)[0]) == 200_000
    assert column(T.sentence_count, "a. " * 100_000) == [100_001]
    assert math.isfinite(column(T.flesch_reading_ease, "word " * 100_000)[0])


def test_unbroken_runs_stay_linear(spark, column):
    import base64
    import time

    from weftline.functions import text as T

    for value in ("漢字" * 50_000, base64.b64encode(bytes(range(256)) * 293).decode()):
        column(T.flesch_reading_ease, value[:10])
        start = time.perf_counter()
        column(T.flesch_reading_ease, value)
        assert time.perf_counter() - start < 2


def test_modules_travel_after_their_functions_were_used(column):
    from pyspark import cloudpickle
    from weftline.functions import scoring, sketch, text

    column(sketch.simhash64, "a b"), column(scoring.char_entropy, "aab"), column(scoring.normalize_unicode, "é"), column(sketch.minhash_signature, "a b")
    for module in (scoring, sketch, text):
        assert cloudpickle.dumps(lambda: module)  # noqa: B023


def test_breaks_follow_the_weights():
    from weftline.functions import hyphenation as hy

    trie = hy.pattern_trie(("hy3ph", "he2n", "hena4", "hen5at", "1na", "n2at", "1tio", "2io", "o2n"))
    assert hy.breaks("hyphenation", trie) == [2, 6] and hy.breaks("", trie) == [] and hy.breaks("hy", trie) == []
    assert hy.breaks("table", hy.pattern_trie((".ta1b", "1ble", "bl2e."))) == [2]
    assert hy.breaks("xaxax", hy.pattern_trie(("1x",))) == [2]      # two letters stay on either side


def test_syllables_by_patterns(spark):
    from weftline.functions import hyphenation as hy

    table = spark.createDataFrame([("o1n",), ("O1N",), (None,), (" ",)], "pattern string")
    patterns = hy.load_patterns(table)
    assert patterns == ("o1n",)
    rows = spark.createDataFrame([(0, "Melone salon. "), (1, ""), (2, None), (3, "melone " * 100_000)], "i int, c string")
    assert [r["n"] for r in rows.select("i", hy.syllables("c", patterns).alias("n")).orderBy("i").collect()] == [3, 0, None, 200_000]


def test_reading_ease_of_plain_prose_lies_on_the_scale(spark):
    from weftline.functions import hyphenation as hy

    patterns = [f"{v}1{c}{w}" for v in "aeiou" for c in "bcdfgklmnprtv" for w in "aeiou"]
    text = "The old man went to the river. He sat by the water and waited for a boat. A lady came along the road."
    rows = spark.createDataFrame([(text,)], "c string")
    assert 60 <= rows.select(hy.flesch_reading_ease("c", patterns).alias("x")).first()["x"] <= 120


def test_tasks_hold_small_batches_of_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from weftline.functions import html as H, hyphenation, registry
    from weftline.operators import graph, language, tokenize

    batch, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.range(0, 3000, 1, 1).select(F.concat(F.lit("word "), "id").alias("content"))
    pages = spark.createDataFrame([("http://a.b/", '<title>t</title><a href="c">x</a><area href="d">'), ("http://a.b/", None)], "url string, html string")
    sized = registry.register_tokenizer("sized", lambda texts, n: [[len(texts)]] * len(texts))
    for use in (lambda: tokenize.tokenize(rows, sized, min_tokens=1), lambda: language.fit_language_profiles(rows.select(F.lit("en").alias("lang"), F.col("content").alias("text"))),
                lambda: graph.link_edges(pages)):
        spark.conf.set(batch, "10000")
        use().count()
        assert int(spark.conf.get(batch)) <= 1000
    most = tokenize.tokenize(rows, sized, min_tokens=1).select(F.max(F.col("tokens")[0])).first()[0]
    assert most <= registry.TEXTS_AT_ONCE
    for areas in (False, True):
        both = pages.select(H.extract_links("html", "url", areas).alias("a"), H.html_extract("html", "url", areas=areas)["links"].alias("b")).collect()
        assert all(r["a"] == r["b"] for r in both) and both[1]["a"] is None
    assert [hyphenation.bare(w) for w in ("salon.", "o'neil!", "x_1́²", "ß")] == ["salon", "o'neil", "x_1²", "ß"]
