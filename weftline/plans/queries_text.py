"""Queries on single documents: filters, text functions, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import hyphenation, scoring as S, sketch, text as T
from weftline.operators import filters, language, quality
from weftline.plans import catalog as C
from weftline.plans.catalog import query

CUT = "CAST(doc_id AS VARCHAR) AS id"


def profiles(t):
    return language.load_profiles(language.fit_language_profiles(t.texts))


# -- filters --------------------------------------------------------------------------------------

for _name, _fn, _test in (
    ("filter_empty", filters.filter_empty, "> 0"),
    ("filter_too_short", filters.filter_too_short, ">= 500"),
    ("filter_too_long", filters.filter_too_long, "<= 100000"),
    ("page_min_content", filters.page_min_content, ">= 100"),
):
    query(_name, f"SELECT doc_id FROM documents WHERE length({C.strip('text')}) {_test}")(
        lambda t, fn=_fn: fn(t.texts, "text").select("doc_id"))


def detected(t):
    return language.detect_language(t.texts, profiles(t), "text")


@query("filter_language", "SELECT doc_id FROM documents WHERE lang IN ('en', 'zh', 'fr', 'ja', 'ko', 'ru')")
def _(t):
    return filters.filter_language(detected(t), ("en", "zh", "fr", "ja", "ko", "ru")).select("doc_id")


@query("filter_quality", f"WITH {C.SCORED} SELECT doc_id FROM scored WHERE q >= 0.6")
def _(t):
    return filters.filter_quality(t.texts.withColumn("quality_score", S.quality_score(T.strip("text")))).select("doc_id")


def annotated(t):
    return filters.annotate_reason(t.raw, profiles(t))


@query("filter_reason", f"WITH {C.SCORED} SELECT {CUT}, reason0 AS reason FROM judged")
def _(t):
    return annotated(t).select("id", "reason")


# -- text functions -------------------------------------------------------------------------------

def _text_query(name, fn, sql):
    query(name, f"SELECT doc_id, {sql} AS value FROM documents")(
        lambda t: t.texts.select("doc_id", fn("text").alias("value")))


_text_query("strip", T.strip, C.strip("text"))
_text_query("clean_whitespace", T.clean_whitespace, C.replace("text", f"[{T.SPACE}]+", " "))
_text_query("remove_urls", T.remove_urls, C.replace("text", T.URL, ""))
_text_query("remove_emails", T.remove_emails, C.replace("text", f"[^{T.SPACE}]+@[^{T.SPACE}]+", ""))
_text_query("collapse_punct", T.collapse_punct, C.replace("text", "[.!?]{2,}", "."))
_text_query("clean_content", T.clean_content, C.clean("text"))
_text_query("words", lambda c: F.array_join(T.words(c), " "), f"array_to_string({C.words('text')}, ' ')")
_text_query("estimate_tokens", T.estimate_tokens,
            f"CAST({C.count('text', T.WORD)} + {C.count('text', T.STOPS)} AS INTEGER)")
_text_query("split_sentences", T.sentence_count, f"CAST({C.count('text', '[.!?]+')} + 1 AS INTEGER)")
_text_query("avg_sentence_len", lambda c: F.round(T.avg_sentence_len(c), 6), f"round({C.asl('text')}, 6)")
_text_query("length_diversity", lambda c: F.round(T.length_diversity(T.avg_sentence_len(c)), 6),
            f"round(greatest(0.0::DOUBLE, 1 - abs({C.asl('text')} - 20) / 50), 6)")
_text_query("flesch_reading_ease", lambda c: F.round(T.flesch_reading_ease(c), 6), f"round({C.flesch('text')}, 6)")
_text_query("readability_score", lambda c: F.round(T.readability_score(c), 6),
            f"round({C.unit(C.flesch('text') + ' / 100')}, 6)")
_text_query("content_hash", T.content_hash, "sha256(text)")


@query("char_entropy", f"SELECT doc_id, round(coalesce(e, 0), 6) AS entropy FROM documents LEFT JOIN {C.entropy('documents')} USING (doc_id)")
def _(t):
    return t.texts.select("doc_id", F.round(S.char_entropy("text"), 6).alias("entropy"))


@query("entropy_score", f"SELECT doc_id, round({C.unit('coalesce(e, 0) / 5')}, 6) AS score FROM documents LEFT JOIN {C.entropy('documents')} USING (doc_id)")
def _(t):
    return t.texts.select("doc_id", F.round(S.entropy_score(S.char_entropy("text")), 6).alias("score"))


@query("quality_score", f"WITH {C.SCORED} SELECT doc_id, round(q, 6) AS quality_score FROM scored")
def _(t):
    body = t.texts.select("doc_id", T.strip("text").alias("body"))
    return body.select("doc_id", F.round(S.quality_score("body"), 6).alias("quality_score"))


_LEX = C.count("text", T.LEXEME)
_SYL = f"greatest({C.count('lower(text)', T.VOWELS)}, {_LEX})"


@query("quality_score_weighted", f"""SELECT doc_id, round(CASE WHEN length(text) < 500 THEN 0 ELSE {C.unit(
    f"0.4::DOUBLE * ({C.flesch('text')} / 100) + 0.3::DOUBLE * least({_LEX} / greatest(1, {C.count('text', T.SENTENCE)}) / 30, 1)"
    f" + 0.3::DOUBLE * least({_SYL} / greatest(1, {_LEX}) / 3, 1)")} END, 9) AS quality_score FROM documents""")
def _(t):
    return t.texts.select("doc_id", F.round(S.quality_score_weighted("text"), 9).alias("quality_score"))


# patterns by rule: a break before every consonant but s that the corpus holds between two vowels
_VCV = "[aeiou][b-df-hj-np-rtv-z][aeiou]"
_BREAKS = f"""CAST(list_sum(list_transform(list_transform(regexp_extract_all(lower(text), '{C.quoted(T.LEXEME)}'),
  lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}_'']', '', 'g')), lambda w:
  1 + len(list_filter(range(2, length(w) - 1), lambda j: regexp_matches(w[j:j + 2], '^{_VCV}$'))))) AS BIGINT)"""


def vowel_patterns(t):
    """v1cv for every vowel, consonant but s, vowel of the corpus."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"(?=({_VCV}))"), F.lit(1))))
    triples = t.texts.select(found.alias("g")).distinct()
    return hyphenation.load_patterns(triples.select(F.regexp_replace("g", "^(.)", "$11").alias("pattern")))


@query("syllables_hyphenated", f"SELECT doc_id, coalesce({_BREAKS}, 0) AS syllables FROM documents")
def _(t):
    return t.texts.select("doc_id", hyphenation.syllables("text", vowel_patterns(t)).alias("syllables"))


@query("flesch_hyphenated", f"""SELECT doc_id, round(206.835::DOUBLE - 1.015::DOUBLE * ({_LEX} / greatest(1, {C.count("text", T.SENTENCE)}))
  - 84.6::DOUBLE * (coalesce({_BREAKS}, 0) / greatest(1, {_LEX})), 6) AS value FROM documents""")
def _(t):
    return t.texts.select("doc_id", F.round(hyphenation.flesch_reading_ease("text", vowel_patterns(t)), 6).alias("value"))


@query("head_truncations", f"""SELECT doc_id, md5(left(text, 1000)) AS language_head, md5(left(text, 512)) AS model_head,
  CAST(len(list_distinct({C.words('text')}[1:1000])) AS INTEGER) AS words_of_signature, md5(array_to_string({C.words('text')}[1:2048], ' ')) AS token_head FROM documents""")
def _(t):
    return t.texts.select(
        "doc_id", F.md5(F.left("text", F.lit(1000))).alias("language_head"), F.md5(F.left("text", F.lit(512))).alias("model_head"),
        F.size(sketch.word_set("text", max_words=1000)).alias("words_of_signature"),
        F.md5(F.array_join(F.slice(T.words("text"), 1, 2048), " ")).alias("token_head"))


@query("normalize_unicode", "SELECT doc_id, nfc_normalize(text) AS value FROM documents")
def _(t):
    return t.texts.select("doc_id", S.normalize_unicode("text").alias("value"))


@query("fuzzy_hash")
def _(t):
    return t.texts.select("doc_id", sketch.fuzzy_hash(sketch.minhash_signature("text")).alias("duplicate_hash"))


@query("minhash_signature")
def _(t):
    return t.texts.select("doc_id", F.array_join(sketch.minhash_signature("text"), ",").alias("signature"))


_SPACED = f"(' ' || {C.replace('lower(text)', '[^\\p{L}]+', ' ')} || ' ')"
_PROFILES = f"""chars AS (SELECT doc_id, lang, unnest(c) AS a, unnest(range(len(c))) AS i FROM (
  SELECT doc_id, lang, string_split({_SPACED}, '') AS c FROM documents)),
ahead AS (SELECT doc_id, lang, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grams AS (SELECT doc_id, lang, 1 AS n, a AS gram FROM ahead UNION ALL SELECT doc_id, lang, 2, a || b FROM ahead WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, lang, 3, a || b || c FROM ahead WHERE c IS NOT NULL),
gcount AS (SELECT lang, n, gram, count(*) AS c FROM grams GROUP BY ALL),
glog AS (SELECT *, sum(c) OVER (PARTITION BY lang, n) AS total,
  row_number() OVER (PARTITION BY lang, n ORDER BY c DESC, gram) AS pos FROM gcount),
profiles AS (SELECT lang, gram, n, ln((c + 1.0::DOUBLE) / (total + {language.GRAMS}::DOUBLE)) AS logp FROM glog
  WHERE pos <= {language.GRAMS})"""


@query("fit_language_profiles", f"WITH {_PROFILES} SELECT lang, gram, CAST(n AS INTEGER) AS n, round(logp, 6) AS logp FROM profiles")
def _(t):
    p = language.fit_language_profiles(t.texts)
    return p.select("lang", "gram", "n", F.round("logp", 6).alias("logp"))


_DETECTED = f"""floors AS (SELECT lang, n, min(logp) AS logp, sum(exp(logp) * logp) / sum(exp(logp)) AS own FROM profiles GROUP BY lang, n),
tf AS (SELECT doc_id, n, gram, count(*) AS c FROM grams GROUP BY ALL),
score AS (SELECT doc_id, f.lang, sum(tf.c * coalesce(p.logp, f.logp)) AS s, sum(tf.c) FILTER (tf.n = 1) AS size,
  sum(tf.c * (coalesce(p.logp, f.logp) - f.logp)) / sum(tf.c * (f.own - f.logp)) AS fit
  FROM tf JOIN floors f ON f.n = tf.n LEFT JOIN profiles p ON p.lang = f.lang AND p.n = tf.n AND p.gram = tf.gram
  GROUP BY doc_id, f.lang),
best AS (SELECT doc_id, max(s) AS top, arg_max(lang, s) AS language, arg_max(fit, s) AS fit FROM score GROUP BY doc_id),
detected AS (SELECT doc_id, language, 1 / sum(exp((s - top) * least(1, {language.EVIDENCE}::DOUBLE / size)))
  / (1 + exp(-{language.STEEP}::DOUBLE * (best.fit - {language.FIT}::DOUBLE))) AS confidence
  FROM score JOIN best USING (doc_id) GROUP BY doc_id, language, best.fit)"""


@query("detect_language", f"WITH {_PROFILES}, {_DETECTED} SELECT doc_id, language, round(confidence, 6) AS language_confidence FROM detected")
def _(t):
    return detected(t).select("doc_id", "language", F.round("language_confidence", 6).alias("language_confidence"))


# the profile of one language: what is written in others falls below the bound
@query("filter_lang_confidence", f"WITH {_PROFILES.replace('profiles AS (SELECT', 'every AS (SELECT')}, "
       f"profiles AS (SELECT * FROM every WHERE lang = 'en'), {_DETECTED} SELECT doc_id, language FROM detected WHERE confidence >= 0.7")
def _(t):
    known = language.load_profiles(language.fit_language_profiles(t.texts.where("lang = 'en'")))
    return filters.filter_lang_confidence(language.detect_language(t.texts, known, "text")).select("doc_id", "language")


@query("quality_model_score")
def _(t):
    labelled = t.texts.join(t.labels.select("doc_id", "quality"), "doc_id")
    model = quality.fit_quality_model(labelled, "text")
    return quality.quality_model_score(t.texts, model, "text").select("doc_id", "quality_score")


@query("register_quality_scorer", "SELECT doc_id, round(length(text) / (length(text) + 1000), 6) AS quality_score FROM documents")
def _(t):
    from weftline.functions.registry import register_quality_scorer

    scorer = register_quality_scorer("length", lambda s: s.str.len() / (s.str.len() + 1000))
    return t.texts.select("doc_id", F.round(scorer("text"), 6).alias("quality_score"))


@query("register_language_detector", "SELECT doc_id, CASE WHEN regexp_matches(lower(text), '[^a-z\\x00-\\x7f]') THEN 'other' ELSE 'en' END AS language FROM documents")
def _(t):
    import pandas as pd

    from weftline.functions.registry import register_language_detector

    def ascii_or_not(s):
        return pd.DataFrame({"language": ["en" if x.isascii() else "other" for x in s], "confidence": 1.0})

    found = register_language_detector("ascii", ascii_or_not)
    return t.texts.select("doc_id", found("text")["language"].alias("language"))


@query("register_tokenizer", "SELECT doc_id, CAST(length(text) AS INTEGER) AS token_count, unicode(text) AS first_token FROM documents WHERE length(text) >= 10")
def _(t):
    from weftline.functions.registry import register_tokenizer
    from weftline.operators.tokenize import tokenize

    chars = register_tokenizer("chars", lambda texts, n: [[ord(c) for c in x[:n]] for x in texts])
    out = tokenize(t.texts, chars, max_length=1_000_000, col="text")
    return out.select("doc_id", "token_count", F.col("tokens")[0].alias("first_token"))
