"""Language identification by character n-grams and by script."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import col
from weftline.operators.rank import top_per_group
from weftline.session import small_batches

GRAMS = 2_000        # most frequent n-grams kept per language and length
GRAMS_HELD = 500_000  # distinct n-grams a task counts before it sends them on
MAX_PROFILE = 300_000  # rows of a profile table that may travel inside a task
EVIDENCE = 20  # characters a text counts as at most when languages are weighed: its n-grams overlap
FIT, STEEP = 0.70, 40.0  # share of a language's own log likelihood at which a text is as likely another's
VERDICT = "struct<language:string,confidence:double>"

# Frequent words of each language, enough for a first profile without labelled text.
COMMON_WORDS = {
    "en": (
        "the of and to in is that it for was on with as are this be at by not have from or which had he "
        "her his she they we you were been has their there what when who will would can could one all "
        "some more about into than them its our out up so if no only other time these those between "
        "after such because most made many through over where"),
    "es": (
        "de la que el en y a los se del las un por con no una su para es al lo como más pero sus este "
        "fue ser son está entre cuando muy sin sobre también me hasta hay donde quien desde todo nos "
        "durante todos uno les ni contra otros ese eso ante ellos e esto"),
    "fr": (
        "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont "
        "avec été être ont cette aux mais on comme tout nous sa fait ses elle leur aussi bien deux même "
        "où ces après sans autres entre ou si y était"),
    "de": (
        "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
        "werden sie ich war hat dass nach wird bei einer um am sind noch wie einem über einen so zum aus "
        "zur nur vor oder aber kann wenn man wir mehr durch"),
    "it": (
        "di e il la che in un è per una sono con del non si da le dei nel alla della ma come anche più "
        "suo al lo gli i delle ha era dal loro essere stato hanno o se sua questo quando tutti tra due "
        "fu ai dopo"),
    "pt": (
        "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das foi à "
        "seu sua ou ser quando muito há já está eu também só pelo pela até isso ela entre era depois sem "
        "mesmo aos ter seus"),
    "nl": (
        "de het een van en in is dat op te zijn met voor niet aan er die om ook als maar bij door wordt "
        "hij ze haar had was of naar nog dan zo uit heeft hebben wat kan zou meer geen worden deze tot "
        "onder tegen na dit al zich over hun"),
}


def letters_only(c):
    """Lowercased letters, every other run one space, a space at both ends."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(col(c)), r"[^\p{L}]+", " "), F.lit(" "))


def _codes(letters: str) -> np.ndarray:
    return np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Every n-gram as one integer, 21 bits a character."""
    room = max(len(codes) - n + 1, 0)
    grams = codes[:room].copy()
    for step in range(1, n):
        grams = (grams << 21) | codes[step: room + step]
    return grams


def _gram_text(gram: int, n: int) -> str:
    return "".join(chr((gram >> (21 * (n - 1 - i))) & 0x1FFFFF) for i in range(n))


def fit_language_profiles(df: DataFrame, text: str = "text", label: str = "lang", n=(1, 3),
                          top: int = GRAMS) -> DataFrame:
    """(lang, gram, n, logp): smoothed log share of each frequent n-gram among those of its length.

    A task counts its texts, a small batch at a time, before anything is shuffled, and sends the counts on
    when it holds many; the result is bounded by `top` per language and length.
    """
    if n[1] > 3:
        raise ValueError("n-grams of at most 3 characters")

    def count(batches):
        known = {}
        for batch in batches:
            for lang, letters in batch.groupby("lang", dropna=True)["letters"]:
                for size in range(n[0], n[1] + 1):
                    held, room = [known[lang, size]] if (lang, size) in known else [], 0
                    for text in letters.dropna():
                        held.append(np.unique(_grams(_codes(text), size), return_counts=True))
                        room += len(held[-1][0])
                        if room > GRAMS_HELD:
                            held, room = [_combined(held)], 0
                    known[lang, size] = _combined(held)
            if sum(len(grams) for grams, _ in known.values()) > GRAMS_HELD:
                yield from told(known)
                known = {}
        yield from told(known)

    def told(known):
        for (lang, size), (grams, counts) in known.items():
            for at in range(0, len(grams), 50_000):
                yield pd.DataFrame({"lang": lang, "n": np.int32(size), "c": counts[at:at + 50_000],
                                    "gram": [_gram_text(int(g), size) for g in grams[at:at + 50_000]]})

    small_batches(df.sparkSession)
    counts = (
        df.select(F.col(label).alias("lang"), letters_only(text).alias("letters"))
        .mapInPandas(count, "lang string, n int, c bigint, gram string")
        .groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    )
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("total"))
    kept = top_per_group(counts, ("lang", "n"), [F.desc("c"), F.asc("gram")], top, "gram")
    return kept.join(totals, ["lang", "n"]).select(
        "lang", "gram", "n",
        F.log((F.col("c") + 1.0) / (F.col("total") + F.lit(float(top)))).alias("logp"),
    )


def _combined(held: list) -> tuple:
    """Sum of several (grams, counts)."""
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, counts = (np.concatenate(part) for part in zip(*held))
    found, at = np.unique(grams, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.int64)


def default_profiles(spark) -> DataFrame:
    rows = [(lang, words) for lang, words in COMMON_WORDS.items()]
    return fit_language_profiles(spark.createDataFrame(rows, "lang string, text string"))


def load_profiles(profiles: DataFrame) -> dict:
    """A profile table as arrays for the detector; refused when larger than a model may be."""
    rows = profiles.select("lang", "gram", "n", "logp").limit(MAX_PROFILE + 1).toPandas()
    if len(rows) > MAX_PROFILE:
        raise ValueError(f"profile table exceeds {MAX_PROFILE} rows; lower `top`")
    langs = sorted(rows["lang"].unique())
    at = {lang: i for i, lang in enumerate(langs)}
    sizes = {}
    for n, part in rows.groupby("n"):
        grams = sorted(part["gram"].unique())
        spot = {g: i for i, g in enumerate(grams)}
        floor = part.groupby("lang")["logp"].min()
        table = np.tile([floor.get(lang, part["logp"].min()) for lang in langs], (len(grams) + 1, 1))
        for lang, gram, logp in zip(part["lang"], part["gram"], part["logp"]):
            table[spot[gram], at[lang]] = logp
        codes = np.array([_grams(_codes(g), len(g))[0] for g in grams], np.int64)
        order = np.argsort(codes)
        weight = np.exp(part["logp"])
        own = (weight * part["logp"]).groupby(part["lang"]).sum() / weight.groupby(part["lang"]).sum()
        room = np.array([own.get(lang, 0.0) - floor.get(lang, 0.0) for lang in langs])
        sizes[int(n)] = (codes[order], table[np.append(order, len(grams))], room)
    return {"langs": langs, "sizes": sizes}


def _script(counts: np.ndarray, total: int):
    """Languages that their script alone gives away; shares are of all letters."""
    hangul, kana, han, cyrillic = counts
    if total and max(hangul, kana + han, cyrillic) * 2 > total:
        if hangul == max(hangul, kana + han, cyrillic):
            return "ko", hangul / total
        if cyrillic > kana + han:
            return "ru", cyrillic / total
        return ("ja" if kana * 10 > kana + han else "zh"), (kana + han) / total
    return None


def _between(codes, *spans):
    return int(sum(((codes >= a) & (codes <= b)).sum() for a, b in spans))


def detect(c, profiles: dict, prefix: int | None = None):
    """struct<language, confidence>: the most probable language and how sure that is.

    The confidence is the language's share among the profiles, for a text of at most EVIDENCE characters
    at the text's mean log likelihood, times the chance that the text is of that language at all: how far
    its log likelihood lies from that of unseen n-grams (0) to that of the language's own (1), by a
    logistic curve around FIT. A script that only one language uses gives its share of the letters.
    `prefix` limits the reading to the first characters. A text without letters is
    ('unknown', 0.0); a missing text stays NULL. Deterministic.
    """
    langs, sizes = profiles["langs"], profiles["sizes"]

    def verdict(letters: str):
        codes = _codes(letters)
        total = int((codes != 32).sum())
        if not total:
            return "unknown", 0.0
        scripts = np.array([
            _between(codes, (0xAC00, 0xD7AF), (0x1100, 0x11FF)), _between(codes, (0x3040, 0x30FF)),
            _between(codes, (0x4E00, 0x9FFF), (0x3400, 0x4DBF)), _between(codes, (0x0400, 0x04FF)),
        ])
        known = _script(scripts, total)
        if known:
            return known
        score, above, room = np.zeros((3, len(langs)))
        for n, (keys, table, own) in sizes.items():
            if len(codes) < n:
                continue
            grams = _grams(codes, n)
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            hits = np.bincount(np.where(keys[at] == grams, at, len(keys)), minlength=len(keys) + 1)
            score += hits @ table
            above += hits @ (table - table[-1])
            room += len(grams) * own
        share = np.exp((score - score.max()) * min(1.0, EVIDENCE / len(codes)))
        best = int(np.argmax(score))
        fit = above[best] / room[best] if room[best] > 0 else 0.0
        return langs[best], float(share[best] / share.sum() / (1 + np.exp(-STEEP * (fit - FIT))))

    @F.pandas_udf(VERDICT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if t is None else verdict(t) for t in texts]
        return pd.DataFrame(rows, columns=["language", "confidence"])

    c = col(c) if prefix is None else F.substring(col(c), 1, prefix)
    # not repeated for a filter above it
    return judge.asNondeterministic()(letters_only(c))


def detect_language(df: DataFrame, profiles, content: str = "content", prefix: int | None = None) -> DataFrame:
    """df + language, language_confidence."""
    if isinstance(profiles, DataFrame):
        profiles = load_profiles(profiles)
    small_batches(df.sparkSession)
    return df.withColumn("_lang", detect(content, profiles, prefix)).withColumns({
        "language": F.col("_lang.language"), "language_confidence": F.col("_lang.confidence"),
    }).drop("_lang")
