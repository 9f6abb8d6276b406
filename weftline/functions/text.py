"""Text functions: Column in, Column out, all evaluated in the JVM.

Whitespace and word classes are spelled out so that they mean the same in Java, in RE2 and in
Unicode-aware Python patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and patterns.
SPACE = r"\t-\r\x1c-\x1f \x{85}\p{Z}"
WORD = r"[\p{L}\p{N}_]+"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
URL = r"https?://[!$-_a-z]+"
EMAIL = f"(?<![^{SPACE}])[^{SPACE}][^{SPACE}@]*+@[^{SPACE}]+"
STOPS = "[.!?]"
# a sentence piece counts for readability when it has more than two tokens; the form that the SQL twins use
SENTENCE = f"(?:[^.!?{SPACE}]+[{SPACE}]+){{2}}[^.!?{SPACE}]+[^.!?]*"
LEXEME = rf"[\p{{L}}\p{{N}}_'][^{SPACE}]*"
VOWELS = "[aeiouyàâäáãåæéèêëíìîïóòôöõøœúùûüýÿ]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c):
    """Unicode whitespace off both ends; looks at the ends only, not through the whole text."""
    return F.btrim(col(c), F.lit(SPACES))


def clean_whitespace(c):
    return F.regexp_replace(col(c), f"[{SPACE}]+", " ")


def remove_urls(c):
    return F.regexp_replace(col(c), URL, "")


def remove_emails(c):
    """Drops every whitespace-delimited token with an inner @; anchored at the token start to stay linear."""
    return F.regexp_replace(col(c), EMAIL, "")


def collapse_punct(c):
    return F.regexp_replace(col(c), "[.!?]{2,}", ".")


def clean_content(c):
    return strip(collapse_punct(remove_emails(remove_urls(clean_whitespace(c)))))


def words(c):
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"({WORD})"), F.lit(1))


def count_matches(c, pattern: str):
    return F.regexp_count(col(c), F.lit(pattern))


def estimate_tokens(c):
    return count_matches(c, WORD) + count_matches(c, STOPS)


def sentence_count(c):
    """Pieces between runs of .!?, the empty last one included."""
    return count_matches(c, "[.!?]+") + 1


def avg_sentence_len(c):
    return count_matches(c, f"[^.!?{SPACE}]+") / sentence_count(c)


def length_diversity(avg_len):
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(col(avg_len) - 20.0) / 50.0)


def lexicon_count(c):
    return count_matches(c, LEXEME)


def syllables(c):
    """Vowel groups, at least one per word."""
    return F.greatest(count_matches(F.lower(col(c)), VOWELS), lexicon_count(c))


def readable_sentences(c):
    """Pieces of more than two tokens; cut first, so that an unbroken run is read once."""
    pieces = F.filter(F.split(col(c), "[.!?]+"), lambda p: F.regexp_count(p, F.lit(f"[^{SPACE}]+")) > 2)
    return F.greatest(F.lit(1), F.size(pieces))


def let(value, fn):
    """fn of a value that is evaluated once, however often fn uses it and under whatever condition."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def reading_counts(c):
    """struct<lexemes, sentences, syllables>, each text pattern counted once."""
    lexemes, vowels = lexicon_count(c), count_matches(F.lower(col(c)), VOWELS)
    return let(F.struct(lexemes.alias("n"), vowels.alias("v"), readable_sentences(c).alias("s")), lambda x: F.struct(
        x["n"].alias("lexemes"), x["s"].alias("sentences"), F.greatest(x["n"], x["v"]).alias("syllables")))


def flesch_of(counts):
    per_word = counts["syllables"] / F.greatest(F.lit(1), counts["lexemes"])
    per_sentence = counts["lexemes"] / counts["sentences"]
    return F.lit(206.835) - F.lit(1.015) * per_sentence - F.lit(84.6) * per_word


def flesch_reading_ease(c):
    return let(reading_counts(c), flesch_of)


def unit_interval(c):
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col(c)))


def readability_score(c):
    return F.when(col(c).isNotNull(), unit_interval(flesch_reading_ease(c) / 100.0))


def content_hash(c, algo: str = "sha256"):
    if algo == "md5":
        return F.md5(col(c))
    if algo != "sha256":
        raise ValueError(f"unknown hash: {algo}")
    return F.sha2(col(c), 256)


def strip_html(c):
    """Plain tag removal: scripts, styles and comments go with their content."""
    bare = F.regexp_replace(col(c), r"(?is)<!--.*?-->|<(script|style)\b.*?</(script|style)[^>]*>", " ")
    return F.regexp_replace(bare, "<[^>]*>", " ")
