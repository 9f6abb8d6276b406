"""Syllables by a table of weighted letter patterns, e.g. `hy3ph` or `.ach4`.

A digit weighs the place it stands at, a dot is the border of a word. All patterns found in a word
are laid over it and the greatest weight of each place counts; where it is odd the word may break.
"""

from __future__ import annotations

from unicodedata import category

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T

MAX_PATTERNS = 200_000  # patterns that tasks carry; dictionaries of a language hold 5 to 70 thousand
MARGIN = 2              # letters before the first and after the last break
REMEMBERED = 200_000    # words whose count a task keeps


def load_patterns(patterns: DataFrame, column: str = "pattern") -> tuple:
    """The patterns of a table, its size checked; null and blank ones say nothing."""
    rows = patterns.where(F.trim(column) != "").select(F.lower(F.trim(column)).alias("p")).distinct().limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} hyphenation patterns")
    return tuple(sorted(r["p"] for r in rows))


def weights_of(pattern: str):
    """(letters, weight before each letter and after the last)."""
    letters, weights = [], [0]
    for ch in pattern:
        if ch.isdecimal():
            weights[-1] = int(ch)
        else:
            letters.append(ch)
            weights.append(0)
    return "".join(letters), weights


def pattern_trie(patterns) -> dict:
    """Nested dicts by letter; under "" the weights of the pattern that ends there."""
    root = {}
    for letters, weights in map(weights_of, patterns):
        node = root
        for ch in letters:
            node = node.setdefault(ch, {})
        held = node.get("", weights)
        node[""] = [max(pair) for pair in zip(held, weights)]
    return root


def breaks(word: str, trie: dict) -> list:
    """Places (letters before them) at which a lower-case word may break."""
    framed = f".{word}."
    best = [0] * (len(framed) + 1)
    for start in range(len(framed)):
        node = trie
        for at in range(start, len(framed)):
            node = node.get(framed[at])
            if node is None:
                break
            for i, weight in enumerate(node.get("", ())):
                if weight > best[start + i]:
                    best[start + i] = weight
    return [i for i in range(MARGIN, len(word) - MARGIN + 1) if best[i + 1] % 2]


def bare(word: str) -> str:
    """Letters, numbers, underscores and apostrophes of a lexeme: "salon." breaks as "salon"."""
    return word if word.isalpha() else "".join(ch for ch in word if ch in "_'" or category(ch)[0] in "LN")


def syllables(c, patterns):
    """Syllables of a text's words, one more than its breaks each; NULL for NULL, 0 without words."""
    patterns = tuple(patterns)

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        trie, known = pattern_trie(patterns), {}

        def of(word):
            n = known.get(word)
            if n is None:
                n = len(breaks(bare(word), trie)) + 1
                if len(known) < REMEMBERED:
                    known[word] = n
            return n

        return texts.map(lambda words: sum(map(of, words)), na_action="ignore").astype("Int64")

    lexemes = F.regexp_extract_all(F.lower(T.col(c)), F.lit(f"({T.LEXEME})"), F.lit(1))
    return count.asNondeterministic()(lexemes)  # not repeated for a filter above it


def flesch_reading_ease(c, patterns):
    """Reading ease with syllables by patterns; the counts are those of text.flesch_reading_ease."""
    counted = F.struct(T.lexicon_count(c).alias("lexemes"), T.readable_sentences(c).alias("sentences"),
                       syllables(c, patterns).alias("syllables"))
    return T.flesch_of(counted)
