"""Document scores."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from weftline.functions import text as T


def _entropy(texts: pd.Series) -> pd.Series:
    def bits(text):
        if not text:
            return 0.0
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        share = np.unique(codes, return_counts=True)[1] / len(text)
        return float(-(share * np.log2(share)).sum()) + 0.0

    return texts.map(bits, na_action="ignore")


def char_entropy(c, once: bool = False):
    """Shannon bits per character; one pass over each text and no shuffle.

    `once` keeps Spark from writing an expression on top of it out again wherever its result is used.
    """
    entropy = F.pandas_udf(_entropy, DoubleType())
    return (entropy.asNondeterministic() if once else entropy)(T.col(c))


def entropy_score(entropy):
    return F.when(T.col(entropy).isNotNull(), T.unit_interval(T.col(entropy) / 5.0))


def quality_score(c, entropy=None):
    """Mean of readability, character entropy and sentence-length fit; 0.5 when undefined."""
    entropy = char_entropy(c) if entropy is None else T.col(entropy)
    form = T.let(T.reading_counts(c), T.flesch_of) / 100.0
    fit = T.let(T.avg_sentence_len(c), T.length_diversity)
    total = T.unit_interval(form) + T.unit_interval(entropy / 5.0) + fit
    missing = F.length(T.col(c)) * 0.0  # NULL without a text, which greatest and least would hide
    return F.coalesce(total / 3.0 + missing, F.lit(0.5))


def quality_score_weighted(c, min_chars: int = 500):
    """The weighted variant: reading ease, sentence length and syllables per word."""
    def mix(n):
        sentence_len = n["lexemes"] / n["sentences"]
        per_word = n["syllables"] / F.greatest(F.lit(1), n["lexemes"])
        return T.unit_interval(
            0.4 * (T.flesch_of(n) / 100.0)
            + 0.3 * F.least(sentence_len / 30.0, F.lit(1.0))
            + 0.3 * F.least(per_word / 3.0, F.lit(1.0)))

    return F.when(F.length(T.col(c)) < min_chars, F.lit(0.0)).otherwise(T.let(T.reading_counts(c), mix))


def normalize_unicode(c, form: str = "NFC"):
    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return normal(T.col(c))
