"""Quality rules: plain counts of a text, and how much likelier its n-grams are in trusted text than in the corpus."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import grams
from weftline.llm.common import id_field, map_rows, texts

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT = 50      # percent of the words
THRESHOLD = -0.2     # log-likelihood ratio a gram; a text below it is less like the target than like the raw corpus


def measures(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), grams.repeat_words(words))


def target_ratio(src: DataFrame, labels: DataFrame):
    """Log-likelihood ratio of each gram bucket over (doc_id, text); all trusted documents count, however many."""
    good = grams.label_rows(labels).where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id", F.lit(2).alias("target"))
    marked = src.join(good.hint("shuffle_hash"), "doc_id", "left").select(
        F.col("text").cast("binary").alias("text"), (F.lit(1) + F.coalesce("target", F.lit(0))).alias("classes"))
    raw, target = grams.corpus_counts(marked, 2)
    return grams.log_ratio(target, raw)


def judged(text: str, ratio, threshold: float = THRESHOLD) -> tuple:
    """(the measures, base_failed, ratio, kept) of a text."""
    m = measures(text)
    failed = m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEAT * m[0]
    r = grams.mean_ratio(text.encode(), ratio)
    return *m, failed, r, not failed and r >= threshold


def passing(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that quality_rules keeps, all their columns unchanged."""
    ratio = target_ratio(texts(docs, id_col, text_col, binary=False), labels)

    @F.pandas_udf("boolean")
    def kept(column: pd.Series) -> pd.Series:
        return column.map(lambda text: judged(text or "", ratio)[-1]).astype(bool)

    return docs.where(kept(text_col))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept) per row.

    The target multinomial comes from all documents labelled quality 1 and not toxic, the raw one from
    all documents. `ratio` is the log-likelihood ratio of the text's hashed byte
    4-grams, divided by their number; kept needs base_failed false and a ratio of at least `threshold`.
    Without labels the ratio is 0. Null texts are empty and fail the base rule; null ids and repeated rows
    stay and are never trusted by a null; other columns are ignored; an empty table gives an empty one.
    """
    src = texts(docs, id_col, text_col, binary=False)
    ratio = target_ratio(src, labels)

    def run(rows):
        for doc_id, text in rows:
            yield doc_id, *judged(text, ratio, threshold)

    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return map_rows(src, run, T.StructType([
        id_field(src), *(T.StructField(c, T.LongType()) for c in counts), T.StructField("base_failed", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()), T.StructField("kept", T.BooleanType())]))
