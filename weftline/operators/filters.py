"""Row filters and the reason a document is dropped for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.config import Config
from weftline.functions import scoring, text as T
from weftline.operators.language import detect

# Reasons in the order they are tested.
REASONS = ("empty", "too_short", "too_long", "unsupported_language", "low_language_confidence",
           "low_quality", "duplicate")


def filter_empty(df, col="content"):
    return df.where(F.length(T.strip(col)) > 0)


def filter_too_short(df, col="content", min_chars=500):
    return df.where(F.length(T.strip(col)) >= min_chars)


def filter_too_long(df, col="content", max_chars=100_000):
    return df.where(F.length(T.strip(col)) <= max_chars)


def filter_language(df, supported=Config().language.supported_languages):
    return df.where(F.col("language").isin(*supported))


def filter_lang_confidence(df, min_confidence=0.7):
    return df.where(F.col("language_confidence") >= min_confidence)


def filter_quality(df, min_score=0.6):
    return df.where(F.col("quality_score") >= min_score)


def filter_min_tokens(df, min_tokens=10):
    return df.where(F.size("tokens") >= min_tokens)


def page_min_content(df, col="content", min_chars=100):
    return df.where(F.length(T.strip(col)) >= min_chars)


def with_length_reason(df: DataFrame, cfg: Config = Config(), col: str = "content") -> DataFrame:
    """Stripped content, its length and the reason found by length alone."""
    n = F.col("content_length")
    return df.withColumn(col, T.strip(F.coalesce(F.col(col), F.lit("")))).withColumn(
        "content_length", F.length(col)
    ).withColumn(
        "reason",
        F.when(n == 0, "empty")
        .when(n < cfg.quality.min_content_length, "too_short")
        .when(n > cfg.quality.max_content_length, "too_long"),
    )


def annotate_reason(df: DataFrame, profiles: dict, cfg: Config = Config(), detector=None,
                    scorer=None) -> DataFrame:
    """df + language, language_confidence, quality_score and the first failing test, or NULL.

    Rows already out by length hand NULL to the language and quality functions, so these cost
    nothing there; the whole step is a projection without a shuffle. Duplicates are found
    afterwards, over the rows that have no reason yet.
    """
    measured = with_length_reason(df, cfg)
    todo = F.when(F.col("reason").isNull(), F.col("content"))
    verdict = detector(todo) if detector else detect(todo, profiles)
    seen = measured.withColumn("_lang", verdict).withColumns({
        "language": F.col("_lang.language"),
        "language_confidence": F.col("_lang.confidence"),
    }).drop("_lang")
    spoken = seen.withColumn(
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(~F.col("language").isin(*cfg.language.supported_languages), "unsupported_language")
        .when(F.col("language_confidence") < cfg.language.min_confidence, "low_language_confidence"),
    )
    spoken = spoken.withColumn("_todo", F.when(F.col("reason").isNull(), F.col("content")))
    # reason and whatever reads it hold the score: its counts over the text are made once
    score = scorer("_todo") if scorer else scoring.quality_score("_todo", scoring.char_entropy("_todo", once=True))
    scored = spoken.withColumn("_score", score).withColumn(
        "quality_score", F.when(F.col("reason").isNull(), F.col("_score"))).drop("_todo", "_score")
    return scored.withColumn(
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("quality_score") < cfg.quality.min_quality_score, "low_quality"),
    )


def split_by_reason(df: DataFrame):
    return df.where("reason IS NULL").drop("reason"), df.where("reason IS NOT NULL")
