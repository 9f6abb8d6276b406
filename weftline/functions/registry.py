"""User functions: quality scorers, language detectors, tokenizers and SQL functions."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StringType, StructField, StructType

from weftline.functions import html as H, text as T

TEXTS_AT_ONCE = 200  # texts a tokenizer is given in one call
_HOOKS: dict = {"scorer": {}, "detector": {}, "tokenizer": {}}


def register_quality_scorer(name: str, fn):
    """fn(Series of texts) -> Series of scores; returned as a Column function."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return fn(texts)

    _HOOKS["scorer"][name] = score
    return score


def register_language_detector(name: str, fn):
    """fn(Series of texts) -> DataFrame(language, confidence)."""
    @F.pandas_udf("struct<language:string,confidence:double>")
    def detect(texts: pd.Series) -> pd.DataFrame:
        return fn(texts)

    _HOOKS["detector"][name] = detect
    return detect


def register_tokenizer(name: str, fn):
    """fn(list of texts, max_length) -> list of id lists."""
    def tokenizer(content, max_length: int):
        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            kind, parts = pa.list_(pa.int32()), []
            for at in range(0, len(texts), TEXTS_AT_ONCE):  # id lists of Python are far larger than arrays
                parts.append(pa.array(fn(texts.slice(at, TEXTS_AT_ONCE).to_pylist(), max_length), kind))
            return pa.concat_arrays(parts) if parts else pa.array([], kind)

        return encode.asNondeterministic()(content)

    _HOOKS["tokenizer"][name] = tokenizer
    return tokenizer


def hook(kind: str, name: str):
    return _HOOKS[kind][name]


@udtf(returnType=StructType([StructField("src", StringType()), StructField("dst", StringType())]))
class ExplodeLinks:
    """One row per distinct link of a page: SELECT l.* FROM pages, LATERAL explode_links(url, html) l."""

    def eval(self, url: str, html: str):
        if html is not None:
            for target in H.page_links(H.parse_page(html), url):
                yield url, target


def register_sql(spark: SparkSession) -> None:
    """The link function for SQL users; text functions need none, being built-in expressions."""
    spark.udtf.register("explode_links", ExplodeLinks)
