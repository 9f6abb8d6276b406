"""Pages to raw documents."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import html as H, text as T, url as U


def page_to_document(pages: DataFrame, run_ts: str, min_chars: int = 100, max_links: int = 100,
                     exclude_subtrees: bool = False) -> DataFrame:
    """The raw record of every page with enough text. Map-only; each page is parsed once.

    pages: url, html and, where known, depth and status_code. run_ts is the ISO time of the run, in UTC.
    """
    have = pages.columns
    depth = F.col("depth") if "depth" in have else F.lit(0)
    status = F.col("status_code") if "status_code" in have else F.lit(200)
    unix_s = datetime.fromisoformat(run_ts.removesuffix("Z")).replace(tzinfo=timezone.utc).timestamp()
    parsed = pages.withColumn("_page", H.html_extract("html", "url", exclude_subtrees))
    text = F.col("_page.text")
    return parsed.where(F.length(T.strip(text)) >= min_chars).select(
        U.doc_id("url", int(unix_s)).alias("id"),
        "url",
        U.url_domain("url").alias("domain"),
        F.col("_page.title").alias("title"),
        text.alias("content"),
        F.length(text).alias("content_length"),
        F.size("_page.links").alias("links_found"),
        depth.cast("int").alias("depth"),
        status.cast("int").alias("status_code"),
        F.lit(run_ts).alias("timestamp"),
        T.content_hash(text).alias("content_hash"),
        H.cap_links("_page.links", max_links).alias("links"),
    )


def unparsed_pages(pages: DataFrame) -> DataFrame:
    """Pages the parser gave up on."""
    return pages.where(H.html_extract("html", "url")["links"].isNull())
