"""Link graph: edges, reach from seeds and URL rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import html as H, url as U
from weftline.session import remove, scratch_path, small_batches, staged


def link_edges(pages: DataFrame, areas: bool = False) -> DataFrame:
    """(src, dst), each once. Links are distinct within a page, so only repeated pages meet here.

    `areas` adds the links of image maps, which a crawl follows but a document does not list.
    """
    small_batches(pages.sparkSession)
    if "html" in pages.columns:
        pages = pages.select("url", H.extract_links("html", "url", areas).alias("links"))
    return pages.select(F.col("url").alias("src"), F.explode("links").alias("dst")).distinct()


def follow_filter(edges: DataFrame, allowed_domains, deny_ext=U.DENY_15, col: str = "dst") -> DataFrame:
    """Links a crawl would follow, canonical and each once: allowed hosts, no denied extension."""
    if allowed_domains:
        edges = edges.where(U.on_domains(col, allowed_domains))
    return edges.where(~U.has_denied_extension(col, deny_ext)).withColumn(col, U.canonical_url(col)).distinct()


def allowed_domain_join(urls: DataFrame, allowed: DataFrame, col: str = "url") -> DataFrame:
    """URLs whose host equals or lies under a domain of a table of any size."""
    hosts = urls.select(U.url_host(col).alias("_host")).distinct()
    good = (
        hosts.select("_host", F.explode(U.host_suffixes("_host")).alias("domain"))
        .join(allowed.select(F.lower("domain").alias("domain")).distinct(), "domain", "left_semi")
        .select("_host").distinct()
    )
    return urls.withColumn("_host", U.url_host(col)).join(good, "_host", "left_semi").drop("_host")


HUB_LINKS = 1_000  # links in one row of the adjacency table


def lay_out(edges: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write adjacency rows (src, chunk, dsts) bucketed by source and chunk; returns hubs(src, chunks).

    A source with many links is cut into chunks by a hash of the target, in buckets of their own.
    """
    spark = edges.sparkSession
    edges = staged(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL"), "edges")  # they may come from parsed pages
    hubs = staged(
        edges.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") > HUB_LINKS)
        .select("src", F.ceil(F.col("n") / HUB_LINKS).alias("chunks")), "hubs")
    chunk = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("chunks")), F.lit(0)).alias("chunk")
    rows = edges.join(hubs, "src", "left").select("src", chunk, "dst").groupBy("src", "chunk").agg(
        F.collect_set("dst").alias("dsts"))
    rows.write.format("parquet").bucketBy(buckets, "src", "chunk").option("path", path).saveAsTable(table)
    spark.catalog.refreshTable(table)
    return hubs


def next_level(adjacency: DataFrame, hubs: DataFrame, visited: DataFrame, depth: int) -> DataFrame:
    """(url, depth) first reached at a depth. Both tables are bucketed: only the frontier and its links move."""
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("chunks", F.lit(1)) - 1))
    asked = visited.where(F.col("depth") == depth - 1).select(F.col("url").alias("src")).join(
        hubs, "src", "left").select("src", chunks.alias("chunk"))
    reached = adjacency.join(asked, ["src", "chunk"]).select(F.explode("dsts").alias("url")).distinct()
    return reached.join(visited.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth))


def crawl_reachability(edges: DataFrame, seeds: DataFrame, max_depth: int, strict: bool = False) -> DataFrame:
    """(url, depth): breadth-first reach from seeds(url).

    A link is followed while the depth of its source is at most max_depth, so pages up to
    max_depth + 1 are reached; strict stops at max_depth. Edges are laid out once, bucketed by
    source, and every level is appended to a table bucketed by URL, which bounds both the plan and
    what a lost executor costs; neither table is shuffled again. Null URLs are left out.
    """
    spark = edges.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links_at, seen_at = scratch_path(spark, "adjacency"), scratch_path(spark, "visited")
    links, seen = (f"weftline_{at.rsplit('/', 1)[1].replace('-', '_')}" for at in (links_at, seen_at))

    def append(rows):
        rows.select("url", F.col("depth").cast("int").alias("depth")).write.format("parquet").mode("append").bucketBy(
            buckets, "url").option("path", seen_at).saveAsTable(seen)

    try:
        hubs = lay_out(edges, links, links_at, buckets)
        append(seeds.select("url").where("url IS NOT NULL").distinct().withColumn("depth", F.lit(0)))
        for depth in range(1, max_depth + (1 if strict else 2)):
            append(next_level(spark.table(links), hubs, spark.table(seen), depth))
            if spark.table(seen).where(F.col("depth") == depth).isEmpty():
                break
    finally:
        for table in (links, seen):
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files of an external table stay
        remove(spark, links_at)
    return spark.read.schema("url string, depth int").parquet(seen_at)


def crawl_scope_counts(reached: DataFrame) -> DataFrame:
    return reached.groupBy("depth", U.url_domain("url").alias("domain")).agg(F.count("*").alias("pages"))
