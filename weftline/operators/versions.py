"""Versioned corpora: snapshots by content, a table of versions, comparison and a training log.

A store is a folder of Parquet tables: `documents` (each distinct row once, in the folder of the version that
brought it), `members` (the row hashes of each version, in order), `digests` (the tree of SHA-256
digests over them), `versions` (one row per version, written last, so that a save that failed is simply
repeated) and `trained` (an append-only log of names). A new version writes the rows that no earlier one
has; two versions are compared by reading the buckets whose digests differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import schemas
from weftline.functions import text as T
from weftline.operators.stats import filter_rate, side_by_side
from weftline.session import remove, staged_at
from weftline.sources.writers import table_exists

COMPONENT_VERSIONS = {"crawler": "1.0.0", "processor": "1.0.0", "tokenizer": "1.0.0"}  # fixed values
TRAINED = "name string, trained_at string"
MEMBERS = "row_hash string, content_hash string, n bigint"
DIGESTS = "level int, prefix string, digest string, n bigint"
LEVELS = (5, 2, 0)  # hex digits of the hash that nodes of the digest tree share, from the leaves to the root
BUCKET = 2          # digits by which members are laid out


@dataclass(frozen=True)
class VersionStore:
    spark: SparkSession
    path: str

    def at(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table}"

    def read(self, table: str, schema: str) -> DataFrame:
        if not table_exists(self.spark, self.at(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.at(table))

    @property
    def versions(self) -> DataFrame:
        return self.read("versions", schemas.VERSIONS)

    @property
    def trained(self) -> DataFrame:
        return self.read("trained", TRAINED)


def digest_tree(counted: DataFrame, col: str = "content_hash") -> DataFrame:
    """(level, prefix, digest, n) over (hash, n): SHA-256 of the sorted hashes and their counts of each leaf, combined up to the root.

    A leaf holds the hashes that agree in five hex digits, a millionth of all; a node joins its children in
    order. Equal multisets have equal digests, and so have equal parts of two multisets.
    """
    level = counted.groupBy(F.substring(col, 1, LEVELS[0]).alias("prefix")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col(col), "n"))), ","), 256).alias("digest"), F.sum("n").alias("n"))
    tree = level.withColumn("level", F.lit(LEVELS[0]))
    for digits in LEVELS[1:]:
        child = F.array_sort(F.collect_list(F.concat_ws(":", "prefix", "digest")))
        level = level.groupBy(F.substring("prefix", 1, digits).alias("parent")).agg(
            F.sha2(F.array_join(child, ","), 256).alias("digest"), F.sum("n").alias("n")).withColumnRenamed("parent", "prefix")
        tree = tree.unionByName(level.withColumn("level", F.lit(digits)))
    return tree.select(*(f.split()[0] for f in DIGESTS.split(", ")))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(content_hash): a hash of the name and the bytes of every file under a folder, such as manifests and tokenizer files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = F.length(F.lit(path.rstrip("/").rsplit("/", 1)[-1])) + 1
    name = F.expr("path").substr(F.instr("path", "/" + path.rstrip("/").rsplit("/", 1)[-1] + "/") + 1 + root, F.lit(1 << 20))
    return files.select(F.sha2(F.concat_ws(":", name, F.sha2("content", 256)), 256).alias("content_hash"))


def dataset_checksum(df: DataFrame, col: str = "content_hash", files: DataFrame | None = None) -> DataFrame:
    """One row: the root digest of the multiset of document hashes, whatever their order, and of file hashes if given."""
    hashes = df.select(col) if files is None else df.select(col).union(files.select("content_hash"))
    root = digest_tree(hashes.groupBy(col).agg(F.count("*").alias("n")), col).where("level = 0")
    return root.agg(F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("checksum"))


def corpus_metrics(df: DataFrame) -> DataFrame:
    """One row: statistics and quality metrics of a snapshot, as maps."""
    have = df.columns
    tokens = F.col("token_count") if "token_count" in have else F.col("token_estimate") if "token_estimate" in have else F.lit(0)
    stats = {"total_docs": F.count("*"), "total_tokens": F.sum(tokens)}
    if "split" in have:
        for split in ("train", "val"):
            on = F.col("split") == split
            stats[f"{split}_docs"] = F.count_if(on)
            stats[f"{split}_tokens"] = F.sum(F.when(on, tokens))
    entries = [x for k, v in stats.items() for x in (F.lit(k), F.coalesce(v, F.lit(0)).cast("double"))]
    quality = F.avg("quality_score") if "quality_score" in have else F.lit(None).cast("double")
    return df.agg(
        F.create_map(*entries).alias("statistics"),
        F.create_map(F.lit("avg_quality"), F.coalesce(quality, F.lit(0.0))).alias("quality_metrics"))


def _pairs(values: dict):
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair]).cast("map<string,string>")


def _layout(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _committed(store: VersionStore, layout: str) -> list[str]:
    """Document folders of the versions of a layout that were saved to the end."""
    names = store.versions.where(F.col("provenance")["layout"] == layout).select("version").distinct().collect()
    return [store.at(f"documents/version={r['version']}") for r in names]


def _stored(store: VersionStore, layout: str) -> DataFrame:
    """Every distinct row of this layout in the store, with its hash."""
    paths, schema = _committed(store, layout), f"row_hash string, {layout}"
    return store.spark.read.schema(schema).parquet(*paths) if paths else store.spark.createDataFrame([], schema)


def members(store: VersionStore, name: str) -> DataFrame:
    """(row_hash, content_hash, n, bucket): the rows of a version and how often it holds each."""
    path = store.at(f"members/version={name}")
    return store.spark.read.schema(MEMBERS + ", bucket string").parquet(path)


def digests(store: VersionStore, name: str) -> DataFrame:
    return store.spark.read.schema(DIGESTS).parquet(store.at(f"digests/version={name}"))


def _append_version(store: VersionStore, name: str, description: str, df: DataFrame, created_at: str,
                    provenance: dict, files: str | None = None) -> None:
    text, layout = F.to_json(F.struct(*df.columns)), _layout(df)
    row_hash = F.sha2(F.concat_ws("|", F.lit(layout), text), 256)
    content = F.col("content_hash") if "content_hash" in df.columns else T.content_hash(text)
    path = staged_at(df.withColumns({"row_hash": row_hash, "_content": content}), "version")  # df is computed once, then read
    hashed = store.spark.read.schema(f"{layout}, row_hash string, _content string").parquet(path)
    df = hashed.select(*df.columns)
    bucket = F.substring("row_hash", 1, BUCKET).alias("bucket")
    found = hashed.select("row_hash", F.col("_content").alias("content_hash")).groupBy("row_hash").agg(
        F.first("content_hash").alias("content_hash"), F.count("*").alias("n"))
    # ranges of hashes a file: a filter on buckets skips files and row groups by their bounds
    laid = found.select("*", bucket).repartitionByRange("bucket", "row_hash").sortWithinPartitions("bucket", "row_hash")
    laid.write.mode("overwrite").parquet(store.at(f"members/version={name}"))
    own = members(store, name)
    fresh = own.join(_stored(store, layout).select("row_hash"), "row_hash", "left_anti").select("row_hash")
    new = hashed.drop("_content").join(fresh, "row_hash", "left_semi").dropDuplicates(["row_hash"])
    new.write.mode("overwrite").parquet(store.at(f"documents/version={name}"))
    counted = own.select("row_hash", "n")
    if files is not None:
        counted = counted.union(file_hashes(store.spark, files).groupBy("content_hash").agg(F.count("*").alias("n")))
    digest_tree(counted, "row_hash").coalesce(1).write.mode("overwrite").parquet(store.at(f"digests/version={name}"))
    written = store.spark.read.schema("row_hash string").parquet(*_committed(store, layout), store.at(f"documents/version={name}"))
    if not own.join(written, "row_hash", "left_anti").isEmpty():
        raise RuntimeError(f"version {name}: the rows changed while they were written")
    checksum = digests(store, name).where("level = 0").agg(F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("checksum"))
    provenance = {**provenance, "layout": layout}
    side_by_side(corpus_metrics(df), checksum).select(
        F.lit(name).alias("version"), F.lit(created_at).alias("created_at"),
        F.lit(description).alias("description"), _pairs(COMPONENT_VERSIONS).alias("source_versions"),
        "statistics", "quality_metrics",
        _pairs(provenance).alias("provenance"), "checksum",
    ).write.mode("append").parquet(store.at("versions"))
    remove(store.spark, path)


def next_version(versions: DataFrame) -> str:
    """1.0 at first, then the last numbered version with its minor part raised: 1.9 gives 1.10."""
    last = versions.where(F.col("version").rlike(r"^\d+\.\d+$")).agg(
        F.max_by("version", F.struct("created_at", F.split("version", r"\.").cast("array<int>")))
    ).first()[0]
    if last is None:
        return "1.0"
    major, minor = last.split(".")
    return f"{major}.{int(minor) + 1}"


def create_version(store: VersionStore, description: str, df: DataFrame, created_at: str,
                   provenance: dict | None = None, files: str | None = None) -> str:
    """Snapshot the rows under the next number; statistics, quality and checksum come from the data.

    The checksum covers the files under `files` too, such as manifests and a tokenizer.
    """
    name = next_version(store.versions)
    _append_version(store, name, description, df, created_at, {"source": "weftline", **(provenance or {})}, files)
    return name


def save_version(store: VersionStore, name: str, description: str, df: DataFrame, created_at: str, files: str | None = None) -> None:
    """Snapshot the rows under a new name; refused for a name in use and for an empty corpus."""
    if not store.versions.where(F.col("version") == name).isEmpty():
        raise ValueError(f"version {name} already exists")
    if df.isEmpty():
        raise ValueError("no documents to save")
    _append_version(store, name, description, df, created_at, {"source": "weftline"}, files)


def list_versions(store: VersionStore) -> DataFrame:
    return store.versions.select("version", "created_at", "description").orderBy("created_at", "version")


def current_version(store: VersionStore) -> DataFrame:
    """One row: the version created last; NULL in an empty store."""
    return store.versions.agg(F.max_by("version", F.struct("created_at", "version")).alias("version"))


def get_version(store: VersionStore, version: str | None = None) -> DataFrame:
    rows = store.versions
    if version is None:
        version = current_version(store).first()[0]
    row = rows.where(F.col("version") == version)
    if version is None or row.isEmpty():
        raise ValueError(f"version {version} not found")
    return row


def newest_version(names: DataFrame, col: str = "name") -> DataFrame:
    return names.agg(F.max(col).alias(col))


def load_version(store: VersionStore, name: str) -> DataFrame:
    """The rows of a version, repeated ones as often as they were saved."""
    layout = get_version(store, name).first()["provenance"]["layout"]
    rows = _stored(store, layout).join(members(store, name).select("row_hash", "n"), "row_hash")
    return rows.withColumn("n_copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("row_hash", "n", "n_copy")


def export_version(store: VersionStore, name: str, out: str) -> None:
    """One version's documents and its row of the versions table as a dataset of their own."""
    load_version(store, name).write.mode("errorifexists").parquet(f"{out}/documents")
    get_version(store, name).write.json(f"{out}/dataset_info")


def compare_metrics(v1: DataFrame, v2: DataFrame, col: str = "statistics") -> DataFrame:
    """(metric, v1, v2, diff, pct_change) over the union of both maps' keys; an absent value is 0."""
    a = v1.select(F.explode(col).alias("metric", "v1"))
    b = v2.select(F.explode(col).alias("metric", "v2"))
    both = a.join(b, "metric", "full_outer").select(
        "metric", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("v1", "v2")])
    diff = F.col("v2") - F.col("v1")
    return both.withColumns({
        "diff": diff, "pct_change": F.when(F.col("v1") == 0, F.lit(0.0)).otherwise(diff / F.col("v1") * 100)})


def compare_versions(store: VersionStore, v1: str, v2: str) -> DataFrame:
    """Differences of statistics and, without a percentage, of quality metrics."""
    one, two = get_version(store, v1), get_version(store, v2)
    quality = compare_metrics(one, two, "quality_metrics").withColumn("pct_change", F.lit(None).cast("double"))
    return compare_metrics(one, two).withColumn("kind", F.lit("statistics")).unionByName(
        quality.withColumn("kind", F.lit("quality")))


def key_union(v1: DataFrame, v2: DataFrame, col: str = "statistics") -> DataFrame:
    keys = [v.select(F.explode(F.map_keys(col)).alias("metric")) for v in (v1, v2)]
    return keys[0].union(keys[1]).distinct()


def compare_counts(store: VersionStore, v1: str, v2: str) -> DataFrame:
    """Documents and tokens of two versions and their signed difference."""
    return compare_metrics(get_version(store, v1), get_version(store, v2)).where(
        F.col("metric").isin("total_docs", "total_tokens")).drop("pct_change")


def version_diff_docs(old: DataFrame, new: DataFrame, col: str = "content_hash") -> DataFrame:
    """(content_hash, change): added, removed or unchanged, each hash once; one shuffle of hashes."""
    sides = old.select(col, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select(col, F.lit(0).alias("o"), F.lit(1).alias("n")))
    return sides.groupBy(col).agg(F.max("o").alias("o"), F.max("n").alias("n")).select(
        col, F.when(F.col("o") + F.col("n") == 2, "unchanged").when(F.col("n") == 1, "added")
        .otherwise("removed").alias("change"))


def version_diff(store: VersionStore, old: str, new: str) -> DataFrame:
    """(content_hash, change, n): rows added or removed from one version to the other.

    Only buckets whose digests differ are read, both of them: at most 256 names are compared first.
    """
    kind = F.col("level") == BUCKET
    before = digests(store, old).where(kind).select("prefix", F.col("digest").alias("a"))
    after = digests(store, new).where(kind).select("prefix", F.col("digest").alias("b"))
    changed = before.join(after, "prefix", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    buckets = [r["prefix"] for r in changed.select("prefix").collect()]
    sides = [members(store, v).where(F.col("bucket").isin(buckets)).select("row_hash", "content_hash", (F.col("n") * sign).alias("n"))
             for v, sign in ((old, -1), (new, 1))]
    moved = sides[0].union(sides[1]).groupBy("row_hash").agg(F.first("content_hash").alias("content_hash"), F.sum("n").alias("n")).where("n <> 0")
    return moved.select("content_hash", F.when(F.col("n") > 0, "added").otherwise("removed").alias("change"), F.abs("n").alias("n"))


def mark_trained(store: VersionStore, trained_at: str, name: str | None = None) -> str:
    """Log a version, by default the current one, as trained."""
    name = get_version(store, name).first()["version"]
    store.spark.createDataFrame([(name, trained_at)], TRAINED).write.mode("append").parquet(store.at("trained"))
    return name


def unique_trained(store: VersionStore) -> DataFrame:
    return store.trained.select("name").distinct()


def with_trained(store: VersionStore) -> DataFrame:
    """versions + trained."""
    log = unique_trained(store).select(F.col("name").alias("version"), F.lit(True).alias("trained"))
    return store.versions.join(log, "version", "left").withColumn("trained", F.coalesce("trained", F.lit(False)))


def untrained_versions(store: VersionStore) -> DataFrame:
    return with_trained(store).where(~F.col("trained")).select(
        "version", "created_at", F.col("statistics")["total_docs"].cast("long").alias("docs"),
        F.col("statistics")["total_tokens"].cast("long").alias("tokens"))


def trainable_versions(shards: DataFrame) -> DataFrame:
    """Versions with at least one training shard, and how many."""
    named = shards.where(F.col("split") == "train").groupBy("version", "shard_id").agg(F.count("*").alias("n"))
    return named.groupBy("version").agg(F.count("*").alias("train_shards"))


def version_report(raw: DataFrame, cleaned: DataFrame, shards: DataFrame, name: str) -> DataFrame:
    """(line_no, line) of the version text: documents and tokens at each stage and the filter rate."""
    def both(split):
        on = F.col("split") == split
        return [F.count_if(on).alias(f"{split}_docs"),
                F.coalesce(F.sum(F.when(on, F.col("token_count"))), F.lit(0)).alias(f"{split}_tokens")]

    row = side_by_side(raw.agg(F.count("*").alias("raw")), cleaned.agg(F.count("*").alias("kept")),
                       shards.agg(*both("train"), *both("val")))
    lines = [
        F.lit(f"Dataset Version: {name}"),
        F.concat(F.lit("Raw Documents: "), F.col("raw")),
        F.concat(F.lit("Cleaned Documents: "), F.col("kept")),
        F.concat(F.lit("Filter Rate: "), F.format_string("%.1f", filter_rate("raw", "kept")), F.lit("%")),
        F.concat(F.lit("Training Documents: "), F.col("train_docs")),
        F.concat(F.lit("Training Tokens: "), F.col("train_tokens")),
        F.concat(F.lit("Validation Documents: "), F.col("val_docs")),
        F.concat(F.lit("Validation Tokens: "), F.col("val_tokens")),
    ]
    return row.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))
