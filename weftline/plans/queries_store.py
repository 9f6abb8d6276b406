"""Queries that write and read back: files, tables, versions, the job log and streams.

What they write goes to the session's shared folder and derives from the given tables.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from weftline.functions import scoring as S, text as T
from weftline.operators import jobs, stats, versions as V
from weftline.plans import catalog as C
from weftline.plans.catalog import ORACLES, query
from weftline.plans.queries_corpus import SHARDED, sharded
from weftline.plans.queries_text import profiles
from weftline.plans.tables import RUN_TS
from weftline.session import remove, scratch_path, staged
from weftline.sources import readers, writers
from weftline.streaming import ingest, state

RAW_SQL = "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS md5, CAST(length(text) AS INTEGER) AS content_length FROM documents"
CLEANED_SQL = f"""WITH {C.DOCS} SELECT CAST(doc_id AS VARCHAR) AS id, md5({C.clean('body')}) AS md5, lang AS language,
  CAST({C.count('body', T.WORD)} + {C.count('body', T.STOPS)} AS INTEGER) AS token_estimate FROM docs"""


# -- files ----------------------------------------------------------------------------------------

def raw_files(t, docs_per_file=10):
    path = scratch_path(t.spark, "raw")
    writers.write_raw(t.raw.drop("ord", "source", "lang"), path, docs_per_file)
    return path


@query("scan_raw_jsonl", RAW_SQL)
def _(t):
    good, _rejects = readers.scan_raw(t.spark, raw_files(t, 1000))
    return good.select("id", F.md5("content").alias("md5"), "content_length")


@query("scan_recent_files", RAW_SQL + " WHERE lang <> 'en'")
def _(t):
    """The files of English documents are made a day old, so that a scan since now leaves them out."""
    path, started = scratch_path(t.spark, "raw"), time.time()
    for part in ("lang = 'en'", "lang <> 'en'"):
        writers.write_raw(t.raw.where(part).drop("ord", "source", "lang"), path, 1000)
        if part == "lang = 'en'":
            set_age(t.spark, path, started - 86_400)
    good, _rejects = readers.scan_raw(t.spark, path, since=started)
    return good.select("id", F.md5("content").alias("md5"), "content_length")


def set_age(spark, folder, seconds):
    """Date all files of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), int(seconds * 1000), -1)


@query("sink_raw_batches", RAW_SQL)
def _(t):
    rows = t.spark.read.schema(readers.schemas.RAW).json(raw_files(t))
    return rows.select("id", F.md5("content").alias("md5"), "content_length")


def cleaned(t):
    body = T.strip("content")
    return t.raw.select(
        "id", F.col("url").alias("original_url"), "domain", "title", T.clean_content(body).alias("content"),
        F.col("lang").alias("language"), F.lit(1.0).alias("language_confidence"), S.quality_score(body).alias("quality_score"),
        F.length(body).alias("content_length"), T.estimate_tokens(body).alias("token_estimate"), "content_hash",
        F.lit(None).cast("string").alias("duplicate_hash"), "timestamp", F.lit("web_crawl").alias("source"),
        F.lit("unknown").alias("license"), F.array().cast("array<string>").alias("tags"))


@query("sink_cleaned_jsonl", CLEANED_SQL)
def _(t):
    path = scratch_path(t.spark, "cleaned")
    writers.write_cleaned(cleaned(t), path)
    rows = readers.scan_cleaned(t.spark, path)
    return rows.select("id", F.md5("content").alias("md5"), "language", "token_estimate")


@query("scan_cleaned_jsonl", "SELECT CAST(doc_id AS VARCHAR) AS id, 'unknown' AS language, 0.5::DOUBLE AS quality_score, 0 AS content_length, md5(text) AS md5 FROM documents")
def _(t):
    path = scratch_path(t.spark, "cleaned")
    writers.write_cleaned(t.raw.select("id", "content"), path)
    return readers.scan_cleaned(t.spark, path).select("id", "language", "quality_score", "content_length", F.md5("content").alias("md5"))


TOKENS = f"CAST({C.count('body', T.WORD)} + {C.count('body', T.STOPS)} AS INTEGER)"


@query("sink_manifest", f"""WITH {C.SCORED} SELECT CAST(doc_id AS VARCHAR) AS id, 'web_crawl' AS source, lang AS language, round(q, 6) AS quality_score,
  {TOKENS} AS tokens, 'unknown' AS license, '{RUN_TS}' AS timestamp FROM scored""")
def _(t):
    path = scratch_path(t.spark, "manifest")
    writers.write_manifest(cleaned(t), path)
    rows = t.spark.read.schema("id string, source string, language string, quality_score double, tokens int, license string, timestamp string").json(path)
    return rows.withColumn("quality_score", F.round("quality_score", 6))


@query("sink_stats_csv", f"""WITH {C.SCORED} SELECT CAST(doc_id AS VARCHAR) AS id, 'https://' || source || '.example.com/' || doc_id AS original_url,
  source || '.example.com' AS domain, 'No Title' AS title, md5({C.clean('body')}) AS md5, lang AS language, 1.0::DOUBLE AS language_confidence,
  round(q, 6) AS quality_score, CAST(len AS INTEGER) AS content_length, {TOKENS} AS token_estimate, sha256(text) AS content_hash, '' AS duplicate_hash,
  '{RUN_TS}' AS timestamp, 'web_crawl' AS source, 'unknown' AS license, '[]' AS tags FROM scored""")
def _(t):
    path = scratch_path(t.spark, "stats")
    writers.write_stats_csv(cleaned(t), path)
    rows = t.spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    numbers = {"language_confidence": "double", "quality_score": "double", "content_length": "int", "token_estimate": "int"}
    rows = rows.withColumns({c: F.col(c).cast(kind) for c, kind in numbers.items()})
    return rows.withColumns({"md5": F.md5("content"), "quality_score": F.round("quality_score", 6),
                             "duplicate_hash": F.coalesce("duplicate_hash", F.lit(""))}).drop("content")


def shard_files(t):
    path = scratch_path(t.spark, "shards")
    rows = sharded(t)
    writers.write_shards(rows, path)
    return path


_SHARD_ROWS = f"WITH {SHARDED} SELECT CAST(doc_id AS VARCHAR) AS doc_id, split, shard_id, CAST(n AS INTEGER) AS token_count, md5(array_to_string(tokens, ',')) AS md5 FROM ranked"


# every file with the tokens it holds, in the order it holds them
@query("sink_parquet_shards", f"""WITH {SHARDED} SELECT split, shard_id, count(*) AS rows, sum(n)::BIGINT AS tokens,
  md5(string_agg(doc_id || ':' || array_to_string(tokens, ','), ';' ORDER BY position)) AS md5 FROM ranked GROUP BY split, shard_id""")
def _(t):
    rows = readers.scan_shards(t.spark, shard_files(t)).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    row = F.struct("at", F.concat_ws(":", "doc_id", F.array_join("tokens", ",")).alias("row"))
    held = rows.groupBy("file", "split", "shard_id").agg(  # a shard's size is a parameter
        F.count("*").alias("rows"), F.sum("token_count").alias("tokens"), F.array_sort(F.collect_list(row))["row"].alias("all"))
    return held.select("split", "shard_id", "rows", "tokens", F.md5(F.array_join("all", ";")).alias("md5"))


@query("scan_shards", _SHARD_ROWS)
def _(t):
    rows = readers.scan_shards(t.spark, shard_files(t))
    return rows.select("doc_id", "split", "shard_id", "token_count", F.md5(F.array_join("tokens", ",")).alias("md5"))


@query("sink_shard_meta", f"WITH {SHARDED} SELECT split, shard_id, count(*) AS total_documents, sum(n)::BIGINT AS total_tokens, true AS sized FROM ranked GROUP BY ALL")
def _(t):
    path, out = scratch_path(t.spark, "shards"), scratch_path(t.spark, "meta")
    rows = sharded(t)
    writers.write_shards(rows, path)
    writers.write_shard_meta(rows, path, out, RUN_TS)
    meta = t.spark.read.schema("split string, shard_id string, total_documents bigint, total_tokens bigint, file_size_mb double").json(out)
    return meta.select("split", "shard_id", "total_documents", "total_tokens", (F.col("file_size_mb") > 0).alias("sized"))


def manifest_rows(t):
    path = scratch_path(t.spark, "manifests")
    writers.write_split_manifest(sharded(t), path, RUN_TS)
    return readers.scan_manifest(t.spark, path)


@query("sink_split_manifest", f"""WITH {SHARDED}, s AS (SELECT split, shard_id, count(*) AS d, sum(n)::BIGINT AS k FROM ranked GROUP BY ALL)
SELECT split, '1.0' AS version, '{RUN_TS}' AS created_at, count(*) AS total_shards, sum(d)::BIGINT AS total_documents, sum(k)::BIGINT AS total_tokens,
  string_agg(shard_id || ':' || d || ':' || k, ',' ORDER BY shard_id) AS shards FROM s GROUP BY split""")
def _(t):
    path = scratch_path(t.spark, "manifests")
    writers.write_split_manifest(sharded(t), path, RUN_TS)
    rows = t.spark.read.schema(readers.schemas.SPLIT_MANIFEST).option("multiLine", True).json(path)
    shards = F.transform("shards", lambda s: F.concat_ws(":", s["shard_id"], s["documents"], s["tokens"]))
    return rows.withColumn("shards", F.array_join(shards, ","))


@query("scan_split_manifest", f"WITH {SHARDED} SELECT shard_id, count(*) AS documents, sum(n)::BIGINT AS tokens FROM ranked GROUP BY split, shard_id")
def _(t):
    return manifest_rows(t).select("shard_id", "documents", "tokens")


@query("sink_documents_table", "SELECT CAST(doc_id AS VARCHAR) AS id, source || '.example.com' AS domain, lang AS language, CAST(length(text) AS INTEGER) AS content_length FROM documents")
def _(t):
    path = scratch_path(t.spark, "documents")
    rows = t.raw.withColumn("language", F.col("lang"))
    writers.insert_absent(rows.where("lang <> 'en'"), "documents", path)
    table = writers.insert_absent(rows, "documents", path)  # the rest; what is there stays
    return table.select("id", "domain", "language", "content_length")


# -- versions -------------------------------------------------------------------------------------

def snapshot(t):
    return t.raw.select("id", "content_hash", F.length("content").alias("content_length"),
                                     T.estimate_tokens("content").alias("token_count"), F.col("lang").alias("language"), "source")


def store(t):
    """Three versions: English only, all languages, and a named one without English."""
    s = V.VersionStore(t.spark, scratch_path(t.spark, "store"))
    rows = staged(snapshot(t), "snapshot")  # texts are read once for the three
    V.create_version(s, "English", rows.where("language = 'en'"), "2024-01-01T00:00:00")
    V.create_version(s, "all languages", rows, "2024-01-02T00:00:00")
    V.save_version(s, "rest", "without English", rows.where("language <> 'en'"), "2024-01-03T00:00:00")
    return s


_TOK = f"({C.count('text', T.WORD)} + {C.count('text', T.STOPS)})"
_V = f"""v AS (SELECT '1.0' AS version, '2024-01-01T00:00:00' AS created_at, 'English' AS description, count(*)::DOUBLE AS docs, sum({_TOK})::DOUBLE AS tokens FROM documents WHERE lang = 'en'
  UNION ALL SELECT '1.1', '2024-01-02T00:00:00', 'all languages', count(*), sum({_TOK}) FROM documents
  UNION ALL SELECT 'rest', '2024-01-03T00:00:00', 'without English', count(*), sum({_TOK}) FROM documents WHERE lang <> 'en')"""


@query("create_version", f"WITH {_V} SELECT version, description, docs, tokens FROM v")
def _(t):
    return store(t).versions.select("version", "description", F.col("statistics")["total_docs"].alias("docs"), F.col("statistics")["total_tokens"].alias("tokens"))


@query("save_version", f"WITH {_V} SELECT version, description, docs FROM v WHERE version = 'rest'")
def _(t):
    return V.get_version(store(t), "rest").select("version", "description", F.col("statistics")["total_docs"].alias("docs"))


@query("list_versions", f"WITH {_V} SELECT version, created_at, description FROM v")
def _(t):
    return V.list_versions(store(t))


@query("current_version", f"WITH {_V} SELECT arg_max(version, created_at) AS version FROM v")
def _(t):
    return V.current_version(store(t))


@query("newest_version", "SELECT max(source) AS name FROM documents")
def _(t):
    return V.newest_version(t.documents.select(F.col("source").alias("name")))


@query("get_version", f"WITH {_V} SELECT version, docs FROM v WHERE version = '1.0'")
def _(t):
    return V.get_version(store(t), "1.0").select("version", F.col("statistics")["total_docs"].alias("docs"))


@query("load_version", "SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS content_hash FROM documents WHERE lang <> 'en'")
def _(t):
    return V.load_version(store(t), "rest").select("id", "content_hash")


@query("export_version", "SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS content_hash FROM documents WHERE lang = 'en'")
def _(t):
    out = scratch_path(t.spark, "export")
    V.export_version(store(t), "1.0", out)
    return t.spark.read.parquet(f"{out}/documents").select("id", "content_hash")


_TREE = """h AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY ALL),
d5 AS (SELECT h[1:5] AS prefix, sha256(string_agg(h || ':' || n, ',' ORDER BY h)) AS digest, sum(n)::BIGINT AS n FROM h GROUP BY ALL),
d2 AS (SELECT prefix[1:2] AS prefix, sha256(string_agg(prefix || ':' || digest, ',' ORDER BY prefix)) AS digest, sum(n)::BIGINT AS n FROM d5 GROUP BY prefix[1:2]),
d0 AS (SELECT '' AS prefix, sha256(string_agg(prefix || ':' || digest, ',' ORDER BY prefix)) AS digest, sum(n)::BIGINT AS n FROM d2)"""


@query("digest_tree", f"WITH {_TREE} SELECT 5 AS level, * FROM d5 UNION ALL SELECT 2, * FROM d2 UNION ALL SELECT 0, * FROM d0")
def _(t):
    return V.digest_tree(t.raw.groupBy("content_hash").agg(F.count("*").alias("n")))


@query("version_diff", """SELECT sha256(text) AS content_hash, 'added' AS change, 1::BIGINT AS n FROM documents WHERE lang = 'en'
UNION ALL SELECT sha256(text), 'removed', 1 FROM documents WHERE lang <> 'en'""")
def _(t):
    return V.version_diff(store(t), "rest", "1.0")


@query("dataset_checksum", f"WITH {_TREE} SELECT digest AS checksum FROM d0")
def _(t):
    return V.dataset_checksum(t.raw.select("content_hash"))


_CMP = f"""{_V}, m AS (SELECT version, 'total_docs' AS metric, docs AS x FROM v UNION ALL SELECT version, 'total_tokens', tokens FROM v),
c AS (SELECT metric, a.x AS v1, b.x AS v2, b.x - a.x AS diff FROM m a JOIN m b USING (metric) WHERE a.version = '1.0' AND b.version = '1.1')"""


@query("compare_versions", f"""WITH {_CMP} SELECT metric, v1, v2, diff, round(CASE WHEN v1 = 0 THEN 0 ELSE diff / v1 * 100 END, 6) AS pct_change FROM c""")
def _(t):
    both = V.compare_versions(store(t), "1.0", "1.1").where("kind = 'statistics'")
    return both.select("metric", "v1", "v2", "diff", F.round("pct_change", 6).alias("pct_change"))


@query("compare_counts", f"WITH {_CMP} SELECT metric, v1, v2, diff FROM c")
def _(t):
    return V.compare_counts(store(t), "1.0", "1.1")


@query("key_union", f"WITH {_CMP} SELECT DISTINCT metric FROM m")
def _(t):
    s = store(t)
    return V.key_union(V.get_version(s, "1.0"), V.get_version(s, "rest"))


@query("version_diff_docs", """WITH o AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE lang <> 'fr'),
n AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE lang <> 'de')
SELECT coalesce(o.h, n.h) AS content_hash, CASE WHEN o.h IS NULL THEN 'added' WHEN n.h IS NULL THEN 'removed' ELSE 'unchanged' END AS change FROM o FULL JOIN n ON o.h = n.h""")
def _(t):
    return V.version_diff_docs(t.raw.where("lang <> 'fr'"), t.raw.where("lang <> 'de'"))


def trained_store(t):
    s = store(t)
    V.mark_trained(s, RUN_TS, "1.0")
    V.mark_trained(s, RUN_TS)
    V.mark_trained(s, RUN_TS, "1.0")
    return s


@query("mark_trained", f"WITH {_V} SELECT version, version <> '1.1' AS trained FROM v")
def _(t):
    return V.with_trained(trained_store(t)).select("version", "trained")


@query("unique_trained", f"WITH {_V} SELECT version AS name FROM v WHERE version <> '1.1'")
def _(t):
    return V.unique_trained(trained_store(t))


@query("untrained_versions", f"WITH {_V} SELECT version, created_at, docs::BIGINT AS docs, tokens::BIGINT AS tokens FROM v WHERE version = '1.1'")
def _(t):
    return V.untrained_versions(trained_store(t))


@query("trainable_versions", f"WITH {SHARDED} SELECT lang AS version, count(DISTINCT shard_id) AS train_shards FROM ranked WHERE split = 'train' GROUP BY lang")
def _(t):
    return V.trainable_versions(sharded(t).withColumn("version", F.col("language")))


@query("version_report", f"""WITH {SHARDED}, n AS (SELECT (SELECT count(*) FROM documents) AS raw, (SELECT count(*) FROM documents WHERE length({C.strip('text')}) >= 500) AS kept,
  count(*) FILTER (split = 'train') AS td, sum(n) FILTER (split = 'train') AS tt, count(*) FILTER (split = 'val') AS vd, sum(n) FILTER (split = 'val') AS vt FROM ranked)
SELECT unnest(range(8))::INTEGER AS line_no, unnest(['Dataset Version: v1', 'Raw Documents: ' || raw, 'Cleaned Documents: ' || kept,
  'Filter Rate: ' || printf('%.1f', round((raw - kept) * 100.0::DOUBLE / raw, 1)) || '%', 'Training Documents: ' || td, 'Training Tokens: ' || tt,
  'Validation Documents: ' || vd, 'Validation Tokens: ' || vt]) AS line FROM n""")
def _(t):
    kept = t.raw.where(F.length(T.strip("content")) >= 500)
    return V.version_report(t.raw, kept, sharded(t), "v1")


@query("dataset_summary", f"""WITH {SHARDED} SELECT 'rest' AS current_version, (SELECT greatest(3, count(DISTINCT source)) FROM documents) AS total_versions,
  count(*) AS total_documents, sum(n)::BIGINT AS total_tokens, count(*) FILTER (split = 'train') AS train_documents, sum(n) FILTER (split = 'train')::BIGINT AS train_tokens,
  count(*) FILTER (split = 'val') AS val_documents, sum(n) FILTER (split = 'val')::BIGINT AS val_tokens FROM ranked""")
def _(t):
    backups = t.documents.select(F.col("source").alias("name")).distinct()
    return stats.dataset_summary(sharded(t), store(t).versions, backups)


# -- jobs -----------------------------------------------------------------------------------------

_EV = """ev AS (SELECT event_id, 'job_' || user_id AS job_id, ['crawl', 'process', 'tokenize'][user_id % 3 + 1] AS type,
  CASE event_type WHEN 'signup' THEN 'queued' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
  least(value / 100, 1) AS progress, event_type AS message, ts, props FROM events),
jobs AS (SELECT job_id, type, min(ts) AS created_at, max(ts) AS updated_at, arg_max(status, (ts, event_id)) AS status,
  arg_max(progress, (ts, event_id)) AS progress, arg_max(message, (ts, event_id)) AS message FROM ev GROUP BY job_id, type)"""


@query("job_latest_status", f"WITH {_EV} SELECT job_id, status, round(progress, 6) AS progress, message FROM jobs WHERE job_id IN (SELECT job_id FROM ev WHERE status = 'queued')")
def _(t):
    known = t.job_events.where("status = 'queued'")
    return jobs.job_latest_status(t.job_events, known).select("job_id", "status", F.round("progress", 6).alias("progress"), "message")


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"


@query("jobs_by_recency", f"WITH {_EV} SELECT job_id, type, status, {_STAMP.format('created_at')} FROM jobs")
def _(t):
    return jobs.jobs_by_recency(t.jobs).select("job_id", "type", "status", stamp("created_at"))


@query("recent_jobs_topk", f"WITH {_EV}, top AS (SELECT * FROM jobs ORDER BY created_at DESC, job_id LIMIT 10) SELECT job_id, status, {_STAMP.format('created_at')} FROM top")
def _(t):
    return jobs.recent_jobs_topk(t.jobs).select("job_id", "status", stamp("created_at"))


@query("job_status_counts", f"WITH {_EV} SELECT type, status, count(*) AS jobs FROM jobs GROUP BY type, status")
def _(t):
    return jobs.job_status_counts(t.jobs)


@query("job_params", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 2048 AS max_length, 0.05::DOUBLE AS val_split, 'dataset/raw' AS raw_dir FROM events")
def _(t):
    given = {"k": 0, "max_length": 2048, "val_split": 0.05, "raw_dir": "dataset/raw"}
    return jobs.job_params(t.job_events.select("event_id", "params"), defaults=given).drop("params")


@query("sink_jobs_table", f"""WITH {_EV} SELECT job_id AS id, type AS job_type, status, round(CAST(progress AS FLOAT)::DOUBLE, 4) AS progress, message,
  {_STAMP.format('created_at')}, {_STAMP.format('updated_at')} FROM jobs""")
def _(t):
    path = scratch_path(t.spark, "jobs-table")
    rows = t.jobs.withColumnsRenamed({"job_id": "id", "type": "job_type"})
    writers.insert_absent(rows.where("status = 'queued'"), "jobs", path)
    table = writers.insert_absent(rows, "jobs", path)
    return table.select("id", "job_type", "status", F.round(F.col("progress").cast("double"), 4).alias("progress"), "message",
                        stamp("created_at"), stamp("updated_at"))


@query("sink_versions_table", f"WITH {_V} SELECT version, description, docs, {_STAMP.format('created_at').replace('strftime(created_at', 'strftime(CAST(created_at AS TIMESTAMP)')}, 64 AS checksum_digits FROM v")
def _(t):
    path = scratch_path(t.spark, "versions-table")
    rows = store(t).versions.withColumn("statistics", F.to_json("statistics"))
    table = writers.insert_absent(rows.select("version", "description", "statistics", "checksum", "created_at"), "dataset_versions", path)
    return table.select("version", "description", F.get_json_object("statistics", "$.total_docs").cast("double").alias("docs"),
                        stamp("created_at"), F.length("checksum").alias("checksum_digits"))


@query("cleaned_rejects", "SELECT 'no_id' AS reason, count(*) AS lines FROM documents WHERE lang = 'fr'")
def _(t):
    path = scratch_path(t.spark, "cleaned")
    nameless = F.when(F.col("lang") != "fr", F.col("id")).alias("id")
    writers.write_cleaned(t.raw.select(nameless, "content"), path)
    return readers.cleaned_rejects(t.spark, path).groupBy("reason").agg(F.count("*").alias("lines"))


# -- streams --------------------------------------------------------------------------------------

def doc_stream(t):
    return t.stream("documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.sha2("text", 256).alias("content_hash"))


@query("stream_ingest_clean", f"WITH {C.DOCS} SELECT CAST(doc_id AS VARCHAR) AS id, md5({C.clean('body')}) AS md5, CAST({C.count('body', T.WORD)} + {C.count('body', T.STOPS)} AS INTEGER) AS token_estimate FROM docs WHERE length(body) BETWEEN 500 AND 100000")
def _(t):
    out = scratch_path(t.spark, "clean-stream")
    ingest.stream_ingest_clean(doc_stream(t), out, scratch_path(t.spark, "stream-state")).awaitTermination()
    rows = writers.read_stream_output(t.spark, out, "id string, content string, token_estimate int")
    return rows.select("id", F.md5("content").alias("md5"), "token_estimate")


@query("stream_dedup", "SELECT DISTINCT sha256(text) AS content_hash FROM documents")
def _(t):
    out = scratch_path(t.spark, "dedup-stream")
    firsts = ingest.stream_dedup(doc_stream(t))
    firsts.select("content_hash").writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", scratch_path(t.spark, "stream-state")).trigger(availableNow=True).start(out).awaitTermination()
    return writers.read_stream_output(t.spark, out, "content_hash string")


@query("periodic_flush", "SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS content_hash FROM documents")
def _(t):
    out = scratch_path(t.spark, "flush-stream")
    ingest.periodic_flush(doc_stream(t), out, scratch_path(t.spark, "stream-state")).awaitTermination()
    return writers.read_stream_output(t.spark, out, "id string, content_hash string", "json")


@query("stream_metrics_window", "SELECT strftime(time_bucket(INTERVAL '10 seconds', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS reason, count(*) AS docs FROM events GROUP BY ALL")
def _(t):
    out = scratch_path(t.spark, "metrics-stream")
    arriving = t.stream("events").select("ts", F.col("event_type").alias("reason"))

    def keep_latest(batch, number):
        batch.write.mode("overwrite").parquet(out)

    ingest.metrics_window(arriving).writeStream.outputMode("complete").option(
        "checkpointLocation", scratch_path(t.spark, "stream-state")).foreachBatch(keep_latest).trigger(availableNow=True).start().awaitTermination()
    counts = writers.read_stream_output(t.spark, out, "window_start timestamp_ntz, reason string, docs bigint")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "reason", "docs")


# every tenth event comes after the others, an hour's watermark behind the newest
_LATE = """m AS (SELECT max(ts) - INTERVAL '1 hour' AS mark FROM events WHERE event_id % 10 <> 0),
w AS (SELECT time_bucket(INTERVAL '10 seconds', ts) AS s, event_type, count(*) AS docs FROM events WHERE event_id % 10 <> 0 GROUP BY ALL)"""


@query("stream_metrics_late", f"""WITH {_LATE} SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS reason, docs
FROM w, m WHERE s + INTERVAL '10 seconds' <= mark""")
def _(t):
    out, arriving, checkpoint = (scratch_path(t.spark, name) for name in ("windows-stream", "arriving", "stream-state"))
    rows = t.events.select("event_id", "ts", F.col("event_type").alias("reason"))
    for part in (rows.where("event_id % 10 <> 0"), rows.where("event_id % 10 = 0")):
        part.write.mode("append").parquet(arriving)
        ingest.stream_metrics(t.spark.readStream.schema(rows.schema).parquet(arriving), out, checkpoint, "1 hour").awaitTermination()
    windows = writers.read_stream_output(t.spark, out, "window_start timestamp_ntz, reason string, docs bigint")
    return windows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "reason", "docs")


@query("stream_ingest_judged", f"""WITH {C.SCORED} SELECT CAST(doc_id AS VARCHAR) AS id, md5({C.clean('body')}) AS md5, lang AS language,
  round(q, 6) AS quality_score FROM judged WHERE reason0 IS NULL""")
def _(t):
    out = scratch_path(t.spark, "judged-stream")
    ingest.stream_ingest_clean(doc_stream(t), out, scratch_path(t.spark, "stream-state"), profiles=profiles(t)).awaitTermination()
    rows = writers.read_stream_output(t.spark, out, "id string, content string, language string, quality_score double")
    return rows.select("id", F.md5("content").alias("md5"), "language", F.round("quality_score", 6).alias("quality_score"))


@query("stream_dedup_similar", f"""WITH RECURSIVE {C.similar_sets()}, {C.GREEDY}
SELECT doc_id FROM documents EXCEPT SELECT b FROM gone""")
def _(t):
    """The documents arrive in two parts, smaller ids first; the second meets the first one's survivors as state."""
    arriving, checkpoint = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "stream-state")
    seen = state.SeenDocuments(t.spark, scratch_path(t.spark, "seen"), "doc_id", "text", id_type="bigint")
    middle = t.documents.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0] or 0
    docs = t.documents.select("doc_id", "text")
    for part in (docs.where(F.col("doc_id") <= middle), docs.where(F.col("doc_id") > middle)):
        part.write.mode("append").parquet(arriving)
        seen.run(t.spark.readStream.schema(docs.schema).parquet(arriving), checkpoint).awaitTermination()
        remove(t.spark, arriving)  # taken: the checkpoint knows its files
    return seen.survivors("doc_id bigint, text string").select("doc_id")


JOB_ROWS = "job_id string, status string, progress double, message string, updated_at timestamp_ntz, event_id bigint"


@query("stream_job_status", ORACLES["job_latest_status"])
def _(t):
    """Events upserted as they arrive, each batch delivered twice."""
    jobs_now = state.LatestRows(t.spark, scratch_path(t.spark, "jobs"), JOB_ROWS, "job_id", ("updated_at", "event_id"), compact=2)
    arriving = scratch_path(t.spark, "arriving")
    for half in (0, 1):
        t.events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(arriving)
        sdf = t.job_events_of(t.spark.readStream.schema(t.events.schema).parquet(arriving)).select(*(c.split()[0] for c in JOB_ROWS.split(", ")))
        for checkpoint in ("first", "again"):   # the second checkpoint has seen nothing: its batches carry the same numbers
            jobs_now.run(sdf, f"{jobs_now.path}/{checkpoint}").awaitTermination()
    known = t.job_events.where("status = 'queued'").select("job_id").distinct()
    return jobs_now.read().join(known, "job_id", "left_semi").select("job_id", "status", F.round("progress", 6).alias("progress"), "message")
