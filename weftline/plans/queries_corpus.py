"""Queries on whole corpora: duplicates, tokens, shards and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.config import Config, merge
from weftline.functions import scoring as S, sketch, text as T
from weftline.operators import bpe, dedup, filters, shard, stats, tokenize
from weftline.plans import catalog as C
from weftline.plans.catalog import query
from weftline.plans.corpus import clean_corpus, shard_corpus
from weftline.plans.queries_text import annotated, profiles

VOCAB = 8_000

# -- duplicates -----------------------------------------------------------------------------------

for _name, _algo, _sql in (("dedup_exact", "sha256", "sha256"), ("dedup_exact_md5", "md5", "md5")):
    query(_name, f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_sql}({C.strip('text')})")(
        lambda t, algo=_algo: dedup.dedup_exact(t.texts, "text", "doc_id", algo=algo).select("doc_id"))


@query("dedup_per_file", f"SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, sha256({C.strip('text')})")
def _(t):
    return dedup.dedup_exact(t.texts, "text", "doc_id", scope=["source"]).select("source", "doc_id")


@query("first_seen_rank", f"""SELECT doc_id, row_number() OVER (PARTITION BY sha256({C.strip('text')}) ORDER BY doc_id) = 1 AS first_seen FROM documents""")
def _(t):
    docs = t.texts
    kept = dedup.dedup_exact(docs, "text", "doc_id").select("doc_id", F.lit(True).alias("first_seen"))
    return docs.select("doc_id").join(kept, "doc_id", "left").select("doc_id", F.coalesce("first_seen", F.lit(False)).alias("first_seen"))


@query("dedup_signature")
def _(t):
    return dedup.dedup_signature(t.texts, "doc_id", col="text").select("doc_id")


@query("dedup_word_set", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY list_sort(list_distinct({C.words('text')}))")
def _(t):
    key = F.sha2(F.to_json(sketch.word_set("text")), 256)
    return dedup.keep_first(t.texts, key, "doc_id").select("doc_id")


@query("lsh_candidates")
def _(t):
    return dedup.lsh_candidates(t.texts, "doc_id", col="text")


@query("near_dup_pairs", f"""WITH RECURSIVE {C.similar_sets()}, {C.GREEDY}
SELECT min(a) AS a, b, round(arg_min(j, a), 6) AS jaccard FROM edges WHERE b IN (SELECT b FROM gone) AND a NOT IN (SELECT b FROM gone) GROUP BY b""")
def _(t):
    pairs = dedup.near_dup_pairs(t.texts, 0.8, "recall", "doc_id", "text")
    return pairs.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("dedup_lsh", f"""WITH RECURSIVE {C.similar_sets()}, {C.GREEDY}
SELECT doc_id FROM documents EXCEPT SELECT b FROM gone""")
def _(t):
    return dedup.dedup_lsh(t.texts, "doc_id", 0.8, "recall", "text").select("doc_id")


_FINGERPRINT = f"""toks AS (SELECT doc_id, tok, count(*) AS n FROM (SELECT doc_id,
  unnest(regexp_extract_all(lower(text), '[^{T.SPACE}]+')) AS tok FROM documents) GROUP BY ALL),
hashed AS (SELECT doc_id, n, ('0x' || md5(tok)[17:32])::UBIGINT AS h FROM toks),
bits AS (SELECT doc_id, i, sum(CASE WHEN (h >> i::UBIGINT) & 1 = 1 THEN n ELSE -n END) > 0 AS up
  FROM hashed, range(64) r(i) GROUP BY doc_id, i),
prints AS (SELECT doc_id, sum(CASE WHEN up THEN CASE WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i::INT) END ELSE 0 END)::BIGINT AS fp
  FROM bits GROUP BY doc_id)"""


@query("simhash64", f"WITH {_FINGERPRINT} SELECT doc_id, fp AS simhash FROM prints")
def _(t):
    return t.texts.select("doc_id", sketch.simhash64("text").alias("simhash"))


_CLOSE = f"""{_FINGERPRINT},
edges AS (SELECT p.doc_id AS a, q.doc_id AS b, bit_count(xor(p.fp, q.fp)) AS d FROM prints p JOIN prints q
  ON p.doc_id < q.doc_id AND bit_count(xor(p.fp, q.fp)) <= 3), {C.GREEDY}"""


@query("simhash_pairs", f"WITH RECURSIVE {_CLOSE} SELECT DISTINCT b FROM gone")
def _(t):
    return dedup.simhash_pairs(t.texts, "doc_id", col="text").select("b")


@query("dedup_simhash", f"WITH RECURSIVE {_CLOSE} SELECT doc_id FROM documents EXCEPT SELECT b FROM gone")
def _(t):
    return dedup.dedup_simhash(t.texts, "doc_id", col="text").select("doc_id")


# -- the whole cleaning job -----------------------------------------------------------------------

CLEAN = {"deduplication": {"mode": "exact"}}
_EXACT = f"""{C.SCORED}, first AS (SELECT min(doc_id) AS doc_id FROM judged WHERE reason0 IS NULL GROUP BY sha256(body)),
final AS (SELECT j.*, CASE WHEN reason0 IS NULL AND f.doc_id IS NULL THEN 'duplicate' ELSE reason0 END AS reason
  FROM judged j LEFT JOIN first f USING (doc_id))"""


def exactly_cleaned(t):
    return clean_corpus(t.raw, profiles(t), merge(Config(), CLEAN), "ord")


@query("clean_corpus", f"""WITH RECURSIVE {_EXACT}, kept AS (SELECT * FROM final WHERE reason IS NULL),
{C.similar_sets('kept', text='body')}, {C.GREEDY},
unique_docs AS (SELECT doc_id FROM kept EXCEPT SELECT b FROM gone)
SELECT CAST(doc_id AS VARCHAR) AS id, 'https://' || source || '.example.com/' || doc_id AS original_url, source || '.example.com' AS domain,
  {C.clean('body')} AS content, lang AS language, round(q, 6) AS quality_score, CAST(len AS INTEGER) AS content_length,
  CAST({C.count('body', T.WORD)} + {C.count('body', T.STOPS)} AS INTEGER) AS token_estimate, sha256(text) AS content_hash,
  'web_crawl' AS source, 'unknown' AS license FROM kept JOIN unique_docs USING (doc_id)""")
def _(t):
    docs = clean_corpus(t.raw, profiles(t), order_by="ord").documents
    return docs.select("id", "original_url", "domain", "content", "language", F.round("quality_score", 6).alias("quality_score"),
                       "content_length", "token_estimate", "content_hash", "source", "license")


@query("filter_duplicate", f"WITH {_EXACT} SELECT CAST(doc_id AS VARCHAR) AS id, reason FROM final")
def _(t):
    return exactly_cleaned(t).verdicts.select("id", "reason")


@query("corpus_stats", f"""WITH {_EXACT} SELECT source, count(*) AS total_docs, count(*) FILTER (reason IS NULL) AS processed_docs,
  count(reason) AS filtered_docs, count(*) FILTER (reason = 'duplicate') AS duplicate_docs,
  count(*) FILTER (reason IN ('unsupported_language', 'low_language_confidence')) AS language_filtered,
  count(*) FILTER (reason = 'low_quality') AS quality_filtered FROM final GROUP BY ROLLUP (source)""")
def _(t):
    return stats.corpus_stats(exactly_cleaned(t).verdicts)


@query("filter_counts_by_reason", f"WITH {_EXACT} SELECT reason, count(*) AS docs FROM final WHERE reason IS NOT NULL GROUP BY reason")
def _(t):
    return stats.filter_counts_by_reason(exactly_cleaned(t).verdicts)


@query("manifest_projection", f"""WITH {C.SCORED} SELECT CAST(doc_id AS VARCHAR) AS id, 'web_crawl' AS source, lang AS language, round(q, 6) AS quality_score,
  CAST({C.count('body', T.WORD)} + {C.count('body', T.STOPS)} AS INTEGER) AS tokens, 'unknown' AS license, '2024-01-01T00:00:00' AS timestamp FROM scored""")
def _(t):
    from weftline.sources.writers import manifest_projection

    body = T.strip("content")
    rows = t.raw.select("id", F.lit("web_crawl").alias("source"), F.col("lang").alias("language"), S.quality_score(body).alias("quality_score"),
                        T.estimate_tokens(body).alias("token_estimate"), F.lit("unknown").alias("license"), "timestamp")
    return manifest_projection(rows).withColumn("quality_score", F.round("quality_score", 6))


@query("quality_histogram", f"WITH {C.SCORED} SELECT CAST(least(floor(q * 10), 9) AS INTEGER) AS bin, count(*) AS docs FROM scored GROUP BY 1")
def _(t):
    return stats.quality_histogram(t.texts.select(S.quality_score(T.strip("text")).alias("quality_score")))


@query("language_distribution", "SELECT source, string_agg(lang || ':' || n, ',' ORDER BY lang) AS languages FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source")
def _(t):
    d = stats.language_distribution(t.documents.withColumnRenamed("lang", "language"), "source")
    return d.select("source", flat_map("languages").alias("languages"))


def flat_map(c):
    """A map as text in key order."""
    pairs = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return F.array_join(pairs, ",")


@query("domain_stats", f"WITH {C.SCORED} SELECT source || '.example.com' AS domain, count(*) AS docs, round(avg(q), 6) AS avg_quality FROM scored GROUP BY 1")
def _(t):
    rows = t.raw.select("domain", S.quality_score(T.strip("content")).alias("quality_score"))
    return stats.domain_stats(rows).withColumn("avg_quality", F.round("avg_quality", 6))


@query("filter_rate", f"WITH {C.DOCS} SELECT source, round((count(*) - count(*) FILTER (length(body) >= 500)) * 100.0::DOUBLE / count(*), 1) AS filter_rate FROM docs GROUP BY source")
def _(t):
    n = t.raw.groupBy("source").agg(F.count("*").alias("raw"), F.count_if(F.length(T.strip("content")) >= 500).alias("kept"))
    return n.select("source", stats.filter_rate("raw", "kept").alias("filter_rate"))


@query("balance_cap", "SELECT id FROM (SELECT CAST(doc_id AS VARCHAR) AS id, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) AS n FROM documents) WHERE n <= 20")
def _(t):
    return stats.balance_cap(t.raw.select("id", "domain"), "domain", 20).select("id")


@query("sample_documents", "SELECT CAST(doc_id AS VARCHAR) AS id, text AS content FROM documents ORDER BY md5('0:' || doc_id), CAST(doc_id AS VARCHAR) LIMIT 50")
def _(t):
    return stats.sample_documents(t.raw.select("id", "content"), 50)


@query("throughput_metrics", f"SELECT count(*) AS docs, sum({C.count('text', T.WORD)} + {C.count('text', T.STOPS)})::BIGINT AS tokens FROM documents")
def _(t):
    watched, seen = stats.throughput(t.texts.select(T.estimate_tokens("text").alias("tokens")), docs=F.count("*"), tokens=F.sum("tokens"))
    watched.agg(F.sum("tokens")).collect()  # any action; the counts come along with it
    return t.spark.createDataFrame([(seen.get["docs"], seen.get["tokens"])], "docs bigint, tokens bigint")


@query("union_files", "SELECT source, doc_id FROM documents UNION ALL SELECT 'conversations', conv_id * 1000 + turn FROM conversations")
def _(t):
    talks = t.conversations.select(F.lit("conversations").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"))
    return t.documents.select("source", "doc_id").unionByName(talks)


# -- tokens ---------------------------------------------------------------------------------------

@query("build_vocab", f"WITH {C.vocab(VOCAB)} SELECT token, CAST(token_id AS INTEGER) AS token_id, n FROM vocab")
def _(t):
    return tokenize.build_vocab(t.texts, VOCAB, col="text")


def to_code(t):
    """Documents to tokenize, and the tokenizer over their vocabulary."""
    docs = t.texts
    tokenizer = tokenize.word_vocab(tokenize.build_vocab(docs, VOCAB, col="text"))
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.col("lang").alias("language"),
                       F.lit(0.5).alias("quality_score"))
    return rows, tokenizer


def coded(t):
    return tokenize.tokenize(*to_code(t)).drop("content")


@query("tokenize", f"WITH {C.coded(VOCAB)} SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(tokens, ',') AS tokens, CAST(n AS INTEGER) AS token_count FROM toks")
def _(t):
    return coded(t).select("id", F.array_join("tokens", ",").alias("tokens"), "token_count")


@query("filter_min_tokens", f"WITH {C.DOCS} SELECT doc_id FROM docs WHERE {C.count('body', T.WORD)} >= 10")
def _(t):
    return filters.filter_min_tokens(t.texts.withColumn("tokens", T.words(T.strip("text")))).select("doc_id")


@query("attention_mask", f"WITH {C.coded(VOCAB)} SELECT CAST(doc_id AS VARCHAR) AS id, n AS ones FROM toks")
def _(t):
    return coded(t).select("id", F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("ones"))


@query("pad_truncate", f"""WITH {C.coded(VOCAB)} SELECT CAST(doc_id AS VARCHAR) AS id,
  array_to_string(list_concat(tokens[1:256], list_transform(range(256 - least(n, 256)), lambda x: 0)), ',') AS tokens, least(n, 256) AS ones FROM toks""")
def _(t):
    out = tokenize.pad_truncate(coded(t), 256)
    return out.select("id", F.array_join("tokens", ",").alias("tokens"),
                      F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("ones"))


@query("training_view", f"WITH {C.coded(VOCAB)} SELECT md5(array_to_string(tokens, ',')) AS input_ids, md5(array_to_string(tokens, ',')) AS labels, n AS ones FROM toks")
def _(t):
    v = tokenize.training_view(coded(t))
    return v.select(F.md5(F.array_join("input_ids", ",")).alias("input_ids"), F.md5(F.array_join("labels", ",")).alias("labels"),
                    F.size("attention_mask").cast("long").alias("ones"))


@query("train_bpe", f"WITH RECURSIVE {C.bpe(100)} SELECT CAST(rank - 1 AS INTEGER) AS rank, l AS \"left\", r AS \"right\", c AS n FROM merges")
def _(t):
    return bpe.train_bpe(t.texts, 100, "text")


def bpe_coder(t, merges=60):
    """Vocabulary and merges of the documents, with a mark before each word."""
    found = bpe.train_bpe(t.texts, merges, "text", bpe.SPACE_MARK)
    return bpe.bpe_vocab(t.texts, found, "text", bpe.SPACE_MARK), found


@query("tokenize_bpe", f"""WITH RECURSIVE {C.bpe_coded(60, bpe.SPACE_MARK)}
SELECT CAST(doc_id AS VARCHAR) AS id, md5(array_to_string(tokens, ',')) AS tokens, n::INTEGER AS token_count, CASE WHEN n < 2048 THEN md5(said) END AS text FROM btoks""")
def _(t):
    vocab, merges = bpe_coder(t)
    docs = t.texts.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"))
    rows = tokenize.tokenize(docs, bpe.bpe_tokenizer(vocab, merges, bpe.SPACE_MARK))
    text = F.when(F.col("token_count") < 2048, F.md5(bpe.decoder(vocab, bpe.SPACE_MARK)("tokens")))
    return rows.select("id", F.md5(F.array_join("tokens", ",")).alias("tokens"), "token_count", text.alias("text"))


# -- order, split, shards -------------------------------------------------------------------------

ORDERED = C.ranked("documents")


def ids(t):
    return t.documents.select(F.col("doc_id").cast("string").alias("id"), "source", "lang", "text")


@query("shuffle_docs", f"WITH {ORDERED} SELECT CAST(doc_id AS VARCHAR) AS id, rank FROM ranked")
def _(t):
    return shard.shuffle_docs(ids(t).select("id")).select("id", "rank")


@query("shuffle_rank", f"WITH {ORDERED} SELECT CAST(doc_id AS VARCHAR) AS id, rank, total FROM ranked")
def _(t):
    return shard.shuffle_docs(ids(t).select("id")).select("id", "rank", "total")


@query("train_val_split", f"WITH {ORDERED} SELECT CAST(doc_id AS VARCHAR) AS id, split FROM ranked")
def _(t):
    return shard.train_val_split(shard.shuffle_docs(ids(t).select("id"))).select("id", "split")


SHARD_MB = 0.125  # 64 documents of 2048 bytes


@query("assign_shards", f"WITH {ORDERED} SELECT CAST(doc_id AS VARCHAR) AS id, split, shard_id FROM ranked")
def _(t):
    split = shard.train_val_split(shard.shuffle_docs(ids(t).select("id")))
    return shard.assign_shards(split, SHARD_MB).select("id", "split", "shard_id")


_RUNNING = f"""sized AS (SELECT doc_id, {C.count('text', T.WORD)} * 8 AS bytes FROM documents),
run AS (SELECT doc_id, coalesce(sum(bytes) OVER (ORDER BY md5('0:' || doc_id), CAST(doc_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)"""


@query("assign_shards_by_bytes", f"WITH {_RUNNING} SELECT CAST(doc_id AS VARCHAR) AS id, printf('%04d', CAST(floor(before / 262144) AS BIGINT)) AS shard_id FROM run")
def _(t):
    sized = ids(t).select("id", T.count_matches("text", T.WORD).alias("token_count"))
    return shard.assign_shards_by_bytes(sized, 0.25).select("id", "shard_id")


@query("shard_running_bytes", f"WITH {_RUNNING} SELECT CAST(doc_id AS VARCHAR) AS id, CAST(before AS BIGINT) AS before FROM run")
def _(t):
    from weftline.operators.rank import ordered_totals, shuffle_key

    sized = ids(t).select("id", T.count_matches("text", T.WORD).alias("n"))
    return ordered_totals(sized, shuffle_key(0), "id", (F.col("n") * 8).cast("long")).select("id", "before")


SHARDED = f"{C.coded(VOCAB)}, {C.ranked('toks')}"


def sharded(t):
    return shard_corpus(*to_code(t), merge(Config(), {"shards": {"shard_size_mb": SHARD_MB}}))


@query("shard_stats", f"""WITH {SHARDED}, l AS (SELECT split, shard_id, lang, count(*) AS c, sum(n) AS t FROM ranked GROUP BY ALL)
SELECT split, shard_id, sum(c)::BIGINT AS documents, sum(t)::BIGINT AS tokens, string_agg(lang || ':' || c, ',' ORDER BY lang) AS languages, 0.5::DOUBLE AS avg_quality
FROM l GROUP BY split, shard_id""")
def _(t):
    return stats.shard_stats(sharded(t)).withColumn("languages", flat_map("languages"))


@query("split_manifest", f"WITH {SHARDED} SELECT split, count(DISTINCT shard_id) AS total_shards, count(*) AS total_documents, sum(n)::BIGINT AS total_tokens FROM ranked GROUP BY split")
def _(t):
    return stats.split_manifest(sharded(t))


@query("token_stats", f"""WITH {SHARDED} SELECT count(*) AS total_docs, sum(n)::BIGINT AS total_tokens, round(sum(n) / count(*), 6) AS avg_doc_length,
  (SELECT string_agg(lang || ':' || c, ',' ORDER BY lang) FROM (SELECT lang, count(*) AS c FROM toks GROUP BY lang)) AS language_dist,
  count(DISTINCT shard_id) FILTER (split = 'train') AS train_shards, count(DISTINCT shard_id) FILTER (split = 'val') AS val_shards FROM ranked""")
def _(t):
    return stats.token_stats(sharded(t)).withColumns({
        "language_dist": flat_map("language_dist"), "avg_doc_length": F.round("avg_doc_length", 6)})


@query("sorted_shards", f"WITH {SHARDED} SELECT DISTINCT split, shard_id FROM ranked")
def _(t):
    return sharded(t).select("split", "shard_id").distinct().orderBy("split", F.col("shard_id").cast("long"))


@query("doc_tokens_join", f"WITH {C.coded(VOCAB)} SELECT CAST(doc_id AS VARCHAR) AS id, source, CAST(n AS INTEGER) AS token_count FROM toks JOIN documents USING (doc_id)")
def _(t):
    manifest = ids(t).select("id", "source")
    return manifest.join(coded(t).select("id", "token_count"), "id")
