"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers

from weftline.llm import (
    chunk_dedup, knn_join, lexical_search, lm_scoring, mixing, packing, quality_classifier, quality_rules, resampling, secrets_scan,
    simhash_dedup, suffix_dedup, token_counts,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, folder) -> DataFrame under a name, with an equivalent SQL text if there is one."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark, folder, name: str):
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


@query("op1_simhash_near_dup")
def op1(spark, folder):
    return simhash_dedup.simhash_components(table(spark, folder, "documents"))


@query("op2_pack_concat_cut")
def op2(spark, folder):
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


@query("op3_token_counts")
def op3(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), TOKENIZER)


@query("op4_quality_rules")
def op4(spark, folder):
    return quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_quality_classifier")
def op8(spark, folder):
    return quality_classifier.quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"))


# sizes, targets by closed form (k sources full, in order of what fills them first), then the two passes
MIX_SQL = """
WITH RECURSIVE sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM sized GROUP BY source),
ord AS (SELECT *, row_number() OVER (ORDER BY 2.0 * s / w, source) AS k, sum(s) OVER () AS total,
  coalesce(sum(2 * s) OVER (ORDER BY 2.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
  sum(w) OVER (ORDER BY 2.0 * s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w FROM src),
lev AS (SELECT (1.5::DOUBLE * total - filled) / open_w AS c FROM ord WHERE 2.0 * s / w > (1.5::DOUBLE * total - filled) / open_w ORDER BY k LIMIT 1),
tgt AS (SELECT source, s, least((2 * s)::DOUBLE, w * c) AS target FROM src, lev),
tgt2 AS (SELECT *, CASE WHEN s > 0 THEN target / s ELSE 0 END AS wanted FROM tgt),
p0 AS (SELECT d.doc_id, d.source, d.size, s AS source_size, target, floor(wanted)::BIGINT AS copies, target - floor(wanted) * s AS open,
  wanted - floor(wanted) AS share, (('0x' || substr(md5('0:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sized d JOIN tgt2 t ON d.source IS NOT DISTINCT FROM t.source),
q0 AS (SELECT *, share > 0 AND size > 0 AS free, (u / (1 - u)) / (share / (1 - share)) AS q FROM p0),
f1 AS (SELECT *, free AND size <= 2 * open AS fits FROM q0),
m1 AS (SELECT *, sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q, doc_id, size) AS cum FROM f1),
t1 AS (SELECT *, fits AND cum - size + size / 2.0 <= open AS take FROM m1),
f2 AS (SELECT * EXCLUDE (open, fits, cum, take, copies), copies + take::BIGINT AS copies, free AND NOT take AS again,
  open - sum(CASE WHEN take THEN size ELSE 0 END) OVER (PARTITION BY source) AS open FROM t1),
m2 AS (SELECT *, again AND size <= 2 * open AS fits,
  sum(CASE WHEN again AND size <= 2 * open THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q, doc_id, size) AS cum FROM f2)
SELECT doc_id, size, source_size, target, (copies + (fits AND cum - size + size / 2.0 <= open)::BIGINT) AS copies,
  ((copies + (fits AND cum - size + size / 2.0 <= open)::BIGINT) * size) AS taken FROM m2"""


@query("op5_mix_pareto", MIX_SQL.replace("WITH RECURSIVE", "WITH"))
def op5(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


@query("op6_voronoi_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""")
def op6(spark, folder):
    return knn_join.knn_join(table(spark, folder, "embeddings"))


@query("op7_secret_scan")
def op7(spark, folder):
    return secrets_scan.scan(table(spark, folder, "documents"), by_window=True)


@query("op9_lm_attention")
def op9(spark, folder):
    return lm_scoring.lm_scores(table(spark, folder, "documents"), TOKENIZER)


@query("op10_suffix_dedup")
def op10(spark, folder):
    return suffix_dedup.suffix_dedup(table(spark, folder, "documents"))


# crc32 by its table over the bytes of each distinct word; the tables are those of the polynomial 0xEDB88320
RESAMPLE_SQL = """
WITH tab AS (SELECT list_transform(range(256), lambda v: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v)) AS t),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
f AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY ALL),
g AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY ALL),
h AS (SELECT word, xor(list_reduce(list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT),
  lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM f UNION SELECT word FROM g), tab),
s AS (SELECT bucket, sum(n)::BIGINT AS n FROM f JOIN h USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS n FROM g JOIN h USING (word) GROUP BY bucket),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s)::DOUBLE + 10000) / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM f JOIN h USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
x AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n_features >= 20)
SELECT x.*, CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (doc_id)"""


@query("op11_importance_resample", RESAMPLE_SQL)
def op11(spark, folder):
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_exact_chunk_dedup", """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM n""")
def op12(spark, folder):
    return chunk_dedup.exact_dedup(table(spark, folder, "documents"))


SEARCH_SQL = """
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT term, doc_id, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, a GROUP BY term, docs),
m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n, a),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""


@query("op13_pipelined_search", SEARCH_SQL)
def op13(spark, folder):
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
