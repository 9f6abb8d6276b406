"""Registered queries and their SQL twins."""

from __future__ import annotations

from weftline.functions import text as T
from weftline.plans.tables import Tables

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register fn(tables) -> DataFrame under a name, with an equivalent SQL text if there is one."""
    def add(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# -- SQL fragments --------------------------------------------------------------------------------

def count(text, pattern):
    return f"len(regexp_extract_all({text}, '{quoted(pattern)}'))"


def quoted(pattern):
    return pattern.replace("'", "''")


def replace(text, pattern, by):
    return f"regexp_replace({text}, '{quoted(pattern)}', '{by}', 'g')"


def strip(text):
    return replace(text, f"^[{T.SPACE}]+|[{T.SPACE}]+$", "")


def clean(text):
    for pattern, by in ((f"[{T.SPACE}]+", " "), (T.URL, ""), (f"[^{T.SPACE}]+@[^{T.SPACE}]+", ""),
                        ("[.!?]{2,}", ".")):
        text = replace(text, pattern, by)
    return strip(text)


def words(text):
    return f"regexp_extract_all(lower({text}), '{T.WORD}')"


def flesch(text):
    lex = count(text, T.LEXEME)
    syl = f"greatest({count(f'lower({text})', T.VOWELS)}, {lex})"
    return (f"(206.835::DOUBLE - 1.015::DOUBLE * ({lex} / greatest(1, {count(text, T.SENTENCE)}))"
            f" - 84.6::DOUBLE * ({syl} / greatest(1, {lex})))")


def asl(text):
    return f"({count(text, f'[^.!?{T.SPACE}]+')} / ({count(text, '[.!?]+')} + 1))"


def unit(x):
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {x}))"


def entropy(src, key="doc_id", text="text"):
    """A subquery (key, e) over a relation."""
    return (f"(SELECT {key}, -sum(n / len * log2(n / len)) AS e FROM (SELECT {key}, len, ch, count(*) AS n FROM ("
            f"SELECT {key}, length({text}) AS len, unnest(string_split(lower({text}), '')) AS ch FROM {src})"
            f" GROUP BY {key}, len, ch) GROUP BY {key})")


# stripped documents
DOCS = f"docs AS (SELECT *, {strip('text')} AS body FROM documents)"

# scored documents; the detector agrees with the lang label on them
SCORED = f"""{DOCS},
scored AS (SELECT d.*, length(body) AS len,
  ({unit(flesch('body') + ' / 100')} + {unit('coalesce(e, 0) / 5')}
   + greatest(0.0::DOUBLE, 1 - abs({asl('body')} - 20) / 50)) / 3 AS q
  FROM docs d LEFT JOIN {entropy('docs', text='body')} USING (doc_id)),
judged AS (SELECT *, CASE WHEN len = 0 THEN 'empty' WHEN len < 500 THEN 'too_short'
  WHEN len > 100000 THEN 'too_long' WHEN q < 0.6 THEN 'low_quality' END AS reason0 FROM scored)"""

# word sets and the pairs that reach 0.8, walked in order
GREEDY = """
nb AS MATERIALIZED (SELECT b, list(a) AS earlier FROM edges GROUP BY b),
seq AS MATERIALIZED (SELECT b, earlier, row_number() OVER (ORDER BY b) AS rn FROM nb),
walk AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS gone
  UNION ALL SELECT s.rn, CASE WHEN len(list_filter(s.earlier, lambda x: NOT list_contains(w.gone, x))) > 0
    THEN list_append(w.gone, s.b) ELSE w.gone END FROM walk w JOIN seq s ON s.rn = w.rn + 1),
gone AS MATERIALIZED (SELECT unnest(gone) AS b FROM (SELECT gone FROM walk ORDER BY rn DESC LIMIT 1))"""


def similar_sets(src="documents", key="doc_id", text="text", threshold=0.8):
    return f"""sets AS (SELECT DISTINCT {key} AS id, unnest({words(text)}) AS w FROM {src}),
sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM sets x JOIN sets y ON x.w = y.w AND x.id < y.id GROUP BY 1, 2),
edges AS MATERIALIZED (SELECT a, b, c / (p.n + q.n - c) AS j FROM common JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b
  WHERE c / (p.n + q.n - c) >= {threshold} - 1e-12)"""


def vocab(size):
    return f"""counts AS (SELECT w AS token, count(*) AS n FROM (SELECT unnest({words('text')}) AS w FROM documents) GROUP BY w),
vocab AS (SELECT * FROM (VALUES ('<pad>', 0, 0), ('<unk>', 1, 0), ('<bos>', 2, 0), ('<eos>', 3, 0)) s(token, token_id, n)
  UNION ALL SELECT token, 3 + row_number() OVER (ORDER BY n DESC, token), n FROM (
    SELECT * FROM counts ORDER BY n DESC, token LIMIT {size - 4}))"""


def coded(size, max_length=2048, min_tokens=10):
    """vocab and toks(doc_id, lang, tokens, n)."""
    return f"""{vocab(size)},
pos AS (SELECT doc_id, lang, unnest({words('text')}) AS w, unnest(range(len({words('text')}))) AS i FROM documents),
toks AS (SELECT doc_id, lang, list(coalesce(token_id, 1) ORDER BY i) AS tokens, count(*) AS n
  FROM pos LEFT JOIN vocab ON token = w WHERE i < {max_length} GROUP BY doc_id, lang HAVING count(*) >= {min_tokens})"""


def bpe(merges, mark=""):
    """base(w, n), st(rank, l, r, c, w, s, n): each word after every merge, symbols in angle brackets; merges(rank, l, r, c). Recursive."""
    return f"""base AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT unnest({words('text')}) AS w FROM documents) GROUP BY w),
st AS (SELECT 0 AS rank, NULL::VARCHAR AS l, NULL::VARCHAR AS r, NULL::BIGINT AS c, w, '<' || array_to_string(string_split('{mark}' || w, ''), '><') || '>' AS s, n FROM base
  UNION ALL SELECT rank + 1, b.l, b.r, b.c, w, replace(s, '<' || b.l || '><' || b.r || '>', '<' || b.l || b.r || '>'), n
  FROM st, (SELECT -x.neg AS c, x.l, x.r FROM (SELECT min(struct_pack(neg := -k, l := pl, r := pr)) AS x FROM (SELECT p.l AS pl, p.r AS pr, sum(n)::BIGINT AS k FROM (SELECT n, unnest(list_transform(list_zip(y[:-2], y[2:]), lambda z: struct_pack(l := z[1], r := z[2]))) AS p
    FROM (SELECT n, string_split(s[2:-2], '><') AS y FROM st)) GROUP BY p.l, p.r)) WHERE x IS NOT NULL) b WHERE rank < {merges}),
merges AS (SELECT DISTINCT rank, l, r, c FROM st WHERE rank > 0)"""


def bpe_coded(merges, mark, max_length=2048, min_tokens=10):
    """pieces(token, token_id), btoks(doc_id, tokens, n, decoded) over bpe."""
    return f"""{bpe(merges, mark)},
letters AS (SELECT ch AS token, 3 + row_number() OVER (ORDER BY ch) AS i FROM (SELECT DISTINCT unnest(string_split('{mark}' || w, '')) AS ch FROM base)),
pieces AS (SELECT token, min(i) AS token_id FROM (SELECT * FROM letters UNION ALL SELECT l || r, 3 + (SELECT count(*) FROM letters) + rank FROM merges) GROUP BY token),
coded AS (SELECT w, list(token_id ORDER BY i) AS ids FROM (SELECT w, unnest(string_split(s[2:-2], '><')) AS token, unnest(range(len(string_split(s[2:-2], '><')))) AS i
  FROM st WHERE rank = {merges}) JOIN pieces USING (token) GROUP BY w),
said AS (SELECT doc_id, unnest({words('text')}) AS w, unnest(range(len({words('text')}))) AS i FROM documents),
btoks AS (SELECT *, len(tokens) AS n FROM (SELECT doc_id, flatten(list(ids ORDER BY i))[1:{max_length}] AS tokens, string_agg(w, ' ' ORDER BY i) AS said FROM said JOIN coded USING (w) GROUP BY doc_id)
  WHERE len(tokens) >= {min_tokens})"""


def ranked(src, key="doc_id", val=0.05, per_shard=64):
    """rank, total, split, position, shard_id over a relation; a string key like the Spark id."""
    return f"""r0 AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || {key}), CAST({key} AS VARCHAR)) AS rank,
  count(*) OVER () AS total FROM {src}),
r1 AS (SELECT *, CAST(floor(total * {val} + 1e-9) AS BIGINT) AS n_val FROM r0),
r2 AS (SELECT *, CASE WHEN rank <= n_val THEN 'val' ELSE 'train' END AS split,
  rank - 1 - CASE WHEN rank <= n_val THEN 0 ELSE n_val END AS position FROM r1),
ranked AS (SELECT *, printf('%04d', CAST(floor(position / {per_shard}) AS BIGINT)) AS shard_id FROM r2)"""
