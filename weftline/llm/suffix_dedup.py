"""Repeated passages by a distributed merge sort of suffixes.

Every 50-byte string holds a gram of least hash among its 18-byte grams; those are its anchors, and equal
strings have the same ones. First the anchors that only one text holds are dropped, by hashes. The
suffixes that begin at the others are sorted where they are read, front-coded, exchanged by anchor and
merged by a loser tree. The merged order with its common prefixes, and the order of the bytes to the
left, tell which strings around an anchor are equal, and the least document that holds each.

Equal texts are worked on once. An anchor with very many suffixes is not merged in one task: its strings
are grouped by a 128-bit hash, with minima combined before they are shuffled; they travel packed, a row a
task and part of the hash, and what is known to go as a row a text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import map_rows, texts
from weftline.llm.merge_tree import merge
from weftline.session import remove, staged, staged_at

LENGTH = 50
GRAM = 18
SPAN = LENGTH - GRAM + 1      # grams of a string, and one more than the bytes before an anchor that matter
HOT = 4096                    # suffixes of one anchor that are merged in one task
CHUNK = 1 << 20
RUN = 100_000                 # suffixes a task sorts at once
LEVEL = 3                     # of compression where texts and suffixes are shuffled
BUCKET_BYTES = 4 << 20        # of text behind a bucket of anchors, on average
LEAST_BUCKETS = 16
RUN_DOCS = 2_000              # texts whose anchors a task looks through at once
HOT_BROADCAST = 1_000_000     # hot anchors that travel to every task, 8 bytes each
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(a, b):
    x = a * _P + b * _Q
    return x ^ (x >> np.uint64(29))


def _slide(x, size, best):
    """best over every `size` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


def anchors(data: bytes) -> tuple:
    """(positions, hashes) of the grams that have the least hash of some string of the text."""
    found, hashes = [], []
    for start in range(0, len(data) - LENGTH + 1, CHUNK):
        raw = np.frombuffer(data, np.uint8, min(CHUNK + LENGTH - 1, len(data) - start), start).astype(np.uint64)
        two = _join(raw[:-1], raw[1:])
        x = two
        for step in (2, 4, 8):
            x = _join(x[:-step], x[step:])
        x = _join(x[:len(raw) - GRAM + 1], two[GRAM - 2:])
        x = (x ^ (x >> np.uint64(32))) * _P
        x ^= x >> np.uint64(31)
        least = _slide(x, SPAN, np.minimum)             # of each string
        wide = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
        at = np.flatnonzero(_slide(wide, SPAN, np.maximum) == x)
        found.append(at + start)
        hashes.append(x[at])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket and 40 bits of a hash in one long."""
    return ((hashes % np.uint64(buckets)).astype(np.int64) << 40) | (hashes >> np.uint64(24)).astype(np.int64)


def _pack(*arrays) -> bytes:
    """Arrays of equal length, byte planes apart, compressed."""
    planes = b"".join(np.ascontiguousarray(a.reshape(len(a), -1).view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(blob: bytes, n: int, kinds: list) -> list:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind, width in kinds:
        size = np.dtype(kind).itemsize * width
        plane = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        at += n * size
        values = np.ascontiguousarray(plane.T).view(kind)
        out.append(values.reshape(n) if width == 1 else values.reshape(n, width))
    return out


# -- which anchors do several texts hold ----------------------------------------------------------------

def _ask(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n, blob) to compare with other tasks, and (text, key) of anchors that two texts here share."""
    def run(batch):
        seen, prints, keys = set(), [], []
        for text, data in batch:
            if text in seen:
                continue
            seen.add(text)
            prints.append(text)
            keys.append(np.unique(_keys(anchors(data)[1], buckets)))
            if len(prints) == RUN_DOCS:
                yield from questions(prints, keys)
                prints, keys = [], []
        if prints:
            yield from questions(prints, keys)

    def questions(prints, keys):
        doc = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(starts, len(key)))
        owner = np.array(prints, np.int64)[doc]
        for i in np.flatnonzero(np.repeat(count > 1, count)).tolist():
            yield None, None, None, int(owner[i]), int(key[i])
        first_key, first_owner = key[starts], owner[starts]
        bucket = first_key >> 40
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            low = first_key[a:b] & ((1 << 40) - 1)
            yield (int(bucket[a]), int(b - a), _pack(np.diff(low, prepend=0), first_owner[a:b], count[a:b].astype(np.int32)), None, None)

    return map_rows(rows, run, "bucket int, n int, blob binary, text long, key long")


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """(text, key) of lone owners whose anchor others hold too; a null text names a hot anchor."""
    parts = [_unpack(b, n, [("<i8", 1), ("<i8", 1), ("<i4", 1)]) for b, n in zip(group.blob, group.n)]
    low = np.concatenate([np.cumsum(p[0]) for p in parts])
    owner, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.argsort(low, kind="stable")
    low, owner, count = low[order], owner[order], count[order]
    starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    sizes = np.diff(np.append(starts, len(low)))
    shared = (np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)) | (np.maximum.reduceat(count, starts) > 1)
    lone = np.repeat(shared, sizes) & (count == 1)
    hot = np.add.reduceat(count.astype(np.int64), starts) > HOT
    base = int(group.bucket.iloc[0]) << 40
    return pd.DataFrame({"text": pd.array(np.concatenate([owner[lone], np.zeros(hot.sum(), np.int64)]), dtype="Int64"),
                         "key": base | np.concatenate([low[lone], low[starts][hot]]),
                         "hot": np.repeat([False, True], [lone.sum(), hot.sum()])})


def shared_anchors(rows: DataFrame, buckets: int) -> tuple[DataFrame, list]:
    """(text, codes): the keys of a text's anchors that other texts hold too, twice the key, and one more if hot; and the tables it reads."""
    read = rows.sparkSession.read
    asking = _ask(rows, buckets)
    paths = [staged_at(asking, "anchors")]
    asked = read.schema(asking.schema).parquet(paths[0])
    answers = asked.where("bucket IS NOT NULL").select("bucket", "n", "blob").groupBy("bucket").applyInPandas(
        _answer, "text long, key long, hot boolean")
    paths.append(staged_at(answers, "replies"))
    replies = read.schema(answers.schema).parquet(paths[1])
    hot = replies.where("hot").select("key", F.lit(1).alias("hot"))
    if hot.count() <= HOT_BROADCAST:
        hot = F.broadcast(hot)
    both = asked.where("bucket IS NULL").select("text", "key").union(replies.where("NOT hot").select("text", "key"))
    coded = both.join(hot, "key", "left").select("text", (F.col("key") * 2 + F.coalesce("hot", F.lit(0))).alias("code"))
    return coded.groupBy("text").agg(F.collect_set("code").alias("codes")), paths


# -- sorted runs of suffixes, merged ---------------------------------------------------------------------

_LEFT = SPAN - 1
_KINDS = [("u1", 1), ("u1", 1), ("u1", 1), ("<i8", 1), ("<i8", 1), ("<i8", 1)]


def _shared_with_last(rows: np.ndarray) -> np.ndarray:
    """Bytes each row shares with the one before it; 0 for the first."""
    differ = rows[1:] != rows[:-1]
    out = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.concatenate([[0], out]) if len(rows) else np.zeros(0, np.int64)


def _send(rows: DataFrame, buckets: int) -> DataFrame:
    """Front-coded sorted runs (bucket, n, blob, rest), packed strings of hot anchors (part, n, blob), and spans known
    to go (doc_id, text, starts, ends): a row a task and bucket, a task and part, and a text.

    Of the holders of a hot string only the least document of a task is sent on with its digest; the strings
    of the others are known to go.
    """
    def run(batch):
        held, n, least, known, waiting = [], 0, {}, {}, 0
        for doc_id, text, packed, codes in batch:
            data = zstandard.ZstdDecompressor().decompress(packed)
            at, hashes = anchors(data)
            code = _keys(hashes, buckets) * 2
            codes = np.array(codes, np.int64)
            cold, hot = np.isin(code, codes), np.isin(code + 1, codes)
            if hot.any():
                starts = np.unique((at[hot][:, None] - np.arange(SPAN)).ravel())
                gone = []
                for s in starts[(starts >= 0) & (starts <= len(data) - LENGTH)].tolist():
                    digest = xxhash.xxh3_128_digest(data[s:s + LENGTH])
                    first = least.get(digest)
                    if first is None or doc_id < first[0]:
                        least[digest] = (doc_id, text, [s])
                        if first:
                            known.setdefault(first[:2], []).extend(first[2])
                            waiting += len(first[2])
                    elif first[0] < doc_id:
                        gone.append(s)
                    elif first[1] == text:
                        first[2].append(s)
                    else:  # another text of the same id: its strings stand beside the first one's
                        least.setdefault(digest + text.to_bytes(8, "little", signed=True), (doc_id, text, []))[2].append(s)
                yield from spans({(doc_id, text): gone} if gone else {})
                if len(least) > RUN:
                    yield from strings(least)
                    least = {}
                if waiting > RUN:
                    yield from spans(known)
                    known, waiting = {}, 0
            if cold.any():
                held.append((doc_id, text, data, at[cold], code[cold] >> 41))
                n += int(cold.sum())
            if n >= RUN:
                yield from runs(held)
                held, n = [], 0
        if held:
            yield from runs(held)
        yield from strings(least)
        yield from spans(known)

    def spans(known):
        for (doc_id, text), starts in known.items():
            joined = _joined(starts, [s + LENGTH for s in starts])
            yield *[None] * 5, doc_id, text, [a for a, _ in joined], [b for _, b in joined]

    def strings(least):
        cols = [(d[:16], doc, text, s) for d, (doc, text, starts) in least.items() for s in starts]
        if not cols:
            return
        digest = np.frombuffer(b"".join(c[0] for c in cols), "<u8").reshape(-1, 2)
        doc, text, start = (np.array([c[i] for c in cols], np.int64) for i in (1, 2, 3))
        part = (digest[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((digest[:, 1], digest[:, 0], part))
        digest, doc, text, start, part = digest[order], doc[order], text[order], start[order], part[order]
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(part)]):
            yield None, int(part[a]), b - a, _pack(digest[a:b], doc[a:b], text[a:b], start[a:b]), *[None] * 5

    def runs(held):
        right, left, cols = [], [], []
        for doc_id, text, data, at, bucket in held:
            raw = np.concatenate([np.zeros(_LEFT, np.uint8), np.frombuffer(data, np.uint8), np.zeros(LENGTH, np.uint8)])
            right.append(raw[(at + _LEFT)[:, None] + np.arange(LENGTH)])
            left.append(raw[(at + _LEFT - 1)[:, None] - np.arange(_LEFT)])
            cols.append((np.minimum(len(data) - at, LENGTH), np.minimum(at, _LEFT), np.full(len(at), doc_id), np.full(len(at), text), at, bucket))
        right, left = np.concatenate(right), np.concatenate(left)
        cols = [np.concatenate(c) for c in zip(*cols)]
        order = np.lexsort((np.ascontiguousarray(right).view(f"S{LENGTH}")[:, 0], cols[5]))
        right, left, cols = right[order], left[order], [c[order] for c in cols]
        cuts = np.flatnonzero(np.append(True, cols[5][1:] != cols[5][:-1])).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            part = right[a:b]
            lcp = _shared_with_last(part)
            rest = part[np.arange(LENGTH) >= lcp[:, None]].tobytes()
            blob = _pack(lcp.astype("u1"), cols[0][a:b].astype("u1"), cols[1][a:b].astype("u1"), *(cols[i][a:b].astype("<i8") for i in (2, 3, 4)))
            # whole rows of what stands to the left: copies repeat them
            yield int(cols[5][a]), None, b - a, blob, zstandard.ZstdCompressor(level=LEVEL).compress(left[a:b].tobytes() + rest), *[None] * 4

    return map_rows(rows, run, "bucket int, part int, n int, blob binary, rest binary, doc_id long, text long, starts array<long>, ends array<long>")


def _front_decoded(lcp: np.ndarray, rest: bytes) -> np.ndarray:
    """The rows of a front-coded run: a byte inside the shared prefix is that of the last row that wrote it."""
    n = len(lcp)
    out = np.zeros((n, LENGTH), np.uint8)
    out[np.arange(LENGTH) >= lcp[:, None]] = np.frombuffer(rest, np.uint8)
    numbers = np.arange(n)
    for j in range(int(lcp.max(initial=0))):
        out[:, j] = out[np.maximum.accumulate(np.where(lcp <= j, numbers, 0)), j]
    return out


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, text, start, end): what the strings around each anchor cover that a smaller document holds."""
    runs = []
    for n, blob, rest in zip(group.n, group.blob, group.rest):
        lcp, *cols = _unpack(blob, n, _KINDS)
        both = zstandard.ZstdDecompressor().decompress(rest)
        left = np.frombuffer(both, np.uint8, n * _LEFT).reshape(n, _LEFT)
        runs.append((_front_decoded(lcp.astype(np.int64), both[n * _LEFT:]), lcp, [*cols, left]))
    strings = [[x.tobytes() for x in r[0]] for r in runs]
    order, lcp = merge(strings, [r[1].tolist() for r in runs])
    order, lcp = np.array(order), np.array(lcp)
    # the i-th string taken from a run is its i-th row
    base = np.cumsum([0, *(len(r[1]) for r in runs)])[:-1]
    by_run = np.argsort(order, kind="stable")
    rows = np.empty(len(order), np.int64)
    rows[by_run] = np.concatenate([np.arange(len(r[1])) + b for r, b in zip(runs, base)])
    right_size, left_size, doc, text, at, left = (np.concatenate([r[2][i] for r in runs])[rows] for i in range(6))
    by_left = np.argsort(np.ascontiguousarray(left).view(f"S{_LEFT}")[:, 0], kind="stable")
    left_lcp = _shared_with_last(left[by_left])
    n = len(rows)
    first, last = np.full(n, -1), np.full(n, -1)   # the least and the greatest offset of a string to drop
    for o in range(SPAN):
        ok = np.flatnonzero((left_size >= o) & (right_size >= LENGTH - o))
        if len(ok) < 2:
            continue
        right_group = np.cumsum(lcp < LENGTH - o)
        left_group = np.empty(n, np.int64)
        left_group[by_left] = np.cumsum(left_lcp < o)
        key = right_group[ok] * (n + 1) + left_group[ok]
        turn = np.argsort(key, kind="stable")
        ok, key = ok[turn], key[turn]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        least = np.repeat(np.minimum.reduceat(doc[ok], starts), np.diff(np.append(starts, len(ok))))
        hit = ok[least < doc[ok]]
        first[hit] = np.where(first[hit] < 0, o, first[hit])
        last[hit] = o
    hit = np.flatnonzero(last >= 0)
    return pd.DataFrame({"doc_id": doc[hit], "text": text[hit], "start": at[hit] - last[hit], "end": at[hit] - first[hit] + LENGTH})


def _least(group: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, text, starts, ends): hot strings that a smaller document holds too, joined; a row a text."""
    cols = [_unpack(b, n, [("<u8", 2), ("<i8", 1), ("<i8", 1), ("<i8", 1)]) for b, n in zip(group.blob, group.n)]
    digest, doc, text, start = (np.concatenate([c[i] for c in cols]) for i in range(4))
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    digest, doc, text, start = digest[order], doc[order], text[order], start[order]
    firsts = np.flatnonzero(np.append(True, (digest[1:] != digest[:-1]).any(1)))
    least = np.repeat(np.minimum.reduceat(doc, firsts), np.diff(np.append(firsts, len(doc))))
    doc, text, start = doc[least < doc], text[least < doc], start[least < doc]
    order = np.lexsort((start, text, doc))
    doc, text, start = doc[order], text[order], start[order]
    other = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(np.append(len(doc) > 0, other | (start[1:] - start[:-1] > LENGTH))[:len(doc)])
    ends = np.append(begins[1:], len(doc))[:len(begins)] - 1
    rows = np.flatnonzero(np.append(len(begins) > 0, (doc[begins][1:] != doc[begins][:-1]) | (text[begins][1:] != text[begins][:-1]))[:len(begins)])
    starts, stops = (np.split(x, rows[1:]) if len(rows) else [] for x in (start[begins], start[ends] + LENGTH))
    return pd.DataFrame({"doc_id": doc[begins][rows], "text": text[begins][rows], "starts": pd.Series(starts, dtype=object), "ends": pd.Series(stops, dtype=object)})


def repeated_spans(leads: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, text, starts, ends) over (doc_id, text, packed, codes): spans to remove, overlapping ones included."""
    sent = staged(_send(leads, buckets), "runs")
    merged = sent.where("bucket IS NOT NULL").select("bucket", "n", "blob", "rest").groupBy("bucket").applyInPandas(
        _merged, "doc_id long, text long, start long, end long")
    known = sent.where("doc_id IS NOT NULL").select("doc_id", "text", "starts", "ends")
    hot = sent.where("part IS NOT NULL").select("part", "n", "blob").groupBy("part").applyInPandas(
        _least, "doc_id long, text long, starts array<long>, ends array<long>")
    return merged.select("doc_id", "text", F.array("start").alias("starts"), F.array("end").alias("ends")).union(known).union(hot)


# -- the operator -----------------------------------------------------------------------------------------

def _joined(starts, ends) -> list:
    """Maximal runs covered by any of the spans."""
    out: list = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _packed(src: DataFrame) -> DataFrame:
    """(doc_id, text, packed): the texts compressed, as they are about to be shuffled."""
    def run(rows):
        for doc_id, text, data in rows:
            yield doc_id, text, zstandard.ZstdCompressor(level=LEVEL).compress(data)

    return map_rows(src.select("doc_id", "text", "data"), run, "doc_id long, text long, packed binary")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of docs.

    A byte goes if a 50-byte string over it also starts in a document of smaller id; ids are whole
    numbers. Strings are judged on the input and never cross documents. Null texts are empty; a row with a
    null id loses nothing and takes nothing from others; rows of equal id are no copies of each other;
    other columns are ignored; an empty table gives an empty one.
    """
    src = texts(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("data")).withColumn(
        "text", F.xxhash64("data"))
    narrow = staged(src.select("doc_id", "text", F.xxhash64(F.lit(1), "data").alias("check"), F.octet_length("data").cast("long").alias("n_bytes"),
                               F.sha2("data", 256).alias("sha")), "texts")
    size = narrow.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    # equal texts: the least id stands for all
    leads = staged(narrow.where("doc_id IS NOT NULL").groupBy("text", "check").agg(F.min("doc_id").alias("lead")), "leads")
    codes, passing = shared_anchors(src.where(F.col("doc_id").isNotNull() & (F.octet_length("data") >= LENGTH)).select("text", "data"), buckets)
    chosen = leads.select(F.col("lead").alias("doc_id"), "text").distinct().join(codes, "text")
    long = _packed(src.where(F.col("doc_id").isNotNull() & (F.octet_length("data") >= LENGTH)))
    spans = repeated_spans(long.join(chosen, ["doc_id", "text"]).select("doc_id", "text", "packed", "codes"), buckets)
    remove(docs.sparkSession, *passing)  # the runs are written
    lists = spans.groupBy("doc_id", "text").agg(F.collect_list(F.struct("starts", "ends")).alias("spans")).select(
        "doc_id", "text", F.flatten("spans.starts").alias("starts"), F.flatten("spans.ends").alias("ends"))

    def cut(rows):
        for doc_id, text, packed, starts, ends in rows:
            data, gone = zstandard.ZstdDecompressor().decompress(packed), _joined(starts, ends)
            kept, at = hashlib.sha256(), 0
            for a, b in gone:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            yield doc_id, text, sum(b - a for a, b in gone), len(gone), kept.hexdigest()

    done = map_rows(long.join(lists, ["doc_id", "text"]).select("doc_id", "text", "packed", "starts", "ends"), cut, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.LongType()), T.StructField("cut", T.LongType()),
        T.StructField("cuts", T.LongType()), T.StructField("cut_sha", T.StringType())]))
    done = done.groupBy("doc_id", "text").agg(*(F.first(c).alias(c) for c in ("cut", "cuts", "cut_sha")))  # repeated rows
    copy = F.coalesce((F.col("doc_id") > F.col("lead")) & (F.col("n_bytes") >= LENGTH), F.lit(False))
    all_rows = narrow.join(leads, ["text", "check"], "left").join(done, ["doc_id", "text"], "left")
    return all_rows.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("cuts", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))
