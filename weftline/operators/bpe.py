"""Byte-pair encoding: merges learned in batches over the distinct words, and texts encoded with them.

The state of training is two tables: the distinct words, each with its count and symbols, and the counts of
three symbols in a row, which give those of pairs. A round plays merges through on the leading pairs' counts
as long as these tell for certain what comes next, applies them in one pass over the words, and adds to the
counts only the differences that the words touched give. Merging one pair after the other gives the same list.
"""

from __future__ import annotations

from collections import Counter
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators.tokenize import MAX_VOCAB, SPECIALS
from weftline.session import remove, staged_at

CANDIDATES = 1024   # leading pairs that reach the driver in a round, with the triples both of whose pairs are among them
COMPACT = 8         # rounds whose differences are summed up anew before the pair counts are written again
SPACE_MARK = "▁"    # a symbol before each word, so that decoded words have spaces between them
_TRIPLE = "left string, right string, next string, n bigint"
_ROW = "n bigint, symbols string, left string, right string, next string"


def word_symbols(df: DataFrame, col: str = "content", mark: str = "") -> DataFrame:
    """(n, symbols): each distinct word's count and its characters, behind the mark, with spaces between."""
    counts = df.select(F.explode(T.words(col)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts.select("n", F.array_join(F.split(F.concat(F.lit(mark), "token"), ""), " ").alias("symbols"))


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _counted(counts: Counter, names: list):
    """One batch of what a task has counted."""
    keys = list(zip(*counts)) or [()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys), pa.array(counts.values(), pa.int64())], names=names)


def _triples(parts: list):
    """Each adjacent pair of a word with the symbol behind it, empty at the end."""
    return zip(parts, parts[1:], [*parts[2:], ""])


def triple_counts(words: DataFrame) -> DataFrame:
    """(left, right, next, n): adjacent symbols and what follows, over all words, weighted by word count; summed in the task first."""
    def run(batches):
        counts: Counter = Counter()
        for n, symbols in _rows(batches):
            for triple in _triples(symbols.split(" ")):
                counts[triple] += n
        yield _counted(counts)

    local = words.select("n", "symbols").mapInArrow(run, _TRIPLE)
    return local.groupBy("left", "right", "next").agg(F.sum("n").alias("n"))


def _counted(counts: Counter):
    """One batch of what a task has counted."""
    keys = list(zip(*counts)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([*(pa.array(k, pa.string()) for k in keys), pa.array(counts.values(), pa.int64())], names=["left", "right", "next", "n"])


def _among(triples: DataFrame, pairs: set) -> dict:
    """(a, b, c) -> n where both (a, b) and (b, c) are among the given pairs."""
    def run(batches):
        counts: Counter = Counter()
        for a, b, c, n in _rows(batches):
            if (a, b) in pairs and (b, c) in pairs:
                counts[a, b, c] += n
        yield _counted(counts)

    local = triples.select("left", "right", "next", "n").mapInArrow(run, _TRIPLE)
    return {(r["left"], r["right"], r["next"]): r["n"] for r in local.groupBy("left", "right", "next").agg(F.sum("n").alias("n")).collect()}


def certain(ranked: list, triples: dict, floor: int, made: set) -> list:
    """The (left, right, n) that sequential merging takes next, in this order; at least one.

    `ranked` lists the leading pairs with their counts, `triples` counts the symbols in a row both of whose
    pairs are among them, and no other pair counts more than `floor`. Merges are played through on these
    numbers. What they do not tell exactly is kept as an upper bound, and the batch ends as soon as a bound
    could come next, at a pair of equal symbols, and at a merge whose symbol exists already.
    """
    exact, bound = {(a, b): n for a, b, n in ranked}, {}
    given, taken = set(exact), []
    lefts, rights = set(), set()      # parts of the merges taken
    while exact:
        pair = min(exact, key=lambda p: (-exact[p], p))
        n = exact.pop(pair)
        if taken and (n <= floor or n <= max(bound.values(), default=0)):
            break
        left, right = pair
        new = left + right
        taken.append((left, right, n))
        if left == right or new in made:
            break
        made.add(new)
        for table in (exact, bound):
            for other, m in list(table.items()):
                before, after = other[1] == left, other[0] == right
                if not before and not after:
                    continue
                row = (other[0], left, right) if before else (left, right, other[1])
                inside = {(row[0], row[1]), (row[1], row[2])} <= given and row[0] not in rights and row[2] not in lefts
                born = [p for p, on in (((other[0], new), before), ((new, other[1]), after)) if on]
                if inside and before != after:
                    shared = triples.get(row, 0)
                    table[other] = m - shared
                    if shared:
                        exact[born[0]] = shared
                else:
                    bound.update({p: min(m, n) for p in born})
                    bound[other] = m
                    exact.pop(other, None)
        lefts.add(left)
        rights.add(right)
    return taken


def merged(parts: list, chosen) -> list:
    """Symbols after merging every adjacent pair of `chosen`, from the left."""
    out, i, last = [], 0, len(parts) - 1
    while i <= last:
        if i < last and (parts[i], parts[i + 1]) in chosen:
            out.append(parts[i] + parts[i + 1])
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def _applied(words: DataFrame, chosen: list) -> DataFrame:
    """Words after the merges, and what the touched ones change in the counts of triples (rows without symbols).

    Merges that share no symbol in a row are done in one pass, the others one after the other.
    """
    passes: list = []
    for left, right in chosen:
        if not passes or any(left in (b, a + b) or right in (a, a + b) for a, b in passes[-1]):
            passes.append(set())
        passes[-1].add((left, right))

    def run(batches):
        change: Counter = Counter()
        for batch in batches:
            counts, after = [], []
            for n, symbols in zip(*(c.to_pylist() for c in batch.columns)):
                parts = new = symbols.split(" ")
                for pairs in passes:
                    new = merged(new, pairs)
                if len(new) < len(parts):
                    for triple in _triples(parts):
                        change[triple] -= n
                    for triple in _triples(new):
                        change[triple] += n
                if len(new) > 1:
                    counts.append(n)
                    after.append(" ".join(new))
            none = pa.nulls(len(after), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64()), pa.array(after, pa.string()), none, none, none], names=names)
        moved = {t: n for t, n in change.items() if n}
        keys = [pa.array(k, pa.string()) for k in zip(*moved)] or [pa.nulls(0, pa.string())] * 3
        yield pa.RecordBatch.from_arrays([pa.array(moved.values(), pa.int64()), pa.nulls(len(moved), pa.string()), *keys], names=names)

    names = ["n", "symbols", "left", "right", "next"]
    return words.select("n", "symbols").mapInArrow(run, _ROW)


def train_bpe(df: DataFrame, merges: int, col: str = "content", mark: str = "", candidates: int = CANDIDATES) -> DataFrame:
    """(rank, left, right, n): the most frequent adjacent pair after all merges before it, ties by code point.

    `n` is the pair's count when it is merged. Pairs of words weigh as often as the word occurs; pairs never
    cross words. Null texts have no words; fewer merges come out where no pair is left. The tables of past
    rounds are removed from the shared folder.
    """
    spark = df.sparkSession
    path = staged_at(word_symbols(df, col, mark).where(F.instr("symbols", " ") > 0), "words")
    base = staged_at(triple_counts(spark.read.schema("n bigint, symbols string").parquet(path)), "triples")
    rounds, found, made = [], [], set()     # rounds: tables whose differences are not in the base yet
    while len(found) < merges:
        triples = spark.read.schema(_TRIPLE).parquet(base)
        if rounds:
            triples = triples.union(spark.read.schema(_ROW).parquet(*rounds).where("left IS NOT NULL").select("left", "right", "next", "n"))
        if len(rounds) == COMPACT:
            old, base = [base, *rounds[:-1]], staged_at(triples.groupBy("left", "right", "next").agg(F.sum("n").alias("n")).where("n > 0"), "triples")
            triples = spark.read.schema(_TRIPLE).parquet(base)
            remove(spark, *old)
            rounds = []
        pairs = triples.groupBy("left", "right").agg(F.sum("n").alias("n")).where("n > 0")
        ranked = [tuple(r) for r in pairs.orderBy(F.desc("n"), "left", "right").limit(candidates).select("left", "right", "n").collect()]
        if not ranked:
            break
        floor = ranked[-1][2] if len(ranked) == candidates else 0
        batch = certain(ranked, _among(triples, {r[:2] for r in ranked}), floor, made)[:merges - len(found)]
        found += [(len(found) + i, *pair) for i, pair in enumerate(batch)]
        if len(found) < merges:
            words = spark.read.schema("n bigint, symbols string").parquet(path).where("symbols IS NOT NULL")
            after = staged_at(_applied(words, [p[:2] for p in batch]), "words")
            if not rounds:
                remove(spark, path)
            rounds.append(after)
            path = after
    remove(spark, base, path, *rounds)
    return spark.createDataFrame(found, "rank int, left string, right string, n bigint")


# -- encoding -------------------------------------------------------------------------------------

def bpe_vocab(df: DataFrame, merges: DataFrame, col: str = "content", mark: str = "", specials=SPECIALS) -> DataFrame:
    """(token, token_id): the specials, the mark, the corpus's characters by code point, then the merges by rank.

    A token that two merges make has the first one's id.
    """
    spark = df.sparkSession
    letters = df.select(F.explode(F.array_distinct(F.split(F.lower(F.col(col)), ""))).alias("token")).distinct()
    letters = letters.where(F.col("token").rlike(f"^{T.WORD}$")).union(spark.createDataFrame([(m,) for m in [mark] if m], "token string")).distinct()
    letters = [r["token"] for r in letters.orderBy("token").limit(MAX_VOCAB).collect()]
    fixed = spark.createDataFrame([(t, i) for i, t in enumerate([*specials, *letters])], "token string, token_id int")
    joined = merges.select(F.concat("left", "right").alias("token"), (F.col("rank") + len(specials) + len(letters)).alias("token_id"))
    return fixed.unionByName(joined).groupBy("token").agg(F.min("token_id").cast("int").alias("token_id"))


def encode_word(parts: list, ranks: dict) -> list:
    """Symbols of a word after all merges in the order of rank; linear in the word but for a logarithm.

    A heap holds the neighbouring pairs by rank and place. A merge only opens pairs of a later rank.
    """
    size = len(parts)
    after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
    heap: list = []

    def offer(i, j, least):
        rank = ranks.get((parts[i], parts[j]), -1)
        if rank > least:
            heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(size - 1):
        offer(i, i + 1, -1)
    while heap:
        rank, i, left, right = heappop(heap)
        j = after[i]
        if parts[i] != left or j >= size or parts[j] != right:
            continue  # one of the two has been merged since
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[j] < size:
            before[after[j]] = i
            offer(i, after[j], rank)
        if before[i] >= 0:
            offer(before[i], i, rank)
    return [p for p in parts if p is not None]


def _table(df: DataFrame, *columns) -> list:
    rows = df.select(*columns).limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"more than {MAX_VOCAB} rows")
    return rows


def bpe_tokenizer(vocab: DataFrame, merges: DataFrame, mark: str = "", unk: str = "<unk>", memo: int = 200_000):
    """Tokenizer over learned merges: the words of a text to piece ids, in Arrow batches; as operators.tokenize takes it."""
    ids = {r["token"]: r["token_id"] for r in _table(vocab, "token", "token_id")}
    ranks = {(r["left"], r["right"]): r["rank"] for r in _table(merges, "left", "right", "rank")}
    other = ids[unk]
    known: dict = {}

    def pieces(word):
        found = known.get(word)
        if found is None:
            found = np.array([ids.get(p, other) for p in encode_word([*([mark] if mark else []), *word], ranks)], np.int32)
            if len(known) < memo and len(word) < 64:
                known[word] = found
        return found

    def encode(words: pa.Array) -> pa.Array:
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        flat = words.flatten().dictionary_encode()
        each = [pieces(w) for w in flat.dictionary.to_pylist()]
        sizes = np.array([len(e) for e in each], np.int64)
        starts, code = np.cumsum(sizes) - sizes, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = sizes[code] if len(code) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])
        spot = np.repeat(starts[code] - ends[:-1], n) + np.arange(ends[-1]) if len(code) else np.zeros(0, np.int64)
        tokens = np.concatenate(each)[spot] if each else np.zeros(0, np.int32)
        lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        offsets = ends[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.int32()))

    udf = F.arrow_udf(encode, "array<int>").asNondeterministic()  # not repeated for a filter above it

    def tokenizer(content, max_length: int):
        return udf(F.slice(T.words(content), 1, max_length))

    return tokenizer


def decoder(vocab: DataFrame, mark: str = ""):
    """Column function from piece ids to text; marks become spaces."""
    tokens = {r["token_id"]: r["token"] for r in _table(vocab, "token", "token_id")}

    def decode(rows: pa.Array) -> pa.Array:
        text = ("".join(tokens[i] for i in row) if row is not None else None for row in rows.to_pylist())
        return pa.array([t.replace(mark, " ").removeprefix(" ") if t and mark else t for t in text], pa.string())

    udf = F.arrow_udf(decode, "string")
    return lambda ids: udf(T.col(ids))


def bpe_pieces(words, merges: DataFrame):
    """Pieces of each word of an array<string> column under the merges, in one flat array."""
    ranks = {(r["left"], r["right"]): r["rank"] for r in _table(merges, "left", "right", "rank")}

    def pieces(rows: pa.Array) -> pa.Array:
        return pa.array([None if row is None else [p for w in row for p in encode_word([*w], ranks)] for row in rows.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(pieces, "array<string>")(T.col(words))
